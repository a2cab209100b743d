"""The sort job: merge logs, keep the strongest sighting per device, classify, split, summarise.

The deduplicated master table is written first and everything else is derived from
the written copy.  Classification is a broadcast lookup, so repeating it per output is
cheaper than storing its result, and a lost executor never causes a second dedup.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airscan.gazetteer import US_OTHER
from airscan.operators.classify import classify, classify_country_state, classify_v1_region
from airscan.operators.dedup import strongest
from airscan.operators.normalize import coerce_numbers, geolocated, keep_types
from airscan.operators.summaries import count_by, funnel, top_countries
from airscan.schema import DEFAULT_TYPES, FILE, LOG_PREHEADER, TYPE
from airscan.sources import sinks
from airscan.sources.publish import Parts
from airscan.sources.survey_csv import SurveyLogs, read_logs


def unique_devices(raw: DataFrame, types: str | Iterable[str] | None = DEFAULT_TYPES, ties=None) -> DataFrame:
    """Raw sightings to one typed row per (MAC, Type)."""
    return strongest(coerce_numbers(keep_types(raw, types)), ties=ties)


def placed_devices(unique: DataFrame, order: str = "area", states_first: bool = False) -> DataFrame:
    """Geolocated devices with country and state."""
    return classify_country_state(geolocated(unique), order, states_first)


@dataclass(frozen=True)
class SurveyJob:
    """``level`` is ``country`` (countries and US states) or ``region`` (four coarse regions).

    With ``run_id`` the outputs are published together: they lie below ``output/runs/<run_id>``, which
    :func:`airscan.sources.publish.current` names once all of them are whole. A job that died goes on where it stopped
    when it is run again under the same name.
    """

    input: str
    output: str
    types: str | tuple[str, ...] | None = DEFAULT_TYPES
    channel_summaries: bool = True
    level: str = "country"
    order: str = "area"
    states_first: bool = False
    export: bool = False
    multiline: bool = False
    strict_files: bool = False
    strict_encoding: bool = False
    na_tokens: tuple[str, ...] = ()
    preheader: str = LOG_PREHEADER
    ties: tuple[str, ...] | None = None  # SQL expressions that decide between equally strong sightings
    rows_per_export: int = sinks.ROWS_PER_EXPORT
    run_id: str | None = None

    def read(self, spark: SparkSession) -> SurveyLogs:
        return read_logs(
            spark, self.input, multiline=self.multiline, strict_files=self.strict_files,
            strict_encoding=self.strict_encoding, na_tokens=self.na_tokens,
        )

    def run(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Write all outputs below ``output`` and return the summary tables, unevaluated."""
        logs = self.read(spark)
        ties = [F.expr(text) for text in self.ties] if self.ties else None
        parts = Parts(spark, self.output, self.run_id)
        parts.write("master", lambda path: sinks.write_master(unique_devices(logs.rows, self.types, ties), path))
        master = spark.read.parquet(parts.path("master"))
        parts.write("no_gps", lambda path: sinks.write_no_gps(master, path))
        outputs = self._regions(master, parts) if self.level == "region" else self._countries(master, parts)
        if self.export:
            self._export(master, parts, "master", None)
            for placed, by, folder in outputs["splits"]:
                self._export(placed, parts, folder, by)
        parts.publish()
        summary = outputs["summary"]
        return {
            "stages": funnel(logs.rows, master, self.types, FILE),
            "types": count_by(master, TYPE),
            "rejected_files": logs.rejected_files,
            "rejected_rows": logs.rejected_rows,
            **summary,
        }

    def _export(self, df: DataFrame, parts: Parts, folder: str, by: str | None) -> None:
        parts.write(
            f"logs/{folder}",
            lambda path: sinks.export_logs(df, path, by, self.rows_per_export, self.preheader, written=True),
        )

    def _regions(self, master: DataFrame, parts: Parts) -> dict:
        placed = classify_v1_region(geolocated(master))
        parts.write("regions", lambda path: sinks.split_regions(placed, path))
        return {"splits": [(placed, "region", "regions")], "summary": {"regions": count_by(placed, "region")}}

    def _countries(self, master: DataFrame, parts: Parts) -> dict:
        placed = placed_devices(master, self.order, self.states_first)
        parts.write("countries", lambda path: sinks.split_countries(placed, path))
        # The states come from the written rows of one country; the others are not read again.
        usa = master.sparkSession.read.parquet(parts.path("countries")).filter("country = 'usa'").drop("country")
        usa = classify(usa, "us_state", self.order, "state", US_OTHER)
        parts.write("us_states", lambda path: sinks.split_states(usa, path))
        if self.channel_summaries:
            parts.write("channel_summaries", lambda path: sinks.write_channel_summaries(placed, path))
        return {
            "splits": [(placed, "country", "countries"), (usa, "state", "us_states")],
            "summary": {
                "countries": count_by(placed, "country"),
                "top_countries": top_countries(placed),
                "us_states": count_by(usa, "state"),
            },
        }
