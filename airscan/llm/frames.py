"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airscan.sources.local import bounded, staged

#: The white space that separates words: space and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Words of a text, with A-Z in lower case. ``bytes.split`` splits at exactly the characters of SPACE."""
    return text.lower().split()


def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Non-empty batches only."""
    return (batch for batch in frames if batch.num_rows)


def row_key() -> tuple[Column, Column]:
    """doc_id and a hash of the text: what a row of documents is found again by."""
    return F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(whole_text()).alias("mark")


def keep_marked(documents: DataFrame, marks: DataFrame) -> DataFrame:
    """``documents`` without the rows whose mark says so; ``marks`` has doc_id, mark and ``keep`` for every row.

    Texts are moved only where more rows are dropped than can be broadcast. An identifier may stand on several equal
    rows of which one stays: such keys are both dropped and kept, and get one row back.
    """
    dropped = staged(marks.filter("not keep").select("doc_id", "mark").distinct(), "dropped")
    again = dropped.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"))
    both = (F.col("mark") == F.col("m")) & F.col("doc_id").eqNullSafe(F.col("d"))
    torn = staged(marks.filter("keep").select("doc_id", "mark").distinct().join(bounded(again), both, "left_semi"), "torn")
    whole = F.struct(*[documents[f"`{name}`"] for name in documents.columns]).alias("whole")
    keyed = documents.select(whole, F.struct(*row_key()).alias("key"))
    same = F.expr("key.mark = k.mark and key.doc_id <=> k.doc_id")
    kept = keyed.join(bounded(dropped).alias("k"), same, "left_anti")
    if not torn.isEmpty():
        repeated = keyed.join(bounded(torn).alias("k"), same, "left_semi")
        kept = kept.unionByName(
            repeated.groupBy("key").agg(F.max_by("whole", F.to_json("whole")).alias("whole")).select("whole", "key")
        )
    return kept.select("whole.*")
