"""Names built from a template with a counter at any place, and numbered lines of a text.

A name is cut into runs, and each run that may be a counter gives a slot: the name with ``{}`` in the run's place is the
slot's skeleton, the run's value its number. Names of one template share a skeleton and differ in the number:

* ``number``: a run of digits anywhere, e.g. ``3 cars``, ``floor 3 guest``, ``net3``. The skeleton keeps all other runs.
* ``hex``: a word of hexadecimal digits, e.g. ``cam-0f``, ``cam-10``.
* ``line``: a leading number and the rest of a text line, e.g. ``01 first words``, ``02 other words``. The skeleton is the
  separator only, as every line has another rest.

Numbers become bit masks like trailing numbers do (:mod:`airscan.operators.signals`), so slots merge by ``bit_or`` in any
order, in batch and on streams. Beside a mask stand 64 marks: of ``hex`` slots, whether a value had a letter; of ``line``
slots, a mark for the hash of each rest, so that the number of marks is never more than that of different rests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airscan.functions.text import HEX_WORD, LINE, normalize_ssid, number_block, with_slots
from airscan.operators.signals import DEFAULTS, Thresholds, run_starts, window_start, with_following
from airscan.schema import SSID

MARKS = 64


def slots(name: Column) -> Column:
    """All slots of a normalised name as an array of (kind, skeleton, digits, mark)."""

    def slot(kind: str, skeleton: Column, digits: Column, mark: Column) -> Column:
        plain = F.regexp_replace(digits, r"^0+(?=\d)", "")
        return F.struct(
            F.lit(kind).alias("kind"), skeleton.alias("skeleton"), plain.alias("digits"), mark.cast("long").alias("mark")
        )

    numbers = F.transform(with_slots(name, r"\d+"), lambda s: slot("number", s["skeleton"], s["run"], F.lit(0)))
    words = F.filter(with_slots(name, "[0-9a-z]+"), lambda s: s["run"].rlike(HEX_WORD))
    counted = F.transform(
        words, lambda s: slot("hex", s["skeleton"], F.conv(s["run"], 16, 10), s["run"].rlike("[a-f]").cast("long"))
    )
    rest = F.conv(F.substring(F.md5(F.regexp_extract(name, LINE, 3).cast("binary")), 1, 2), 16, 10).cast("int")
    line = slot(
        "line", F.concat(F.lit("{}"), F.regexp_extract(name, LINE, 2), F.lit("*")), F.regexp_extract(name, LINE, 1),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(rest, F.lit(MARKS))),
    )
    return F.concat(numbers, counted, F.when(name.rlike(LINE), F.array(line)).otherwise(F.array().cast(LINES)))


LINES = "array<struct<kind: string, skeleton: string, digits: string, mark: bigint>>"


def template_masks(df: DataFrame, keys: list[Column | str], *more: Column) -> DataFrame:
    """Masks of the numbers of every slot per key, kind and skeleton (``prefix``), the marks beside them, and more aggregates."""
    named = df.filter(F.col(SSID).rlike("[0-9]|(^|[^0-9a-zA-Z])[a-fA-F]{2}"))
    high, block, place = number_block(F.col("_slot.digits"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    return (
        named.withColumn("_slot", F.explode(slots(normalize_ssid(F.col(SSID)))))
        .groupBy(
            *keys, F.col("_slot.kind").alias("kind"), F.col("_slot.skeleton").alias("prefix"),
            high.alias("high"), block.alias("block"),
        )
        .agg(F.bit_or(bit).alias("own"), F.bit_or("_slot.mark").alias("marks"), *more)
    )


def template_names(masks: DataFrame, keys: list[str], limits: Thresholds = DEFAULTS) -> DataFrame:
    """Distinct numbers and run starts per key, kind and skeleton.

    A ``number`` trips by many numbers or one run, as trailing numbers do. Random hexadecimal endings are common in honest
    names, so ``hex`` trips by a run only, of which one value has a letter. ``line`` trips by a longer run with as many
    different rests.
    """
    followed = with_following(masks, [*keys, "kind"], max(limits.min_run, limits.min_lines), F.bit_or("marks").alias("marks"))
    starts = F.when(F.col("kind") == "line", run_starts(F.col("words"), limits.min_lines)).otherwise(
        run_starts(F.col("words"), limits.min_run)
    )
    found = followed.groupBy(*keys, "kind", "prefix").agg(
        F.sum(F.bit_count(F.get("words", F.lit(0)))).cast("long").alias("n_numbers"),
        F.sum(starts).cast("long").alias("n_run_starts"),
        F.bit_count(F.bit_or("marks")).cast("long").alias("n_marks"),
    )
    run = F.col("n_run_starts") >= 1
    tripped = (
        F.when(F.col("kind") == "number", run | (F.col("n_numbers") >= limits.min_numbers))
        .when(F.col("kind") == "hex", run & (F.col("n_marks") >= 1))
        .otherwise(run & (F.col("n_marks") >= limits.min_lines - 1))
    )
    return found.withColumn("tripped", tripped)


def templates(df: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Template score per log, time window, kind and skeleton."""
    keys = [log, "window_start"]
    windowed = df.withColumn("window_start", window_start(size=limits.window))
    return template_names(template_masks(windowed, keys), keys, limits)
