"""Canned-phrase matching of network names."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airscan.functions.text import normalize_ssid
from airscan.schema import SSID
from airscan.sources.local import small_table

PHRASE_SCHEMA = pa.schema([("pack", pa.string()), ("phrase", pa.string())])


def phrase_list(spark: SparkSession, rows: Iterable[tuple[str, str]]) -> DataFrame:
    """(pack, phrase) pairs as a table."""
    return small_table(spark, rows, PHRASE_SCHEMA)


def match_phrases(df: DataFrame, phrases: DataFrame, how: str = "left", ssid: str = SSID) -> DataFrame:
    """Add ``phrase`` (normalised) and ``pack`` of the phrase a name equals.

    ``how`` is ``left`` to keep every sighting, ``inner`` for hits only, ``left_semi`` /
    ``left_anti`` to filter.  The list has one row per phrase, so no sighting is
    multiplied; Spark broadcasts it only while its size is below the session's
    broadcast threshold, and otherwise splits hot names by the skew join.
    """
    phrase = normalize_ssid(F.col("phrase"))
    lookup = (
        phrases.select(phrase.alias("phrase"), "pack")
        .groupBy("phrase")
        .agg(F.array_join(F.array_sort(F.collect_set("pack")), "|").alias("pack"))
    )
    return df.join(lookup, normalize_ssid(F.col(ssid)) == F.col("phrase"), how)


# -- phrases inside names -----------------------------------------------------

SLOT = "{}"


def words_of(name: Column) -> Column:
    return F.filter(F.split(normalize_ssid(name), " "), lambda word: word != "")


def indexed_phrases(phrases: DataFrame) -> DataFrame:
    """Phrases (normalised) with their packs and words, and ``key``: the word by which names are looked up.

    The key is the word that the fewest phrases have, the longest of these, so that a word of many phrases leads to few. A
    phrase of slots only is left out.
    """
    listed = phrases.select(normalize_ssid(F.col("phrase")).alias("phrase"), "pack").groupBy("phrase")
    listed = listed.agg(F.array_join(F.array_sort(F.collect_set("pack")), "|").alias("pack"))
    listed = listed.withColumn("words", words_of(F.col("phrase")))
    words = listed.select("phrase", F.explode(F.array_distinct("words")).alias("word")).filter(F.col("word") != SLOT)
    common = words.withColumn("n", F.count("*").over(Window.partitionBy("word")))
    key = common.groupBy("phrase").agg(F.min_by("word", F.struct("n", -F.length("word"), "word")).alias("key"))
    return listed.join(key, "phrase")


def holds(name: Column, phrase: Column) -> Column:
    """Do the words of a phrase stand one after another among the words of a name; a slot is any one word."""
    starts = F.sequence(F.lit(0), F.size(name) - F.size(phrase))
    places = F.sequence(F.lit(0), F.size(phrase) - 1)

    def at(start: Column) -> Column:
        return F.forall(places, lambda i: (F.get(phrase, i) == SLOT) | (F.get(name, start + i) == F.get(phrase, i)))

    return (F.size(name) >= F.size(phrase)) & F.when(F.size(name) >= F.size(phrase), F.exists(starts, at))


def contained_phrases(df: DataFrame, phrases: DataFrame, ssid: str = SSID) -> DataFrame:
    """Sightings whose name holds a phrase, once for each such phrase, with ``phrase`` and ``pack``.

    Phrases may have slots (``{}``) that stand for one word. Names meet only those phrases whose key word they have, by
    an ordinary join on the word, so the list may have any size. In a batch every name is looked up once, however often
    it was seen; on a stream each sighting is, without state.
    """
    index = indexed_phrases(phrases).select(F.col("phrase"), "pack", F.col("words").alias("_phrase"), F.col("key").alias("_key"))
    if df.isStreaming:
        worded = df.withColumn("_words", words_of(F.col(ssid)))
        keyed = worded.withColumn("_word", F.explode(F.array_distinct("_words")))
        found = keyed.join(index, F.col("_word") == F.col("_key")).filter(holds(F.col("_words"), F.col("_phrase")))
        return found.drop("_words", "_word", "_phrase", "_key")
    names = df.select(normalize_ssid(F.col(ssid)).alias("_name")).filter("_name != ''").distinct()
    names = names.withColumn("_words", words_of(F.col("_name")))
    keyed = names.withColumn("_word", F.explode(F.array_distinct("_words")))
    found = keyed.join(index, F.col("_word") == F.col("_key")).filter(holds(F.col("_words"), F.col("_phrase")))
    found = found.select("_name", "phrase", "pack")
    return df.join(found, normalize_ssid(F.col(ssid)) == F.col("_name")).drop("_name")
