"""Perspective rotation for conversations of any number of speakers, in DataFrame operations only.

Every conversation is rendered once for each of its speakers: that speaker's turns become the assistant's, system turns
stay as they are, and all others become users with their names. The mask marks what the assistant is to learn: its
texts with their end marks.

A conversation is one row per speaker. Only one of more than ``limit`` bytes (of roles and texts) is cut, into parts of about
that size: a turn belongs to the part in which the bytes before it fall. Every part then begins with the system turns of
the parts before it, unless a conversation's system turns alone are over a quarter of the limit; those stand once, in their
places. Turns of large conversations are sorted over all partitions and their bytes summed there, so that a conversation
that holds a third of all turns is never one task.

Turns are ordered by turn number (null last), then role, then text. Repeated rows (equal in conversation, turn, role and
text) count once. Null text is empty, a null role speaks as "unknown", and rows of a null conv_id form one conversation. A
conversation of system turns only has no speaker and gives no row. A very long text is rendered whole, in a part of its own
if need be. Marks inside texts and names are broken by a space, so they cannot end a turn. An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airscan.sources.local import bounded, staged

LIMIT = 1 << 20
STRIDE = 64  # segments whose lengths are summed at once
END = "<|end|>"
TURN = ["late", "turn", "role", "text"]


def harmless(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))


def turns(conversations: DataFrame) -> DataFrame:
    """All rows: conv (never null), conv_id, the order keys and ``size`` in bytes."""
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").isNull().alias("late"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.withColumn("size", (F.octet_length("role") + F.octet_length("text")).cast("bigint"))


def large_parts(rows: DataFrame, limit: int) -> DataFrame:
    """Turns of large conversations with the part each is rendered in, system turns once for every later part too."""
    keys = ["conv", *TURN]
    rows = rows.distinct().repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = staged(rows.withColumn("at", F.monotonically_increasing_id()), "chat-large")
    slice_ = F.shiftrightunsigned("at", 33).alias("slice")
    rows = rows.withColumn("slice", slice_)
    system = F.when(F.col("role") == "system", F.col("size")).otherwise(F.lit(0))
    sums = rows.groupBy("conv", "slice").agg(F.sum("size").alias("own"), F.sum(system).alias("system"))
    whole = Window.partitionBy("conv")
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "conv", "slice", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("base"),
        F.sum("own").over(whole).alias("total"), F.sum("system").over(whole).alias("system"),
    )
    within = Window.partitionBy("conv", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0))
    part = F.when(F.col("total") > limit, F.call_function("div", before, F.lit(limit))).otherwise(F.lit(0))
    placed = rows.join(sums, ["conv", "slice"]).withColumn("part", part)
    placed = staged(placed.select("conv", "conv_id", "part", *TURN, (F.col("system") <= limit // 4).alias("again")), "chat-parts")
    later = placed.select("conv", F.col("part").alias("later")).distinct()
    repeated = placed.filter("again and role = 'system'").join(later, "conv").filter("later > part")
    return placed.drop("again").unionByName(repeated.withColumn("part", F.col("later")).drop("again", "later"))


def parts(conversations: DataFrame, limit: int) -> DataFrame:
    """(conv_id, perspective, part, turns): the turns of each part in order, once for each speaker of the conversation."""
    rows = turns(conversations)
    sizes = rows.groupBy("conv").agg(F.sum("size").alias("size"))
    large = staged(sizes.filter(F.col("size") > limit).select("conv"), "chat-sizes")
    turn = F.struct(*TURN)
    small = rows.join(bounded(large), "conv", "left_anti").groupBy("conv", "conv_id")
    small = small.agg(F.sort_array(F.collect_set(turn)).alias("turns"))
    speakers = F.array_except(F.transform("turns", lambda t: t["role"]), F.array(F.lit("system")))
    out = small.select("conv_id", F.explode(speakers).alias("perspective"), F.lit(0).cast("bigint").alias("part"), "turns")
    if large.isEmpty():
        return out
    rows = rows.join(bounded(large), "conv", "left_semi")
    who = rows.filter("role != 'system'").select("conv", F.col("role").alias("perspective")).distinct()
    cut = large_parts(rows, limit).groupBy("conv", "conv_id", "part").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return out.unionByName(cut.join(who, "conv").select("conv_id", "perspective", F.col("part").cast("bigint").alias("part"), "turns"))


def rendered(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per conversation, speaker and part: the text, and the mask as code point spans within the text.

    Columns: conv_id, perspective, part, n_turns, rendered, mask (array of start and end).
    """

    def head(turn: Column) -> Column:
        named = F.concat(F.lit("<|user name="), harmless(turn["role"]), F.lit("|>\n"))
        other = F.when(turn["role"] == "system", F.lit("<|system|>\n")).otherwise(named)
        return F.when(turn["role"] == F.col("perspective"), F.lit("<|assistant|>\n")).otherwise(other)

    def segment(turn: Column) -> Column:
        text = F.concat(harmless(turn["text"]), F.lit(END))
        return F.struct(
            F.concat(head(turn), text, F.lit("\n")).alias("whole"), F.length(head(turn)).alias("before"),
            F.length(text).alias("size"), (turn["role"] == F.col("perspective")).alias("own"),
        )

    def total(lengths: Column) -> Column:
        return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, b: a + b)

    def start(i: Column) -> Column:
        """Code points before segment i: whole strides first, then the rest."""
        strides = F.call_function("div", i, F.lit(STRIDE)).cast("int")
        rest = F.slice("lengths", strides * STRIDE + 1, i - strides * STRIDE)
        return total(F.slice("strides", F.lit(1), strides)) + total(rest)

    rows = parts(conversations, limit).withColumn("segments", F.transform("turns", segment)).drop("turns")
    rows = rows.withColumn("lengths", F.transform("segments", lambda s: F.length(s["whole"]).cast("bigint")))
    strides = F.sequence(F.lit(0), F.call_function("div", F.size("lengths"), F.lit(STRIDE)).cast("int"))
    rows = rows.withColumn("strides", F.transform(strides, lambda c: total(F.slice("lengths", c * STRIDE + 1, F.lit(STRIDE)))))
    spans = F.transform("segments", lambda s, i: F.when(s["own"], F.struct((start(i) + s["before"]).alias("start"), s["size"].alias("size"))))
    own = F.filter(spans, lambda s: s.isNotNull())
    return rows.select(
        "conv_id", "perspective", "part", F.size("segments").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: s["whole"]), "").alias("rendered"),
        F.transform(own, lambda s: F.struct(s["start"].alias("start"), (s["start"] + s["size"]).alias("end"))).alias("mask"),
    )
