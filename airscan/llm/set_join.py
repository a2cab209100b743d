"""Jaccard join of word shingle sets, with set relations used to skip work.

Equal sets are one set from the start. A set then takes part only as long as it can have a partner:

1. Of two similar sets, the lowest-hashed prefixes share a known number of shingles. Sets whose prefix holds fewer
   shingles that occur anywhere else are done.
2. For the others all shingles are counted; a set of which less than the threshold occurs elsewhere is done.

What is left is indexed by its rarest shared shingles, with positions. Index lists are skipped in blocks: entries of one
list, component and size class form a block that knows its sizes and the most shingles that follow any of its positions,
and two blocks are joined only if these allow the overlap that the threshold asks for.

Answers are derived from answers already computed. In each list the most typical set is a centre; every set is first
compared with its best centre only. Sets that are both similar to a centre are in one component and are not compared
with each other. For the rest, the distances to a centre bound the distance between two sets (Jaccard distance is a
metric), and only pairs that the bound allows are compared. Components are what links give, so no link between different
texts is lost, and a group of thousands of near copies costs about one comparison per copy.

A set has the distinct 5-word shingles of the whole text (A-Z in lower case), with fewer words the whole sequence as one.
Null, empty and white texts have the empty set and no link. A null doc_id is larger than all others and never names a
component with another document. Repeated rows are rows of one set. An empty table gives an empty result. Only doc_id
and text are read. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airscan.llm.frames import batches, keep_marked, row_key, utf8, whole_text, words
from airscan.llm.links import components
from airscan.sources.local import bounded, staged

ODD = np.uint64(0x9E3779B97F4A7C15)
REMEMBERED = 1 << 20  # words whose hash a task keeps


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, the similarity in percent, the share of a set by which prefixes overlap, and centre rounds."""

    size: int = 5
    percent: int = 80
    extra: int = 10
    rounds: int = 3

    def least(self, n: Column) -> Column:
        """Shingles that a set of n shares with any similar set, at the least."""
        return F.ceil(n * self.percent / 100.0)


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * ODD
    return h ^ (h >> np.uint64(29))


def shingles(text: bytes, hashes: Hashes, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    size = min(size, len(h))
    n = len(h) - size + 1
    out = h[:n] + np.uint64(size)
    for i in range(1, size):
        out = out * ODD + h[i : i + n]
    return np.unique(mixed(out))


def digest(found: np.ndarray) -> tuple[int, int]:
    """128 bits that do not depend on the order of the shingles."""
    if not len(found):
        return 0, 0
    whole = found.tobytes()
    return xxhash.xxh3_64_intdigest(whole, 1), xxhash.xxh3_64_intdigest(whole, 2)


def signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def flat_lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)])
    values = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def sets(documents: DataFrame, rule: Rule) -> DataFrame:
    """One row per document: row, doc_id, mark, n, digest d1 and d2, and the lowest-hashed prefix; a written table."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches(frames):
            found = [shingles(text, hashes, rule.size) for text in utf8(batch[2])]
            n = np.array([len(x) for x in found])
            extra = np.maximum(1, -(-n * rule.extra // 100))
            take = np.minimum(n, n - -(-n * rule.percent // 100) + extra)
            digests = [digest(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch[0], batch[1], pa.array(n, pa.int64()), pa.array(signed([a for a, _ in digests])),
                    pa.array(signed([b for _, b in digests])), flat_lists([x[:k] for x, k in zip(found, take, strict=True)]),
                ],
                ["doc_id", "mark", "n", "d1", "d2", "prefix"],
            )

    schema = "doc_id bigint, mark bigint, n bigint, d1 bigint, d2 bigint, prefix array<bigint>"
    rows = documents.select(*row_key(), whole_text().alias("text")).mapInArrow(run, schema)
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "sets")


def full_sets(documents: DataFrame, chosen: DataFrame, rule: Rule) -> DataFrame:
    """(sid, n, tokens) of the chosen sets, from a second reading of their texts; a written table."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches(frames):
            found = [shingles(text, hashes, rule.size) for text in utf8(batch[1])]
            n = pa.array([len(x) for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch[0], n, flat_lists(found)], ["sid", "n", "tokens"])

    keys = staged(chosen.select(F.col("row").alias("sid"), F.col("doc_id").alias("d"), F.col("mark").alias("m")), "sets-chosen")
    texts = documents.select(*row_key(), whole_text().alias("text"))
    same = (F.col("mark") == F.col("m")) & F.col("doc_id").eqNullSafe(F.col("d"))
    rows = texts.join(bounded(keys), same).select("sid", "text").mapInArrow(run, "sid bigint, n bigint, tokens array<bigint>")
    rows = staged(rows, "sets-full")
    # Repeated rows of one text and identifier come back as often as they stand in the table.
    return rows if rows.count() == keys.count() else staged(rows.dropDuplicates(["sid"]), "sets-full")


def shared(lists: DataFrame, column: str) -> DataFrame:
    """(sid, token, df) for the tokens that stand in two lists or more; ``df`` is the number of lists."""
    rows = lists.select("sid", F.explode(column).alias("token"))
    df = staged(rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "sets-df")
    return rows.join(df, "token")


def hopeful(distinct: DataFrame, rule: Rule) -> DataFrame:
    """Rows of distinct sets whose prefixes share as many shingles with others as two similar prefixes must."""
    hits = shared(distinct.select(F.col("row").alias("sid"), "prefix"), "prefix").groupBy("sid").count()
    hits = staged(hits, "sets-hits")
    rows = distinct.drop("prefix").join(hits, F.col("row") == F.col("sid"))
    least = F.greatest(F.lit(1), F.ceil(rule.least(F.col("n")) * rule.extra / 100.0))
    return staged(rows.filter(F.col("count") >= least).drop("sid", "count"), "sets-hopeful")


def index(full: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Index entries (token, sid, n, rest) and the sets that have any, with how typical their shingles are.

    A set's shared shingles are put in order from rare to common; as many as the threshold asks for must follow or be
    the first one that a similar set shares, so only those at the front are indexed. ``rest`` counts those that follow.
    """
    least = rule.least(F.col("n"))
    listed = shared(full, "tokens").groupBy("sid").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"), F.avg(F.log("df")).alias("typical")
    )  # as many as the set has shingles
    rows = listed.join(full.select("sid", "n"), "sid").filter(F.size("shared") >= least)
    kept = F.slice("shared", F.lit(1), F.size("shared") - least.cast("int") + 1)
    typical = F.col("typical") * F.size("shared") / F.col("n")
    rows = rows.select("sid", "n", typical.alias("typical"), F.size("shared").alias("size"), kept.alias("kept"))
    rows = staged(rows, "sets-index")
    entries = rows.select("sid", "n", "typical", "size", F.posexplode("kept").alias("place", "entry"))
    return entries.select(
        F.col("entry.token").alias("token"), "sid", "n", "typical", (F.col("size") - F.col("place") - 1).alias("rest")
    ), rows.select("sid", "n")


def compared(pairs: DataFrame, full: DataFrame, rule: Rule) -> DataFrame:
    """(a, b, distance, linked) for pairs of sets, by all their shingles; a written table."""
    first = full.select(F.col("sid").alias("a"), F.col("n").alias("an"), F.col("tokens").alias("at"))
    second = full.select(F.col("sid").alias("b"), F.col("n").alias("bn"), F.col("tokens").alias("bt"))
    rows = pairs.join(first, "a").join(second, "b").withColumn("common", F.size(F.array_intersect("at", "bt")).cast("bigint"))
    union = F.col("an") + F.col("bn") - F.col("common")
    return staged(
        rows.select(
            "a", "b", (1 - F.col("common") / union).alias("distance"), (100 * F.col("common") >= rule.percent * union).alias("linked")
        ),
        "sets-compared",
    )


def labelled(sids: DataFrame, links: DataFrame | None) -> DataFrame:
    """(sid, label): the smallest set of each set's component so far; a written table."""
    if links is None:
        return staged(sids.select("sid", F.col("sid").alias("label")), "sets-labels")
    found = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    rows = sids.select("sid").join(found, F.col("sid") == F.col("u"), "left")
    return staged(rows.select("sid", F.coalesce("v", "sid").alias("label")), "sets-labels")


def possible(rule: Rule, an: Column, ar: Column, bn: Column, br: Column) -> Column:
    """Whether sizes and the shingles that follow a shared one allow the overlap of similar sets."""
    sizes = (100 * F.least(an, bn) >= rule.percent * F.greatest(an, bn))
    return sizes & ((100 + rule.percent) * (1 + F.least(ar, br)) >= rule.percent * (an + bn))


def centre_pairs(entries: DataFrame, labels: DataFrame, done: DataFrame | None, rule: Rule) -> DataFrame:
    """For every set the most typical centre of its lists that is in another component and was not compared yet."""
    rows = entries.join(labels, "sid")
    best = F.max(F.struct("typical", (-F.col("sid")).alias("by"), "sid", "n", "label", "rest")).alias("c")
    centres = staged(rows.groupBy("token").agg(best), "sets-centres")
    near = rows.join(centres, "token").filter(F.col("label") != F.col("c.label"))
    near = near.filter(possible(rule, F.col("n"), F.col("rest"), F.col("c.n"), F.col("c.rest")))
    pairs = near.select(F.col("sid").alias("a"), F.col("c.sid").alias("b"), F.col("c.typical").alias("typical")).distinct()
    if done is not None:
        pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
    return staged(pairs.groupBy("a").agg(F.max_by("b", F.struct("typical", "b")).alias("b")), "sets-pairs")


def remaining_pairs(entries: DataFrame, labels: DataFrame, done: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of sets in different components that share an index list and that no bound excludes.

    Blocks are joined first, on their largest rest and their smallest and largest size; entries only where their blocks
    were. Then a pair of which both were compared with one centre is dropped if the distances differ by too much.
    """
    rows = entries.join(labels, "sid").withColumn("class", F.floor(F.log(F.col("n")) / F.log(F.lit(1.12))))
    rows = staged(rows.select("token", "label", "class", "sid", "n", "rest"), "sets-entries")
    blocks = staged(
        rows.groupBy("token", "label", "class").agg(
            F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("rest")
        ),
        "sets-blocks",
    )
    a, b = (blocks.select("token", *(F.col(c).alias(f"{x}_{c}") for c in blocks.columns[1:])) for x in "ab")
    sizes = (100 * F.col("a_high") >= rule.percent * F.col("b_low")) & (100 * F.col("b_high") >= rule.percent * F.col("a_low"))
    rest = (100 + rule.percent) * (1 + F.least("a_rest", "b_rest")) >= rule.percent * (F.col("a_low") + F.col("b_low"))
    met = a.join(b, "token").filter((F.col("a_label") < F.col("b_label")) & sizes & rest)
    met = staged(met.select("token", "a_label", "a_class", "b_label", "b_class"), "sets-met")
    for x in "ab":
        side = rows.select("token", *(F.col(c).alias(f"{x}_{c}") for c in ("label", "class")),
                           *(F.col(c).alias(f"{x}_{c}") for c in ("sid", "n", "rest")))
        met = met.join(side, ["token", f"{x}_label", f"{x}_class"])
    met = met.filter(possible(rule, F.col("a_n"), F.col("a_rest"), F.col("b_n"), F.col("b_rest")))
    pairs = met.select(F.least("a_sid", "b_sid").alias("a"), F.greatest("a_sid", "b_sid").alias("b")).distinct()
    known = done.select("a", "b").unionByName(done.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = staged(pairs.join(known, ["a", "b"], "left_anti"), "sets-pairs")
    far = 1 - rule.percent / 100 + 1e-9
    ab = done.select(F.col("a").alias("a"), F.col("b").alias("centre"), F.col("distance").alias("da"))
    bb = done.select(F.col("a").alias("b"), F.col("b").alias("centre"), F.col("distance").alias("db"))
    apart = pairs.join(ab, "a").join(bb, ["b", "centre"]).filter(F.abs(F.col("da") - F.col("db")) > far)
    return staged(pairs.join(apart.select("a", "b").distinct(), ["a", "b"], "left_anti"), "sets-pairs")


def linked_sets(documents: DataFrame, distinct: DataFrame, rule: Rule) -> DataFrame:
    """(sid, label) of all sets that have a link to another set."""
    full = full_sets(documents, hopeful(distinct, rule), rule)
    entries, sids = index(full, rule)
    labels, done = labelled(sids, None), None

    def links() -> DataFrame:
        return done.filter("linked").select("a", "b")

    for _ in range(rule.rounds):
        pairs = centre_pairs(entries, labels, done, rule)
        if pairs.isEmpty():
            break
        found = compared(pairs, full, rule)
        done = found if done is None else staged(done.unionByName(found), "sets-done")
        labels = labelled(sids, links())
    if done is None:  # no set can be similar to its centre, others may still be
        done = documents.sparkSession.createDataFrame([], "a bigint, b bigint, distance double, linked boolean")
    found = compared(remaining_pairs(entries, labels, done, rule), full, rule)
    labels = labelled(sids, links().unionByName(found.filter("linked").select("a", "b")))
    grouped = labels.groupBy("label").count().filter("count > 1").select("label")
    return staged(labels.join(staged(grouped, "sets-grouped"), "label"), "sets-linked")


def marked(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Per row of ``documents``: row, doc_id, mark, n, component_id and keep_row (the row that may stand for its component)."""
    rows = sets(documents, rule)
    key = ["n", "d1", "d2"]
    classes = rows.filter("n > 0").groupBy(*key).agg(F.min("row").alias("sid"), F.count(F.lit(1)).alias("size"))
    classes = staged(classes.filter("size > 1").select(*key, "sid"), "sets-classes")
    placed = rows.drop("prefix").join(classes, key, "left")
    placed = staged(placed.withColumn("sid", F.coalesce("sid", "row")).select("row", "doc_id", "mark", "n", "sid"), "sets-placed")
    copies = staged(placed.filter("row != sid").select(F.col("row").alias("copy")), "sets-copies")
    distinct = rows.filter("n > 0").join(bounded(copies), F.col("row") == F.col("copy"), "left_anti")
    linked = linked_sets(documents, distinct, rule)
    grouped = placed.join(linked, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    grouped = staged(grouped.select("row", "doc_id", "mark", "n", "label"), "sets-labelled")
    by_id = F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)), "row", "doc_id"))
    first = grouped.groupBy("label").agg(F.count(F.lit(1)).alias("size"), by_id.alias("first")).filter("size > 1")
    first = staged(first.select("label", F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("first_row")), "sets-first")
    out = grouped.join(first, "label", "left")
    component = F.when(F.col("first_row").isNull(), F.col("doc_id")).otherwise(F.col("first_id"))
    return out.select("row", "doc_id", "mark", "n", component.alias("component_id"), F.coalesce("first_row", "row").alias("keep_row"))


def one_of_each(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``documents`` with one row of each component (the smallest doc_id), all columns as they were."""
    rows = marked(documents, rule)
    return keep_marked(documents, staged(rows.select("doc_id", "mark", (F.col("row") == F.col("keep_row")).alias("keep")), "sets-marks"))
