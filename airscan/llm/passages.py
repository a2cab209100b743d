"""Repeated passages by sparse suffix arrays.

Suffixes are kept only where a short word sequence, the seed, is the minimiser of its window, so that every passage of
``least`` words holds a seed wherever it stands. Suffixes of seeds that occur in one document only are dropped. The
others are sorted over the whole cluster, by seed and by the words that follow it; neighbours are compared, and matches
extended to the left. A second sort, by the words that precede the seed read backwards, does the same from the other
side. The two give the longest right and the longest left match of every suffix; only where no neighbour has both at
once can a longer passage be shared with a suffix further away, and these few are settled by their windows of
``least`` words. The sorts are range partitions on the suffix itself, which ties (equal suffixes of many documents) do not
hold together; what lies across partition borders is compared in a short second pass.

Copies of a whole document are found first, and one of them takes part. Deep in periodic stretches (a phrase over and
over, all words equal) suffixes of one seed are equal, and are thinned out to one for every half window. A result row is a maximal stretch of words of a document of which every
``least`` successive words also stand in another document (copies included), with one such document. Passages that
repeat within one document only are not results.

Words are cut at white space, with A-Z in lower case. Null, empty and short texts have no passage. Repeated rows are
copies of each other. A null doc_id is kept as null. An empty table gives an empty result. Only doc_id and text are read.
Words are compared by 32-bit hashes, seeds and documents by 64 and 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airscan.llm.frames import batches, row_key, utf8, whole_text, words
from airscan.sources.local import staged

ODD = np.uint64(0x9E3779B97F4A7C15)
REMEMBERED = 1 << 20  # words whose hash a task keeps


@dataclass(frozen=True)
class Rule:
    """Words of a passage and of a seed. Seeds are minimisers of as many positions as a passage has."""

    least: int = 50
    seed: int = 10

    @property
    def window(self) -> int:
        return self.least - self.seed + 1

    @property
    def reach(self) -> int:
        """Words before and after a seed that a passage around it can need."""
        return self.least - self.seed


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hashed(text: bytes, hashes: Hashes) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))


def seeds_of(h: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the minimisers of a word sequence, and their seeds' hashes."""
    n = len(h) - rule.seed + 1
    if len(h) < rule.least:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    rolled = h[:n].copy()
    for i in range(1, rule.seed):
        rolled = rolled * ODD + h[i : i + n]
    rolled = (rolled ^ (rolled >> np.uint64(32))) * ODD
    rolled ^= rolled >> np.uint64(29)
    views = np.lib.stride_tricks.sliding_window_view(rolled, rule.window)
    at = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    # Deep in a periodic stretch the suffixes of one seed are all equal: of these the first, the last and one for every
    # half window are kept, which leaves no gap longer than a window.
    order = np.lexsort((at, rolled[at]))
    at, seed = at[order], rolled[at[order]]
    deep = periodic(h, at, seed, rule)
    new = ~deep | np.append(True, ~deep[:-1] | (seed[1:] != seed[:-1]) | (np.diff(at) > rule.window // 2))
    part = (at - at[new][np.cumsum(new) - 1]) // (rule.window // 2)
    kept = new | np.append(True, part[1:] != part[:-1]) | np.append(new[1:], True)
    at = np.sort(at[kept])
    return at, rolled[at]


def periodic(h: np.ndarray, at: np.ndarray, seed: np.ndarray, rule: Rule) -> np.ndarray:
    """Which of the places, sorted by seed and place, lie ``least`` or more words inside a stretch of one short period.

    Only the words around a place decide, so documents that share them agree; rows that differ in a word are no period.
    """
    deep = np.zeros(len(at), bool)
    step = np.where(seed[1:] == seed[:-1], np.diff(at), 0)
    some = np.flatnonzero((step[1:] == step[:-1]) & (step[1:] > 0) & (step[1:] <= rule.window // 2)) + 1
    some = some[(at[some] >= rule.least) & (at[some] + rule.seed + rule.least <= len(h))]
    for period in np.unique(step[some]).tolist():
        which = some[step[some] == period]
        equal = np.append(0, np.cumsum(h[:-period] == h[period:]))
        first, end = at[which] - rule.least, at[which] + rule.seed + rule.least - period
        deep[which] = equal[end] - equal[first] == end - first
    return deep


def positions(documents: DataFrame, rule: Rule) -> DataFrame:
    """One row per document: row, doc_id, mark, n, digest d1 and d2, seeds and their places; a written table."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches(frames):
            n, d1, d2, seeds, places = [], [], [], [], []
            for text in utf8(batch[2]):
                h = hashed(text, hashes)
                whole = h.tobytes()
                at, found = seeds_of(h, rule)
                n.append(len(h))
                d1.append(xxhash.xxh3_64_intdigest(whole, 1))
                d2.append(xxhash.xxh3_64_intdigest(whole, 2))
                seeds.append(found)
                places.append(at)
            ends = pa.array(np.cumsum([0, *map(len, seeds)]), pa.int32())
            flat = [np.concatenate([*x, np.empty(0, x[0].dtype)]) for x in (seeds, places)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch[0], batch[1], pa.array(n, pa.int64()), *(pa.array(np.array(d, np.uint64).view(np.int64)) for d in (d1, d2)),
                    pa.ListArray.from_arrays(ends, pa.array(flat[0].view(np.int64))),
                    pa.ListArray.from_arrays(ends, pa.array(flat[1], pa.int64())),
                ],
                ["doc_id", "mark", "n", "d1", "d2", "seeds", "places"],
            )

    schema = "doc_id bigint, mark bigint, n bigint, d1 bigint, d2 bigint, seeds array<bigint>, places array<bigint>"
    rows = documents.select(*row_key(), whole_text().alias("text")).mapInArrow(run, schema)
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "passages-positions")


def suffixes(documents: DataFrame, distinct: DataFrame, rule: Rule) -> DataFrame:
    """(seed, row, place, after, before) of the seeds that occur in several documents; a written table.

    ``after`` and ``before`` are the hashes of the words that follow the seed, and of those that precede it read
    backwards, as big-endian bytes, so that they sort as the words' hashes do.
    """
    places = distinct.select("row", F.explode(F.arrays_zip("seeds", "places")).alias("s"))
    places = places.select("row", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place"))
    repeated = places.groupBy("seed").agg(F.min("row").alias("low"), F.max("row").alias("high")).filter("low != high")
    repeated = staged(repeated.select("seed"), "passages-seeds")
    kept = places.join(repeated, "seed").groupBy("row").agg(F.collect_list(F.struct("place", "seed")).alias("wanted"))
    keys = distinct.select("row", "doc_id", "mark").join(kept, "row")
    keys = staged(keys.select("row", F.col("doc_id").alias("d"), F.col("mark").alias("m"), "wanted"), "passages-wanted")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, reach, size = Hashes(), rule.reach, rule.seed
        for batch in batches(frames):
            out: list[list] = [[], [], [], [], []]
            for row, wanted, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), utf8(batch[2]), strict=True):
                forward = (hashed(text, hashes) >> np.uint64(32)).astype(">u4")
                backward = forward[::-1].tobytes()
                forward, n = forward.tobytes(), len(forward)
                for each in wanted:
                    p = each["place"]
                    out[0].append(each["seed"])
                    out[1].append(row)
                    out[2].append(p)
                    out[3].append(forward[4 * (p + size) : 4 * (p + size + reach)])
                    out[4].append(backward[4 * (n - p) : 4 * (n - p + reach)])
                if len(out[0]) >= 20_000:
                    yield suffix_batch(out)
                    out = [[], [], [], [], []]
            if out[0]:
                yield suffix_batch(out)

    texts = documents.select(*row_key(), whole_text().alias("text"))
    same = (F.col("mark") == F.col("m")) & F.col("doc_id").eqNullSafe(F.col("d"))
    rows = texts.join(keys, same).select("row", "wanted", "text")
    rows = rows.mapInArrow(run, "seed bigint, row bigint, place bigint, after binary, before binary")
    return staged(rows, "passages-suffixes")


def suffix_batch(out: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    arrays = [pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["seed", "row", "place", "after", "before"])


def common(a: bytes, b: bytes) -> int:
    """Words that two hash strings share from their beginnings."""
    if a == b:
        return len(a) // 4
    low, high = 0, min(len(a), len(b)) // 4
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: 4 * middle] == b[: 4 * middle] else (low, middle - 1)
    return low


class Neighbours:
    """Compares each suffix with the nearest one of another document on either side, in sorted order.

    Suffixes are (seed, row, place, sorted side, other side). Successive ones of one document form a run; a run is
    compared with the last suffix before and the first after it.
    """

    def __init__(self):
        self.before = None
        self.run: list[tuple] = []
        self.out: list[tuple] = []

    def compare(self, suffix: tuple, other: tuple | None) -> None:
        if other is not None and suffix[0] == other[0]:
            self.out.append((suffix[1], suffix[2], other[1], common(suffix[3], other[3]), common(suffix[4], other[4])))

    def add(self, suffix: tuple) -> None:
        if self.run and self.run[-1][1] != suffix[1]:
            for each in self.run:
                self.compare(each, suffix)
            self.before, self.run = self.run[-1], []
        self.compare(suffix, self.before)
        self.run.append(suffix)

    def taken(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


MATCH = "row bigint, place bigint, other bigint, sorted_words bigint, other_words bigint"
FACE = "part bigint, ord bigint, seed bigint, s_row bigint, s_place bigint, side binary, face binary"


def neighbours(rows: DataFrame, side: str, other: str) -> DataFrame:
    """Matches of each suffix with its neighbours when sorted by seed and ``side``; a written table.

    Each task compares what lies within its range, and hands on the suffixes at its ends: its first and last run
    with the suffix beside them. These few, put together in order, are compared once more.
    """

    def match_batch(found: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
        size = len(found)
        columns = list(zip(*found, strict=True)) or [()] * 5
        faces = list(zip(*edges, strict=True)) or [()] * 7
        arrays = [pa.array([*c, *[None] * len(edges)], pa.int64()) for c in columns]
        kinds = [pa.int64()] * 5 + [pa.binary()] * 2
        arrays += [pa.array([*[None] * size, *c], kind) for c, kind in zip(faces, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in f"{MATCH}, {FACE}".split(", ")])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state = TaskContext.get().partitionId(), Neighbours()
        head: list[tuple] = []
        open_head = True
        for batch in batches(frames):
            for suffix in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                state.add(suffix)
                if open_head:
                    head.append(suffix)
                    open_head = suffix[1] == head[0][1]
            if len(state.out) >= 20_000:
                yield match_batch(state.taken(), [])
        tail = [] if open_head else [x for x in [state.before, *state.run] if x is not None]
        edges = [(part, i, *x) for i, x in enumerate(head)] + [(part, len(head) + i, *x) for i, x in enumerate(tail)]
        yield match_batch(state.taken(), edges)

    def finish(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Neighbours()
        for batch in batches(frames):
            for suffix in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                state.add(suffix)
        yield match_batch(state.taken(), []).select([x.split()[0] for x in MATCH.split(", ")])

    order = ["seed", side, "row", "place"]
    ranged = rows.select("seed", "row", "place", side, other).repartitionByRange(*order).sortWithinPartitions(*order)
    found = staged(ranged.mapInArrow(run, f"{MATCH}, {FACE}"), "passages-neighbours")
    matches = [x.split()[0] for x in MATCH.split(", ")]
    # A few suffixes for each partition: the runs at its ends.
    ends = found.filter("part is not null").select("part", "ord", "seed", "s_row", "s_place", "side", "face").distinct()
    ends = ends.coalesce(1).sortWithinPartitions("part", "ord").drop("part", "ord").mapInArrow(finish, MATCH)
    return found.filter("row is not null").select(*matches).unionByName(ends)


def matched(rows: DataFrame, rule: Rule) -> DataFrame:
    """(row, place, before, after, other): words around a seed that it shares with one other document, ``least`` or more."""
    right = neighbours(rows, "after", "before").select(
        "row", "place", "other", F.col("sorted_words").alias("after"), F.col("other_words").alias("before")
    )
    left = neighbours(rows, "before", "after").select(
        "row", "place", "other", F.col("other_words").alias("after"), F.col("sorted_words").alias("before")
    )
    found = staged(right.unionByName(left), "passages-matches")
    long = found.filter(F.col("before") + F.col("after") >= rule.reach)
    # Windows by their distance before the seed: those that some match covers, and those that the longest ones allow.
    covered = F.flatten(F.collect_set(F.when(
        F.col("before") + F.col("after") >= rule.reach, F.sequence(rule.reach - F.col("after"), F.col("before"))
    )))
    reach = found.groupBy("row", "place").agg(
        F.max("before").alias("most_before"), F.max("after").alias("most_after"), F.size(F.array_distinct(covered)).alias("covered")
    )
    allowed = F.col("most_before") + F.col("most_after") - rule.reach + 1
    reach = staged(reach.filter(allowed > 0).withColumn("open", allowed > F.greatest(F.col("covered"), F.lit(0))), "passages-reach")
    return long.select("row", "place", "before", "after", "other").unionByName(settled(rows, reach, rule))


def settled(rows: DataFrame, reach: DataFrame, rule: Rule) -> DataFrame:
    """Windows of ``least`` words around the seeds for which neighbours leave some open, where several documents have them."""
    known = rows.join(reach, ["row", "place"])
    seeds = staged(known.filter("open").select("seed").distinct(), "passages-open")
    some = known.join(seeds, "seed").withColumn("j", F.explode(F.expr(f"sequence({rule.reach} - most_after, most_before)")))
    start = F.expr("substring(before, 1, int(4 * j))")
    rest = F.expr(f"substring(after, 1, int(4 * ({rule.reach} - j)))")
    some = some.select("row", "place", "j", F.xxhash64("seed", "j", start, F.lit(0), rest).alias("window"))
    shared = some.groupBy("window").agg(F.min("row").alias("low"), F.max("row").alias("high")).filter("low != high")
    out = some.join(staged(shared, "passages-windows"), "window")
    other = F.when(F.col("row") == F.col("low"), F.col("high")).otherwise(F.col("low"))
    return out.select("row", "place", F.col("j").alias("before"), (rule.reach - F.col("j")).alias("after"), other.alias("other"))


def merged(spans: DataFrame) -> DataFrame:
    """(row, first, end, other): overlapping and touching spans of a document as one, with the smallest partner row."""
    in_row = Window.partitionBy("row").orderBy("first", "end")
    earlier = F.max("end").over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    starts = spans.withColumn("new", F.coalesce((F.col("first") > earlier).cast("int"), F.lit(1)))
    numbered = starts.withColumn("part", F.sum("new").over(in_row.rowsBetween(Window.unboundedPreceding, 0)))
    grouped = numbered.groupBy("row", "part").agg(F.min("first").alias("first"), F.max("end").alias("end"), F.min("other").alias("other"))
    return grouped.drop("part")


def repeated(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Maximal repeated stretches: doc_id, first_word, n_words, other_doc_id."""
    rows = positions(documents, rule).filter(F.col("n") >= rule.least)
    key = ["n", "d1", "d2"]
    classes = rows.groupBy(*key).agg(F.min("row").alias("low"), F.max("row").alias("high")).filter("low != high")
    classes = staged(classes, "passages-classes")
    narrow = rows.select("row", *key)
    copies = narrow.join(classes, key)
    other = F.when(F.col("row") == F.col("low"), F.col("high")).otherwise(F.col("low"))
    whole = staged(copies.select("row", F.lit(0).cast("bigint").alias("first"), F.col("n").alias("end"), other.alias("other"), "low"), "passages-copies")
    spare = whole.filter("row != low").select(F.col("row").alias("copy"))
    distinct = rows.join(spare, F.col("row") == F.col("copy"), "left_anti")
    found = matched(suffixes(documents, staged(distinct, "passages-distinct"), rule), rule)
    spans = found.groupBy("row", (F.col("place") - F.col("before")).alias("first"),
                          (F.col("place") + rule.seed + F.col("after")).alias("end")).agg(F.min("other").alias("other"))
    # A copied document is one span as a whole.
    spans = spans.join(whole.select(F.col("row").alias("copy")), F.col("row") == F.col("copy"), "left_anti")
    found = staged(merged(spans).select("row", "first", "end", "other").unionByName(whole.drop("low")), "passages-spans")
    ids = rows.select("row", "doc_id")
    named = found.join(ids, "row").join(ids.select(F.col("row").alias("other"), F.col("doc_id").alias("other_doc_id")), "other")
    return named.select("doc_id", F.col("first").alias("first_word"), (F.col("end") - F.col("first")).alias("n_words"), "other_doc_id")
