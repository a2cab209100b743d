"""Near copies among embeddings by sorted projection passes.

A pass gives every vector a key of 62 random hashes (the signs of projections), concatenated. Vectors of one label are sorted
by key, so that those that agree in many leading hashes stand near each other, and each is compared with a bounded window
of its neighbours. The links that hold are united over all passes.

How many passes are needed follows from the rows: a pair of the least similarity agrees in ``b`` leading hashes with a
known probability, and ``b`` hashes leave about a window of vectors where ``n / 2**b`` is the window. Passes are added until
a pair is missed with probability ``1 - recall`` at most, so recall is the same at every size.

A window is no limit for a crowd. Equal vectors are one from the start and count as many. Links of the windows give groups,
and the links of a vector are counted against its whole group afterwards: a group is laid out in blocks in key order, and
pairs of blocks are multiplied, unless their centres are too far apart for any link. Only counts leave a block, and of the
links one spanning tree a block, so no group is listed as pairs and none is held by one task.

Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do rows without a label, nor
vectors of different lengths. Similarity is the cosine in doubles. A null vec_id is larger than all others and stands as
null. Rows of one vec_id are separate rows. An empty table gives an empty result. Columns other than vec_id, label and the
vector are not read. Equal vectors are found by 128-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airscan.llm.frames import batches
from airscan.llm.links import components
from airscan.llm.order import placed
from airscan.sources.local import bounded, staged

BITS = 62
LAST_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Rule:
    """Least cosine, neighbours on each side, rows of a segment or block, recall asked for, fewest passes, and the seed."""

    least: float = 0.98
    window: int = 256
    block: int = 2048
    recall: float = 0.98
    fewest: int = 3
    seed: int = 13

    def passes(self, vectors: int) -> int:
        """Passes after which a pair of the least cosine is missed with probability ``1 - recall`` among so many vectors."""
        agree = 1 - math.acos(self.least) / math.pi
        hashes = 1 + max(0.0, math.log2(max(vectors, 1) / self.window))
        once = agree**hashes
        return max(self.fewest, math.ceil(math.log(1 - self.recall) / math.log(1 - once)))


def unit(lists: pa.Array) -> list[np.ndarray | None]:
    """Vectors of length one in doubles, or None where a row has no direction."""
    out: list[np.ndarray | None] = []
    for i in range(len(lists)):
        values = lists[i].values if lists[i].is_valid else None
        if values is None or not len(values) or values.null_count:
            out.append(None)
            continue
        vector = values.to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.abs(vector).max()
        if not np.isfinite(top) or not top:
            out.append(None)
            continue
        vector = vector / top
        out.append(vector / math.sqrt(vector @ vector))
    return out


def keyed(embeddings: DataFrame, vector: str, passes: int, rule: Rule) -> DataFrame:
    """One row per vector: row, vec_id, label, dims (null where it cannot link), digests, keys and the vector; a written table."""
    planes: dict[int, np.ndarray] = {}

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches(frames):
            vectors = unit(batch["vector"])
            labels = batch["label"].is_valid().to_pylist()
            dims = [len(x) if x is not None and ok else None for x, ok in zip(vectors, labels, strict=True)]
            keys: list[np.ndarray | None] = [None] * len(vectors)
            for size in {x for x in dims if x}:
                if size not in planes:
                    planes[size] = np.random.default_rng([rule.seed, size]).standard_normal((size, passes * BITS))
                at = [i for i, n in enumerate(dims) if n == size]
                signs = (np.stack([vectors[i] for i in at]) @ planes[size] > 0).reshape(len(at), passes, BITS)
                for i, key in zip(at, signs @ powers, strict=True):
                    keys[i] = key
            # Positive zero stands for both zeros, so equal vectors have equal bytes.
            raw = [(x + 0.0).tobytes() if n else b"" for x, n in zip(vectors, dims, strict=True)]
            digests = [np.array([xxhash.xxh3_64_intdigest(x, s) for x in raw], np.uint64).view(np.int64) for s in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], pa.array(dims, pa.int32()), *map(pa.array, digests),
                 pa.array(keys, pa.list_(pa.int64())), batch["vector"]],
                ["vec_id", "label", "dims", "d1", "d2", "keys", "vector"],
            )

    # Single numbers are kept as such while they are moved, and compared as doubles.
    kind = "float" if embeddings.schema[vector].dataType.simpleString() == "array<float>" else "double"
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col(vector).cast(f"array<{kind}>").alias("vector"),
    )
    schema = f"vec_id bigint, label string, dims int, d1 bigint, d2 bigint, keys array<bigint>, vector array<{kind}>"
    return staged(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "projection-rows")


def matrix(table: pa.Table, column: str = "vector") -> np.ndarray:
    vectors = unit(table[column].combine_chunks())
    return np.stack(vectors) if vectors else np.empty((0, 0))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component, given links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tree(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Links (u, v) that keep together what the links (a, b) between places of ``ids`` do."""
    root = roots(len(ids), a, b)
    at = np.flatnonzero(root != np.arange(len(ids)))
    return pa.table({"u": pa.array(ids[at], pa.int64()), "v": pa.array(ids[root[at]], pa.int64())})


def neighbours(rows: DataFrame, rule: Rule) -> DataFrame:
    """Links of all passes: every vector against those up to a window after it, within segments that overlap by a window."""
    keys = rows.select("row", "label", "dims", F.posexplode("keys").alias("pass", "key"))
    ranked = placed(keys, [], ["pass", "label", "dims", "key", "row"], "projection-order")
    here = F.expr(f"place div {rule.block}")
    again = F.when((F.col("place") % rule.block < rule.window) & (here > 0), F.array(here, here - 1)).otherwise(F.array(here))
    ranked = ranked.select(F.col("row").alias("r"), "pass", "place", F.explode(again).alias("segment"))
    ranked = staged(ranked, "projection-segments")
    found = ranked.join(rows.select("row", "label", "dims", "vector"), F.col("r") == F.col("row")).drop("r")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        ids = table["row"].to_numpy()
        border = [table[name].to_numpy(zero_copy_only=False) for name in ("pass", "label", "dims")]
        new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in border], axis=0)])
        links = []
        # Neighbours of another pass, label or length are not compared.
        for part in np.split(np.arange(len(ids)), np.flatnonzero(new)[1:]):
            vectors = matrix(table.slice(part[0], len(part)))
            for at in range(0, len(part), rule.window):
                left, right = vectors[at : at + rule.window], vectors[at : at + 2 * rule.window]
                a, b = np.nonzero(left @ right.T >= rule.least)
                close = (b > a) & (b <= a + rule.window)
                links.append(part[0] + at + np.stack([a[close], b[close]]))
        a, b = np.concatenate(links, axis=1)
        return tree(ids, a, b)

    return staged(found.groupBy("segment").applyInArrow(run, "u bigint, v bigint").distinct(), "projection-links")


def counts(members: DataFrame, rule: Rule) -> DataFrame:
    """(row, n): how many other vectors of its group each member links with, equal ones included; members have a weight.

    Members are laid out by group and key in blocks of one size. Small groups share a block; a group of many blocks is
    compared block by block, each pair of blocks on its own.
    """
    laid = placed(members, [], ["group", "key", "row"], "projection-members")
    laid = staged(laid.withColumn("block", F.expr(f"place div {rule.block}")).drop("place", "size"), "projection-blocks")
    schema = "row bigint, n bigint"

    def linked(left: pa.Table, right: pa.Table, same: bool) -> pa.Table:
        x, y = matrix(left), matrix(right)
        if not same:
            # No link can hold where the centres' angle exceeds the radii by more than the angle of a link.
            centres = [v.mean(axis=0) for v in (x, y)]
            norms = [float(np.linalg.norm(c)) for c in centres]
            if all(norm > 1e-6 for norm in norms):
                cx, cy = (c / norm for c, norm in zip(centres, norms, strict=True))
                reach = sum(math.acos(max(-1.0, min(1.0, float((v @ c).min())))) for v, c in ((x, cx), (y, cy)))
                if math.acos(max(-1.0, min(1.0, float(cx @ cy)))) > reach + math.acos(rule.least) + 1e-6:
                    return pa.table({"row": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        hit = (x @ y.T >= rule.least).astype(np.float64)
        wx, wy = (t["weight"].to_numpy().astype(np.float64) for t in (left, right))
        if same:
            np.fill_diagonal(hit, 0)
            return pa.table({"row": left["row"], "n": pa.array((hit @ wx).astype(np.int64))})
        n = np.concatenate([hit @ wy, hit.T @ wx]).astype(np.int64)
        return pa.table({"row": pa.concat_arrays([*left["row"].chunks, *right["row"].chunks]), "n": pa.array(n)})

    def within(table: pa.Table) -> pa.Table:
        table = table.sort_by("group")
        group = table["group"].to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        return pa.concat_tables(
            [linked(t, t, True) for t in (table.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True))]
        )

    def across(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        return linked(table.filter(pa.array(side == 0)), table.filter(pa.array(side == 1)), False)

    inside = laid.groupBy("block").applyInArrow(within, schema)
    spans = laid.groupBy("group").agg(F.min("block").alias("low"), F.max("block").alias("high")).filter("low < high")
    pairs = spans.withColumn("i", F.explode(F.sequence("low", "high"))).filter("i < high")
    pairs = staged(pairs.select("group", "i", F.explode(F.expr("sequence(i + 1, high)")).alias("j")), "projection-pairs")
    sides = [
        laid.join(pairs.withColumnRenamed(name, "block"), ["group", "block"])
        .select("group", *([F.col("block").alias("i"), "j"] if name == "i" else ["i", F.col("block").alias("j")]),
                "row", "weight", "vector", F.lit(side).alias("side"))
        for side, name in enumerate("ij")
    ]
    between = sides[0].unionByName(sides[1]).groupBy("group", "i", "j").applyInArrow(across, schema)
    return inside.unionByName(between).groupBy("row").agg(F.sum("n").alias("n"))


def near_copies(embeddings: DataFrame, vector: str = "embedding", rule: Rule = Rule()) -> DataFrame:
    """Per vector: vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable), and kept."""
    most = embeddings.filter("label is not null").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    rows = keyed(embeddings, vector, rule.passes(most), rule)
    able = rows.filter("dims is not null")
    same = ["label", "dims", "d1", "d2"]
    classes = able.groupBy(*same).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("weight")).filter("weight > 1")
    classes = staged(classes, "projection-classes")
    narrow = rows.select("row", "vec_id", *same)
    named = narrow.join(bounded(classes), same, "left").select(
        "row", "vec_id", F.coalesce("first", "row").alias("first"), F.coalesce("weight", F.lit(1)).alias("weight")
    )
    named = staged(named, "projection-named")
    copies = staged(named.filter("row != first").select(F.col("row").alias("copy")), "projection-copies")
    single = able.join(bounded(copies), F.col("row") == F.col("copy"), "left_anti")
    groups = components(neighbours(single, rule))
    groups = staged(groups.unionByName(groups.select(F.col("v").alias("u"), "v")).distinct(), "projection-groups")
    weights = named.filter("row = first").select(F.col("row").alias("w"), "weight")
    members = (
        groups.select(F.col("u").alias("row"), F.col("v").alias("group"))
        .join(single.select("row", F.col("keys")[0].alias("key"), "vector"), "row")
        .join(weights, F.col("row") == F.col("w"))
        .select("row", "group", "key", "weight", "vector")
    )
    linked = staged(counts(members, rule), "projection-counts")
    grouped = groups.select(F.col("u").alias("first"), F.col("v").alias("group")).join(
        linked.select(F.col("row").alias("first"), "n"), "first"
    )
    # All rows of a group, of which the smallest identifier names it; equal rows without neighbours are groups too.
    out = named.join(grouped, "first", "left")
    out = out.select("row", "vec_id", F.coalesce("group", "first").alias("group"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = staged(out, "projection-out")
    least = out.filter("n_links > 0").groupBy("group").agg(F.min(F.coalesce("vec_id", F.lit(LAST_ID))).alias("least"))
    out = out.join(bounded(staged(least, "projection-least")), "group", "left")
    component = F.when(F.col("least") < LAST_ID, F.col("least")).when(F.col("least").isNull(), F.col("vec_id"))
    out = out.select("row", "vec_id", "n_links", component.alias("component_id"))
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
