"""A Merkle manifest whose parents retain hash states, so that a proof is folded from the replaced leaf on.

The children of a node are written as hexadecimal digests of 64 bytes, which is one block of SHA-256. A node keeps, for
each child, the hash state just before that child's block. To see what root a replaced leaf gives, folding resumes the
state kept before the leaf's slot, takes the replacement and only the siblings to its right, and goes on with the digest
at the parent's own slot. What stands left of a slot is never read again.

A leaf is the digest of a row's fields; the leaves of a source, in order of doc_id, form a tree of nodes of three, and the
subroots of all sources, in order of source, form one more. Trees are built in chunks of 81 nodes (four levels), chunks of
chunks and so on; within a batch all nodes of a level are hashed at once. Paths go down the same way: a chunk hands each
chunk below it the slots, states and siblings up to the root. No tree, path or list of sources is held by one task.

Null fields are written as ``-``. Rows with a null source form a tree of their own, first in order; a null doc_id comes
first in its tree, and rows of one doc_id follow each other by digest. Repeated rows are separate leaves. Empty texts are
fields of length 0, very long ones are hashed by Spark in one pass. An empty table gives an empty result. Columns other
than doc_id, source, lang, n_chars and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airscan.llm.frames import batches
from airscan.llm.order import placed
from airscan.sources.local import staged

FAN = 3
DEEP = 4  # levels of a chunk
CHUNK = FAN**DEEP
TOGETHER = 128  # chunks hashed at once
ITEM = "struct<place: bigint, digest: string, doc_id: bigint, replacement: string, name: string>"
CHUNKS = f"tree string, chunk bigint, size bigint, items array<{ITEM}>, top string, above binary, states binary"
#: One level of a path: the slot, the number of children, the state kept before the slot, and all children.
STEP = np.dtype([("slot", "u1"), ("width", "u1"), ("state", ">u4", 8), ("children", ">u4", (FAN, 16))])


# -- SHA-256 over many blocks at once -----------------------------------------


def primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= x else (low, mid - 1)
    return low


#: The first 32 fraction bits of the square and cube roots of the first primes.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in primes(8)], np.uint32)
ROUNDS = np.array([cube_root(p << 96) & 0xFFFFFFFF for p in primes(64)], np.uint32)


def turned(x: np.ndarray, *by: int) -> np.ndarray:
    """XOR of x rotated right by each amount."""
    out = (x >> by[0]) | (x << (32 - by[0]))
    for r in by[1:]:
        out ^= (x >> r) | (x << (32 - r))
    return out


def absorbed(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states (n, 8) after one more block (n, 16) each."""
    if not len(state):
        return state
    w = np.empty((64, len(block)), np.uint32)
    w[:16] = block.T
    for t in range(16, 64):
        low, high = w[t - 15], w[t - 2]
        w[t] = w[t - 16] + (turned(low, 7, 18) ^ (low >> 3)) + w[t - 7] + (turned(high, 17, 19) ^ (high >> 10))
    first = np.ascontiguousarray(state.T)
    a, b, c, d, e, f, g, h = first
    for t in range(64):
        one = h + turned(e, 6, 11, 25) + (g ^ (e & (f ^ g))) + ROUNDS[t] + w[t]
        two = turned(a, 2, 13, 22) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return (first + np.stack([a, b, c, d, e, f, g, h])).T


def closed(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 8) of messages of that many whole blocks."""
    last = np.zeros((len(state), 16), np.uint32)
    last[:, 0], last[:, 14], last[:, 15] = 1 << 31, blocks >> 23, blocks << 9
    return absorbed(state, last)


def texts(digests: np.ndarray) -> list[str]:
    whole = digests.astype(">u4").tobytes().hex()
    return [whole[i : i + 64] for i in range(0, len(whole), 64)]


def blocks_of(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 8) as the blocks (n, 16) that their hexadecimal texts are."""
    return np.frombuffer(digests.astype(">u4").tobytes().hex().encode(), ">u4").reshape(-1, 16).astype(np.uint32)


def blocks_of_texts(digests: list[str]) -> np.ndarray:
    return np.frombuffer("".join(digests).encode(), ">u4").reshape(-1, 16).astype(np.uint32)


# -- chunks -------------------------------------------------------------------


def depths(counts: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Levels of each chunk: all where the tree has further chunks, else until one node remains."""
    needed = np.ceil(np.log(np.maximum(counts, 1)) / np.log(FAN) - 1e-9).astype(int)
    return np.where(more, DEEP, needed)


class Level(NamedTuple):
    """Children of one level of several chunks: their blocks, the states kept before them, and where each chunk's begin."""

    blocks: np.ndarray
    states: np.ndarray
    starts: np.ndarray
    counts: np.ndarray


def levels_of(blocks: np.ndarray, counts: np.ndarray, deep: np.ndarray) -> tuple[list[Level], np.ndarray]:
    """All levels of chunks whose leaves stand one after another, and the block of each chunk's top."""
    out, tops = [], np.empty((len(counts), 16), np.uint32)
    for level in range(int(deep.max(initial=0)) + 1):
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        done = (deep == level) & (counts > 0)
        tops[done] = blocks[starts[done]]
        counts = np.where(deep > level, counts, 0)
        if not counts.any():
            break
        parents = -(-counts // FAN)
        chunk = np.repeat(np.arange(len(counts)), parents)
        rank = np.arange(len(chunk)) - np.repeat(np.cumsum(parents) - parents, parents)
        first, width = starts[chunk] + FAN * rank, np.minimum(FAN, counts[chunk] - FAN * rank)
        kept, state = np.empty((len(blocks), 8), np.uint32), np.tile(START, (len(chunk), 1))
        for slot in range(FAN):
            here = width > slot
            kept[first[here] + slot] = state[here]
            state[here] = absorbed(state[here], blocks[first[here] + slot])
        out.append(Level(blocks, kept, starts, counts))
        blocks, counts = blocks_of(closed(state, width)), parents
    return out, tops


def packed(parts: list[np.ndarray], chunk: int, levels: list[Level]) -> bytes:
    return b"".join(
        part[at.starts[chunk] : at.starts[chunk] + at.counts[chunk]].astype(">u4").tobytes()
        for part, at in zip(parts, levels, strict=True)
    )


def built(chunks: DataFrame) -> DataFrame:
    """Chunks (tree, chunk, size, items) with their top, the digests above the items and the states kept before every child."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                items = part["items"]
                counts = items.value_lengths().to_numpy(zero_copy_only=False)
                blocks = blocks_of_texts(items.flatten().field("digest").to_pylist())
                more = part["size"].to_numpy(zero_copy_only=False) > CHUNK
                levels, tops = levels_of(blocks, counts, depths(counts, more))
                above = [packed([x.blocks for x in levels[1:]], i, levels[1:]) for i in range(len(counts))]
                states = [packed([x.states for x in levels], i, levels) for i in range(len(counts))]
                top = [row.astype(">u4").tobytes().decode() for row in tops]
                yield pa.RecordBatch.from_arrays(
                    [part["tree"], part["chunk"], part["size"], items, pa.array(top, pa.string()),
                     pa.array(above, pa.binary()), pa.array(states, pa.binary())],
                    ["tree", "chunk", "size", "items", "top", "above", "states"],
                )

    return staged(chunks.mapInArrow(run, CHUNKS), "manifest-chunks")


def grouped(nodes: DataFrame) -> DataFrame:
    """Chunks of nodes (tree, size, place and the fields of an item)."""
    item = F.struct("place", "digest", "doc_id", "replacement", "name").cast(ITEM)
    rows = nodes.groupBy("tree", F.expr(f"place div {CHUNK}").alias("chunk"), "size")
    return rows.agg(F.sort_array(F.collect_list(item)).alias("items")).select("tree", "chunk", "size", "items")


def trees(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Written chunks of every height, leaves first, and (tree, digest, size) of the tops."""
    heights, tops = [built(grouped(nodes))], []
    while True:
        chunks = heights[-1]
        tops.append(chunks.filter(f"size <= {CHUNK}").select("tree", F.col("top").alias("digest"), F.lit(len(heights) - 1).alias("height")))
        above = chunks.filter(f"size > {CHUNK}")
        if above.isEmpty():
            break
        none = F.lit(None)
        nodes = above.select(
            "tree", F.expr(f"(size + {CHUNK - 1}) div {CHUNK}").alias("size"), F.col("chunk").alias("place"),
            F.col("top").alias("digest"), none.alias("doc_id"), none.alias("replacement"), none.alias("name"),
        )
        heights.append(built(grouped(nodes)))
    whole = tops[0]
    for more in tops[1:]:
        whole = whole.unionByName(more)
    return heights, whole


class Manifest(NamedTuple):
    """Written chunks of the sources' trees and of the tree of subroots, by height, and the root (null without rows)."""

    documents: list[DataFrame]
    sources: list[DataFrame]
    root: str | None


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """The digest of a row's fields, with ``text`` as its text."""
    fields = [field(F.col(name)) for name in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*fields, field(text)).cast("binary"), 256)


def manifest(documents: DataFrame, replacement: Column | None = None) -> Manifest:
    """The manifest of documents; ``replacement`` is the text that folding is to put in place of a row's own."""
    replaced = F.lit(None).cast("string") if replacement is None else leaf(replacement)
    source = F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit(""))
    rows = documents.select(
        source.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf(F.col("text")).alias("digest"), replaced.alias("replacement")
    )
    nodes = placed(rows, ["tree"], [F.col("doc_id").asc_nulls_first(), "digest"], "manifest-leaves")
    documents_, tops = trees(nodes.withColumn("name", F.lit(None)))
    tops = staged(tops, "manifest-subroots")
    named = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("digest"), F.col("height").alias("doc_id"))
    named = placed(named, ["tree"], ["name"], "manifest-sources").withColumn("replacement", F.lit(None))
    sources, roots = trees(named)
    root = roots.first()
    return Manifest(documents_, sources, root["digest"] if root else None)


# -- folding ------------------------------------------------------------------


def opened(batch: pa.RecordBatch) -> tuple[list[Level], np.ndarray, pa.StructArray]:
    """The levels of a batch of written chunks, the chunks' numbers of items, and all items."""
    lists = batch["items"]
    items, counts = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    deep = depths(counts, batch["size"].to_numpy(zero_copy_only=False) > CHUNK)
    above, states = ([np.frombuffer(x, ">u4") for x in batch[name].to_pylist()] for name in ("above", "states"))
    levels, at, now = [], np.zeros(len(counts), int), counts
    blocks = blocks_of_texts(items.field("digest").to_pylist())
    for level in range(int(deep.max(initial=0))):
        now = np.where(deep > level, now, 0)
        if level:
            before = at - counts
            cut = [x[16 * a : 16 * (a + n)] for x, a, n in zip(above, before, now, strict=True)]
            blocks = np.concatenate(cut).astype(np.uint32).reshape(-1, 16)
        cut = [x[8 * a : 8 * (a + n)] for x, a, n in zip(states, at, now, strict=True)]
        kept = np.concatenate(cut).astype(np.uint32).reshape(-1, 8)
        if not level and len(kept) < len(blocks):  # chunks of one node have no levels
            blocks = blocks[np.repeat(now > 0, counts)]
        levels.append(Level(blocks, kept, np.cumsum(now) - now, now))
        at, now = at + now, -(-now // FAN)
    return levels, counts, items


def steps(levels: list[Level], chunk: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each level the items that have one, and their steps; ``rank`` counts within the chunk."""
    for number, level in enumerate(levels):
        here = np.flatnonzero(level.counts[chunk])
        place = rank[here] // FAN**number
        own, slot = level.starts[chunk[here]] + place, place % FAN
        out = np.zeros(len(here), STEP)
        out["slot"], out["width"] = slot, np.minimum(FAN, level.counts[chunk[here]] - place + slot)
        out["state"] = level.states[own]
        for other in range(FAN):
            there = (out["width"] > other) & (slot != other)
            out["children"][there, other] = level.blocks[(own - slot)[there] + other]
        yield here, out


class Folding:
    """Digests that are carried up, and the running hash of the siblings met."""

    def __init__(self, digests: list[str]) -> None:
        self.blocks = blocks_of_texts(digests)
        self.proof = np.tile(START, (len(digests), 1))
        self.met = np.zeros(len(digests), np.int64)

    def up(self, here: np.ndarray, step: np.ndarray) -> None:
        """One level up for some digests: resume the state before the slot, then take the siblings to the right only."""
        slot, width, children = step["slot"], step["width"], step["children"].astype(np.uint32)
        state = absorbed(step["state"].astype(np.uint32), self.blocks[here])
        for other in range(FAN):
            sibling = (width > other) & (slot != other)
            right = sibling & (slot < other)
            state[right] = absorbed(state[right], children[right, other])
            self.proof[here[sibling]] = absorbed(self.proof[here[sibling]], children[sibling, other])
            self.met[here[sibling]] += 1
        self.blocks[here] = blocks_of(closed(state, width.astype(np.int64)))


def below(chunks: DataFrame, names: bool) -> DataFrame:
    """(tree, chunk, path, subroot) for every item of chunks that have their own path: what the chunk below goes on with."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                levels, counts, items = opened(part)
                chunk = np.repeat(np.arange(len(counts)), counts)
                rank = np.arange(len(chunk)) - np.repeat(np.cumsum(counts) - counts, counts)
                paths: list[list[bytes]] = [[] for _ in chunk]
                for here, step in steps(levels, chunk, rank):
                    whole = step.tobytes()
                    for i, x in enumerate(here):
                        paths[x].append(whole[i * STEP.itemsize : (i + 1) * STEP.itemsize])
                upper, subroot = part["path"].to_pylist(), part["subroot"].to_pylist()
                path = [b"".join([*x, upper[c]]) for x, c in zip(paths, chunk, strict=True)]
                trees_ = items.field("name") if names else part["tree"].take(pa.array(chunk))
                place = pa.array(np.zeros(len(chunk), np.int64)) if names else items.field("place")
                root = items.field("digest") if names else pa.array([subroot[c] for c in chunk], pa.string())
                # The height of a source's tree rides in the place of its doc_id.
                yield pa.RecordBatch.from_arrays(
                    [trees_, place, pa.array(path, pa.binary()), root, items.field("doc_id")],
                    ["tree", "chunk", "path", "subroot", "height"],
                )

    return staged(chunks.mapInArrow(run, "tree string, chunk bigint, path binary, subroot string, height bigint"), "manifest-paths")


def with_paths(chunks: DataFrame, paths: DataFrame) -> DataFrame:
    return chunks.join(paths.select("tree", "chunk", "path", "subroot"), ["tree", "chunk"])


def folded(written: Manifest) -> DataFrame:
    """Per row: source, doc_id, leaf, subroot, root, proof_sha256 and folded_root, which uses the replacement where there is one."""
    session = written.documents[0].sparkSession
    start = session.createDataFrame([("", 0, b"", None)], "tree string, chunk bigint, path binary, subroot string")
    paths = start
    for height in range(len(written.sources) - 1, -1, -1):
        paths = below(with_paths(written.sources[height], paths), names=not height)
    tops, paths = paths, None
    for height in range(len(written.documents) - 1, -1, -1):
        here = tops.filter(F.col("height") == height)
        paths = here if paths is None else here.unionByName(paths)
        if height:
            paths = below(with_paths(written.documents[height], paths), names=False)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                levels, counts, items = opened(part)
                chunk = np.repeat(np.arange(len(counts)), counts)
                rank = np.arange(len(chunk)) - np.repeat(np.cumsum(counts) - counts, counts)
                leaves = items.field("digest")
                fold = Folding([new or old for new, old in zip(items.field("replacement").to_pylist(), leaves.to_pylist(), strict=True)])
                for here, step in steps(levels, chunk, rank):
                    fold.up(here, step)
                upper = [np.frombuffer(x, STEP) for x in part["path"].to_pylist()]
                for level in range(max(map(len, upper))):
                    has = np.array([len(x) > level for x in upper])
                    line = np.cumsum(has) - 1
                    here = np.flatnonzero(has[chunk])
                    fold.up(here, np.array([x[level] for x in upper if len(x) > level], STEP)[line[chunk[here]]])
                root = [row.astype(">u4").tobytes().decode() for row in fold.blocks]
                chunks_ = pa.array(chunk)
                yield pa.RecordBatch.from_arrays(
                    [part["tree"].take(chunks_), items.field("doc_id"), leaves, part["subroot"].take(chunks_),
                     pa.array(texts(closed(fold.proof, fold.met)), pa.string()), pa.array(root, pa.string())],
                    ["tree", "doc_id", "leaf", "subroot", "proof_sha256", "folded_root"],
                )

    schema = "tree string, doc_id bigint, leaf string, subroot string, proof_sha256 string, folded_root string"
    rows = with_paths(written.documents[0], paths).mapInArrow(run, schema)
    source = F.when(F.col("tree") != "", F.expr("substring(tree, 2)"))
    root = F.lit(written.root).cast("string")
    return rows.select(source.alias("source"), "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root")
