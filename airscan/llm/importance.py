"""Importance resampling towards a target: hashed word runs, log ratio gains, and a draw by Gumbel keys.

Features are hashed by CRC-32 of their bytes, for all features of a batch at once. The checksum is linear: each byte adds
what a table holds for its value and its distance from the end, so a feature's sum is the XOR of its bytes' entries
(``bitwise_xor.reduceat`` over the features' spans) with a constant of its length. Spans longer than the table are cut into
blocks from their end; blocks are folded in pairs, the left one moved past the right one's bytes by the same table.

Counts by bucket are summed per task, then over tasks; the gains are one number a bucket (``Rule.buckets`` in all, whatever
the data). Drawing sorts the documents' scores over all partitions and counts ranks, so any share can be drawn.

Words are runs of 0-9, a-z and all characters beyond ASCII, with A-Z lowered. A null or empty text has no features, weight
0, and is never drawn; it is not among the documents that the share is taken of. A null doc_id is drawn with the key of
an empty id, after all others of its score. Equal scores go by doc_id, rows of one doc_id by weight and features; repeated
rows are drawn as separate rows. Long texts are read in pieces that end between words, so that memory follows the piece and
the longest word. Empty tables give an empty result, an empty target gives gains from the corpus alone. Other columns are
not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airscan.llm.frames import batches, utf8, whole_text
from airscan.llm.order import placed
from airscan.sources.local import staged

REACH = 32  # distances from the end that the table knows
PIECE = 1 << 19  # bytes hashed at once
ONES = np.uint32(0xFFFFFFFF)
POLYNOMIAL = np.uint32(0xEDB88320)  # fixed value


@dataclass(frozen=True)
class Rule:
    """Longest run of words, buckets, words a drawn document has at least, share drawn in percent, and the seed of the keys."""

    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024


# -- CRC-32 by position -------------------------------------------------------


def position_table() -> np.ndarray:
    """[distance from the end, byte] -> what the byte adds to the sum."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = (one >> 1) ^ np.where(one & 1, POLYNOMIAL, np.uint32(0))
    table = np.empty((REACH, 256), np.uint32)
    table[0] = one
    for d in range(1, REACH):
        table[d] = one[table[d - 1] & 255] ^ (table[d - 1] >> 8)
    return table


TABLE = position_table()


def moved(sums: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Sums after as many zero bytes as the shift (4 x 256: one row a byte of the sum) stands for."""
    return shift[0][sums & 255] ^ shift[1][(sums >> 8) & 255] ^ shift[2][(sums >> 16) & 255] ^ shift[3][sums >> 24]


#: Zero bytes in the place of the table's whole reach; a sum is like four bytes before them.
SHIFT = np.stack([TABLE[REACH - 1 - k] for k in range(4)])
#: What the initial ones become after n bytes.
LENGTH = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32) ^ ONES


def checksums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data``; spans are not empty and may overlap."""
    if not len(starts):
        return np.empty(0, np.uint32)
    pieces = -(-lengths // REACH)
    span = np.repeat(np.arange(len(starts)), pieces)
    from_end = np.repeat(np.cumsum(pieces), pieces) - 1 - np.arange(len(span))
    ends = (starts + lengths)[span] - from_end * REACH
    begins = np.maximum(starts[span], ends - REACH)
    size = ends - begins
    cut = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat(begins - cut, size)
    distance = np.repeat(ends, size) - 1 - at
    sums = np.bitwise_xor.reduceat(TABLE[distance, data[at]], cut)
    first = begins == starts[span]
    sums[first] ^= LENGTH[size[first]]
    shift = SHIFT
    while len(span) > len(starts):
        odd = (from_end & 1).astype(bool)
        left = np.flatnonzero(odd)
        sums[left + 1] ^= moved(sums[left], shift)
        span, from_end, sums = span[~odd], from_end[~odd] >> 1, sums[~odd]
        shift = np.stack([moved(row, shift) for row in shift])
    return sums ^ ONES


# -- features -----------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


class Found(NamedTuple):
    """Buckets of features with the text each belongs to, and the words of each text."""

    buckets: np.ndarray
    text: np.ndarray
    words: np.ndarray


def compact(data: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words joined by one space: bytes, start and end of each word, and each word's text."""
    inside = IN_WORD[data]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    kept = inside.copy()
    kept[ends[ends < len(data)]] = True
    joined = np.where(inside, data, 32)[kept]
    lengths = ends - starts
    new = np.cumsum(lengths + 1) - lengths - 1
    return joined, new, new + lengths, text[starts]


def features(texts: list[bytes], skipped: list[int], rule: Rule) -> Found:
    """Features of texts whose first ``skipped`` words were counted before, and begin features only."""
    data = LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    sizes = np.array([len(x) + 1 for x in texts])
    joined, starts, ends, text = compact(data, np.repeat(np.arange(len(texts)), sizes))
    words = np.bincount(text, minlength=len(texts))
    place = np.arange(len(text)) - np.repeat(np.cumsum(words) - words, words)
    old = np.array(skipped)
    buckets, owner = [], []
    for run in range(1, rule.longest + 1):
        last = np.flatnonzero((place >= run - 1) & (place >= old[text]))
        first = last - (run - 1)
        sums = checksums(joined, starts[first], ends[last] - starts[first])
        buckets.append(sums.astype(np.int64) % rule.buckets)
        owner.append(text[last])
    return Found(np.concatenate(buckets), np.concatenate(owner), words - np.minimum(words, old))


def pieces(text: bytes, rule: Rule) -> Iterator[tuple[bytes, int]]:
    """A text cut between words, each piece led by the words that runs may begin with, and the number of those."""
    lead: list[bytes] = []
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and IN_WORD[LOWER[text[end]]]:
            end += 1
        part = text[at:end]
        yield b" ".join([*lead, part]), len(lead)
        keep = rule.longest - 1
        if keep:
            flat = LOWER[np.frombuffer(part, np.uint8)]
            words = np.where(IN_WORD[flat], flat, 32).tobytes().split(b" ")
            lead = [*lead, *(w for w in words if w)][-keep:]
        at = end
    yield b" ".join([*lead, text[at:]]), len(lead)


def found(texts: list[bytes], rule: Rule) -> Iterator[tuple[np.ndarray, Found]]:
    """Features of texts, some at a time: the numbers of the texts and what was found in them."""
    numbers: list[int] = []
    parts: list[bytes] = []
    old: list[int] = []
    held = 0
    for number, text in enumerate(texts):
        for part, skipped in pieces(text, rule):
            if parts and held + len(part) > PIECE:
                yield np.array(numbers), features(parts, old, rule)
                numbers, parts, old, held = [], [], [], 0
            numbers.append(number)
            parts.append(part)
            old.append(skipped)
            held += len(part)
    if parts:
        yield np.array(numbers), features(parts, old, rule)


# -- corpus -------------------------------------------------------------------


def bucket_counts(rows: DataFrame, rule: Rule) -> DataFrame:
    """(bucket, n) over all whole texts."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(rule.buckets, np.int64)
        for batch in batches(frames):
            for _, got in found(utf8(batch[0]), rule):
                total += np.bincount(got.buckets, minlength=rule.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    counts = rows.select(whole_text().alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, rule: Rule) -> np.ndarray:
    """The gain of every bucket in thousandths."""
    counts = []
    for rows in (target, documents):
        n = np.zeros(rule.buckets, np.float64)
        for bucket, count in bucket_counts(rows, rule).collect():  # at most one row a bucket
            n[bucket] = count
        counts.append(n)
    t, s = counts
    ratio = (t + 1) * (s.sum() + rule.buckets) / ((s + 1) * (t.sum() + rule.buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weighted(documents: DataFrame, gain: np.ndarray, rule: Rule) -> DataFrame:
    """Per document: doc_id, n_features, weight and n_words."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            count, weight, words = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for numbers, got in found(utf8(batch[1]), rule):
                n = np.bincount(got.text, minlength=len(numbers))
                sums = np.concatenate([[0], np.cumsum(gain[got.buckets[np.argsort(got.text, kind="stable")]])])
                ends = np.cumsum(n)
                np.add.at(count, numbers, n)
                np.add.at(weight, numbers, sums[ends] - sums[ends - n])
                np.add.at(words, numbers, got.words)
            yield pa.RecordBatch.from_arrays(
                [batch[0], *map(pa.array, (count, weight, words))], ["doc_id", "n_features", "weight", "n_words"]
            )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_features bigint, weight bigint, n_words bigint")


def resampled(documents: DataFrame, target: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Per document: doc_id, n_features, weight, score, n_words, and rank (null where it is not drawn)."""
    # Written before it is sorted, as sorting over partitions reads its input twice.
    rows = staged(weighted(documents, gains(documents, target, rule), rule), "resampled-weights")
    key = F.concat(F.lit(f"{rule.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = rows.withColumn("score", F.col("weight") + gumbel)
    rows = rows.withColumn("able", F.col("n_words") >= rule.least_words)
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id"), "weight", "n_features"]
    rows = placed(rows, [], order, "resampled")
    able = rows.filter("able").count()
    rank = F.when(F.col("able") & (F.col("place") < able * rule.percent // 100), F.col("place") + 1)
    return rows.select("doc_id", "n_features", "weight", "score", "n_words", rank.alias("rank"))


def drawn(documents: DataFrame, target: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The drawn documents' doc_id, rank and score."""
    return resampled(documents, target, rule).filter("rank is not null").select("doc_id", "rank", "score")
