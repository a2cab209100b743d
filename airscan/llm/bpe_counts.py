"""Token counts by byte-pair merging with a heap over a linked list.

The number of tokens of a piece is its number of bytes less the number of merges, so no token identifier is
ever formed. Pieces recur, so each task keeps the counts of the pieces it has met in a table of bounded size.

Null and empty texts have no tokens. Rows may repeat; each gets its own result row. Texts of any length are
read whole; the pieces of a long text are taken one after the other and not listed.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airscan.llm.frames import batches, whole_text

# Fixed value: how the byte-level vocabulary cuts a text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
LISTED = 1 << 22  # characters up to which the pieces of a text are listed at once
REMEMBERED = 1 << 18  # pieces whose counts a task keeps


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, with the byte.

    Printable Latin-1 characters stand for themselves; the other bytes take the characters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(byte): byte for byte in shown} | {chr(256 + i): byte for i, byte in enumerate(hidden)}


def read_merges(path: str) -> tuple[dict[int, tuple[int, int]], list[str]]:
    """Merges of a vocabulary file as ``left << 32 | right -> (rank, merged symbol)``, and its special strings."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    symbols: dict[str, int] = dict(byte_symbols())
    merges = {}
    for rank, pair in enumerate(content["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merged = symbols.setdefault(left + right, 256 + rank)
        merges[symbols[left] << 32 | symbols[right]] = (rank, merged)
    return merges, [token["content"] for token in content.get("added_tokens", ())]


def count_merged(piece: bytes, merges: dict[int, tuple[int, int]]) -> int:
    """Symbols left when the adjacent pair of lowest rank, the leftmost first, is merged until none is left."""
    symbols = list(piece)
    size = len(symbols)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    heap = []
    for i in range(size - 1):
        found = merges.get(symbols[i] << 32 | symbols[i + 1])
        if found:
            heap.append((found[0], i, found[1], symbols[i + 1]))
    heapq.heapify(heap)
    left = size
    while heap:
        rank, i, merged, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] < 0 or j >= size or symbols[j] != right:
            continue
        now = merges.get(symbols[i] << 32 | right)
        if now is None or now[0] != rank:
            continue
        symbols[i], symbols[j] = merged, -1
        after[i] = after[j]
        if after[i] < size:
            before[after[i]] = i
            found = merges.get(merged << 32 | symbols[after[i]])
            if found:
                heapq.heappush(heap, (found[0], i, found[1], symbols[after[i]]))
        if before[i] >= 0:
            k = before[i]
            found = merges.get(symbols[k] << 32 | merged)
            if found:
                heapq.heappush(heap, (found[0], k, found[1], merged))
        left -= 1
    return left


class PieceCounts(dict):
    """Counts by piece, computed when first asked for; emptied when it has grown to its bound."""

    def __init__(self, merges: dict[int, tuple[int, int]]):
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        count = count_merged(piece.encode(), self.merges)
        if len(piece) <= 64:
            self[piece] = count
        return count


def counter(merges: dict[int, tuple[int, int]], special: list[str]) -> Callable[[str], int]:
    """A function that counts the tokens of a text; a special string counts as one token."""
    counts = PieceCounts(merges)
    pieces = regex.compile(PIECES)
    cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def plain(text: str) -> int:
        if len(text) <= LISTED:
            return sum(map(counts.__getitem__, pieces.findall(text)))
        return sum(counts[found.group()] for found in pieces.finditer(text))

    def count(text: str) -> int:
        if cut is None or not cut.search(text):
            return plain(text)
        parts = cut.split(text)
        return len(parts) - 1 + sum(map(plain, parts))

    return count


def token_counts(documents: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): UTF-8 bytes, tokens, and whether the tokens exceed ``limit``.

    ``vocabulary`` is a byte-level vocabulary file on the driver; its merges, whose number the file fixes, are
    broadcast. One pass, no shuffle.
    """
    shared = documents.sparkSession.sparkContext.broadcast(read_merges(vocabulary))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(*shared.value)
        for batch in batches(frames):
            texts = batch.column(1).to_pylist()
            tokens = [count(text) for text in texts]
            sizes = [len(text.encode()) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return documents.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).mapInArrow(run, SCHEMA)
