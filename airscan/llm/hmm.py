"""A hidden Markov language model, trained by Baum-Welch over all partitions.

A text is its words (A-Z in lower case) and one end token. The states emit word classes: short words stand for
themselves, longer ones for their ending, folded into a fixed number of classes; within a class a word has its share of
the training tokens, with one place kept for unseen words. The class of a word does not depend on the corpus, so the
model that is broadcast (states x classes) has a fixed size, while the word counts stay a table that grows with the
input and is joined to the blocks of texts that use them.

Texts are coded once into blocks of whole documents: numbers into the block's own word list. An expectation step sums
expected counts within a task, then by class across partitions. The score is the scaled forward recursion's exact
likelihood; a text of any length is read whole.

Null text counts as empty and has the end token only. A null doc_id counts as the empty text when its remainder is
taken. Repeated rows are separate rows. Without training rows the base has N = V = 0 and the states are uniform. An empty
table gives an empty result. Columns other than doc_id and text are not read. Sums are over all rows, so scores do not
depend on how the rows lie in files or partitions, but for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airscan.llm.frames import batches, utf8, whole_text, words
from airscan.sources.local import staged

BLOCKS = """block bigint, doc_ids array<bigint>, trained array<boolean>, ends array<bigint>, tokens binary,
    words array<bigint>, classes array<int>, counts array<int>"""
SCORES = """doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,
    base_score double, score double"""


@dataclass(frozen=True)
class Settings:
    """States, classes and rounds of the model; tokens of a block (a longer text has a block of its own).

    Training starts from the counts of adjacent classes: ``common`` classes by themselves, all others folded into
    ``folded`` groups, fitted by ``start_rounds`` rounds on that table of fixed size.
    """

    states: int = 10
    classes: int = 1 << 14
    rounds: int = 2
    start_rounds: int = 300
    common: int = 192
    folded: int = 64
    block_tokens: int = 1_000_000
    stay: float = 0.9
    prior: float = 200.0


@dataclass
class Model:
    """Start, transition and emission probabilities; emissions have one row per class."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def word_class(word: bytes, classes: int) -> int:
    """0 for the end token, else a class by the word (up to 5 bytes) or its last 4 bytes."""
    if not word:
        return 0
    return 1 + xxhash.xxh3_64_intdigest(word if len(word) <= 5 else b"\x00" + word[-4:]) % (classes - 1)


class Coder:
    """Collects whole documents into blocks."""

    def __init__(self, settings: Settings, first: int):
        self.settings, self.block = settings, first
        self.clear()

    def clear(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.ids, self.trained, self.lengths, self.parts = [], [], [], []
        self.size = 0

    def add(self, doc_id: int | None, trained: bool, text: bytes) -> None:
        seen = self.seen
        numbers = [seen.setdefault(word, len(seen)) for word in words(text)]
        numbers.append(seen.setdefault(b"", len(seen)))
        self.ids.append(doc_id)
        self.trained.append(trained)
        self.lengths.append(len(numbers))
        self.parts.append(np.array(numbers, np.int32))
        self.size += len(numbers)

    def row(self) -> pa.RecordBatch:
        tokens, ends = np.concatenate(self.parts), np.cumsum(self.lengths)
        used = np.repeat(np.array(self.trained, bool), self.lengths)
        counts = np.bincount(tokens[used], minlength=len(self.seen))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.seen), np.uint64, len(self.seen)).view(np.int64)
        classes = [word_class(word, self.settings.classes) for word in self.seen]
        row = {
            "block": self.block, "doc_ids": self.ids, "trained": self.trained, "ends": ends,
            "tokens": zstandard.ZstdCompressor(level=1).compress(tokens.tobytes()),
            "words": hashes, "classes": classes, "counts": counts,
        }
        kinds = [
            pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(),
            pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()),
        ]
        arrays = [pa.array([value], kind) for value, kind in zip(row.values(), kinds, strict=True)]
        self.block += 1
        self.clear()
        return pa.RecordBatch.from_arrays(arrays, list(row))


def coded(documents: DataFrame, settings: Settings, modulus: int, remainder: int) -> DataFrame:
    """The documents as a written table of blocks, one pass over the texts."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(settings, TaskContext.get().partitionId() << 32)
        for batch in batches(frames):
            for doc_id, trained, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), utf8(batch[2]), strict=True):
                coder.add(doc_id, trained, text)
                if coder.size >= settings.block_tokens:
                    yield coder.row()
        if coder.ids:
            yield coder.row()

    key = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (key % modulus != remainder).alias("trained"), whole_text().alias("text")
    )
    return staged(rows.mapInArrow(run, BLOCKS), "hmm-blocks")


def unpack(row: dict) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(row["tokens"]), np.int32)


def by_length(ends: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the chosen documents, longest first: their numbers and starts, and how many reach each position."""
    starts = np.concatenate([[0], ends[:-1]])
    lengths = ends - starts
    order = chosen[np.argsort(-lengths[chosen], kind="stable")]
    reach = len(order) - np.searchsorted(lengths[order][::-1], np.arange(lengths[order[0]]), side="right")
    return order, starts[order], reach


def forward(model: Model, codes: np.ndarray, starts: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, list, list]:
    """Scaled forward recursion over many sequences at once: log10 likelihoods, and the scaled rows and scales by position."""
    emit, move = model.emit, model.move
    total = np.zeros(len(starts))
    rows, scales = [], []
    state = None
    for t, n in enumerate(reach):
        state = (model.start if t == 0 else state[:n] @ move) * emit[codes[starts[:n] + t]]
        scale = state.sum(axis=1)
        state /= scale[:, None]
        total[:n] += np.log10(scale)
        rows.append(state)
        scales.append(scale)
    return total, rows, scales


def likelihoods(model: Model, codes: np.ndarray, starts: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """log10 likelihood of each sequence, without keeping the rows."""
    emit, move = model.emit, model.move
    total = np.zeros(len(starts))
    state = None
    for t, n in enumerate(reach):
        state = (model.start if t == 0 else state[:n] @ move) * emit[codes[starts[:n] + t]]
        scale = state.sum(axis=1)
        state /= scale[:, None]
        total[:n] += np.log10(scale)
    return total


class Expected:
    """Expected counts of starts, moves and emissions."""

    def __init__(self, states: int, classes: int):
        self.start = np.zeros(states)
        self.move = np.zeros((states, states))
        self.emit = np.zeros((classes, states))

    def add(self, model: Model, codes: np.ndarray, starts: np.ndarray, reach: np.ndarray) -> None:
        """Forward and backward over the sequences; expected emissions are summed by class at the end."""
        _, rows, scales = forward(model, codes, starts, reach)
        states = len(self.start)
        weights = np.empty((int(reach.sum()), states), np.float32)
        seen = np.empty(len(weights), np.int64)
        at = len(weights)
        moved = np.zeros((states, states))
        back = np.ones((0, states))
        carried = None
        for t in range(len(reach) - 1, -1, -1):
            n = reach[t]
            code = codes[starts[:n] + t]
            if carried is not None:
                moved += rows[t][: len(carried)].T @ carried
                back = carried @ model.move.T
            back = np.concatenate([back, np.ones((n - len(back), states))]) if n > len(back) else back
            at -= n
            weights[at : at + n] = rows[t] * back
            seen[at : at + n] = code
            carried = model.emit[code] * back / scales[t][:, None]
        self.start += weights[: reach[0]].sum(axis=0, dtype=np.float64)
        self.move += moved * model.move
        for k in range(states):
            self.emit[:, k] += np.bincount(seen, weights=weights[:, k], minlength=len(self.emit))


def estimate(settings: Settings, shares: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
    """Probabilities from expected counts; emissions lean on the corpus share of each class, so none is zero."""
    emitted = (emit + settings.prior * shares[:, None]) / (emit.sum(axis=0) + settings.prior)
    moved = move + 1.0
    return Model((start + 1.0) / (start + 1.0).sum(), moved / moved.sum(axis=1, keepdims=True), emitted)


def pair_counts(blocks: DataFrame, group: np.ndarray, kinds: int) -> np.ndarray:
    """How often each group of classes follows each other one, over all training documents: kinds x kinds."""
    shared = blocks.sparkSession.sparkContext.broadcast(group)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(kinds * kinds, np.int64)
        for batch in batches(frames):
            for row in batch.to_pylist():
                ends = np.array(row["ends"])
                codes = shared.value[np.array(row["classes"], np.int64)][unpack(row)]
                within = np.repeat(np.array(row["trained"], bool), np.diff(ends, prepend=0))
                within[ends - 1] = False  # the last token of a text has none after it
                first = np.flatnonzero(within)
                total += np.bincount(codes[first] * kinds + codes[first + 1], minlength=kinds * kinds)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["pair", "n"])

    rows = blocks.select("trained", "ends", "tokens", "classes").mapInArrow(run, "pair bigint, n bigint")
    whole = np.zeros(kinds * kinds)
    for row in rows.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # kinds * kinds rows at most
        whole[row["pair"]] = row["n"]
    return whole.reshape(kinds, kinds)


def first_model(settings: Settings, blocks: DataFrame, shares: np.ndarray) -> Model:
    """A start for training that depends on the counts of all training documents only, not on how they lie in partitions.

    Emissions of each group of classes and joint chances of adjacent states are fitted to the table of adjacent groups by
    expectation and maximisation; within a group a class keeps its share.
    """
    states, common, folded = settings.states, min(settings.common, len(shares)), settings.folded
    order = np.argsort(-shares, kind="stable")
    group = common + np.arange(len(shares)) * 2654435761 % 4294967296 % folded
    group[order[:common]] = np.arange(common)
    kinds = common + folded
    pairs = pair_counts(blocks, group.astype(np.int64), kinds)
    by_group = np.bincount(group, shares, kinds) + 1e-12
    rng = np.random.default_rng(20)
    emit = by_group * rng.gamma(1.0, 1.0, (states, kinds)) + 1e-12
    emit /= emit.sum(axis=1, keepdims=True)
    joint = np.full((states, states), (1 - settings.stay) / max(1, states - 1))
    np.fill_diagonal(joint, settings.stay if states > 1 else 1.0)
    joint /= joint.sum()
    if pairs.any():
        for _ in range(settings.start_rounds):
            ratio = pairs / (emit.T @ joint @ emit + 1e-300)
            right, left = emit @ ratio.T, emit @ ratio
            joint, emit = joint * (emit @ ratio @ emit.T), emit * (joint @ right + joint.T @ left)
            joint = (joint + 1e-9) / (joint + 1e-9).sum()
            emit = (emit + 1e-9 * by_group) / (emit + 1e-9 * by_group).sum(axis=1, keepdims=True)
    spread = shares[:, None] * (emit / by_group).T[group]
    return Model(joint.sum(axis=1), joint / joint.sum(axis=1, keepdims=True), spread / spread.sum(axis=0))


def expected_counts(blocks: DataFrame, model: Model, settings: Settings) -> Expected:
    """One Baum-Welch expectation over all training documents: summed in each task, then by class across partitions."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)
    states, classes = settings.states, settings.classes

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Expected(states, classes)
        for batch in batches(frames):
            for row in batch.to_pylist():
                chosen = np.flatnonzero(row["trained"])
                if len(chosen):
                    codes = np.array(row["classes"], np.int64)[unpack(row)]
                    _, starts, reach = by_length(np.array(row["ends"]), chosen)
                    found.add(shared.value, codes, starts, reach)
        used = np.flatnonzero(found.emit.any(axis=1))
        table = np.concatenate([found.emit[used], found.move, found.start[None, :]])
        rows = np.concatenate([used, np.arange(classes, classes + states + 1)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), *(pa.array(table[:, k]) for k in range(states))], names
        )

    names = ["row", *(f"s{k}" for k in range(states))]
    schema = ", ".join(["row bigint", *(f"{name} double" for name in names[1:])])
    rows = blocks.select("trained", "ends", "tokens", "classes").mapInArrow(run, schema)
    summed = rows.groupBy("row").agg(*(F.sum(name).alias(name) for name in names[1:]))
    total = Expected(states, classes)
    whole = np.zeros((classes + states + 1, states))
    for row in summed.collect():  # a row per class and state at most
        whole[row[0]] = row[1:]
    total.emit, total.move, total.start = whole[:classes], whole[classes:-1], whole[-1]
    return total


def word_counts(blocks: DataFrame) -> DataFrame:
    """Training tokens of every word seen in training: (word, class, n), a written table."""
    pairs = blocks.select(F.explode(F.arrays_zip("words", "classes", "counts")).alias("w"))
    pairs = pairs.select("w.words", "w.classes", "w.counts").filter("counts > 0")
    counts = pairs.groupBy(F.col("words").alias("word"), F.col("classes").alias("class")).agg(F.sum("counts").alias("n"))
    return staged(counts, "hmm-counts")


def train(blocks: DataFrame, counts: DataFrame, settings: Settings) -> tuple[Model, np.ndarray, int, int]:
    """The model, log10 of each class's size with its places, and the numbers of training tokens and words."""
    size, kinds = np.zeros(settings.classes), np.zeros(settings.classes)
    by_class = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"))
    for row in by_class.collect():  # a row per class at most
        size[row["class"]], kinds[row["class"]] = row["n"], row["kinds"]
    shares = (size + 1) / (size + 1).sum()
    model = first_model(settings, blocks, shares)
    for _ in range(settings.rounds):
        found = expected_counts(blocks, model, settings)
        model = estimate(settings, shares, found.start, found.move, found.emit)
    return model, np.log10(size + kinds + 1), int(size.sum()), int(kinds.sum())


def scores(documents: DataFrame, settings: Settings = Settings(), modulus: int = 7, remainder: int = 2) -> DataFrame:
    """Per document: tokens, known tokens, unigram base score and the model's exact log10 probability.

    Rows whose crc32(doc_id) leaves ``remainder`` modulo ``modulus`` are held out of all counts and of training.
    """
    blocks = coded(documents, settings, modulus, remainder)
    counts = word_counts(blocks)
    model, sizes, n_train, n_words = train(blocks, counts, settings)
    shared = documents.sparkSession.sparkContext.broadcast((model, sizes))
    uses = blocks.select("block", F.posexplode("words").alias("place", "word"))
    known = uses.join(counts, "word").groupBy("block").agg(
        F.collect_list("place").alias("places"), F.collect_list("n").alias("ns")  # as many as the block has words
    )
    lined = blocks.select("block", "doc_ids", "trained", "ends", "tokens", "classes").join(known, "block", "left")
    whole = np.log10(n_train + n_words + 1)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = shared.value
        for batch in batches(frames):
            for row in batch.select(["doc_ids", "trained", "ends", "tokens", "classes", "places", "ns"]).to_pylist():
                tokens, ends = unpack(row), np.array(row["ends"])
                classes = np.array(row["classes"], np.int64)
                n = np.zeros(len(classes))
                n[np.array(row["places"] or [], np.int64)] = row["ns"] or []
                starts = np.concatenate([[0], ends[:-1]])
                order, firsts, reach = by_length(ends, np.arange(len(ends)))
                codes = classes[tokens]
                score = np.empty(len(ends))
                score[order] = likelihoods(found, codes, firsts, reach)
                share = np.log10(n + 1)
                base = np.add.reduceat(share[tokens], starts)
                score += base - np.add.reduceat(size[codes], starts)
                length = ends - starts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array([not x for x in row["trained"]], pa.bool_()),
                        pa.array(length, pa.int64()), pa.array(np.add.reduceat((n > 0)[tokens].astype(np.int64), starts)),
                        pa.array(np.full(len(ends), n_train, np.int64)), pa.array(base - length * whole), pa.array(score),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return lined.mapInArrow(run, SCORES)
