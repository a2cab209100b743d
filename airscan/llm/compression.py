"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

A text is compressed in pieces, each on its own, once with either dictionary. Two normalised size differences tell how
much better the good dictionary fits: against the bad one, and against the plain bytes. A logistic curve, fitted on
labelled rows that took no part in the dictionaries and weighted to the labels' true shares, turns them into a score.

The dictionaries and the curve come from a bounded sample of labelled training rows (``Sample``); scores read every
whole text. A doc_id with both labels is left out of training; repeated labels count once, null ids and null labels
not at all. If a class has no labelled text, every score is the share of good labels, or 0.5 without labels. Null text
counts as empty; an empty text has differences 0. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airscan.llm.frames import whole_text


@dataclass(frozen=True)
class Sample:
    """Bounds of what is fitted on the driver: rows per label, and the longest text taken (in code points)."""

    rows: int = 2000
    longest: int = 20_000
    dictionary: int = 1 << 16
    piece: int = 1024
    level: int = 3


@dataclass
class Classifier:
    """Dictionaries of bad and good text and the weights of the curve; without dictionaries a constant."""

    dictionaries: tuple[bytes, bytes] | None
    weights: tuple[float, ...]
    sample: Sample


def remainder(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def pieces(text: bytes, size: int) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)]


class Sizes:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, dictionaries: tuple[bytes, bytes], sample: Sample):
        self.piece = sample.piece
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.compressors = []
        for content in dictionaries:
            dictionary = zstandard.ZstdCompressionDict(content)
            dictionary.precompute_compress(level=sample.level)
            self.compressors.append(zstandard.ZstdCompressor(level=sample.level, dict_data=dictionary, **plain))

    def differences(self, text: bytes) -> tuple[float, float]:
        if not text:
            return 0.0, 0.0
        cut = pieces(text, self.piece)
        bad, good = (sum(len(c.compress(piece)) for piece in cut) for c in self.compressors)
        return (bad - good) / max(bad, good), (len(text) - good) / len(text)


def curve(differences: np.ndarray, good: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve by Newton's method, lightly held to zero."""
    rows = np.column_stack([np.ones(len(good)), differences])
    weights = np.zeros(rows.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (weight * (good - p)) - 1e-2 * weights
        bend = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(len(weights))
        weights = weights + np.linalg.solve(bend, slope)
    return weights


def labelled(labels: DataFrame, modulus: int) -> DataFrame:
    """(doc_id, good) for every id with one label, training rows only."""
    rows = labels.filter("doc_id is not null and quality in (0, 1)").filter(remainder(modulus) != 0)
    rows = rows.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("good"))
    return rows.filter("low = good").select("doc_id", "good")


def dictionary(texts: list[bytes], sample: Sample) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train one.

    Texts that fill more than the dictionary give it an equal share each, so that none of them is left out.
    """
    cut = [piece for text in texts for piece in pieces(text, sample.piece)]
    try:
        return zstandard.train_dictionary(sample.dictionary, cut).as_bytes()
    except zstandard.ZstdError:
        total = sum(map(len, texts))
        if total <= sample.dictionary:
            return b"".join(texts)
        return b"".join(text[: max(1, len(text) * sample.dictionary // total)] for text in texts)


def fit(documents: DataFrame, labels: DataFrame, modulus: int = 5, sample: Sample = Sample()) -> Classifier:
    """Dictionaries and curve from at most ``sample.rows`` texts of each label, chosen by a hash of their ids.

    Of the sample, two of three texts go into the dictionaries and the third into the curve. Labels are counted in
    full, so the curve is weighted to their true shares.
    """
    rows = labelled(labels, modulus)
    counts = {row["good"]: row["count"] for row in rows.groupBy("good").count().collect()}
    order = F.xxhash64("doc_id", F.lit(9))
    chosen = [rows.filter(F.col("good") == good).orderBy(order, "doc_id").limit(sample.rows) for good in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    texts = texts.filter(F.length("text").between(1, sample.longest)).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "good").agg(F.min("text").alias("text"))  # one text per id, at most 2 * sample.rows
    found = sorted((row["good"], row["doc_id"], row["text"].encode()) for row in texts.collect())
    total = sum(counts.values())
    if len({good for good, _, _ in found}) < 2:
        return Classifier(None, (counts.get(1, 0) / total if total else 0.5,), sample)
    by_label = [[text for label, _, text in found if label == good] for good in (0, 1)]
    fitted = [[t for i, t in enumerate(texts) if i % 3 != 2] for texts in by_label]
    held = [[t for i, t in enumerate(texts) if i % 3 == 2] or texts for texts in by_label]
    dictionaries = (dictionary(fitted[0], sample), dictionary(fitted[1], sample))
    sizes = Sizes(dictionaries, sample)
    differences = np.array([sizes.differences(text) for texts in held for text in texts])
    good = np.repeat([0.0, 1.0], [len(held[0]), len(held[1])])
    share = np.array([counts[0], counts[1]]) / total * len(good)
    weight = np.repeat(share / [len(held[0]), len(held[1])], [len(held[0]), len(held[1])])
    return Classifier(dictionaries, tuple(curve(differences, good, weight)), sample)


def score(text: Column, documents: DataFrame, classifier: Classifier) -> Column:
    """Score of a text column: 0 to 1, higher for good text. The dictionaries, of fixed size, are broadcast."""
    shared = documents.sparkSession.sparkContext.broadcast(classifier)

    @F.pandas_udf("double")
    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = shared.value
        sizes = Sizes(found.dictionaries, found.sample) if found.dictionaries else None
        for texts in frames:
            if sizes is None:
                yield pd.Series(np.full(len(texts), found.weights[0]))
                continue
            differences = np.array([sizes.differences(text.encode()) for text in texts]).reshape(-1, 2)
            raw = found.weights[0] + differences @ np.array(found.weights[1:])
            yield pd.Series(1 / (1 + np.exp(-np.clip(raw, -30, 30))))

    return run(F.coalesce(text.cast("string"), F.lit("")))


def scored(documents: DataFrame, labels: DataFrame, modulus: int = 5, threshold: float = 0.3) -> DataFrame:
    """Per row of ``documents``: doc_id, held_out, score, predicted."""
    classifier = fit(documents, labels, modulus)
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (remainder(modulus) == 0).alias("held_out"),
        score(F.col("text"), documents, classifier).alias("score"),
    )
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that the classifier does not reject, all columns as they were."""
    return documents.filter(score(documents["text"], documents, fit(documents, labels)) >= threshold)
