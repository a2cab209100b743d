"""Mixing to target weights with soft domain membership, in DataFrame operations only.

A multinomial naive Bayes classifier over hashed words, counted from the labelled table, gives every document its posterior
over the domains good, poor and toxic; a long text counts as much evidence as ``Mix.evidence`` of its words on average, so
that membership stays soft. A document's rate says how often it is to be drawn. Projected gradient steps fit non-negative
rates by least squares, so that the expected tokens of each domain (rate x tokens x posterior, summed) meet their targets.
One step is one aggregate; only the domain totals reach the driver, and a document's new rate depends on its own posterior
and on it alone, so rates can be worked out again from the list of steps.

Null text counts as empty and has no tokens. A null doc_id has no label. A doc_id with several labels counts once, as
toxic if any label says so, else poor if any says so; null labels do not count. Repeated rows are separate documents. A
domain without labels has the even prior of one pseudo-count; a domain without tokens cannot meet its target, and the
others are fitted regardless; a gap that is left is told by a warning and by ``Fit.gap``. Very long texts are read whole. An
empty table gives an empty result. Columns other than doc_id and text are not read by ``rates`` and are kept by ``mixed``.
"""

from __future__ import annotations

import json
import math
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airscan.llm.frames import SPACE, whole_text
from airscan.sources.local import staged

DOMAINS = ("good", "poor", "toxic")
MICRO = 1_000_000  # log chances are summed as whole millionths, so that sums do not depend on their order


@dataclass(frozen=True)
class Mix:
    """Target weights by domain, drawn tokens as a share of all tokens, and how closely to fit them.

    ``buckets`` words are told apart by their hash; at most ``sample`` labelled documents, chosen by a hash of their ids,
    teach the classifier. No rate falls below ``least``. The fit ends when every domain is within ``gap`` of all tokens wanted, or after ``steps``.
    """

    weights: dict[str, float] = field(default_factory=lambda: {"good": 0.86, "poor": 0.08, "toxic": 0.06})
    tokens: float = 0.5
    steps: int = 200
    gap: float = 1e-5
    hold: int = 10
    least: float = 0.0
    buckets: int = 1 << 14
    evidence: int = 24
    sample: int = 100_000


class Model(NamedTuple):
    """Log prior odds against good, and for every bucket the log chance against good, in millionths."""

    prior: dict[str, float]
    words: dict[str, list[int]]


class Fit(NamedTuple):
    """Rows (doc_id, tokens, posteriors, rate), the classifier, the steps taken, and the largest gap left, as a share."""

    rows: DataFrame
    model: Model
    slopes: list[dict[str, float]]
    gap: float


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) for every labelled id."""
    rows = labels.filter("doc_id is not null and quality is not null and toxic is not null")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").otherwise("good")
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), domain.alias("domain"))


def buckets_of(text: Column, mix: Mix) -> Column:
    """The bucket of every word of a text."""
    words = F.filter(F.split(F.lower(text), SPACE), lambda word: word != "")
    return F.transform(words, lambda word: F.pmod(F.xxhash64(word), F.lit(mix.buckets)).cast("int"))


def trained(documents: DataFrame, labels: DataFrame, mix: Mix) -> Model:
    """Words counted by domain and bucket over the labelled documents; 3 x ``mix.buckets`` counts reach the driver."""
    known = staged(domains(labels), "mixing-labels")
    if known.count() > mix.sample:
        known = known.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(mix.sample)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    texts = texts.join(F.broadcast(known), "doc_id")
    sizes = {row["domain"]: row["count"] for row in texts.groupBy("domain").count().collect()}
    rows = texts.select("domain", F.explode(buckets_of(F.col("text"), mix)).alias("bucket")).groupBy("domain", "bucket").count()
    counts = {domain: np.ones(mix.buckets) for domain in DOMAINS}
    for row in rows.collect():
        counts[row["domain"]][row["bucket"]] += row["count"]
    log = {domain: np.log(n / n.sum()) for domain, n in counts.items()}
    others = DOMAINS[1:]
    prior = {domain: math.log((sizes.get(domain, 0) + 1) / (sizes.get("good", 0) + 1)) for domain in others}
    return Model(prior, {domain: np.rint(MICRO * (log[domain] - log["good"])).astype(int).tolist() for domain in others})


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def membership(text: Column, model: Model, mix: Mix) -> Column:
    """Tokens and posteriors (good, poor, toxic) of a text, as a struct."""
    tables = {domain: F.from_json(F.lit(json.dumps(words)), "array<bigint>") for domain, words in model.words.items()}
    nothing = F.struct(*(F.lit(0).cast("bigint").alias(domain) for domain in tables))

    def add(sums: Column, bucket: Column) -> Column:
        return F.struct(*((sums[domain] + F.get(table, bucket)).alias(domain) for domain, table in tables.items()))

    def odds(sums: Column, tokens: Column) -> Column:
        weight = F.least(F.lit(1.0), mix.evidence / F.greatest(tokens, F.lit(1))) / MICRO
        logs = {domain: F.lit(model.prior[domain]) + sums[domain] * weight for domain in tables} | {"good": F.lit(0.0)}
        return F.struct(*(logs[domain].alias(domain) for domain in DOMAINS))

    def chances(logs: Column) -> Column:
        top = F.greatest(*(logs[domain] for domain in DOMAINS))
        return F.struct(*(F.exp(logs[domain] - top).alias(domain) for domain in DOMAINS))

    def shares(found: Column, tokens: Column) -> Column:
        whole = reduce(lambda a, b: a + b, [found[domain] for domain in DOMAINS])
        return F.struct(tokens.cast("bigint").alias("tokens"), *((found[domain] / whole).alias(domain) for domain in DOMAINS))

    def of_words(buckets: Column) -> Column:
        logs = let(F.aggregate(buckets, nothing, add), lambda sums: odds(sums, F.size(buckets)))
        return let(let(logs, chances), lambda found: shares(found, F.size(buckets)))

    return let(buckets_of(text, mix), of_words)


def stepped(rate: Column, slopes: list[dict[str, float]], least: float = 0.0) -> Column:
    """The rate after further projected steps: against each slope, and never below ``least``."""
    for slope in slopes:
        move = reduce(lambda a, b: a + b, [F.col(f"p_{domain}") * slope[domain] for domain in DOMAINS])
        rate = F.greatest(F.lit(float(least)), rate - move)
    return rate


def totals(rows: DataFrame, rate: Column) -> dict[str, float]:
    """Expected tokens of each domain at a rate."""
    drawn = rows.select((rate * F.col("tokens")).alias("drawn"), *(f"p_{domain}" for domain in DOMAINS))
    row = drawn.agg(*(F.sum(F.col("drawn") * F.col(f"p_{domain}")).alias(domain) for domain in DOMAINS)).first()
    return {domain: row[domain] or 0.0 for domain in DOMAINS}


def metric(rows: DataFrame) -> np.ndarray:
    """Tokens by pair of posteriors; its inverse weighs the least squares, so that full steps are short enough."""
    pairs = [(a, b) for a in DOMAINS for b in DOMAINS]
    sums = rows.agg(*(F.sum(F.col("tokens") * F.col(f"p_{a}") * F.col(f"p_{b}")) for a, b in pairs)).first()
    return np.array([x or 0.0 for x in sums]).reshape(len(DOMAINS), len(DOMAINS))


def fit(documents: DataFrame, labels: DataFrame, mix: Mix) -> Fit:
    """Posteriors and fitted rates of all documents.

    A step goes against the gradient of the weighted least squares, p . W (expected - target), and back to 0 where it would
    pass it; W is the inverse of ``metric``. Steps end when every domain is within ``mix.gap`` of its target, when no gap
    changes any more (targets out of reach), or after ``mix.steps``.
    """
    model = trained(documents, labels, mix)
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    rows = documents.select(doc_id, membership(whole_text(), model, mix).alias("of"))
    rows = rows.select("doc_id", "of.tokens", *(F.col(f"of.{domain}").alias(f"p_{domain}") for domain in DOMAINS))
    rows = staged(rows, "mixing-posteriors")
    natural = totals(rows, F.lit(1.0))
    target = {domain: mix.weights[domain] * mix.tokens * sum(natural.values()) for domain in DOMAINS}
    wanted = sum(target.values())
    inverse = np.linalg.pinv(metric(rows), rcond=1e-9)
    rows = rows.withColumn("rate", F.lit(float(mix.tokens)))
    taken: list[dict[str, float]] = []
    held = 0  # steps that the written rates have taken
    gaps = np.full(len(DOMAINS), np.inf)
    while True:
        before, expected = gaps, totals(rows, stepped(F.col("rate"), taken[held:], mix.least))
        gaps = np.array([expected[domain] - target[domain] for domain in DOMAINS])
        still = np.abs(gaps - before).max() <= mix.gap * wanted / 10
        if np.abs(gaps).max() <= mix.gap * wanted or still or len(taken) == mix.steps:
            break
        if len(taken) - held == mix.hold:
            rows = staged(rows.withColumn("rate", stepped(F.col("rate"), taken[held:], mix.least)), "mixing-rates")
            held = len(taken)
        taken.append(dict(zip(DOMAINS, (inverse @ gaps).tolist(), strict=True)))
    left = float(np.abs(gaps).max() / wanted) if wanted else 0.0
    if left > mix.gap:
        warnings.warn(f"tokens of a domain are off their target by {left:.2%} of all tokens wanted", stacklevel=2)
    return Fit(rows.withColumn("rate", stepped(F.col("rate"), taken[held:], mix.least)), model, taken, left)


def replayed(shares: Column, slopes: list[dict[str, float]], mix: Mix) -> Column:
    """The rate of a document with these posteriors (a struct), worked out from all steps."""
    kind = "array<struct<" + ", ".join(f"{domain}: double" for domain in DOMAINS) + ">>"
    steps = F.from_json(F.lit(json.dumps(slopes)), kind)

    def step(rate: Column, slope: Column, own: Column) -> Column:
        return F.greatest(F.lit(float(mix.least)), rate - reduce(lambda a, b: a + b, [own[domain] * slope[domain] for domain in DOMAINS]))

    return let(shares, lambda own: F.aggregate(steps, F.lit(float(mix.tokens)), lambda rate, slope: step(rate, slope, own)))


def rates(documents: DataFrame, labels: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per row of ``documents``: doc_id, tokens, posteriors p_good, p_poor and p_toxic, and the fitted rate."""
    return fit(documents, labels, mix).rows


def mixed(documents: DataFrame, labels: DataFrame, mix: Mix = Mix(least=0.05)) -> DataFrame:
    """The documents that are drawn at all, with their ``mix_rate`` (in place of one they had); other columns as they were.

    As given, no document's rate falls below 0.05, so that targets out of reach take no clean document away.
    """
    documents = documents.drop("mix_rate")
    found = fit(documents, labels, mix)
    whole = F.struct(*[documents[f"`{name}`"] for name in documents.columns]).alias("whole")
    rate = replayed(membership(whole_text(), found.model, mix), found.slopes, mix)
    # The rate is worked out once for each row, and rows that are never drawn end here.
    rows = documents.select(whole, F.explode(F.filter(F.array(rate), lambda x: x > 0)).alias("rate"))
    return rows.select("whole.*", F.col("rate").alias("mix_rate"))
