"""Token counts, quality scores, language model and mixing against libraries and plain versions."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airscan.llm import bpe_counts, compression, hmm, mixing

tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")
VOCABULARY = vocabularies.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(VOCABULARY)
COUNT = bpe_counts.counter(*bpe_counts.read_merges(VOCABULARY))


def library_count(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("aeth 'snd\n<|endoftext|>", max_size=60))
def test_counts_equal_the_library(text):
    assert COUNT(text) == library_count(text)


def test_counts_of_documents(documents, odd_documents, no_documents):
    for table in (documents, odd_documents):
        texts = Counter((r["doc_id"], library_count(r["text"] or ""), len((r["text"] or "").encode())) for r in table.collect())
        rows = bpe_counts.token_counts(table, VOCABULARY).collect()
        assert Counter((r["doc_id"], r["n_tokens"], r["n_bytes"]) for r in rows) == texts
        assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)
    assert bpe_counts.token_counts(no_documents, VOCABULARY).count() == 0


def test_pieces_of_a_long_text_are_taken_one_by_one(monkeypatch):
    monkeypatch.setattr(bpe_counts, "LISTED", 10)
    text = "some words, 12 and <|endoftext|> more of them " * 9
    assert COUNT(text) == library_count(text)


def test_quality_on_held_out_labels(spark, sf):
    data = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{data}/{name}.parquet") for name in ("documents", "labels"))
    rows = compression.scored(documents, labels).join(labels, "doc_id").collect()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.9


def test_quality_odd_rows(spark, odd_documents, no_documents, documents, sf):
    labels = sf("labels")
    assert compression.scored(odd_documents, labels).count() == odd_documents.count()
    assert all(0 <= r["score"] <= 1 for r in compression.scored(odd_documents, labels).collect())
    kept = compression.accepted(odd_documents, labels)
    assert kept.columns == odd_documents.columns
    assert compression.scored(no_documents, labels).count() == 0
    none = labels.limit(0)
    assert {r["score"] for r in compression.scored(documents, none).collect()} == {0.5}
    good = labels.filter("quality = 1")
    assert {r["score"] for r in compression.scored(documents, good).collect()} == {1.0}
    twice = labels.unionByName(labels).unionByName(labels.withColumn("doc_id", F.lit(None).cast("bigint")))
    once = {r["doc_id"]: r["score"] for r in compression.scored(documents, labels).collect()}
    assert once == {r["doc_id"]: r["score"] for r in compression.scored(documents, twice).collect()}


def plain_base(rows, modulus=7, remainder=2):
    counts, texts = Counter(), []
    for doc_id, text in rows:
        words = [*(text or "").encode().lower().split(), None]
        held = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus == remainder
        texts.append((doc_id, held, words))
        if not held:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    base = lambda words: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
    return [(i, held, len(w), sum(counts[x] > 0 for x in w), n, base(w)) for i, held, w in texts]


@pytest.mark.parametrize("block", [1, 5_000, 1_000_000])
def test_base_scores(spark, documents, odd_documents, block):
    for table in (documents, odd_documents):
        rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
        found = hmm.scores(table, hmm.Settings(block_tokens=block, rounds=1, start_rounds=2)).drop("score").collect()
        order = lambda r: (repr(r[0]), r[2], r[5])
        for got, want in zip(sorted(found, key=order), sorted(plain_base(rows), key=order), strict=True):
            assert tuple(got)[:5] == want[:5] and got[5] == pytest.approx(want[5], abs=1e-6)


def test_forward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    emit, move = rng.random((5, 3)), rng.random((3, 3))
    model = hmm.Model(np.array([0.2, 0.3, 0.5]), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    codes, ends = np.array([0, 4, 2, 1, 1, 3]), np.array([4, 6])
    order, starts, reach = hmm.by_length(ends, np.arange(2))
    found = dict(zip(order.tolist(), hmm.likelihoods(model, codes, starts, reach), strict=True))
    for i, text in enumerate((codes[:4], codes[4:])):
        total = 0.0
        for path in np.ndindex(*[3] * len(text)):
            p = model.start[path[0]] * model.emit[text[0], path[0]]
            for t in range(1, len(text)):
                p *= model.move[path[t - 1], path[t]] * model.emit[text[t], path[t]]
            total += p
        assert found[i] == pytest.approx(math.log10(total))


def test_expected_counts_are_posteriors():
    rng = np.random.default_rng(2)
    emit, move = rng.random((4, 2)), rng.random((2, 2))
    model = hmm.Model(np.array([0.4, 0.6]), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    codes = np.array([0, 3, 1])
    found = hmm.Expected(2, 4)
    found.add(model, codes, np.array([0]), np.array([1, 1, 1]))
    start, moves, emits, whole = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2)), 0.0
    for path in np.ndindex(2, 2, 2):
        p = model.start[path[0]] * model.emit[0, path[0]]
        p *= model.move[path[0], path[1]] * model.emit[3, path[1]] * model.move[path[1], path[2]] * model.emit[1, path[2]]
        whole += p
        start[path[0]] += p
        for t, code in enumerate(codes):
            emits[code, path[t]] += p
        for a, b in zip(path, path[1:], strict=False):
            moves[a, b] += p
    assert np.allclose(found.start, start / whole) and np.allclose(found.move, moves / whole)
    assert np.allclose(found.emit, emits / whole, atol=1e-6)


def test_model_beats_the_base_on_held_out_text(documents, no_documents):
    rows = [r for r in hmm.scores(documents).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.95 * sum(r["base_score"] for r in rows)
    assert hmm.scores(no_documents).count() == 0


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_scores_do_not_depend_on_partitions(documents, partitions):
    def by_id(rows):
        return {r["doc_id"]: r["score"] for r in hmm.scores(rows).collect()}

    got, want = by_id(documents.repartition(partitions)), by_id(documents)
    assert got == pytest.approx(want, rel=1e-6)


def test_model_gains_on_held_out_text(spark):
    rows = hmm.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out")
    gain, n = rows.agg(F.sum(F.col("score") - F.col("base_score")), F.sum("n_tokens")).first()
    assert gain / n > 0.42


def test_word_probabilities_of_a_class_leave_room_for_one_unseen_word(spark):
    """Over all words seen in training and one unseen word for each class, a one-token text has probability 1."""
    table = spark.createDataFrame([(0, "a b b c"), (1, "b c d d d e")], "doc_id bigint, text string")
    config = hmm.Settings(classes=8, states=2, rounds=1)
    blocks = hmm.coded(table, config, 1, 5)
    counts = hmm.word_counts(blocks)
    model, sizes, n, v = hmm.train(blocks, counts, config)
    total = 0.0
    known = {r["class"]: [] for r in counts.collect()}
    for r in counts.collect():
        known[r["class"]].append(r["n"])
    for k in range(8):
        places = [c + 1 for c in known.get(k, [])] + [1]
        total += float(model.start @ model.emit[k]) * sum(places) / 10 ** sizes[k]
    assert (n, v) == (12, 6) and total == pytest.approx(1.0)


def plain_rates(rows, mix):
    p = np.array([[r["p_good"], r["p_poor"], r["p_toxic"]] for r in rows])
    tokens = np.array([r["tokens"] for r in rows], float)
    target = np.array([mix.weights[d] for d in mixing.DOMAINS]) * mix.tokens * tokens.sum()
    weight = np.linalg.pinv((p * tokens[:, None]).T @ p, rcond=1e-9)
    rate = np.full(len(rows), mix.tokens)
    for _ in range(500):
        rate = np.maximum(0, rate - p @ (weight @ (p.T @ (rate * tokens) - target)))
    return rate, p.T @ (rate * tokens), target


def plain_posteriors(texts, labels, mix):
    """Naive Bayes over hashed words in plain Python: posteriors by text for labelled texts (id, domain)."""
    import xxhash

    def buckets(text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
        signed = (((xxhash.xxh64_intdigest(w.encode(), 42) + 2**63) % 2**64) - 2**63 for w in words)
        return [x % mix.buckets for x in signed]

    counts, sizes = {d: np.ones(mix.buckets) for d in mixing.DOMAINS}, Counter()
    for doc_id, text in texts:
        if doc_id in labels:
            sizes[labels[doc_id]] += 1
            np.add.at(counts[labels[doc_id]], buckets(text), 1)
    log = {d: np.log(n / n.sum()) for d, n in counts.items()}
    out = []
    for _, text in texts:
        found = buckets(text)
        weight = min(1.0, mix.evidence / max(1, len(found)))
        odds = [math.log((sizes[d] + 1) / (sizes["good"] + 1)) + weight * sum((log[d] - log["good"])[found]) for d in mixing.DOMAINS]
        chances = np.exp(np.array(odds) - max(odds))
        out.append((len(found), *(chances / chances.sum())))
    return out


def test_posteriors_equal_plain_naive_bayes(spark, documents, odd_documents, sf):
    mix = mixing.Mix(buckets=512)
    texts = documents.select("doc_id", "text").unionByName(odd_documents.select("doc_id", "text").filter("doc_id is null or doc_id != 5"))
    labels = {r["doc_id"]: r["domain"] for r in mixing.domains(sf("labels")).collect()}
    want = plain_posteriors([tuple(r) for r in texts.collect()], labels, mix)
    got = mixing.rates(texts, sf("labels"), mix).collect()
    assert sorted(map(list, ((r["tokens"], r["p_good"], r["p_poor"], r["p_toxic"]) for r in got))) == [
        pytest.approx(x, abs=1e-4) for x in sorted(map(list, want))
    ]


def test_posteriors_tell_texts_apart(spark, documents, sf):
    odd = [(-1, "buy now " * 60), (-2, "lorem ipsum " * 60), (-3, "((((( @@@@@ ~~~~ " * 30)]
    rows = documents.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    found = mixing.rates(rows, sf("labels")).collect()
    assert len({r["p_good"] for r in found if r["doc_id"] < 0}) == 3
    assert len({round(r["p_good"], 9) for r in found}) > 0.6 * len({r["text"] for r in documents.select("text").collect()})


def test_targets_out_of_reach_are_told(spark, documents, sf):
    mix = mixing.Mix(weights={"good": 0.0, "poor": 0.0, "toxic": 1.0}, tokens=1.0, steps=5)
    with pytest.warns(UserWarning, match="off their target"):
        found = mixing.fit(documents, sf("labels"), mix)
    assert found.gap > mix.gap and len(found.slopes) <= 5


def test_replayed_rates_are_the_fitted_ones(spark, documents, sf):
    mix = mixing.Mix(hold=3, weights={"good": 0.1, "poor": 0.1, "toxic": 0.8})
    found = mixing.fit(documents, sf("labels"), mix)
    both = found.rows.withColumn("again", mixing.replayed(F.struct(*(F.col(f"p_{d}").alias(d) for d in mixing.DOMAINS)), found.slopes, mix))
    assert len(found.slopes) > 1 and both.filter("abs(rate - again) > 1e-12").count() == 0


@pytest.mark.parametrize("weights", [(0.86, 0.08, 0.06), (0.3, 0.4, 0.3)])
def test_rates_meet_the_targets(spark, weights):
    data = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{data}/{name}.parquet") for name in ("documents", "labels"))
    mix = mixing.Mix(weights=dict(zip(mixing.DOMAINS, weights, strict=True)), gap=1e-8, steps=200)
    rows = mixing.rates(documents, labels, mix).collect()
    want, reached, target = plain_rates(rows, mix)
    got = np.array([r["rate"] for r in rows])
    assert (got >= 0).all() and np.allclose(got, want, atol=1e-5)
    p = np.array([[r["p_good"], r["p_poor"], r["p_toxic"]] for r in rows])
    assert np.allclose(p.sum(axis=1), 1) and np.allclose(reached, target, rtol=1e-4)


def test_posteriors_follow_the_labels(spark):
    data = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{data}/{name}.parquet") for name in ("documents", "labels"))
    rows = mixing.rates(documents, labels).join(mixing.domains(labels), "doc_id").collect()
    assert sum(max(mixing.DOMAINS, key=lambda d: r[f"p_{d}"]) == r["domain"] for r in rows) / len(rows) > 0.85


def test_mixing_odd_rows(odd_documents, no_documents, sf):
    labels = sf("labels")
    rows = mixing.rates(odd_documents, labels)
    assert rows.count() == odd_documents.count() and rows.filter("rate is null or rate < 0").count() == 0
    kept = mixing.mixed(odd_documents.withColumn("mix_rate", F.lit(1)), labels)
    assert kept.columns == [*odd_documents.columns, "mix_rate"]
    assert mixing.rates(no_documents, labels).count() == 0
    assert mixing.rates(odd_documents, labels.limit(0)).count() == odd_documents.count()


def test_native_plans_hold_no_python(documents, sf):
    plan = mixing.mixed(documents, sf("labels"))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
