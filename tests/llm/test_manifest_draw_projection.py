"""The manifest of midstates, importance resampling, and sorted projections against plain versions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from airscan.llm import importance, midstate, projection

DOCUMENTS = "doc_id bigint, source string, lang string, n_chars int, text string, tree string, place int, size string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def climbed(tree: list[list[str]], place: int, digest: str) -> tuple[str, str]:
    """The top when ``digest`` stands at ``place``, and all siblings on the way."""
    met = ""
    for nodes in tree[:-1]:
        run = nodes[place // 3 * 3 : place // 3 * 3 + 3]
        met += "".join(x for i, x in enumerate(run) if i != place % 3)
        run[place % 3] = digest
        digest, place = sha("".join(run)), place // 3
    return digest, met


def plain_manifest(rows, tampered) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for at, source in enumerate(order):
        for place, (_, _, digest, row) in enumerate(sorted(groups[source], key=lambda x: x[:3])):
            folded, met = climbed(trees[source], place, leaf(row, tampered(row)))
            folded, more = climbed(top, at, folded)
            out.append((row["doc_id"], digest, trees[source][-1][0], top[-1][0], sha(met + more), folded))
    return out


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [81, 82, 243], [6562, 5, 1]])
def test_manifest_equals_plain(spark, sizes):
    rows = [
        (i, f"s{source}" if source else None, None if i % 5 else "en", i, f"text {i}\nmore", "t", 1, "s")
        for source, n in enumerate(sizes) for i in range(n)
    ]
    documents = spark.createDataFrame(rows, DOCUMENTS).repartition(3)
    tampered = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = midstate.folded(midstate.manifest(documents, tampered)).drop("source").collect()
    want = plain_manifest(documents.collect(), lambda r: r["text"].replace("\n", "") if r["doc_id"] % 2 == 0 else r["text"])
    assert sorted(map(tuple, got)) == sorted(want)
    assert {r["folded_root"] == r["root"] for r in got if r["doc_id"] % 2} <= {True}


def test_manifest_without_replacement_verifies(spark, odd_documents):
    rows = odd_documents.withColumn("source", F.when(F.col("doc_id") % 2 == 0, "ü")).withColumns({"lang": F.lit(None), "n_chars": F.lit(2)})
    got = midstate.folded(midstate.manifest(rows)).collect()
    assert len(got) == odd_documents.count() and all(r["folded_root"] == r["root"] for r in got)
    want = plain_manifest(rows.collect(), lambda r: r["text"])
    assert sorted(map(repr, (tuple(r)[1:] for r in got))) == sorted(map(repr, want))


def test_manifest_of_nothing(spark):
    none = spark.createDataFrame([], DOCUMENTS)
    assert midstate.folded(midstate.manifest(none)).collect() == []


def test_many_sources(spark):
    rows = [(i, f"s{i % 200:03d}", "en", 1, "x", "t", 1, "s") for i in range(500)]
    documents = spark.createDataFrame(rows, DOCUMENTS)
    got = midstate.folded(midstate.manifest(documents)).drop("source").collect()
    assert sorted(map(tuple, got)) == sorted(plain_manifest(documents.collect(), lambda r: r["text"]))


# -- importance resampling ----------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_checksums_of_any_spans(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(0, 256, 50_000, dtype=np.uint8)
    starts = rng.integers(0, 20_000, 500)
    lengths = np.concatenate([rng.integers(1, 70, 480), rng.integers(1, 30_000, 20)])
    got = importance.checksums(data, starts, lengths)
    assert got.tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, lengths, strict=True)]


def plain_features(text, rule):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(words[i : i + k]) for k in range(1, rule.longest + 1) for i in range(len(words) - k + 1)]
    return [zlib.crc32(x.encode()) % rule.buckets for x in runs], len(words)


def plain_draw(documents, target, rule):
    s, t = np.zeros(rule.buckets), np.zeros(rule.buckets)
    for count, texts in ((s, [r["text"] for r in documents]), (t, target)):
        for text in texts:
            np.add.at(count, plain_features(text, rule)[0], 1)
    ratio = (t + 1) * (s.sum() + rule.buckets) / ((s + 1) * (t.sum() + rule.buckets))
    gain = [math.floor(1000 * math.log(x)) for x in ratio]
    rows = []
    for row in documents:
        found, words = plain_features(row["text"], rule)
        weight = sum(gain[b] for b in found)
        name = "" if row["doc_id"] is None else row["doc_id"]
        h = int(sha(f"{rule.seed}:{name}")[:8], 16)
        rows.append((row["doc_id"], len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), words))
    able = sorted((r for r in rows if r[4] >= rule.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    rank = {}
    for i, row in enumerate(able[: rule.percent * len(able) // 100]):
        rank.setdefault(row, []).append(i + 1)
    return [(*r, rank[r].pop(0) if rank.get(r) else None) for r in rows]


@pytest.mark.parametrize("rule", [importance.Rule(percent=30, least_words=1), importance.Rule(longest=3, buckets=97, percent=50)])
def test_draw_equals_plain(spark, odd_documents, sf, rule, monkeypatch):
    documents = odd_documents.unionByName(sf("documents").select("doc_id", "text"), allowMissingColumns=True)
    target = sf("benchmark")
    got = importance.resampled(documents, target, rule).collect()
    want = plain_draw(documents.collect(), [r["text"] for r in target.collect()], rule)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert importance.drawn(documents, target, rule).count() == sum(r[-1] is not None for r in want)


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_pieces_give_the_features_of_the_whole(longest, monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 40)
    rule = importance.Rule(longest=longest)
    texts = ["", "one", "Ä b.C d--e " * 40, "x" * 300, "a " * 100 + "y" * 90 + " é" * 30]
    found: list[list[int]] = [[] for _ in texts]
    words = [0] * len(texts)
    for numbers, got in importance.found([x.encode() for x in texts], rule):
        for bucket, owner in zip(got.buckets, got.text, strict=True):
            found[numbers[owner]].append(int(bucket))
        for number, n in zip(numbers, got.words, strict=True):
            words[number] += int(n)
    assert [(sorted(f), w) for f, w in zip(found, words, strict=True)] == [
        (sorted(f), w) for f, w in (plain_features(x, rule) for x in texts)
    ]


def test_draw_from_nothing(spark, no_documents, sf):
    assert importance.resampled(no_documents, sf("benchmark")).collect() == []
    assert importance.resampled(sf("documents"), no_documents).count() == sf("documents").count()


# -- sorted projections -------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, row string, key int, dims string"


def plain_links(rows, least=0.98):
    """Per row the other rows linked with, by all pairs of a label."""
    out = [[] for _ in rows]
    kept = []
    for i, (_, v, label, *_) in enumerate(rows):
        if label is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            kept.append((i, label, x / np.linalg.norm(x)))
    for label, size in {(k[1], len(k[2])) for k in kept}:
        some = [k for k in kept if k[1] == label and len(k[2]) == size]
        x = np.stack([k[2] for k in some])
        for (i, *_), near in zip(some, x @ x.T >= least, strict=True):
            out[i] = [some[j][0] for j in np.flatnonzero(near) if some[j][0] != i]
    return out


def plain_components(rows, links):
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in links[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append(min(ids) if ids else None)
    return out


def planted(rng, singles: int, crowd: int, dims: int = 24):
    rows = []

    def add(v, label):
        rows.append((len(rows), [float(x) for x in v], label, "r", 1, "d"))

    for _ in range(singles):
        v = rng.standard_normal(dims)
        add(v, int(rng.integers(3)))
        if rng.random() < 0.4:
            add(v + rng.standard_normal(dims) * 0.12, rows[-1][2])
    centre = rng.standard_normal(dims)
    for _ in range(crowd):
        add(centre + rng.standard_normal(dims) * 0.1, 1)
    for _ in range(40):
        add(centre, 1)
    return rows


def test_projections_with_windows_over_all_equal_plain(spark):
    rows = planted(np.random.default_rng(3), 150, 60)
    rows += [(i, v, label, "r", 1, "d") for i, v, label in [
        (None, rows[0][1], rows[0][2]), (None, rows[0][1], rows[0][2]), (900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, [None] * 24, 1),
        (904, [float("nan")] * 24, 1), (905, [float("inf")] + [1.0] * 23, 1), (906, rows[0][1], None), (907, rows[0][1][:5], rows[0][2]),
        (908, [x * 1e18 for x in rows[0][1]], rows[0][2]), (909, rows[0][1], rows[0][2] + 10), (5, rows[5][1], rows[5][2]), (None, [1.0] * 24, 7),
    ]]
    got = projection.near_copies(spark.createDataFrame(rows, VECTORS)).collect()
    links = plain_links(rows)
    want = [(r[0], len(n), c, r[0] == c) for r, n, c in zip(rows, links, plain_components(rows, links), strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_projections_find_crowds_and_pairs_through_small_windows(spark):
    rows = planted(np.random.default_rng(4), 1500, 300)
    rule = projection.Rule(window=16, block=64)
    got = {r["vec_id"]: r for r in projection.near_copies(spark.createDataFrame(rows, VECTORS), rule=rule).collect()}
    links = plain_links(rows)
    found, there = sum(r["n_links"] for r in got.values()), sum(map(len, links))
    assert len(got) == len(rows) and 0.97 * there <= found <= there
    assert all(got[r[0]]["n_links"] <= len(n) for r, n in zip(rows, links, strict=True))
    pairs = [i for i, n in enumerate(links) if len(n) == 1]
    assert sum(got[i]["n_links"] for i in pairs) >= 0.9 * len(pairs)


def test_projections_of_nothing(spark):
    assert projection.near_copies(spark.createDataFrame([], VECTORS)).collect() == []


def test_passes_grow_with_the_vectors():
    rule = projection.Rule()
    assert rule.passes(0) == rule.passes(500) == rule.fewest
    assert rule.passes(10**6) < rule.passes(10**9) < 40
