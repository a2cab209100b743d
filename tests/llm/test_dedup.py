"""Exact deduplication, Jaccard join and repeated passages against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from airscan.llm import links, passages, set_join, stream_dedup


def plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    return groups


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("per_batch", [1, 1 << 30])
def test_exact_groups_in_any_number_of_batches(spark, documents, per_batch):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = {r["doc_id"]: r for r in stream_dedup.marked(documents.repartition(3), per_batch).collect()}
    for norm, members in plain_groups(rows).items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0]))[0]
        for doc_id, _ in members:
            row = found[doc_id]
            assert (row["keep_id"], row["group_size"]) == (keep, len(members))
            assert row["digest"] == hashlib.sha256(norm.encode()).hexdigest()


def test_texts_that_share_a_digest_are_told_apart(spark):
    rows = [(1, "one"), (2, "o n e"), (3, "two"), (4, "two "), (5, "three"), (6, "four")]
    same = stream_dedup.marked(frame(spark, rows), digest=lambda text: F.substring(F.md5(text.cast("binary")), 1, 0))
    found = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in same.collect()}
    assert found == {1: (2, 2), 2: (2, 2), 3: (4, 2), 4: (4, 2), 5: (5, 1), 6: (6, 1)}


def test_later_arrivals_meet_the_state_and_the_contents_at_its_locators(spark, tmp_path):
    def arrival(name, rows):
        frame(spark, rows).repartition(2).write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    def found(name, rows, **options):
        marks = stream_dedup.marked(arrival(name, rows), state=f"{tmp_path}/state", arrival=name, **options).collect()
        return {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in marks}

    first, second, third = [(1, "one"), (2, "o ne"), (3, "two")], [(4, "two"), (5, "four")], [(6, " t w o"), (7, "five")]
    assert found("a", first) == {1: (2, 2), 2: (2, 2), 3: (3, 1)}
    assert found("b", second) == {4: (3, 2), 5: (5, 1)}
    assert found("b", second) == {4: (3, 2), 5: (5, 1)}  # as after a crash: counted once
    assert found("c", third) == {6: (6, 3), 7: (7, 1)}


def test_later_arrivals_with_an_earlier_digest_but_other_bytes(spark, tmp_path):
    same = lambda text: F.substring(F.md5(text.cast("binary")), 1, 0)
    frames = {"a": [(1, "one")], "b": [(2, "two"), (3, "on e"), (4, "t  wo")], "c": [(5, "t   w o")], "d": [(6, "six")]}
    expected = {"a": {1: (1, 1)}, "b": {2: (4, 2), 3: (3, 2), 4: (4, 2)}, "c": {5: (5, 3)}, "d": {6: (6, 1)}}
    for name, rows in frames.items():  # not from files: contents are written below the state
        marks = stream_dedup.marked(frame(spark, rows), digest=same, state=f"{tmp_path}/state", arrival=name).collect()
        assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in marks} == expected[name]


def test_content_at_a_locator_is_followed(spark, tmp_path):
    frame(spark, [(1, "same"), (2, "sa me"), (3, "other")]).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    row = next(r for r in stream_dedup.marked(docs).collect() if r["doc_id"] == 1)
    place = docs.select("text", stream_dedup.locator(docs).alias("row")).filter(F.col("row.position") == row["keep_row"]["position"])
    assert [r["text"] for r in place.filter(F.col("row.file") == row["keep_row"]["file"]).collect()] == ["sa me"]


def test_exact_odd_rows(spark, odd_documents, no_documents):
    rows = stream_dedup.marked(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    kept = [r for r in rows if r["row"] == r["keep_row"]]
    texts = [r["text"] for r in odd_documents.select("text").collect()]
    assert len(kept) == len(plain_groups((0, t) for t in texts))
    assert stream_dedup.marked(no_documents).count() == 0
    left = stream_dedup.drop_copies(odd_documents)
    assert left.columns == odd_documents.columns and left.count() == len(kept)
    assert stream_dedup.drop_copies(no_documents).count() == 0


def plain_set(text, size=5):
    found = (text or "").encode().lower().split()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))) if found else frozenset()


def plain_components(rows):
    sets = {i: plain_set(t) for i, t in rows}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, groups=6, copies=25):
    """Groups of edited texts of which some are similar only by way of others, with a passage common to many."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    common = [word() for _ in range(30)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([6, 40, 90]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.4:
                text += common
            if rng.random() < 0.3:
                base = text
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    found = {r["doc_id"]: (r["n"], r["component_id"]) for r in set_join.marked(frame(spark, rows)).collect()}
    assert found == plain_components(rows)
    left = {r["doc_id"] for r in set_join.one_of_each(frame(spark, rows)).collect()}
    assert left == {i for i, (_, component) in found.items() if i == component}


def test_links_are_found_where_no_centre_pair_is(spark):
    """Two near copies inside a longer text, which is the centre of their lists, and texts that hold each other."""
    word = lambda i: f"w{i}"
    copy = [word(i) for i in range(60)]
    other = [*copy[:-1], "changed"]
    nested, size = [], 30
    for _ in range(12):
        nested.append([word(1000 + i) for i in range(size)])
        size = size * 3 // 2
    texts = [copy, other, copy + other + nested[0], *nested]
    rows = [(i, " ".join(text)) for i, text in enumerate(texts)]
    want = plain_components(rows)
    assert want[1][1] == 0 and len({label for _, label in want.values()}) == len(rows) - 1
    found = {r["doc_id"]: (r["n"], r["component_id"]) for r in set_join.marked(frame(spark, rows)).collect()}
    assert found == want


def test_components_of_the_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = {r["doc_id"]: (r["n"], r["component_id"]) for r in set_join.marked(documents).collect()}
    assert found == plain_components(rows)


def test_set_join_odd_rows(odd_documents, no_documents):
    rows = set_join.marked(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by_text = {(r["doc_id"], r["n"]): r["component_id"] for r in rows}
    assert by_text[3, 1] == 3 and by_text[1, 0] == 1 and by_text[None, 0] is None
    left = set_join.one_of_each(odd_documents)
    assert left.columns == odd_documents.columns
    assert left.filter("text = 'a'").count() == 1 and left.filter("text = 'no id'").count() == 1
    assert left.filter("trim(coalesce(text, '')) = ''").count() == 3  # empty sets are in no group
    assert set_join.marked(no_documents).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 299)]
    found = {r["u"]: r["v"] for r in links.components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 60)}, 300: 299}


def plain_passages(rows, least=50):
    seen, repeated = {}, set()
    cut = [(n, (t or "").encode().lower().split()) for n, (_, t) in enumerate(rows)]
    for n, words in cut:
        for k in range(len(words) - least + 1):
            window = tuple(words[k : k + least])
            if seen.setdefault(window, n) != n:
                repeated.add(window)
    out = []
    for n, words in cut:
        spans = []
        for k in range(len(words) - least + 1):
            if tuple(words[k : k + least]) in repeated:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + least
                else:
                    spans.append([k, k + least])
        out += [(rows[n][0], a, b - a) for a, b in spans]
    return sorted(out, key=repr)


def passage_rows(seed):
    """Passages that overlap in different ways, so that the nearest suffix does not always hold the longest match."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    some = lambda n: [word() for _ in range(n)]
    pool, rows = some(400), []
    for _ in range(120):
        text = some(rng.randrange(30))
        for _ in range(rng.randrange(4)):
            a = rng.randrange(350)
            text += pool[a : a + rng.choice([20, 30, 45, 49, 50, 51, 80, 150])] + some(rng.randrange(12))
        if rng.random() < 0.2:
            text += some(rng.choice([1, 2, 7])) * rng.choice([10, 60, 120]) if rng.random() < 0.5 else pool[:2] * rng.choice([30, 70])
        rows.append((len(rows), " ".join(text)))
    return rows + [(len(rows), rows[5][1]), (5, rows[5][1])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages_equal_brute_force(spark, seed):
    rows = passage_rows(seed)
    found = [(r["doc_id"], r["first_word"], r["n_words"]) for r in passages.repeated(frame(spark, rows).repartition(5)).collect()]
    assert sorted(found, key=repr) == plain_passages(rows)


def near_periodic_rows(seed):
    """Tables, a template with a number a row, of which two documents share rows with other rows before and after."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(150):
        template = [word() for _ in range(rng.randrange(9, 19))]
        at = rng.randrange(len(template) + 1)
        exact = rng.random() < 0.2
        lines = lambda n: [w for _ in range(n) for w in [*template[:at], "same" if exact else str(rng.randrange(10**9)), *template[at:]]]  # noqa: E731, B023
        shared = lines(rng.randrange(3, 9))
        shared = shared[rng.randrange(10) : len(shared) - rng.randrange(10)]
        for _ in range(2):
            text = [word() for _ in range(rng.randrange(20))] + lines(rng.randrange(12)) + shared + lines(rng.randrange(12))
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_near_periodic_rows_equal_brute_force(spark, seed):
    rows = near_periodic_rows(seed)
    found = [(r["doc_id"], r["first_word"], r["n_words"]) for r in passages.repeated(frame(spark, rows).repartition(5)).collect()]
    assert sorted(found, key=repr) == plain_passages(rows)


def test_passages_odd_rows(spark, odd_documents, no_documents):
    assert passages.repeated(odd_documents).count() == 0
    assert passages.repeated(odd_documents.unionByName(odd_documents)).count() == 2  # the long text, on two rows
    assert passages.repeated(no_documents).count() == 0


def test_periodic_texts_keep_few_seeds():
    h = np.array([1, 2] * 5000, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at, _ = passages.seeds_of(h, passages.Rule())
    assert len(at) < len(h) / 15 and np.diff(at).max() <= passages.Rule().window
