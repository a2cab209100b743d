"""Decontamination, dialogues, fixity and the pipeline."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from airscan.llm import chat, decontaminate, fixity
from airscan.llm.decontaminate import Index, Rule


def copies_with_edits(items, n, seed):
    """Texts that hold an item with some words replaced, between other words."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = rng.choice(items)[1].split()
        words = [w if rng.random() < 0.85 else "changed" for w in words]
        out.append((i, " ".join([*["other"] * rng.randrange(30), *words, *["more"] * rng.randrange(30)])))
    return out


@pytest.mark.parametrize("shard", [7, 60])
def test_shards_find_what_the_whole_index_finds(spark, shard):
    items = random_items(200, 8)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    documents = spark.createDataFrame(copies_with_edits(items, 300, 9), "doc_id bigint, text string")
    whole = sorted(map(tuple, decontaminate.matches(documents, benchmark).collect()))
    parts = sorted(map(tuple, decontaminate.matches(documents, benchmark, shard=shard).collect()))
    assert whole and [(r[:2], r[3:]) for r in parts] == [(r[:2], r[3:]) for r in whole]
    assert [r[2] for r in parts] == pytest.approx([r[2] for r in whole], abs=1e-9)
    kept = {r["doc_id"] for r in decontaminate.without_leaks(documents, benchmark, shard=shard).collect()}
    assert kept == set(range(300)) - {r[0] for r in whole}


def random_items(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.choice([2, 3, 5]))) for _ in range(300)]
    return [(i, " ".join(rng.choice(words[: rng.choice([20, 300])]) for _ in range(rng.randrange(5, 50)))) for i in range(n)]


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.6])
def test_wand_retrieves_what_full_scoring_does(threshold):
    index = Index(random_items(150, 3), Rule(threshold=threshold, block=4))
    rng = random.Random(4)
    for _ in range(400):
        terms = set(rng.sample(range(len(index.known)), rng.randint(1, 40))) | set(rng.choice(index.items)[: rng.randint(0, 30)])
        scores = Counter()
        for t in terms:
            for item, weight in zip(index.docs[t], index.weights[t], strict=True):
                scores[item] += weight
        want = {item: s for item, s in scores.items() if s >= threshold - 1e-9}
        found = dict(index.search(sorted(terms)))
        assert found.keys() == want.keys() and all(found[i] == pytest.approx(want[i]) for i in want)


def test_no_passage_above_the_threshold_is_passed_over():
    index = Index(random_items(60, 5), Rule(threshold=0.35, overlap=0.0))
    rng = random.Random(6)
    step = index.span // 2
    for _ in range(150):
        numbers = [rng.randrange(-1, len(index.known)) for _ in range(rng.randrange(1, 400))]
        item = rng.choice(index.items)
        at = rng.randrange(len(numbers))
        numbers = np.array(numbers[:at] + item[: rng.randint(1, len(item))] + numbers[at:], np.int64)
        want = set()
        for k in range(0, max(1, len(numbers) - step), step):
            terms = sorted({t for t in numbers[k : k + index.span].tolist() if t >= 0})
            want |= {item for item, _ in index.search(terms)} if terms else set()
        assert set(index.leaks(numbers)) == want


def alike_items(n, seed):
    """Items with one opening, so that their first words are common and their last ones rare."""
    rng = random.Random(seed)
    opening = "Which of the following statements about the".split()
    return [(i, " ".join([*opening, *(f"w{rng.randrange(10_000)}" for _ in range(rng.randrange(5, 40)))])) for i in range(n)]


def test_items_that_begin_with_common_words_are_found_at_every_place():
    index = Index(alike_items(100, 7), Rule())
    step = index.span // 2
    for i in (min(range(100), key=lambda i: len(index.items[i])), 1, 2, max(range(100), key=lambda i: len(index.items[i]))):
        for at in range(2 * step + 1):
            for after in (0, 3 * step):
                assert i in index.leaks(np.array([-1] * at + index.items[i] + [-1] * after, np.int64)), (i, at, after)


def edited_copies(item):
    """The item with one word replaced, left out or put in, at every position."""
    for k in range(len(item)):
        yield item[:k] + [-1] + item[k + 1 :]
        yield item[:k] + item[k + 1 :]
        yield item[:k] + [-1] + item[k:]


def test_no_single_edit_hides_a_copy_that_is_retrieved(sf):
    for items in ([tuple(r) for r in sf("benchmark").collect()], [x for x in random_items(60, 8) if len(x[1].split()) < 12]):
        index = Index(items, Rule())
        retrieved = 0
        for i, item in enumerate(index.items):
            for copy in edited_copies(item):
                if i in dict(index.search(sorted({t for t in copy if t >= 0}))):
                    retrieved += 1
                    assert i in index.leaks(np.array([-1] * 7 + copy + [-1] * 30, np.int64)), (item, copy)
        assert retrieved > len(items)


def plain_edits(item, text):
    """Fewest edits between the item and any stretch of the text."""
    costs = list(range(len(item) + 1))
    fewest = costs[-1]
    for word in text:
        new = [0]
        for j, term in enumerate(item):
            new.append(min(costs[j] + (term != word), costs[j + 1] + 1, new[j] + 1))
        costs = new
        fewest = min(fewest, costs[-1])
    return fewest


def test_alignments_equal_plain_edits():
    rng = random.Random(9)
    index = Index(random_items(40, 10), Rule())
    found = 0
    for _ in range(600):
        i = rng.randrange(len(index.items))
        item = index.items[i]
        text = [t if rng.random() > 0.2 else rng.choice([-1, *item]) for t in item for _ in range(rng.choice([0, 1, 1, 1, 1, 1, 2]))]
        text = [rng.choice([-1, *item]) for _ in range(5)] + text
        near, edits = index.aligned(i, text), plain_edits(item, text)
        if edits <= 1:
            assert near is not None and 1 - near[0] <= 1 / (len(item) - index.answer(item)) + 1e-9
        if edits > 0.4 * len(item) + 1e-9:
            assert near is None
        found += near is not None
    assert 100 < found < 600
    whole = max(range(len(index.items)), key=lambda i: len(index.items[i]))
    item = index.items[whole]
    assert index.aligned(whole, item[: -index.answer(item)] + [-1] * 50) is None
    assert index.aligned(whole, item[::-1]) is None


def test_planted_items_are_found_in_any_writing(spark, sf):
    items = [tuple(r) for r in sf("benchmark").collect()]
    filler = "filler words that no item holds " * 40
    rows = []
    for n, (item_id, text) in enumerate(items):
        written = [text, text.upper(), "** " + " | ".join(text.split()) + "!!"][n % 3]
        rows.append((item_id, filler * (n % 3) + written + " " + filler * (n % 2)))
    rows.append((10_000, filler * 5))
    rows.append((10_001, " ".join(items[0][1].split()[: len(items[0][1].split()) // 3])))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(table, sf("benchmark")).collect()}
    assert found == {(i, i) for i, _ in items}
    assert found == {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(table, sf("benchmark"), shard=7).collect()}
    left = decontaminate.without_leaks(table, sf("benchmark"), shard=15)
    assert sorted(r["doc_id"] for r in left.collect()) == [10_000, 10_001]


@pytest.mark.parametrize("space", ["\u00a0", "\u3000", "\u202f", "\u2009", "\u0085", "\x1c"])
def test_items_with_any_white_space_are_found_verbatim(spark, space):
    words = "Which planet of the solar system has the largest moon of all Jupiter with Ganymede".split()
    texts = [space.join(words), " ".join(words[:-2]) + space + words[-2] + " " + words[-1]]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    other = [(9, "filler words that no item holds " * 20)]
    table = spark.createDataFrame([*enumerate(f"before it {text} after it" for text in texts), *other], "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(table, items).collect()}
    assert {(0, 0), (1, 1)} <= found and 9 not in {doc for doc, _ in found}
    assert [r["doc_id"] for r in decontaminate.without_leaks(table, items).collect()] == [9]


def test_decontamination_odd_rows(spark, odd_documents, no_documents, sf):
    items = sf("benchmark")
    assert decontaminate.matches(odd_documents, items).count() == 0
    left = decontaminate.without_leaks(odd_documents, items)
    assert left.columns == odd_documents.columns and left.count() == odd_documents.count()
    assert decontaminate.matches(no_documents, items).count() == 0
    empty = spark.createDataFrame([(None, None), (1, ""), (2, "!!")], "item_id bigint, text string")
    assert decontaminate.matches(odd_documents, empty).count() == 0
    assert decontaminate.without_leaks(odd_documents, items.limit(0)).count() == odd_documents.count()
    one = spark.createDataFrame([(5, "no id")], "item_id bigint, text string")
    assert [r["item_id"] for r in decontaminate.matches(odd_documents, one).collect()] == [5, 5]


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, part string, slice int"


def dialogue(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], CONVERSATIONS)


def test_every_speaker_is_the_assistant_once(spark):
    rows = [(1, 0, "system", "Be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "a <|end|> b"), (1, 3, "ann", None), (1, 1, "ann", "hi")]
    found = {r["perspective"]: r for r in chat.rendered(dialogue(spark, rows)).collect()}
    assert found.keys() == {"ann", "bob"}
    ann = found["ann"]
    assert ann["rendered"] == (
        "<|system|>\nBe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user name=bob|>\na < |end| > b<|end|>\n<|assistant|>\n<|end|>\n"
    )
    assert [ann["rendered"][s["start"] : s["end"]] for s in ann["mask"]] == ["hi<|end|>", "<|end|>"]
    assert [found["bob"]["rendered"][s["start"] : s["end"]] for s in found["bob"]["mask"]] == ["a < |end| > b<|end|>"]


def test_dialogues_odd_rows(spark):
    rows = [(1, 0, "system", "alone"), (None, 0, "a", "x"), (None, 1, None, "y"), (2, None, "a", "last"), (2, 200, "b", ""), (2, 3, "a", "1")]
    rows += [(3, 0, "a", "long " * 300_000), (3, 0, "a", "long " * 300_000), (3, 1, "b", "short")]
    found = {(r["conv_id"], r["perspective"], r["part"]): r for r in chat.rendered(dialogue(spark, rows)).collect()}
    assert {k: r["n_turns"] for k, r in found.items()} == {
        (None, "a", 0): 2, (None, "unknown", 0): 2, (2, "a", 0): 3, (2, "b", 0): 3,
        (3, "a", 0): 1, (3, "b", 0): 1, (3, "a", 1): 1, (3, "b", 1): 1,
    }
    assert found[2, "a", 0]["rendered"].index("last") > found[2, "a", 0]["rendered"].index("1<|end|>")
    assert len(found[3, "a", 0]["rendered"]) > 1_500_000
    assert chat.rendered(dialogue(spark, [])).count() == 0


def plain_parts(rows, limit):
    """Turns of each part of each conversation, by one pass over the sorted turns."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted({r[1:] for r in rows if r[0] == conv}, key=lambda t: (t[0] is None, t))
        size = [len((role + text).encode()) for _, role, text in own]
        systems = [t for t in own if t[1] == "system"]
        again = sum(len((role + text).encode()) for _, role, text in systems) <= limit // 4
        cut, before = {}, 0
        for t, n in zip(own, size, strict=True):
            cut.setdefault(before // limit if sum(size) > limit else 0, []).append(t)
            before += n
        for part, inside in cut.items():
            lead = [t for p in cut if p < part for t in cut[p] if t[1] == "system"] if again else []
            out[conv, part] = sorted([*lead, *inside], key=lambda t: (t[0] is None, t))
    return out


@pytest.mark.parametrize("limit", [200, 1000, 50_000])
def test_long_dialogues_are_cut_by_bytes_with_their_system_turns(spark, limit):
    rng = random.Random(limit)
    rows = [(conv, t if rng.random() < 0.98 else None, rng.choice("abc"), "é" * rng.randrange(40)) for conv in (1, 2, 3) for t in range(40 * conv)]
    rows += [(1, 0, "system", "be kind"), (2, 30, "system", "half way"), (3, 0, "system", "s" * 400), *[(3, 7, "a", f"crowd {i:03d}") for i in range(80)]]
    found = chat.rendered(dialogue(spark, rows).repartition(5), limit).collect()
    want = plain_parts(rows, limit)
    speakers = {conv: {r for (c, _), turns in want.items() if c == conv for _, r, _ in turns} - {"system"} for conv in (1, 2, 3)}
    assert {(r["conv_id"], r["part"], r["perspective"]) for r in found} == {(c, p, s) for c, p in want for s in speakers[c]}
    for r in found:
        text, spans = "", []
        for _, role, said in want[r["conv_id"], r["part"]]:
            own = role == r["perspective"]
            text += "<|assistant|>\n" if own else "<|system|>\n" if role == "system" else f"<|user name={role}|>\n"
            spans += [(len(text), len(text) + len(said) + 7)] if own else []
            text += said + "<|end|>\n"
        assert (r["rendered"], [(m["start"], m["end"]) for m in r["mask"]]) == (text, spans)


def test_a_whole_dialogue_is_one_row(spark):
    turns = [(7, t, "ab"[t % 2], f"t{t}") for t in range(1000)] + [(7, 5, "a", f"same {i}") for i in range(500)]
    rows = chat.rendered(dialogue(spark, turns)).filter("perspective = 'a'").collect()
    assert [r["n_turns"] for r in rows] == [1500] and rows[0]["rendered"].count("<|assistant|>") == 1000
    for limit in (chat.LIMIT, 500):
        plan = chat.rendered(dialogue(spark, turns), limit)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "CartesianProduct"))


PAGES = "page_id bigint, url string, html string, file string, digest int"


def manifest(spark, rows, html="html"):
    return fixity.manifest(fixity.records(spark.createDataFrame([(*r, "f", 0) for r in rows], PAGES), F.coalesce(F.expr(html), F.lit(""))))


def test_audit_finds_exactly_the_damage(spark):
    rng = random.Random(1)
    rows = [(i, f"http://x/{i}", "<p>" + "z" * rng.randrange(3000)) for i in range(6000)]
    bad = {5, 77, 4095, 4096, 5999}
    first, second = manifest(spark, rows), manifest(spark, rows, f"if(page_id in {tuple(bad)}, overlay(html placing '#' from 2), html)")
    lost = second.filter("page_id != 5998")
    found = {r["page_id"]: r["kind"] for r in fixity.audit(first, lost).collect()}
    assert found == {**{i: "changed" for i in bad}, 5998: "missing"}
    assert {r["kind"] for r in fixity.audit(lost, second).collect()} == {"extra"}
    assert fixity.audit(first, manifest(spark, rows)).count() == 0


def test_audit_tells_a_shift_from_damage(spark):
    rng = random.Random(2)
    rows = [(i, f"http://x/{i}", "<p>" + "z" * rng.randrange(2000)) for i in range(9000)]
    first = manifest(spark, rows)
    one = lambda second: [(r["page_id"], r["kind"]) for r in fixity.audit(first, second).collect()]
    assert one(manifest(spark, rows[:500] + rows[501:])) == [(500, "missing")]
    assert one(manifest(spark, rows, "if(page_id = 700, concat(html, '!'), html)")) == [(700, "changed")]
    r = fixity.audit(manifest(spark, rows[:500] + rows[501:]), first).collect()
    at = {r["page_id"]: r["offset"] for r in first.filter("page_id = 500").collect()}
    assert [(x["kind"], x["byte_offset"], x["second_offset"]) for x in r] == [("extra", None, at[500])]
    several = manifest(spark, rows[:100] + rows[101:], "if(page_id in (50, 150, 8999), concat(html, 'more'), html)")
    assert sorted(one(several)) == [(50, "changed"), (100, "missing"), (150, "changed"), (8999, "changed")]


def test_audit_sees_records_that_changed_places(spark):
    places = lambda order: spark.createDataFrame(
        [("f", 100 * k, 100, f"digest {i}", i) for k, i in enumerate(order)],
        "file string, offset bigint, length bigint, digest string, page_id bigint",
    )
    found = fixity.audit(places(range(2000)), places([*range(700), 701, 700, *range(702, 2000)])).collect()
    assert sorted((r["page_id"], r["kind"], r["byte_offset"], r["second_offset"]) for r in found) == [
        (700, "moved", 70000, 70100), (701, "moved", 70100, 70000),
    ]


def test_audit_does_not_pair_several_records_of_an_id(spark):
    first = manifest(spark, [(1, "u", "a"), (1, "u", "b"), (2, "u", "c"), (None, "u", "d")])
    second = manifest(spark, [(1, "u", "x"), (1, "u", "b"), (2, "u", "y"), (2, "u", "z"), (None, "u", "e")])
    found = sorted((r["page_id"] or 0, r["kind"]) for r in fixity.audit(first, second).collect() if r["kind"] != "moved")
    assert found == [(0, "extra"), (0, "missing"), (1, "changed"), (2, "extra"), (2, "extra"), (2, "missing")]


def test_offsets_and_digests_are_those_of_the_written_file(spark):
    rows = [(i, "u", "é" * (i % 50)) for i in range(300)]
    at = 0
    found = {r["page_id"]: r for r in manifest(spark, rows).collect()}
    for i, url, html in rows:
        body = html.encode()
        head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: {url}\r\nWARC-Record-ID: <urn:page:{i}>\r\n"
        record = head.encode() + f"Content-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
        assert (found[i]["offset"], found[i]["length"]) == (at, len(record))
        assert found[i]["digest"] == hashlib.sha256(record).hexdigest()
        at += len(record)


def test_fixity_odd_rows(spark):
    rows = [(None, None, None), (None, "u", "x"), (1, None, None), (1, None, None), (1, "u", "y"), (2, "u", "")]
    rows += [(9, "u", f"crowd {i}") for i in range(3000)]
    first = manifest(spark, rows)
    assert first.count() == len(rows) - 1
    by_file = defaultdict(list)
    for r in first.collect():
        by_file[r["file"]].append((r["offset"], r["length"]))
    for places in by_file.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False)) and places[0][0] == 0
    assert fixity.audit(first, first).count() == 0
    none = manifest(spark, [])
    assert fixity.audit(none, none).count() == 0 and fixity.audit(first, none).count() == first.count()


def test_pipeline_stages_take_effect(spark):
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
        assert docs.columns[: len(columns)] == columns
        left = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(left) == len(set(left)) and set(left) <= ids, name
        ids = set(left)
    whole = corpus_pipeline.run(spark, data)
    assert {r["doc_id"] for r in whole.collect()} == ids and whole.filter("mix_rate <= 0").count() == 0


def test_pipeline_of_odd_and_no_rows(spark, odd_documents, no_documents):
    data = "/root/testdata/sf0.001"
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, data)
            docs.collect()
