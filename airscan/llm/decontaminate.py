"""Benchmark decontamination: BM25 over an inverted index of the test items, searched by block-max WAND.

Every passage of every document is a query. Passages are windows of twice the longest item's words, half overlapping,
so an item that was copied lies whole in one of them. Term weights are divided by the item's score against itself; a
passage retrieves all items of at least ``threshold`` of that. Most passages end at a first bound: the common terms
together bring an item a known share, and the postings of the rarer terms, summed for all passages of a document at
once, must bring some item the rest. What is retrieved counts only if the passage also holds enough of the word sequences of the item's question and of its answer
(the last quarter of its words), or nearly the whole item in order: aligned with the passage, at most the share of
edits that ``overlap`` leaves, and in question and answer each at most that share of missing words, or one word. So no
single edit of an item of three or more words hides a copy that was retrieved. The overlaps of such rows are shares of words.

The index holds a bounded number of items (``SHARD`` items at most, then another pass over the documents with the next
ones), so what is broadcast has a bound that does not depend on the documents. Numbers of items and of items with a term,
the mean length and the passage width are those of all items, so the cut into shards does not change any result. Whole
texts are read, however long.

Words of items and documents are cut at any Unicode white space, compared without case, and lose marks at their ends; words
of marks only are dropped. Null and empty documents match
nothing; null and empty items are left out; items with one text each get their own row. Repeated documents get rows of
their own. Empty tables give an empty result. Columns other than doc_id, text and item_id are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airscan.llm.frames import batches, utf8, whole_text
from airscan.sources.local import small_table, staged

SCHEMA = "doc_id bigint, item_id bigint, bm25_share double, question_overlap double, answer_overlap double, first_word bigint"
MARKS = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")
SHARD = 20_000
REMEMBERED = 1 << 19  # raw words whose term a task keeps
EDIT, ANSWER = 1 << 40, 1 << 20  # what an edit, and a missing word of the answer, add to the cost of an alignment


@dataclass(frozen=True)
class Rule:
    """BM25's constants, the share of an item's own score to reach, and the share of its sequences to hold."""

    k1: float = 1.2
    b: float = 0.75
    threshold: float = 0.6
    overlap: float = 0.6
    sequence: int = 5
    block: int = 16


def raw_words(text: str) -> list[str]:
    """Words of an item or a document, cut at all Unicode white space."""
    return text.split()


def term_of(word: str) -> str:
    return MARKS.sub("", word.casefold())


def sequences(terms: list[int], size: int) -> set[tuple[int, ...]]:
    size = max(1, min(size, len(terms)))
    return set(zip(*(terms[i:] for i in range(size)), strict=False))


class Terms(dict):
    """Numbers of raw words: of its term in the index, -1 for other terms, -2 for no term."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        term = term_of(word)
        number = self.known.get(term, -1) if term else -2
        self[word] = number
        return number


def terms_of(text: str) -> list[str]:
    return [t for t in map(term_of, raw_words(text)) if t]


@dataclass(frozen=True)
class Corpus:
    """Of all test items: how many there are, their mean and greatest length in terms, and how many hold each term."""

    items: int
    mean: float
    longest: int
    holding: dict[str, int]

    @classmethod
    def of(cls, texts: list[list[str]]) -> Corpus:
        sizes = [len(terms) for terms in texts if terms]
        holding = Counter(t for terms in texts for t in set(terms))
        return cls(len(sizes), sum(sizes) / max(1, len(sizes)), max(sizes, default=1), dict(holding))


class Index:
    """Inverted index of test items with block maxima, and what a task needs to search it.

    ``corpus`` describes all items where these are only some of them.
    """

    def __init__(self, items: list[tuple[int, str]], rule: Rule, corpus: Corpus | None = None):
        self.rule = rule
        texts = [terms_of(text) for _, text in items]
        self.corpus = corpus or Corpus.of(texts)
        kept = [i for i, terms in enumerate(texts) if terms]
        self.item_ids = [items[i][0] for i in kept]
        self.known: dict[str, int] = {}
        self.items = [[self.known.setdefault(t, len(self.known)) for t in texts[i]] for i in kept]
        self.span = 2 * self.corpus.longest
        self.parts = []
        for terms in self.items:
            answer = self.answer(terms)
            self.parts.append((sequences(terms[:-answer] or terms, rule.sequence), sequences(terms[-answer:], rule.sequence)))
        self.weigh()
        del self.corpus  # as large as the items' vocabulary, and not searched

    @staticmethod
    def answer(terms: list[int]) -> int:
        """Words of an item that count as its answer."""
        return max(1, len(terms) // 4)

    def weigh(self) -> None:
        """Postings by term with item-normalised weights, their maxima, and the common terms' most in any item."""
        rule, n, mean = self.rule, self.corpus.items, self.corpus.mean
        df = {number: self.corpus.holding[term] for term, number in self.known.items()}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.known]
        shares = []
        for i, terms in enumerate(self.items):
            norm = rule.k1 * (1 - rule.b + rule.b * len(terms) / mean)
            raw = {t: np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * f * (rule.k1 + 1) / (f + norm) for t, f in Counter(terms).items()}
            total = sum(raw.values())
            shares.append({t: w / total for t, w in raw.items()})
            for t, w in shares[-1].items():
                postings[t].append((i, w))
        self.docs = [[i for i, _ in p] for p in postings]
        self.weights = [[w for _, w in p] for p in postings]
        self.most = np.array([max(w) for w in self.weights] or [0.0])
        size = rule.block
        self.blocks = [[(d[min(k + size, len(d)) - 1], max(w[k : k + size])) for k in range(0, len(d), size)]
                       for d, w in zip(self.docs, self.weights, strict=True)]
        # Terms by falling frequency count as common while no item gets half the threshold from them together.
        got, self.rare = np.zeros(len(self.items)), np.ones(len(df), bool)
        for t in sorted(range(len(df)), key=lambda t: (-df[t], t)):
            more = got.copy()
            more[self.docs[t]] += self.weights[t]
            if df[t] < 2 or more.max() > rule.threshold / 2:
                break
            got, self.rare[t] = more, False
        self.common = got
        self.first = np.cumsum([0, *map(len, self.docs)])
        self.flat_items = np.array([i for d in self.docs for i in d], np.int64)
        self.flat_weights = np.array([w for ws in self.weights for w in ws])

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """Block-max WAND: all items to which the terms bring the threshold or more, with their shares."""
        least = self.rule.threshold - 1e-9
        lists = [[self.docs[t][0], t, 0] for t in terms]
        found = []
        while lists:
            lists.sort()
            bound, pivot = 0.0, -1
            for k, (_, t, _) in enumerate(lists):
                bound += self.most[t]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            head = lists[: pivot + 1]
            bound, end = 0.0, None
            for _, t, at in head:
                last, most = self.block_of(t, at, item)
                bound += most
                end = last if end is None or (last is not None and last < end) else end
            if bound >= least:
                if lists[0][0] == item:
                    share = sum(self.weights[t][at] for _, t, at in head)
                    if share >= least:
                        found.append((item, share))
                    lists = self.moved(lists, pivot, item + 1)
                else:
                    lists = self.moved(lists, pivot, item)
            else:
                skip = (end if end is not None else item) + 1
                if pivot + 1 < len(lists):
                    skip = min(skip, lists[pivot + 1][0])
                lists = self.moved(lists, pivot, max(skip, item + 1))
        return found

    def block_of(self, term: int, at: int, item: int) -> tuple[int | None, float]:
        """Last item and largest weight of the block of a posting list in which ``item`` would lie."""
        blocks = self.blocks[term]
        for k in range(at // self.rule.block, len(blocks)):
            if blocks[k][0] >= item:
                return blocks[k]
        return None, 0.0

    def moved(self, lists: list[list[int]], pivot: int, item: int) -> list[list[int]]:
        """The lists up to the pivot moved to their first posting from ``item`` on; ended lists are left out."""
        out = lists[pivot + 1 :]
        for doc, t, at in lists[: pivot + 1]:
            docs = self.docs[t]
            while at < len(docs) and doc < item:
                at += 1
                doc = docs[at] if at < len(docs) else doc
            if at < len(docs):
                out.append([doc, t, at])
        return out

    def hopeful(self, numbers: np.ndarray, step: int) -> list[int]:
        """Passages whose two halves bring some item enough from rarer terms; in all others it is below the threshold.

        Either half may bring all of it: an item may begin with common terms only, its rarer ones in the half after.
        """
        at = np.flatnonzero(numbers >= 0)
        at = at[self.rare[numbers[at]]]
        terms = numbers[at]
        size = self.first[terms + 1] - self.first[terms]
        place = np.repeat(self.first[terms] - np.cumsum(size) + size, size) + np.arange(size.sum())
        half = np.repeat(at // step, size)
        pairs, which = np.unique(half * len(self.items) + self.flat_items[place], return_inverse=True)
        mass = np.bincount(which, self.flat_weights[place], len(pairs))
        after = np.searchsorted(pairs, pairs + len(self.items))
        joined = mass + np.where(np.append(pairs, -1)[after] == pairs + len(self.items), np.append(mass, 0.0)[after], 0.0)
        halves, items = np.divmod(pairs, max(1, len(self.items)))
        least = self.rule.threshold - 1e-9 - self.common[items]
        last = max(0, -(-(len(numbers) - step) // step) - 1)
        begin = np.concatenate([halves[joined >= least], halves[mass >= least] - 1])
        return np.unique(np.clip(begin, 0, last)).tolist()

    def aligned(self, item: int, passage: list[int]) -> tuple[float, float] | None:
        """Shares of the question's and the answer's words that stand in order in a near copy of the item, if there is one.

        The item is aligned with every stretch of the passage at the fewest edits, and of those the fewest missing words of
        the answer, then of the question: the three counts are the digits of one number.
        """
        terms = np.array(self.items[item], np.int64)
        n, answer = len(terms), self.answer(self.items[item])
        spare = 1 - self.rule.overlap + 1e-9
        if spare * n < 1 or np.isin(terms, passage, invert=True).sum() > spare * n:
            return None
        missing = np.where(np.arange(n) < n - answer, EDIT + 1, EDIT + ANSWER)
        gone = np.append(0, np.cumsum(missing))
        costs, ends = gone, np.empty(len(passage), np.int64)
        for k, word in enumerate(passage):
            best = np.minimum(costs[:-1] + np.where(terms == word, 0, missing), costs[1:] + EDIT)
            costs = np.minimum.accumulate(np.append(0, best) - gone) + gone
            ends[k] = costs[-1]
        asked, answered = ends % ANSWER, ends % EDIT // ANSWER
        near = (ends // EDIT <= spare * n) & (asked <= max(1, spare * (n - answer))) & (answered <= max(1, spare * answer))
        if not near.any():
            return None
        k = np.where(near, ends, np.iinfo(np.int64).max).argmin()
        return float(1 - asked[k] / (n - answer)), float(1 - answered[k] / answer)

    def leaks(self, numbers: np.ndarray) -> dict[int, tuple[float, float, float, int]]:
        """Verified items of a document, each with its best passage: share, overlaps and first word."""
        numbers = numbers[numbers > -2]
        step = self.span // 2
        best: dict[int, tuple[float, float, float, int]] = {}
        for k in self.hopeful(numbers, step):
            passage = numbers[k * step : k * step + self.span].tolist()
            terms = sorted({t for t in passage if t >= 0})
            for item, share in self.search(terms):
                question, answer = self.parts[item]
                held = sequences(passage, len(next(iter(question))))
                asked = len(question & held) / len(question)
                held = sequences(passage, len(next(iter(answer))))
                answered = len(answer & held) / len(answer)
                if min(asked, answered) < self.rule.overlap:
                    near = self.aligned(item, passage)
                    if near is None:
                        continue
                    asked, answered = near
                row = (share, asked, answered, k * step)
                if row > best.get(item, (0.0,)):
                    best[item] = row
        return best


def described(rows: DataFrame) -> tuple[DataFrame, Corpus]:
    """(term, n) for all items, a written table, and the rest of the corpus without the terms."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, sizes = Counter(), []
        for batch in batches(frames):
            for text in batch["text"].to_pylist():
                terms = terms_of(text)
                holding.update(set(terms))
                sizes += [len(terms)] if terms else []
        found = [*holding.items(), (None, len(sizes))]
        total, longest = [0] * len(holding) + [sum(sizes)], [0] * len(holding) + [max(sizes, default=0)]
        columns = [[t for t, _ in found], [n for _, n in found], total, longest]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["term", "n", "total", "longest"])

    parts = staged(rows.select("text").mapInArrow(run, "term string, n bigint, total bigint, longest bigint"), "items-terms")
    whole = parts.filter("term is null").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("longest").alias("longest")).first()
    corpus = Corpus(whole.n or 0, (whole.total or 0) / max(1, whole.n or 0), whole.longest or 1, {})
    return staged(parts.filter("term is not null").groupBy("term").agg(F.sum("n").alias("n")), "items-holding"), corpus


def indexes(benchmark: DataFrame, rule: Rule, shard: int) -> Iterator[Index]:
    """One index per ``shard`` items; items beyond the first are read in further, equally bounded parts."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), whole_text().alias("text"))
    parts = max(1, -(-rows.count() // shard))
    if parts == 1:
        yield Index(sorted((tuple(row) for row in rows.collect()), key=repr), rule)
        return
    holding, corpus = described(rows)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        found = sorted((tuple(row) for row in rows.filter(part == k).collect()), key=repr)
        terms = sorted({t for _, text in found for t in terms_of(text)})
        own = small_table(rows.sparkSession, [(t,) for t in terms], pa.schema([("term", pa.string())]))
        counts = dict(map(tuple, holding.join(own, "term").select("term", "n").collect()))
        yield Index(found, rule, replace(corpus, holding=counts))


def matches(documents: DataFrame, benchmark: DataFrame, rule: Rule = Rule(), shard: int = SHARD) -> DataFrame:
    """One row per document and test item that it holds."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    found = None
    for index in indexes(benchmark, rule, shard):
        part = rows.mapInArrow(searcher(documents, index), SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found


def searcher(documents: DataFrame, index: Index):
    shared = documents.sparkSession.sparkContext.broadcast(index)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        numbers = Terms(found.known)
        for batch in batches(frames):
            rows = []
            for doc_id, text in zip(batch[0].to_pylist(), utf8(batch[1]), strict=True):
                if text:
                    leaks = found.leaks(np.array([numbers[word] for word in raw_words(text.decode())], np.int64))
                    rows += [(doc_id, found.item_ids[item], *row) for item, row in leaks.items()]
            if rows:
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [part.split()[0] for part in SCHEMA.split(", ")])

    return run


def clean(documents: DataFrame, index: Index):
    """A pandas function that says of texts whether they hold no item of the index."""
    shared = documents.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("boolean")
    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = shared.value
        numbers = Terms(found.known)
        for texts in frames:
            terms = (np.array([numbers[word] for word in raw_words(text)], np.int64) for text in texts)
            yield pd.Series([not found.leaks(each) for each in terms], dtype=bool)

    return run


def without_leaks(documents: DataFrame, benchmark: DataFrame, rule: Rule = Rule(), shard: int = SHARD) -> DataFrame:
    """The documents that hold no test item, all columns as they were."""
    for index in indexes(benchmark, rule, shard):
        documents = documents.filter(clean(documents, index)(whole_text()))
    return documents
