"""Operator 11: ranked lexical search by scanning whole texts with an Aho-Corasick automaton.

The automaton holds the terms of all items, each between guards: a term is a maximal run,
so it has to be met from guard to guard. Texts get a guard in place of every other
character, and then each occurrence of a term is one output of the automaton. There is no
index of the documents: one scan counts the documents, their terms and the documents of
each item term; a second one counts again and scores, since weights need the first's sums.

Texts are read where they lie and never shuffled. A task keeps the best documents of each
item only, and these meet in a window per item. Items are handled in chunks of bounded
size, each broadcast to the tasks; more items make more scans, not larger broadcasts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import lean, slices

#: Terms are the maximal matches, once A-Z are lower case. Every byte of a longer UTF-8 sequence belongs to a term.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents returned for an item.
BEST = 10
#: Bytes of item texts of a chunk: some hundred MB of automaton, at the worst.
CHUNK_BYTES = 2 << 20
#: Scores (documents x items) held at a time, and terms of documents expanded to their items at a time.
CELLS, POSTINGS = 400_000, 2_000_000

GUARD = " "
#: What each byte of a text becomes: a term's byte in lower case, or the guard.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else ord(GUARD) for b in range(256))
_INSIDE = np.array([b != ord(GUARD) for b in FOLD])


def folded(text: bytes) -> str:
    """A text for the automaton, one character a byte, with a guard at both ends."""
    return f"{GUARD}{text.translate(FOLD).decode('latin-1')}{GUARD}"


def n_terms(text: bytes) -> int:
    """Number of terms of a text, with repeats."""
    inside = _INSIDE[np.frombuffer(text, np.uint8)]
    return int(np.count_nonzero(inside[1:] > inside[:-1])) + int(inside[:1].sum())


class Items:
    """Items of one chunk: their distinct terms, and for each term the items that it is of."""

    def __init__(self, rows: list[tuple[int | None, list[str | None]]]):
        self.ids = [r[0] for r in rows]
        own = [sorted({t for text in r[1] for t in folded((text or "").encode()).split(GUARD) if t}) for r in rows]
        self.terms = sorted({t for ts in own for t in ts})
        place = {t: k for k, t in enumerate(self.terms)}
        term = np.array([place[t] for ts in own for t in ts], np.int64)
        item = np.repeat(np.arange(len(rows)), [len(ts) for ts in own])
        order = np.argsort(term, kind="stable")
        self.item = item[order]
        self.begin = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        self.weight = np.zeros(len(self.terms), np.int64)
        self.documents, self.length = 0, 0

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "automaton"}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Built once in a worker; its outputs are the places of the terms."""
        found = ahocorasick.Automaton()
        for k, term in enumerate(self.terms):
            found.add_word(GUARD + term + GUARD, k)
        found.make_automaton()
        return found

    def occurrences(self, text: bytes) -> Counter[int]:
        """How often each item term occurs in a text."""
        return Counter(map(itemgetter(1), self.automaton.iter(folded(text)))) if self.terms else Counter()

    def weigh(self, documents: int, length: int, holding: dict[int, int]) -> None:
        """Set what the scores need of the corpus: documents with terms, their terms, documents that hold each item term."""
        self.documents, self.length = documents, length
        for k in range(len(self.terms)):
            self.weight[k] = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(k, 0) + 1)))

    def scores(self, counts: list[Counter[int]], lengths: list[int]) -> np.ndarray:
        """Scores of documents (rows) for all items (columns)."""
        sizes = [len(c) for c in counts]
        term = np.fromiter((t for c in counts for t in c), np.int64, sum(sizes))
        tf = np.fromiter((n for c in counts for n in c.values()), np.int64, sum(sizes))
        m = np.array([100 - 90 + (90 * n * self.documents) // max(1, self.length) for n in lengths], np.int64)
        doc = np.repeat(np.arange(len(counts)), sizes)
        part = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        out = np.zeros(len(counts) * len(self.ids), np.int64)
        ends = np.cumsum(self.begin[term + 1] - self.begin[term])
        at = 0
        while at < len(term):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + POSTINGS, "right")))
            first, n = self.begin[term[at:to]], self.begin[term[at:to] + 1] - self.begin[term[at:to]]
            posting = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            np.add.at(out, np.repeat(doc[at:to], n) * len(self.ids) + self.item[posting], np.repeat(part[at:to], n))
            at = to
        return out.reshape(len(counts), len(self.ids))


class Best:
    """The best documents of each item that a task has met: by score, then by the smaller doc_id, null last."""

    def __init__(self, items: int, n: int):
        self.n, self.least = n, np.ones(items, np.int64)
        self.item = self.score = self.doc = np.empty(0, np.int64)
        self.missing = np.empty(0, bool)

    def add(self, scores: np.ndarray, docs: np.ndarray, missing: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[row, item]])
        doc, missing = np.concatenate([self.doc, docs[row]]), np.concatenate([self.missing, missing[row]])
        order = np.lexsort((doc, missing, -score, item))
        ranked = item[order]
        rank = np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
        order, rank = order[rank < self.n], rank[rank < self.n]
        self.item, self.score, self.doc, self.missing = item[order], score[order], doc[order], missing[order]
        full = rank == self.n - 1
        self.least[self.item[full]] = self.score[full]


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of each item with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Every
    row of ``docs`` is a document of its own, also one that repeats another or has no doc_id
    (ranked after others of the same score); a null or empty text has no terms. Rows of
    ``items`` with the same item_id, null included, are one item with the terms of all of
    them; an item without terms has no rows. A very long text is scanned in one go: its
    copy for the automaton is what it takes.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).filter("text is not null")
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-size // CHUNK_BYTES))
    found = None
    for k in range(chunks):
        own = tests.filter(F.pmod(F.xxhash64("item_id"), F.lit(chunks)) == k).groupBy("item_id").agg(F.collect_list("text").alias("texts"))
        part = _ranked(texts, Items([tuple(r) for r in own.collect()]), best)
        found = part if found is None else found.unionByName(part)
    return found


def _ranked(texts: DataFrame, items: Items, best: int) -> DataFrame:
    context = texts.sparkSession.sparkContext
    terms = context.broadcast(items)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, n, length = terms.value, 0, 0
        holding: Counter[int] = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text"):
                    own = n_terms(data := text.as_py())
                    n, length = n + (own > 0), length + own
                    holding.update(items.occurrences(data).keys())
        keys = [-1, -2, *holding]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([n, length, *holding.values()], pa.int64())], ["term", "n"])

    sums = dict(map(tuple, texts.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect()))
    items.weigh(sums.pop(-1, 0), sums.pop(-2, 0), sums)
    weighed = context.broadcast(items)

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = weighed.value
        top, rows = Best(len(items.ids), best), max(1, CELLS // max(1, len(items.ids)))
        for batch in batches if items.terms else ():
            for part in slices(batch, "text"):
                for at in range(0, len(part), rows):
                    data = part.column("text").slice(at, rows).to_pylist()
                    ids = part.column("doc_id").slice(at, rows)
                    lengths = [n_terms(t) for t in data]
                    scores = items.scores([items.occurrences(t) for t in data], lengths)
                    top.add(scores, ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False))
        item = pa.array([items.ids[i] for i in top.item.tolist()], pa.int64())
        doc = pa.array(top.doc, pa.int64(), mask=top.missing)
        yield pa.RecordBatch.from_arrays([item, doc, pa.array(top.score, pa.int64())], ["item_id", "doc_id", "score"])

    met = texts.mapInArrow(score, "item_id long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return met.withColumn("rank", rank).filter(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")


def terms_of(text: str | None) -> list[str]:
    """The terms of a text as the definition says it, for tests."""
    return re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
