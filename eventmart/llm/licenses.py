"""Operator 12: license scan as an exact set-similarity join of text blocks and templates.

Blocks of a text are windows of its words: for templates of up to w words (w a power of
two) windows of 2 w words that begin every w words, so any w words in a row lie whole in a
block. A block and a template are sets of words, and a block matches if it holds
``threshold`` of the template's words. Words of templates are ordered by their frequency
in the whole corpus. A block has to hold one of the template's rarest words (its prefix:
as many as the threshold allows to be missing, and one more), to be large enough (length
filter), and to have enough words left after a shared one in both orders (positional
filter); what remains is counted. So each match is found, and no other.

A phrase is a template that has to be there whole: where the block join meets its rarest
word, all of its words are compared in order.

Texts are read where they lie, twice, and never shuffled; templates are broadcast, of a
size that is checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import lean, slices
from eventmart.llm.license_texts import PHRASES, TEMPLATES

#: Part of a template's distinct words that a block has to hold, in percent.
PERCENT = 80
#: Bytes of templates and phrases that are broadcast, at most.
TEMPLATE_BYTES = 32 << 20
#: Bytes of a text split into words at a time.
PART_BYTES = 4 << 20
#: What each byte of a text becomes: a word's byte in lower case, or a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
MATCHES = "array<struct<label: string, kind: string, first: long, last: long, score: double>>"


def words(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


@dataclass
class Template:
    """Distinct words as ranks by frequency, the rarest first; ``order`` keeps a phrase's words as they stand."""

    label: str
    width: int
    need: int
    ranks: np.ndarray
    order: np.ndarray

    @property
    def prefix(self) -> np.ndarray:
        return self.ranks[: len(self.ranks) - self.need + 1]


def width_of(n: int) -> int:
    """The power of two from which on a template of ``n`` words fits."""
    return 1 << max(0, n - 1).bit_length()


def blocks_of(n: int, width: int) -> int:
    """Number of blocks of a text of ``n`` words: one begins every ``width`` words, while there are words beyond those of the last one."""
    return max(1, -(-n // width) - 1) if n else 0


class Catalogue:
    """Templates and phrases, and their words in the order of the corpus."""

    def __init__(self, templates: list[tuple[str, str]], phrases: list[tuple[str, str]], percent: int):
        self.templates, self.phrases, self.percent = templates, phrases, percent
        texts = [t for _, t in [*templates, *phrases]]
        if sum(len(t.encode()) for t in texts) > TEMPLATE_BYTES:
            raise ValueError(f"more than {TEMPLATE_BYTES} bytes of templates: scan with parts of them")
        if not all(map(words, texts)):
            raise ValueError("a template without words matches everything")
        self.rank(dict.fromkeys({w for t in texts for w in words(t)}, 0))

    def rank(self, seen: dict[bytes, int]) -> None:
        """Order the words by how often the corpus has them."""
        self.vocabulary = {w: k for k, w in enumerate(sorted(seen, key=lambda w: (seen[w], w)))}
        self.found: list[Template] = []
        for label, text in self.templates:
            own = np.array([self.vocabulary[w] for w in words(text)], np.int32)
            ranks = np.unique(own)
            self.found.append(Template(label, width_of(len(own)), -(-self.percent * len(ranks) // 100), ranks, own))
        self.exact: list[Template] = []
        for label, text in self.phrases:
            own = np.array([self.vocabulary[w] for w in words(text)], np.int32)
            self.exact.append(Template(label, len(own), len(np.unique(own)), np.unique(own), own))
        # templates (index) by the words of their prefixes
        rows = sorted((int(r), k) for k, t in enumerate(self.found) for r in t.prefix)
        self.by_rank = np.array([k for _, k in rows], np.int64)
        self.begin = np.searchsorted(np.array([r for r, _ in rows], np.int64), np.arange(len(self.vocabulary) + 1))

    def ranks(self, text: bytes) -> np.ndarray:
        """The words of a text as ranks, -1 for words of no template."""
        data, out, at = text.translate(FOLD), [], 0
        while at < len(data):
            to = len(data) if len(data) - at <= PART_BYTES else data.find(b" ", at + PART_BYTES)
            to = len(data) if to < 0 else to
            own = data[at:to].split()
            out.append(np.fromiter(map(self.vocabulary.get, own, repeat(-1)), np.int32, len(own)))
            at = to
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def places(self, ranks: np.ndarray) -> Iterator[tuple[str, str, int, int, float]]:
        """Where the words of a phrase stand in a row."""
        for t in self.exact:
            rarest = int(np.argmin(t.order))
            at = np.flatnonzero(ranks == t.order[rarest]) - rarest
            at = at[(at >= 0) & (at + len(t.order) <= len(ranks))]
            for k, r in enumerate(t.order):
                at = at[ranks[at + k] == r]
            for p in at.tolist():
                yield t.label, "phrase", p, p + len(t.order) - 1, 1.0

    def candidates(self, ranks: np.ndarray) -> np.ndarray:
        """(template, block) pairs in which the block holds a word of the template's prefix, in order."""
        at = np.flatnonzero(ranks >= 0)
        first = self.begin[ranks[at]]
        n = self.begin[ranks[at] + 1] - first
        at, first, n = at[n > 0], first[n > 0], n[n > 0]
        if not len(at):
            return np.empty((0, 2), np.int64)
        found = np.empty((0, 2), np.int64)
        begin, ends = 0, np.cumsum(n)
        while begin < len(at):  # words that many prefixes share come in parts
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + 1_000_000, "right")))
            some = n[begin:end]
            place = np.repeat(at[begin:end], some)
            which = self.by_rank[np.repeat(first[begin:end] - np.concatenate([[0], np.cumsum(some)[:-1]]), some) + np.arange(some.sum())]
            width = np.array([t.width for t in self.found])[which]
            block = place // width
            pairs = np.concatenate([np.stack([which, block], 1), np.stack([which, block - 1], 1)])
            last = np.maximum(1, -(-len(ranks) // width) - 1)
            pairs = pairs[(pairs[:, 1] >= 0) & (pairs[:, 1] < np.concatenate([last, last]))]
            found = np.unique(np.concatenate([found, pairs]), axis=0)
            begin = end
        return found

    def blocks(self, ranks: np.ndarray) -> Iterator[tuple[str, str, int, int, float]]:
        """The blocks that hold enough of a template."""
        sets: dict[tuple[int, int], np.ndarray] = {}
        for k, block in self.candidates(ranks).tolist():
            t = self.found[k]
            begin, end = block * t.width, min(len(ranks), (block + 2) * t.width)
            if (t.width, block) not in sets:
                own = np.unique(ranks[begin:end])
                sets[t.width, block] = own[own >= 0]
            own = sets[t.width, block]
            if len(own) < t.need:
                continue
            i, j = (x.searchsorted(y) for x, y in ((t.ranks, own), (own, t.prefix)))
            shared = np.flatnonzero(own[np.minimum(j, len(own) - 1)] == t.prefix)
            if not len(shared):
                continue
            # the first shared word: no more can be shared than it and what follows in both orders
            p = int(shared[0])
            if 1 + min(len(t.ranks) - p - 1, len(own) - int(j[p]) - 1) < t.need:
                continue
            n = int(np.count_nonzero(t.ranks[np.minimum(i, len(t.ranks) - 1)] == own))
            if n >= t.need:
                yield t.label, "template", begin, end - 1, n / len(t.ranks)


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_words, matches) of every row of ``docs`` (doc_id, text; other columns are ignored).

    ``matches`` holds each place of a phrase (kind 'phrase', score 1) and each block that
    holds ``percent`` of a template's distinct words (kind 'template'; the score is the part
    it holds), with their first and last word, counted from 0, in the order of phrases,
    templates and places. ``templates`` and ``phrases`` are (label, text). A null or empty
    text has no words and no matches; repeated rows have a row each; a null doc_id stays
    null. A long text's words take four bytes each.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent is above 0 and at most 100")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    context = docs.sparkSession.sparkContext
    catalogue = Catalogue(templates, phrases, percent)
    unordered = context.broadcast(catalogue)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        catalogue = unordered.value
        n = np.zeros(len(catalogue.vocabulary) + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text"):
                    n += np.bincount(catalogue.ranks(text.as_py()) + 1, minlength=len(n))
        yield pa.RecordBatch.from_arrays([pa.array(list(catalogue.vocabulary), pa.binary()), pa.array(n[1:])], ["word", "n"])

    sums = texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n")).collect()  # one row per word of a template
    catalogue.rank(dict.fromkeys(catalogue.vocabulary, 0) | {bytes(r[0]): r[1] for r in sums})
    ordered = context.broadcast(catalogue)

    @lean
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        catalogue = ordered.value
        kind = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
        names = [f.name for f in kind.value_type]
        for batch in batches:
            for part in slices(batch, "text"):
                n, found = [], []
                for text in part.column("text"):
                    ranks = catalogue.ranks(text.as_py())
                    n.append(len(ranks))
                    found.append([dict(zip(names, m, strict=True)) for m in (*catalogue.places(ranks), *catalogue.blocks(ranks))])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(found, kind)], ["doc_id", "n_words", "matches"])

    return texts.mapInArrow(match, f"doc_id long, n_words long, matches {MATCHES}")


def digest(scanned: DataFrame) -> DataFrame:
    """One row per row of ``scan``: places of phrases, their labels, all labels, and the best score (0 without matches)."""

    def labels(matches):
        return F.array_join(F.sort_array(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    every = F.col("matches")
    base = F.filter(every, lambda m: m["kind"] == "phrase")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["first"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(every).alias("labels"),
        F.coalesce(F.array_max(F.transform(every, lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )
