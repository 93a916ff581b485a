"""Operator 4: benchmark decontamination by rare n-gram seeds and local alignment.

Words are compared in lower case. Seeds are word trigrams of the test items. Counted over the whole corpus, those
that are far more common than an item's others are dropped as seeds of it. Where a
remaining seed occurs in a text, the passage around it and the item are aligned
word by word (Smith-Waterman: a match 2, a mismatch or a gap -1). The score is the
alignment's part of the item's best possible, so edited and paraphrased copies count by
how much of the item they keep.

Texts are read where they lie and never shuffled. Items are handled in chunks of
bounded size, each broadcast to the tasks; more items make more passes, not larger
broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import lean, slices
from eventmart.llm.shingles import grams, words

SEED_WORDS = 3
#: A seed of an item is common if it occurs in so many times as many texts as the item's median seed, and in more than the least.
COMMON, COMMON_LEAST = 20, 50
#: Part of the best possible score from which a text counts as contaminated; shorter items than SHORT words have to match whole.
THRESHOLD, SHORT = 0.5, 8
MATCH, OTHER = 2, -1
#: Bytes of benchmark text of a chunk.
CHUNK_BYTES = 16 << 20
#: Cells of alignment matrices handled at a time.
CELLS = 400_000
FILTER_BITS = 22


def _hashed(text: str | None) -> np.ndarray:
    """Hashes of the words of a text in lower case, of any alphabet."""
    return words((text or "").lower().encode())[2]


class Items:
    """Test items of one chunk: their words, and the postings of their seeds."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        self.ids = [r[0] for r in rows]
        self.words = [_hashed(r[1]) for r in rows]
        found = [grams(w, SEED_WORDS) for w in self.words]
        self.item = np.repeat(np.arange(len(rows)), [len(g) for g in found])
        self.at = np.concatenate([np.arange(len(g)) for g in found]) if rows else np.empty(0, int)
        self.seeds, self.seed = np.unique(np.concatenate(found) if rows else np.empty(0, np.uint64), return_inverse=True)
        self._index()

    def _index(self) -> None:
        order = np.argsort(self.seed, kind="stable")
        self.item, self.at, self.seed = self.item[order], self.at[order], self.seed[order]
        self.begin = np.searchsorted(self.seed, np.arange(len(self.seeds) + 1))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        live = np.diff(self.begin) > 0
        self.filter[(self.seeds[live] >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def keep_rare(self, texts: np.ndarray) -> None:
        """Drop postings of common seeds; ``texts`` counts the texts of each seed."""
        n = texts[self.seed]
        usual = np.ones(len(self.ids))
        order = np.lexsort((n, self.item))
        heads = np.searchsorted(self.item[order], np.arange(len(self.ids) + 1))
        some = np.diff(heads) > 0
        begin, end = heads[:-1][some], heads[1:][some]
        ranked = n[order]
        usual[some] = np.maximum(1, (ranked[(begin + end - 1) // 2] + ranked[(begin + end) // 2]) / 2)
        rare = n <= np.maximum(COMMON_LEAST, COMMON * usual[self.item])
        self.item, self.at, self.seed = self.item[rare], self.at[rare], self.seed[rare]
        self._index()

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of seeds in a text, and which seeds they are."""
        found = grams(hashes, SEED_WORDS)
        at = np.flatnonzero(self.filter[(found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        seed = np.searchsorted(self.seeds, found[at])
        good = (seed < len(self.seeds)) & (self.seeds[np.minimum(seed, len(self.seeds) - 1)] == found[at])
        return at[good], seed[good]

    def windows(self, hashes: np.ndarray, threshold: float = THRESHOLD) -> Iterator[tuple[int, int, int, int]]:
        """(item, begin, end, seeds) of the passages to align: they hold every alignment through a seed that can reach the threshold."""
        at, seed = self.hits(hashes)
        n = self.begin[seed + 1] - self.begin[seed]
        if not n.sum():
            return
        place = np.repeat(at, n)
        posting = np.repeat(self.begin[seed] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        item = self.item[posting]
        # where the item would begin in the text; passages that overlap make one window
        zero = place - self.at[posting]
        order = np.lexsort((zero, item))
        item, zero = item[order], zero[order]
        size = np.array([len(self.words[i]) for i in item])
        # more inserted words cost more than the threshold leaves of a whole item
        slack = np.maximum(4, np.floor(MATCH * size * (1 - threshold) / -OTHER).astype(int))
        new = np.diff(item, prepend=-1) != 0
        new |= np.diff(zero, prepend=0) > size + 2 * slack
        heads = np.flatnonzero(new)
        for a, b in zip(heads, [*heads[1:], len(item)], strict=True):
            begin, end = max(0, zero[a] - slack[a]), min(len(hashes), zero[b - 1] + size[a] + slack[a])
            yield int(item[a]), int(begin), int(end), int(b - a)


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each pair of word sequences, and where in the text it ends (exclusive).

    All pairs at once, row by row of the items; gaps along a row are a running maximum.
    """
    rows, width = max(map(len, items)), max(map(len, texts))
    left = np.zeros((len(items), rows), np.uint64)
    right = np.zeros((len(items), width), np.uint64)
    for k, (a, b) in enumerate(zip(items, texts, strict=True)):
        left[k, : len(a)], right[k, : len(b)] = a, b
    inside = np.arange(width)[None, :] < np.array([len(b) for b in texts])[:, None]
    slope = -OTHER * np.arange(width, dtype=np.int32)
    last = np.zeros((len(items), width + 1), np.int32)
    best, end = np.zeros(len(items), np.int32), np.zeros(len(items), np.int64)
    for i in range(rows):
        same = (left[:, i : i + 1] == right) & inside & (i < np.array([len(a) for a in items]))[:, None]
        h = np.maximum(last[:, :-1] + np.where(same, MATCH, OTHER), last[:, 1:] + OTHER)
        np.maximum(h, 0, out=h)
        h = np.maximum.accumulate(h + slope, axis=1) - slope
        last[:, 1:] = h
        top = h.max(axis=1)
        better = top > best
        end[better] = h[better].argmax(axis=1) + 1
        best = np.maximum(best, top)
    return best, end


def _aligned(items: Items, texts: list[np.ndarray], pairs: list[tuple], threshold: float) -> list[tuple]:
    """(text, item, score, begin, end, seeds) of the passages that reach the threshold, the best of each text and item."""
    best: dict[tuple[int, int], tuple] = {}
    pairs.sort(key=lambda p: (len(items.words[p[1]]), p[3] - p[2]))
    begin = 0
    while begin < len(pairs):
        own = items.words[pairs[begin][1]], pairs[begin][3] - pairs[begin][2]
        n = max(1, CELLS // max(1, own[1]))
        some = pairs[begin : begin + n]
        # an item or a passage much longer than the first of these waits for its own batch
        some = list(takewhile(lambda p: len(items.words[p[1]]) <= 2 * len(own[0]) + 8 and p[3] - p[2] <= 2 * own[1] + 8, some))
        begin += len(some)
        left = [items.words[p[1]] for p in some]
        right = [texts[p[0]][p[2] : p[3]] for p in some]
        scores, ends = align(left, right)
        full = np.array([MATCH * len(a) for a in left])
        part = scores / full
        need = np.where(full < MATCH * SHORT, 1.0, threshold)
        good = np.flatnonzero(part >= need)
        if len(good):
            # backwards, the alignment that ends first tells where it begins
            _, back = align([left[k][::-1] for k in good], [right[k][: ends[k]][::-1] for k in good])
            for k, size in zip(good, back, strict=True):
                text, item, at, _, seeds = some[k]
                row = (text, item, float(part[k]), int(at + ends[k] - size), int(at + ends[k]), seeds)
                if (text, item) not in best or (-row[2], row[3]) < (-best[text, item][2], best[text, item][3]):
                    best[text, item] = row
    return list(best.values())


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, item_id, score, start_word, end_word, n_seeds) of every text and item it holds a copy of.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored.
    ``score`` is 0 to 1; the words are the passage, end exclusive; ``text_hash`` is Spark's
    xxhash64 of the text. A repeated row is reported as often as it occurs. Null and empty
    texts and items match nothing, and so do items of fewer than three words.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").filter("text is not null")
    tests = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-size // CHUNK_BYTES))
    found = None
    for k in range(chunks):
        own = tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == k)
        items = Items(sorted((tuple(r) for r in own.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")))
        part = _search(spark, texts, items, threshold)
        found = part if found is None else found.unionByName(part)
    return found


def _search(spark, texts: DataFrame, items: Items, threshold: float) -> DataFrame:
    all_seeds = spark.sparkContext.broadcast(items)

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = all_seeds.value
        n = np.zeros(len(items.seeds), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    n[np.unique(items.hits(_hashed(text))[1])] += 1
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n[found])], ["seed", "n"])

    n = np.zeros(len(items.seeds), np.int64)
    if len(n):
        sums = texts.select("text").mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toPandas()
        n[sums["seed"].to_numpy(int)] = sums["n"].to_numpy(int)
    items.keep_rare(n)
    rare = spark.sparkContext.broadcast(items)

    @lean
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = rare.value
        for batch in batches:
            for part in slices(batch, "text"):
                hashes = [_hashed(t) for t in part.column("text").to_pylist()] if len(items.seeds) else []
                pairs = [(k, *w) for k, h in enumerate(hashes) for w in items.windows(h, threshold)]
                rows = _aligned(items, hashes, pairs, threshold)
                ids, prints = (part.column(c).to_pylist() for c in ("doc_id", "text_hash"))
                columns = [[ids[r[0]] for r in rows], [prints[r[0]] for r in rows], [items.ids[r[1]] for r in rows], *([r[i] for r in rows] for i in range(2, 6))]
                kinds = [pa.int64()] * 3 + [pa.float64()] + [pa.int64()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "text_hash", "item_id", "score", "start_word", "end_word", "n_seeds"])

    schema = "doc_id long, text_hash long, item_id long, score double, start_word long, end_word long, n_seeds long"
    return texts.mapInArrow(search, schema)
