"""Operator 6: n-gram Jaccard join with prefix trees.

Every text is a set of word shingles. All sets are put into one global order, rare
shingles first. Two sets of Jaccard similarity t or more share at least k shingles among the first
``n - ceil(t * n) + k`` of each, so only those prefixes are shuffled. A k of a few rules
out texts that share a phrase by chance. What prefixes share gathers texts into
coarse groups; the ordered sets of a group are stored in a
prefix tree, and each set walks the tree, adding up the overlap once for all sets
that share a path, and leaving subtrees whose remaining lengths can't reach the
threshold. Links that a walk finds are exact.

Any total order gives the right result; rarity only keeps candidates few. It comes
from a sketch: 2 ** SKETCH_BITS counters of hashed shingles over all texts, merged by a
shuffle and kept as one byte each (4 MB, whatever the size of the corpus). Coarse groups
that come out larger than a block are grouped anew, in an order by a sketch of
their own texts, which tells passages that many of them share from shingles that are rare.

The result is the connected components of the links. A pair whose sets are already
connected needs no check, which is what makes large groups of copies cheap: equal
sets are represented by one text, and a group of more than ``BLOCK`` texts is
split into blocks. Each block is joined with itself and with the pivot block; then
every text outside the largest component found so far is compared with every
block. No pair is left unchecked but those already connected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import lean, slices, small, staged
from eventmart.llm.components import components
from eventmart.llm.shingles import shingle_set

WORDS = 5
PERCENT = 80
SKETCH_BITS = 22
CHUNK_BITS = 16
#: Shingles that prefixes have to share: one for so many of the set's, up to the most.
ONE_OF, MOST_SHARED = 12, 12
#: Texts with a shingle in common are counted in pairs up to so many; more are joined to the first of them.
PAIRED = 16
#: Wide groups are grouped anew while that leaves fewer texts in wide groups than this share.
SHRINKS = 0.7
#: Texts of a block. A join in one task sees two blocks at most.
BLOCK = 96


def sets_of(batch: pa.RecordBatch, words: int) -> Iterator[tuple[dict, list[np.ndarray]]]:
    for part in slices(batch, "text"):
        rows = {c: part.column(c).to_pylist() for c in part.schema.names if c != "text"}
        yield rows, [shingle_set(t, words) for t in part.column("text").cast(pa.binary()).to_pylist()]


def shingle_ranks(docs: DataFrame, words: int) -> np.ndarray:
    """One byte per counter: how common the shingles hashed there are, on a scale of eighths of log2."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(1 << SKETCH_BITS, np.uint32), [], 0
        for batch in batches:
            for _, sets in sets_of(batch, words):
                held += [s >> np.uint64(64 - SKETCH_BITS) for s in sets]
                size += sum(map(len, sets))
                if size > 2_000_000:
                    total += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(total)).astype(np.uint32)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(total)).astype(np.uint32)
        for k, part in enumerate(total.reshape(-1, 1 << CHUNK_BITS)):
            if part.any():
                kind = "<u2" if part.max() < 1 << 16 else "<u4"
                yield pa.RecordBatch.from_pylist([{"chunk": k, "kind": kind, "counts": part.astype(kind).tobytes()}])

    @lean
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                part = sums.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.int64))
                part += np.frombuffer(data, kind)
        for chunk, part in sums.items():
            rank = np.minimum(255, 8 * np.log2(1.0 + part)).astype(np.uint8)
            yield pa.RecordBatch.from_pylist([{"chunk": chunk, "ranks": rank.tobytes()}])

    parts = docs.select("text").mapInArrow(count, "chunk long, kind string, counts binary").repartition(1 << (SKETCH_BITS - CHUNK_BITS), "chunk")
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in parts.mapInArrow(merge, "chunk long, ranks binary").collect():
        out[r.chunk << CHUNK_BITS : (r.chunk + 1) << CHUNK_BITS] = np.frombuffer(r.ranks, np.uint8)
    return out


def ordered(shingles: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The set in the global order: a byte of rank, then 56 bits of the hash."""
    rank = ranks[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    return np.sort((rank << np.uint64(56)) | (shingles >> np.uint64(8)))


class Group:
    """Ordered sets of one group in a path-compressed prefix tree."""

    def __init__(self, sets: list[np.ndarray], names: list[int], percent: int):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.order, self.sets, self.percent = order, [sets[i] for i in order], percent
        self.up = {n: n for n in names}
        self.names = [names[i] for i in order]
        self.root = self._build()

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def _shared(self, i: int) -> int:
        a, b = self.sets[i], self.sets[i + 1]
        n = min(len(a), len(b))
        different = np.flatnonzero(a[:n] != b[:n])
        return int(different[0]) if len(different) else n

    def _build(self) -> tuple:
        """Nodes are (lo, hi, begin, end, shortest, longest, children): keys begin..end of sets lo..hi are the same."""
        shared = [self._shared(i) for i in range(len(self.sets) - 1)]
        sizes = [len(s) for s in self.sets]

        def node(lo: int, hi: int, begin: int) -> tuple:
            end = sizes[lo] if hi - lo == 1 else min(shared[lo : hi - 1])
            return (lo, hi, begin, end, min(sizes[lo:hi]), max(sizes[lo:hi]), [])

        root = (0, len(sizes), 0, 0, min(sizes), max(sizes), [])
        todo = [root]
        while todo:
            lo, hi, _, end, *_, children = todo.pop()
            if hi - lo == 1 and sizes[lo] == end:
                continue
            cuts = [lo, *(i + 1 for i in range(lo, hi - 1) if shared[i] == end), hi]
            if len(cuts) == 2 and hi - lo > 1 and end == sizes[lo]:
                continue
            for a, b in zip(cuts, cuts[1:], strict=False):
                if sizes[a] == end and b - a == 1:
                    children.append((a, b, end, end, end, end, []))
                else:
                    children.append(child := node(a, b, end))
                    todo.append(child)
        return root

    def partners(self, q: int, after: int, allowed) -> Iterator[int]:
        """Sets from position ``after`` on that link with set ``q`` and aren't known to be connected with it."""
        own, percent = self.sets[q], self.percent
        n, todo = len(own), [(self.root, 0)]
        while todo:
            (lo, hi, begin, end, shortest, longest, children), overlap = todo.pop()
            if hi <= after or 100 * min(n, longest) < percent * max(n, shortest):
                continue
            if hi - lo == 1 and (not allowed(lo) or self.find(self.names[lo]) == self.find(self.names[q])):
                continue
            keys, alive = self.sets[lo], True
            step = max(16, n // 5)
            while begin < end and alive:
                to = min(end, begin + step)
                at = np.searchsorted(own, keys[begin:to])
                overlap += int((own[np.minimum(at, n - 1)] == keys[begin:to]).sum())
                begin, step = to, 2 * step
                rest = n - int(np.searchsorted(own, keys[to - 1], "right"))
                best = min(max(to + rest, shortest), longest)
                alive = (100 + percent) * (overlap + min(best - to, rest)) >= percent * (n + best)
            if not alive:
                continue
            if not children:
                for i in range(max(lo, after), hi):
                    if i != q and allowed(i) and (100 + percent) * overlap >= percent * (n + len(self.sets[i])) and self.find(self.names[i]) != self.find(self.names[q]):
                        yield i
            todo += [(c, overlap) for c in children]

    def links(self, roles: list[int], known: list[int]) -> list[tuple[int, int]]:
        """Links that join components. Roles: 0 any; 1 a pivot, not compared with pivots; 2 a probe, compared with all but probes.

        With probes in the group, only they walk the tree. ``known`` names the component of each set so far.
        """
        roles, known = [roles[i] for i in self.order], [known[i] for i in self.order]
        first: dict[int, int] = {}
        for name, component in zip(self.names, known, strict=True):
            self.up[self.find(name)] = self.find(first.setdefault(component, name))
        probing, out = 2 in roles, []
        for q, role in enumerate(roles):
            if probing and role != 2:
                continue
            # what isn't a probe has to meet only what stands after it
            for i in self.partners(q, 0 if probing else q + 1, lambda i: not role or roles[i] != role):
                out.append((self.names[q], self.names[i]))
                self.up[self.find(self.names[q])] = self.find(self.names[i])
        return out


@lean
def _join_groups(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a group is held whole, and is two blocks at most."""

    def closed(rows: list[tuple]) -> pa.RecordBatch:
        sets = [np.frombuffer(r[6], "<u8") for r in rows]
        found = Group(sets, [r[3] for r in rows], percent).links([r[4] for r in rows], [r[5] for r in rows])
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:3] != row[:3]:
                yield closed(held)
                held = []
            held.append(row)
    if held:
        yield closed(held)


def _linked(docs: DataFrame, tasks: DataFrame, ranks, words: int, percent: int) -> DataFrame:
    """Links within groups; ``tasks`` are (doc_id, known, g, x, y, role): the groups (g, x, y) a text goes to."""

    @lean
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets in sets_of(batch, words):
                data = [ordered(s, ranks.value).astype("<u8").tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], pa.int64()), pa.array(data, pa.binary())], ["doc_id", "keys"])

    tasks = staged(tasks, "tasks")
    rows = docs.join(small(staged(tasks.select("doc_id").distinct(), "asked")), "doc_id", "left_semi")
    sets = rows.mapInArrow(keys, "doc_id long, keys binary").filter("length(keys) > 0")
    sets = sets.join(small(tasks), "doc_id").select("g", "x", "y", "doc_id", "role", "known", "keys")
    sets = sets.repartition("g", "x", "y").sortWithinPartitions("g", "x", "y")
    return staged(sets.mapInArrow(lambda b: _join_groups(b, percent), "a long, b long"), "links")


def _needed(n: int) -> int:
    """How many shingles of its prefix a set of n has to share with one that links and asks for no fewer."""
    return max(1, min(MOST_SHARED, n // ONE_OF))


def _prefix(keys: np.ndarray, percent: int) -> np.ndarray:
    """The first keys: with any set that links, as many are shared as the less demanding of both needs."""
    n = len(keys)
    return keys[: n - (percent * n + 99) // 100 + _needed(n)].astype(np.int64)


def _lists(keys: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))


@lean
def _prefixes(batches: Iterator[pa.RecordBatch], ranks, words: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, sets in sets_of(batch, words):
            firsts = _lists([_prefix(ordered(s, ranks.value), percent) for s in sets])
            needs = pa.array([_needed(len(s)) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(v, pa.int64()) for v in rows.values()), needs, firsts], [*rows, "need", "prefix"])


def _edges(a: np.ndarray, b: np.ndarray, need: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(need)], ["a", "b", "need"])


def _star(first: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    n = rows.shape[1]
    return _edges(np.full(n, first[2]), rows[2], np.zeros(n, np.int64))


def _paired(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Edges within whole runs of rows with the same (g, key)."""
    if not rows.shape[1]:
        return
    new = np.append(True, (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1]))
    run = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    long = np.bincount(run)[run] > PAIRED
    at = np.flatnonzero(long & ~new)
    yield _edges(rows[2, heads[run[at]]], rows[2, at], np.zeros(len(at), np.int64))
    for d in range(1, PAIRED):
        i = np.flatnonzero((run[d:] == run[:-d]) & ~long[d:]) if len(run) > d else []
        if not len(i):
            return
        yield _edges(rows[2, i], rows[2, i + d], np.minimum(rows[3, i], rows[3, i + d]))


@lean
def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, need) of texts with the same key, from rows (g, key, doc_id, need) in order of (g, key).

    A run of up to PAIRED texts makes pairs, to be counted over all keys. In a longer run
    every text goes with the first one, and that alone makes them candidates (need 0).
    No more of an unfinished run is held than that first row.
    """
    first, held = None, np.empty((4, 0), np.int64)
    for batch in batches:
        rows = np.array([c.to_numpy() for c in batch.columns]).reshape(4, -1)
        if first is not None:
            other = np.flatnonzero((rows[:2] != first[:2, None]).any(axis=0))
            n = int(other[0]) if len(other) else rows.shape[1]
            yield _star(first, rows[:, :n])
            rows, first = rows[:, n:], first if n == rows.shape[1] else None
        rows = np.concatenate([held, rows], axis=1)
        if not rows.shape[1]:
            continue
        other = np.flatnonzero((rows[:2] != rows[:2, -1:]).any(axis=0))
        begin = int(other[-1]) + 1 if len(other) else 0
        held = rows[:, begin:]
        if held.shape[1] > PAIRED:
            first = held[:, 0]
            yield _star(first, held[:, 1:])
            held = held[:, :0]
        yield from _paired(rows[:, :begin])
    yield from _paired(held)


def _grouped(prefixes: DataFrame, block: int) -> DataFrame:
    """(doc_id, g, blocks): coarse groups of texts whose prefixes share enough, within the groups given; ``prefixes`` is (doc_id, g, need, prefix)."""
    rows = prefixes.select("g", F.explode("prefix").alias("key"), "doc_id", "need")
    rows = rows.repartition("g", "key").sortWithinPartitions("g", "key")
    pairs = rows.mapInArrow(_candidates, "a long, b long, need long").filter("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "need")
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("need").alias("need")).filter("n >= need")
    found = components(pairs.select("a", "b")).select(F.col("node").alias("doc_id"), F.col("component").alias("g"))
    sizes = staged(found.groupBy("g").agg(F.ceil(F.count("*") / block).alias("blocks")), "sizes")
    return staged(found.join(small(sizes), "g").select("doc_id", "g", "blocks"), "near")


def _tasks(rows: DataFrame, groups) -> DataFrame:
    return rows.select("doc_id", "known", F.explode(groups).alias("t")).select("doc_id", "known", "t.*")


def _group(g, x, y, role):
    return F.struct(g.alias("g"), x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(role).cast("long").alias("role"))


def jaccard_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of ``docs`` (doc_id, text; others are ignored).

    Texts link when 100 * intersection >= percent * union of their shingle sets;
    ``component_id`` is the smallest doc_id reachable by links, itself included. A text of
    fewer words is one shingle; without words, or null, it is empty and links with
    nothing. Rows of the same doc_id are one node. A null doc_id has no component.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranks = spark.sparkContext.broadcast(shingle_ranks(docs, words))

    @lean
    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets in sets_of(batch, words):
                keys = [ordered(s, ranks.value) for s in sets]
                prints = np.array([np.frombuffer(hashlib.blake2b(k.tobytes(), digest_size=16).digest(), "<i8") for k in keys]).reshape(-1, 2)
                sizes = [len(k) for k in keys]
                columns = [pa.array(rows["doc_id"], pa.int64()), pa.array(sizes, pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1])]
                needs = pa.array([_needed(n) for n in sizes], pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, needs, _lists([_prefix(k, percent) for k in keys])], ["doc_id", "n_shingles", "f1", "f2", "need", "prefix"])

    sets = staged(docs.mapInArrow(described, "doc_id long, n_shingles long, f1 long, f2 long, need long, prefix array<long>"), "sets")
    filled = sets.filter("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "f1", "f2"]
    firsts = staged(filled.groupBy(*same).agg(F.min("doc_id").alias("doc_id")), "firsts")
    n_firsts = firsts.count()

    prefixes = filled.join(small(firsts, n_firsts), [*same, "doc_id"], "left_semi")
    near = _grouped(prefixes.select("doc_id", F.lit(0).cast("long").alias("g"), "need", "prefix"), block)
    wide = staged(near.filter("blocks > 1").select("doc_id", "g"), "wide")
    n_wide, before = wide.count(), None
    while n_wide and (before is None or n_wide < SHRINKS * before):
        texts = docs.join(small(wide, n_wide), "doc_id").select("doc_id", "g", "text")
        ranks = spark.sparkContext.broadcast(shingle_ranks(texts, words))
        prefixes = texts.mapInArrow(lambda b, r=ranks: _prefixes(b, r, words, percent), "doc_id long, g long, need long, prefix array<long>")
        again = _grouped(prefixes, block)
        near = staged(near.filter("blocks = 1").unionByName(again), "near")
        wide = staged(again.filter("blocks > 1").select("doc_id", "g"), "wide")
        n_wide, before = wide.count(), n_wide

    # coarse groups, in blocks
    blocks = staged(near.withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks")), "blocks")
    g, own, last = F.col("g"), F.col("block"), F.col("blocks") - 1
    none = F.lit(-1)
    home = F.array(_group(g, own, none, 0))
    pivots = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda y: _group(g, y, none, 1))
    groups = F.when((own == 0) & (last > 0), F.concat(home, pivots)).otherwise(home)
    tasks = _tasks(blocks.withColumn("known", F.col("doc_id")), groups)
    links = _linked(docs, tasks, ranks, words, percent)

    # texts outside the largest component of a split group meet every block of it
    parts = staged(components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("known")), "parts")
    parted = blocks.filter("blocks > 1").join(small(parts), "doc_id", "left").withColumn("known", F.coalesce("known", "doc_id"))
    parted = staged(parted, "parted")
    counts = parted.groupBy("g", "known").agg(F.count("*").alias("n"))
    largest = counts.groupBy("g").agg(F.max_by("known", F.struct("n", "known")).alias("largest"), F.sum("n").alias("all"), F.max("n").alias("most"))
    largest = largest.withColumn("sides", F.ceil((F.col("all") - F.col("most")) / block)).filter("sides > 0")
    rest = staged(parted.join(small(staged(largest, "largest")), "g"), "rest")
    if not rest.isEmpty():
        outside = F.col("known") != F.col("largest")
        side = F.pmod(F.xxhash64("doc_id", F.lit(1)), "sides")
        probes = F.transform(F.sequence(F.lit(0), last), lambda y: _group(g, y, side, 2))
        others = F.transform(F.sequence(F.lit(0), F.col("sides") - 1), lambda y: _group(g, own, y, 0))
        # a probe is a partner too, for probes of other sides and of its own
        tasks = _tasks(rest, F.when(outside, F.concat(probes, others)).otherwise(others))
        links = links.unionByName(_linked(docs, tasks, ranks, words, percent))

    copies = filled.join(small(firsts.withColumnRenamed("doc_id", "first"), n_firsts), same).filter("doc_id <> first")
    found = staged(components(links.unionByName(copies.select(F.col("doc_id").alias("a"), F.col("first").alias("b")))), "found")
    found = found.select(F.col("node").alias("doc_id"), "component")
    out = sets.select("doc_id", "n_shingles").join(small(found), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
