from __future__ import annotations

from collections import Counter

import pytest
from llm_rows import documents, odd_rows, words_of  # noqa: F401
from pyspark.sql import functions as F

from eventmart.llm import mixing
from eventmart.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def plain_targets(sizes: dict) -> dict:
    names = sorted((x for x in sizes if x is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {x: (5, 2, 1)[i % 3] for i, x in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[x] for x in capped)
        weights = sum(weight[x] for x in names if x not in capped)
        target = {x: 2 * sizes[x] if x in capped else left * weight[x] / weights for x in names}
        over = {x for x in names if target[x] > 2 * sizes[x] + 1e-9}
        if not over:
            return target
        capped |= over


def check(df, rows, tolerance):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    want, got = plain_targets(sizes), df.collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= tolerance
    return got


def test_the_table(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    first = check(mixing.mixed_words(docs), rows, mixing.BLOCK_WORDS)
    again = mixing.mixed_words(docs.repartition(7)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_small_blocks_come_nearer(documents):
    rows = [(i, "word " * (i % 40 + 1), None, f"s{i % 7}") for i in range(200)]
    check(mixing.mixed_words(documents(rows), block=8), rows, 8)


def test_every_block_once_a_pass(spark):
    """Slots of a source take each block as often as every other, but for the last pass."""
    rows = [("a", 1000, 1500.0), ("b", 7, 14.0), (None, 3, 4.0), ("none", 0, 0.0)]
    slots = mixing.draw(spark.createDataFrame(rows, "source string, source_size long, target double"), block=10, shard=20).collect()
    by_source = {s: Counter(r.block for r in slots if r.source == s) for s in ("a", "b", None)}
    assert set(by_source["a"]) == set(range(100)) and sorted(by_source["a"].values()) == [1] * 50 + [2] * 50
    assert by_source["b"] == {0: 2} and by_source[None] == {0: 1}
    shards = Counter(r.shard for r in slots)
    assert len(shards) == 8 and max(shards.values()) < 45
    assert len({r.slot for r in slots}) == len(slots)


def test_odd_rows(documents, odd_rows):
    check(mixing.mixed_words(documents(odd_rows), block=4), odd_rows, 60_000)
    assert mixing.mixed_words(documents([])).count() == 0
    assert [r.taken for r in mixing.mixed_words(documents([(1, None), (2, "")])).collect()] == [0, 0]


def test_documents_are_repeated_as_often_as_taken(documents):
    rows = [(i, f"{i} " + "word " * (i % 50 + 10), "en", f"s{i % 4}") for i in range(300)]
    docs = documents(rows)
    words = {r.doc_id: r for r in mixing.mixed_words(docs, block=8).collect()}
    out = mixing.mixed_documents(docs, block=8)
    assert out.columns == docs.columns
    times = Counter(r.doc_id for r in out.select("doc_id").collect())
    for d, r in words.items():
        assert abs(times[d] - r.taken / r.size) < 1
    assert out.select("doc_id", "text").distinct().count() == len(times)
    odd = mixing.mixed_documents(documents([(1, "a b c", "en", "x"), (1, "a b c", "en", "x"), (None, "a b c", None, None)]))
    assert odd.filter(F.col("text") != "a b c").count() == 0


def test_small_sources_come_near_their_targets(documents):
    """To 1% or five words, whatever the size of the source."""
    rows = [(i, "w " * n, None, s) for i, (s, n) in enumerate([("a", 10), ("a", 10), ("a", 10), ("b", 10), ("c", 30), ("d", 1), ("e", 900), ("e", 37), ("f", 40_000), (None, 250), (None, 7)])]
    taken, target, size = Counter(), {}, Counter()
    for r in mixing.mixed_words(documents(rows)).collect():
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
        assert r.taken <= 2 * r.size
    assert len(target) == 7
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(5, 0.01 * t), (s, taken[s], t, size[s])
