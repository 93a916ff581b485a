from __future__ import annotations

import random

import numpy as np
import pytest
from llm_rows import documents, odd_rows, words_of  # noqa: F401

from eventmart.llm import jaccard, shingles
from eventmart.llm.components import components


def sets_of(rows):
    out = []
    for doc_id, text, *_ in rows:
        w = words_of(text)
        out.append((doc_id, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    return out


def expected(rows, percent=80):
    sets = sets_of(rows)
    up = {d: d for d, _ in sets if d is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return sorted(((d if d is not None else -1), len(s), find(d) if d is not None else -1) for d, s in sets)


def got(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in df.collect())


def near_copies(seed: int, n: int = 90) -> list[tuple]:
    """Texts with copies of various closeness, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in "aeiou"]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows: list[tuple] = []
    while len(rows) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 60, 150]))]
        if rng.random() < 0.5:
            base[5:5] = passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3 % 271, " ".join(w)))
    return rows


@pytest.mark.parametrize(("seed", "block"), [(1, jaccard.BLOCK), (2, 3)])
def test_classes_equal_brute_force(documents, seed, block):
    """Tiny blocks take every text through the pivots and the probes."""
    rows = near_copies(seed)
    assert got(jaccard.jaccard_classes(documents(rows), block=block)) == expected(rows)


def test_odd_rows(documents, odd_rows):
    assert got(jaccard.jaccard_classes(documents(odd_rows))) == expected(odd_rows)
    assert jaccard.jaccard_classes(documents([])).count() == 0
    assert got(jaccard.jaccard_classes(documents([(1, None), (2, "")]))) == [(1, 0, 1), (2, 0, 2)]


def test_threshold_is_exact(documents):
    """9 of 11 shingles link at 80 percent of the union, 8 of 10 too, 7 of 9 don't."""
    w = [f"v{i}" for i in range(40)]
    rows = [(1, " ".join(w[:14])), (2, " ".join([*w[:13], "x"])), (3, " ".join([*w[20:33], "y"])), (4, " ".join([*w[20:32], "y", "z"]))]
    assert got(jaccard.jaccard_classes(documents(rows))) == expected(rows)


@pytest.mark.parametrize("seed", range(5))
def test_tree_walk_equals_all_pairs(seed):
    rng = np.random.default_rng(seed)
    base = [np.unique(rng.integers(1, 5_000, 40)) for _ in range(4)]
    sets = []
    for _ in range(40):
        s = base[rng.integers(4)]
        s = s[rng.random(len(s)) > rng.choice([0, 0.05, 0.1])]
        sets.append(np.unique(np.append(s, rng.integers(1, 5_000, rng.integers(0, 4)))).astype(np.uint64))
    names = list(range(40))
    up = {n: n for n in names}

    def find(up, x):
        while up[x] != x:
            x = up[x]
        return x

    for i in names:
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                up[find(up, i)] = find(up, j)
    other = {n: n for n in names}
    for a, b in jaccard.Group(sets, names, 80).links([0] * 40, names):
        n = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)
        other[find(other, a)] = find(other, b)
    assert all((find(up, i) == find(up, j)) == (find(other, i) == find(other, j)) for i in names for j in names)


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 9), (9, 8), (8, 7), (7, 6), (3, 3), (None, 4), (5, 50), (50, 5), (1, 2)]
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6, 8: 6, 9: 6, 10: 6, 5: 5, 50: 5}
    chain = spark.createDataFrame([(i * 7 % 101, (i + 1) * 7 % 101) for i in range(100)], "a long, b long")
    assert {r.component for r in components(chain).collect()} == {0}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_longer_than_a_chunk():
    text = ("x" * (shingles.CHUNK * 2 + 5) + " yy " + "ab " * 600_000).encode()
    starts, ends, hashes = shingles.words(text)
    assert len(starts) == 600_002 and len(np.unique(hashes)) == 3
    assert (shingles.words(b"AB cd")[2] == shingles.words(b" ab\x0bCD ")[2]).all()
