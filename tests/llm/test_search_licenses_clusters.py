"""Ranked search, license scan and centroid clustering against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import CLASHES, documents, odd_rows  # noqa: F401  fixtures

from eventmart.llm import centroids, lexical, licenses
from eventmart.llm.license_texts import TEMPLATES


def brute_search(docs: list[tuple], items: list[tuple], best: int = 10) -> list[tuple]:
    counts = [(d, Counter(lexical.terms_of(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    holding = Counter(t for _, c in counts for t in c)
    terms = defaultdict(set)
    for i, text in items:
        terms[i].update(lexical.terms_of(text))
    out = []
    for i, own in terms.items():
        scored = []
        for d, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(i, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:best], 1)]
    return sorted(out, key=str)


def found(df) -> list[tuple]:
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture
def items(spark):
    def make(rows: list[tuple]):
        return spark.createDataFrame([(*r, None) for r in rows], "item_id long, text string, doc_id long")

    return make


def test_search_equals_brute_force(documents, items, odd_rows):
    tests = [(1, "The RIVER and the mill, river"), (2, "éß x"), (3, "1234"), (4, None), (5, ""), (None, "w1x1 villages"), (1, "hills"), (6, "-- !!"), (7, "river riverbank iver")]
    docs = [(r[0], r[1]) for r in odd_rows] + [(20 + i, "mill river " * (i % 3)) for i in range(30)] + [(60, "bankriver riverbanks_river")]
    got = found(lexical.search(documents(docs), items(tests)))
    assert got == brute_search(docs, tests)
    assert {r[0] for r in got} == {1, 2, 3, 7, None}


def test_search_ties_and_random_texts(documents, items):
    rng = random.Random(5)
    words = ["a", "b", "ab", "ba", "aab", "É", "é", "Z", "0", "日本"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "-", "_", ".\n", "\t"]) for _ in range(n))
    docs = [(rng.randrange(40), text(rng.randrange(0, 25))) for _ in range(300)]
    tests = [(i, text(rng.randrange(1, 6))) for i in range(12)]
    assert found(lexical.search(documents(docs).repartition(7), items(tests))) == brute_search(docs, tests)


def test_search_in_chunks_and_small_steps(documents, items, monkeypatch):
    docs = [(i, f"common word{i % 17} word{i % 5}") for i in range(200)]
    tests = [(i, f"common word{i}") for i in range(20)]
    want = brute_search(docs, tests)
    monkeypatch.setattr(lexical, "CHUNK_BYTES", 40)
    assert found(lexical.search(documents(docs, clash=False), items(tests))) == want
    some = lexical.Items(tests_rows := [(i, [t]) for i, t in tests])
    counts = [some.occurrences(t.encode()) for _, t in docs]
    some.weigh(200, 600, Counter(t for c in counts for t in c))
    whole = some.scores(counts, [3] * 200)
    monkeypatch.setattr(lexical, "POSTINGS", 3)
    assert (some.scores(counts, [3] * 200) == whole).all() and len(tests_rows) == whole.shape[1]


def test_search_of_nothing(documents, items):
    assert found(lexical.search(documents([]), items([(1, "a")]))) == []
    assert found(lexical.search(documents([(1, "a")]), items([]))) == []
    assert found(lexical.search(documents([(1, None), (2, "")]), items([(1, "a")]))) == []


def test_terms_are_met_from_guard_to_guard():
    some = lexical.Items([(1, ["he she hers his"]), (2, ["SHE"])])
    assert {some.terms[k]: n for k, n in some.occurrences(b"ushers, she-he's his.hers hers").items()} == {"he": 1, "she": 1, "his": 1, "hers": 2}
    assert lexical.n_terms("a  É,b".encode()) == 3 and lexical.n_terms(b"") == 0


def plain_words(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_scan(text: str | None, templates, phrases, percent: int) -> list[tuple]:
    own, out = plain_words(text), []
    for label, phrase in phrases:
        p = plain_words(phrase)
        out += [(label, "phrase", i, i + len(p) - 1, 1.0) for i in range(len(own) - len(p) + 1) if own[i : i + len(p)] == p]
    for label, template in templates:
        t = plain_words(template)
        width = 1
        while width < len(t):
            width *= 2
        begin = 0
        while begin == 0 or begin + width < len(own):
            block = set(own[begin : begin + 2 * width]) & set(t)
            if own and 100 * len(block) >= percent * len(set(t)):
                out.append((label, "template", begin, min(len(own), begin + 2 * width) - 1, len(block) / len(set(t))))
            begin += width
    return sorted(out)


def scanned(df) -> list[tuple]:
    return sorted(((r.doc_id, r.n_words, sorted(map(tuple, r.matches))) for r in df.collect()), key=str)


@pytest.mark.parametrize("percent", [100, 80, 50, 1])
def test_scan_equals_brute_force(documents, percent):
    rng = random.Random(percent)
    letters = list("abcdefghijkl")
    text = lambda n: " ".join(rng.choices(letters, k=n))
    templates = [(f"t{i % 4}", text(rng.randrange(1, 20))) for i in range(9)]
    phrases = [("p", "a b"), ("q", "c c"), ("r", "a b a")]
    docs = [(i, text(rng.choice([0, 1, 2, 5, 17, 40, 150]))) for i in range(80)]
    want = sorted(((d, len(plain_words(t)), brute_scan(t, templates, phrases, percent)) for d, t in docs), key=str)
    assert scanned(licenses.scan(documents(docs), templates, phrases, percent)) == want


def test_scan_of_odd_rows_and_notices(documents, odd_rows, monkeypatch):
    notice = TEMPLATES[0][1].replace("copy, modify", "duplicate, alter")
    filler = " ".join(f"f{i}" for i in range(300))
    docs = [(r[0], r[1]) for r in odd_rows] + [(30, f"{filler} {notice} {filler}"), (31, "The MIT License. mit-license MIT\nLICENSE"), (32, notice[: len(notice) // 3])]
    monkeypatch.setattr(licenses, "PART_BYTES", 50)
    rows = licenses.digest(licenses.scan(documents(docs)))
    got = sorted((r.asDict() for r in rows.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    assert len(got) == len(docs)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[30]["labels"] == "mit" and by_id[30]["base_labels"] == "" and 0.8 <= by_id[30]["score"] < 1
    assert by_id[30]["first_word"] is None and by_id[30]["n_base"] == 0
    assert {k: by_id[31][k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "score")} == {"n_words": 7, "n_base": 3, "first_word": 1, "last_word": 5, "base_labels": "mit", "score": 1.0}
    assert by_id[32]["labels"] == "" and by_id[32]["score"] == 0
    assert by_id[2]["n_words"] == by_id[3]["n_words"] == 0 and by_id[5]["n_words"] == 60_000


def test_scan_of_an_empty_table_and_bad_templates(documents):
    assert scanned(licenses.scan(documents([]))) == []
    assert scanned(licenses.scan(documents([(1, "a b")]), [], [])) == [(1, 2, [])]
    with pytest.raises(ValueError):
        licenses.scan(documents([]), [("x", "--")])
    with pytest.raises(ValueError):
        licenses.scan(documents([]), percent=0)


def test_filters_reject_before_counting():
    """A block that shares only words in front of which too few are left isn't counted, and blocks without a rare word aren't met."""
    catalogue = licenses.Catalogue([("t", " ".join("abcdefghij"))], [], 80)
    catalogue.rank({w.encode(): n for n, w in enumerate("abcdefghij")})
    assert len(catalogue.found[0].prefix) == 3
    assert not len(catalogue.candidates(catalogue.ranks(b"d e f g h i j")))
    assert len(catalogue.candidates(catalogue.ranks(b"c d e f g h i j"))) == 1
    assert [m[4] for m in catalogue.blocks(catalogue.ranks(b"c d e f g h i j"))] == [0.8]


def brute_clusters(rows: list[tuple], dimension: int, clusters: int, rounds: int, seed: int = 3) -> list[tuple]:
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(1024 * x) for x in v]))
    name = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    found = [v for _, v in sorted(kept, key=name)[:clusters]]
    if not found:
        return []
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((distance(v, c), k) for k, c in enumerate(found))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for k in range(len(found)):
            some = [v for (_, v), c in zip(kept, own, strict=True) if c == k]
            if some:
                found[k] = [sum(x) // len(some) for x in zip(*some, strict=True)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, k in last:
        inertia[k] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), sha[k]) for i, d, k in last), key=str)


@pytest.fixture
def vectors(spark):
    def make(rows: list[tuple]):
        clash = CLASHES.replace("_key string", "vector string, cluster int")
        return spark.createDataFrame([(*r, *[None] * len(clash.split(", "))) for r in rows], f"vec_id long, embedding array<double>, {clash}")

    return make


def clustered(df) -> list[tuple]:
    return sorted(map(tuple, df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


def test_clusters_equal_brute_force(vectors):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(i % 5, 1, 4).tolist()) for i in range(150)]
    rows += [(200 + i, [0.0] * 4) for i in range(10)] + [(1, rows[1][1])] * 3 + [(None, [1.0, 2.0, 3.0, 4.0]), (300, None), (301, []), (302, [1.0] * 5), (303, [1.0, None, 2.0, 3.0]), (304, [math.nan] * 4), (305, [math.inf, 0.0, 0.0, 0.0])]
    assert clustered(centroids.cluster(vectors(rows).repartition(5), 4, 6, 5)) == brute_clusters(rows, 4, 6, 5)


def test_few_equal_and_no_vectors(vectors):
    same = [(i, [0.5, -0.5]) for i in range(6)]
    assert clustered(centroids.cluster(vectors(same), 2, 4, 3)) == brute_clusters(same, 2, 4, 3)
    few = [(None, [1.0, 2.0]), (2, [-3.0, 0.0])]
    assert clustered(centroids.cluster(vectors(few), 2, 4, 3)) == brute_clusters(few, 2, 4, 3)
    assert clustered(centroids.cluster(vectors([]), 2, 4, 3)) == clustered(centroids.cluster(vectors([(1, None)]), 2, 4, 3)) == []


def test_components_too_large_stop_the_job(vectors):
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(vectors([(1, [1e30, 0.0])]), 2, 1, 1).collect()


def test_search_is_exact_and_rejects_most():
    rng = np.random.default_rng(3)
    level = rng.normal(0, 300, (200, 1))
    points = (level + rng.normal(0, 40, (200, 16))).astype(np.int64)
    own = (rng.normal(0, 300, (3000, 1)) + rng.normal(0, 40, (3000, 16))).astype(np.int64)
    points[7] = points[3]
    own[:200] = points
    cluster, distance, computed = centroids.Centroids(points).nearest(own)
    every = ((own[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (cluster == every.argmin(axis=1)).all()
    assert computed < 0.1 * every.size


def test_search_at_the_largest_components():
    big = centroids.LIMIT
    points = np.array([[big] * 64, [-big] * 64, [big - 1] * 64, [0] * 64], np.int64)
    own = np.concatenate([points, points[::-1] // 2 + 3])
    every = np.array([[sum((int(x) - int(y)) ** 2 for x, y in zip(a, b, strict=True)) for b in points] for a in own], object)
    cluster, distance, _ = centroids.Centroids(points).nearest(own)
    assert distance.tolist() == every.min(axis=1).tolist() and cluster.tolist() == [r.tolist().index(min(r)) for r in every]
