from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from llm_rows import LONG, documents, odd_rows, words_of  # noqa: F401
from pyspark.sql import functions as F

from eventmart.llm import decontaminate, langid
from eventmart.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = table(spark, SF_DIR, "documents")
    found = {r.doc_id: r for r in langid.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(found) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in found.items())
    held = [d for d, r in found.items() if r.held_out]
    assert held and sum(found[d].lang_pred == truth[d] for d in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_mixture_finds_shares():
    """Words of two languages in known parts; a third language gets nothing."""
    rng = np.random.default_rng(0)
    words = np.full((400, 3), -30.0, np.float32)
    words[:300, 0], words[300:, 1] = -10, -10
    words += rng.normal(0, 0.5, words.shape).astype(np.float32)
    alone = words[:50]
    shares = langid.infer(np.concatenate([words, alone]), np.array([0, 400]))
    assert shares[0].round(2).tolist() == [0.75, 0.25, 0]
    assert shares[1].tolist() == [1, 0, 0]


def test_odd_texts(documents, odd_rows):
    rows = [*odd_rows, *[(100 + i, "the cat and the dog sat", "en", "a") for i in range(20)], *[(200 + i, "der Hund und die Katze", "de", "a") for i in range(20)]]
    out = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(documents(rows)).collect()]
    assert len(out) == len(rows)
    und = [x for x in out if x[1] == "und"]
    assert all(x[2] == 0 for x in und)
    letterless = sum(1 for r in rows if not any(c.isalpha() for c in r[1] or ""))
    assert len(und) == letterless
    assert langid.identify(documents([])).count() == 0
    unlabelled = langid.identify(documents([(1, "text"), (2, None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0), ("und", 0)]


def test_parts_of_a_long_text_agree(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice(["the", "und", "chat", "où"]) for _ in range(3000))
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([text, "", "the und"])], ["text"])
    table_ = np.log(np.random.default_rng(1).dirichlet(np.ones(langid.GRAMS), 3).T).astype(np.float32)
    whole = langid._scored(batch, table_)
    monkeypatch.setattr(langid, "CELLS", 600)
    parts = langid._scored(batch, table_)
    assert whole[0].tolist() == parts[0].tolist()
    assert np.allclose(whole[1], parts[1], atol=1e-5)


def plain_align(item, text):
    best, rows = 0, [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item):
        for j, b in enumerate(text):
            v = max(0, rows[i][j] + (2 if a == b else -1), rows[i][j + 1] - 1, rows[i + 1][j] - 1)
            rows[i + 1][j + 1] = v
            best = max(best, v)
    return best


@pytest.mark.parametrize("seed", range(4))
def test_alignment_equals_the_plain_recursion(seed):
    rng = np.random.default_rng(seed)
    items = [rng.integers(1, 6, rng.integers(1, 30)).astype(np.uint64) for _ in range(25)]
    texts = [rng.integers(1, 6, rng.integers(1, 60)).astype(np.uint64) for _ in range(25)]
    scores, ends = decontaminate.align(items, texts)
    assert scores.tolist() == [plain_align(a.tolist(), b.tolist()) for a, b in zip(items, texts)]
    for a, b, s, e in zip(items, texts, scores, ends):
        assert plain_align(a.tolist(), b[:e].tolist()) == s


def edited(words, rng, every):
    out = []
    for i, w in enumerate(words):
        if i % every == every - 1:
            out += [f"new{rng.random()}"] if rng.random() < 0.7 else []
        else:
            out.append(w)
    return out


def test_copies_are_found_and_clean_texts_left_alone(spark, documents):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnr"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [text(rng.randint(15, 45)) for _ in range(30)]
    rows, want = [], set()
    for i in range(120):
        w = text(rng.randint(30, 300))
        if i % 3 == 0:
            k = rng.randrange(30)
            at = rng.randrange(len(w))
            w[at:at] = items[k] if i % 2 else edited(items[k], rng, 6)
            want.add((i, k))
        rows.append((i, " ".join(w)))
    benchmark = spark.createDataFrame([(k, " ".join(w), 1.0) for k, w in enumerate(items)], "item_id long, text string, score double")
    found = decontaminate.contamination(documents(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    for r in found:
        assert 0.5 <= r.score <= 1
        words = words_of(rows[r.doc_id][1])[r.start_word : r.end_word]
        assert words and sum(w in words for w in items[r.item_id]) >= 0.7 * len(items[r.item_id])


def test_item_in_many_texts_is_still_found(spark, documents):
    """An item that a third of all texts hold has only common seeds, but common alike."""
    item = "a rare passage about the keeping of bees on the roofs of large towns in spring"
    rows = [(i, f"intro {i} {item if i % 3 == 0 else 'nothing to see here'} and some more {i * 7}") for i in range(300)]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert decontaminate.contamination(documents(rows), benchmark).count() == 100


def test_odd_rows(spark, documents, odd_rows):
    schema = "item_id long, text string"
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "one"), (None, "The river begins in the hills and runs past three villages"), (3, LONG)], schema)
    found = decontaminate.contamination(documents(odd_rows), odd).groupBy("item_id").count().collect()
    assert {r.item_id: r["count"] for r in found} == {None: 4, 3: 1}
    assert decontaminate.contamination(documents([]), odd).count() == 0
    assert decontaminate.contamination(documents(odd_rows), spark.createDataFrame([], schema)).count() == 0


def test_chunks_of_the_benchmark(spark, documents, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(f"q{i}w{j}" for j in range(20))) for i in range(12)], "item_id long, text string")
    rows = [(i, "before " + " ".join(f"q{i}w{j}" for j in range(20))) for i in range(12)]
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", 400)
    found = decontaminate.contamination(documents(rows), items)
    assert sorted((r.doc_id, r.item_id) for r in found.select("doc_id", "item_id").filter(F.col("score") == 1).collect()) == [(i, i) for i in range(12)]


def test_letter_case_of_any_alphabet(spark, documents):
    item = "Éaînt der Öl ñandú passage über größere Dinge als âne"
    rows = [(1, f"x {item.upper()} y"), (2, item.lower()), (3, "another text without it")]
    found = decontaminate.contamination(documents(rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id for r in found} == {1, 2}


@pytest.mark.parametrize("extra", [16, 20])
def test_a_copy_with_inserted_text_is_aligned_as_one(spark, documents, extra):
    item = [f"i{k}" for k in range(30)]
    copy = [*item[:15], *[f"new{k}" for k in range(extra)], *item[15:]]
    copy[4] = copy[-5] = "other"
    text = [f"a{k}" for k in range(40)] + copy + [f"b{k}" for k in range(40)]
    found = decontaminate.contamination(documents([(1, " ".join(text))]), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert [(r.item_id, r.score, r.start_word, r.end_word) for r in found] == [(7, plain_align(item, text) / 60, 40, 70 + extra)]


def test_passages_of_any_length_are_aligned_in_bounded_batches(spark, documents, monkeypatch):
    """A text that repeats an item makes one long passage, which doesn't widen the batch of the others."""
    item = [f"i{k}" for k in range(20)]
    cells, align = [], decontaminate.align
    monkeypatch.setattr(decontaminate, "align", lambda a, b: cells.append(len(b) * max(map(len, b))) or align(a, b))
    items = decontaminate.Items([(1, " ".join(item))])
    items.keep_rare(np.ones(len(items.seeds), int))
    texts = [decontaminate._hashed(" ".join(item * n)) for n in [1] * 50 + [3000]]
    pairs = [(k, *w) for k, h in enumerate(texts) for w in items.windows(h)]
    assert len(pairs) == 51
    assert len(decontaminate._aligned(items, texts, pairs, 0.5)) == 51
    assert max(cells) <= 3 * decontaminate.CELLS


@pytest.mark.parametrize("others", [0, 5, 1500])
def test_common_seeds_are_the_same_beside_any_number_of_items(others):
    items = decontaminate.Items([(k, " ".join(f"q{k}w{j}" for j in range(6))) for k in range(1 + others)])
    texts = np.ones(len(items.seeds), int)
    texts[items.seed[np.flatnonzero(items.item == 0)]] = [1, 1, 10, 150]
    items.keep_rare(texts)
    assert (items.item == 0).sum() == 3
