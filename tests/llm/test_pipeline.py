from __future__ import annotations

import importlib
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from llm_rows import documents, odd_rows, words_of  # noqa: F401

from eventmart.llm import langid
from eventmart.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows each stage returns over the whole table."""
    docs, out = table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        from eventmart.llm.common import staged

        done = staged(stage(spark, docs, SF_DIR), f"test-{name}")
        out.append((docs, done))
        docs = done
    return out


def test_stages_keep_the_columns(stages):
    assert all(done.columns == docs.columns for docs, done in stages[:-1])


def test_language_keeps_clean_texts(stages):
    docs, done = stages[0]
    lost = {r.doc_id for r in docs.collect()} - {r.doc_id for r in done.collect()}
    pred = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert all(pred[d].lang_pred == "und" or pred[d].score < corpus_pipeline.LEAST_SHARE for d in lost)
    assert len(lost) <= 0.02 * docs.count()


def test_one_of_each_group_stays(stages):
    docs, done = stages[1]
    kept = {r.doc_id for r in done.collect()}
    sets = {}
    for r in docs.collect():
        w = words_of(r.text)
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    assert kept == {d for d in sets if find(d) == d}


def test_contaminated_texts_go(spark, stages):
    docs, done = stages[2]
    items = [" ".join(words_of(r.text)) for r in table(spark, SF_DIR, "benchmark").collect()]
    holds = {r.doc_id for r in docs.collect() if any(i in " ".join(words_of(r.text)) for i in items)}
    kept = {r.doc_id for r in done.collect()}
    assert holds and not holds & kept
    assert len(kept) >= 0.9 * docs.count() - len(holds)


def test_mix_and_tokens(stages):
    docs, done = stages[3]
    assert {r.doc_id for r in done.collect()} <= {r.doc_id for r in docs.collect()}
    assert stages[4][1].count() == done.count()


def test_odd_rows_pass_all_stages(spark, documents, odd_rows):
    docs = documents(odd_rows)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        if name != "tokens":
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.columns[:3] == ["doc_id", "start", "n_tokens"]
    empty = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_queries_are_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_the_rest_imports_without_the_subpackage(tmp_path):
    """With the folders of the subpackage gone, the entry still has the other queries."""
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'eventmart.llm' or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 50 and not any(n.startswith('op1') for n in e.queries())\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
