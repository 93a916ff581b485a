"""Every query of the event engine against its SQL, on the smallest tables."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from parity.check import compare
from parity.oracles import ORACLES
from parity.queries import REGISTRY

ROOT = Path(__file__).resolve().parents[1]
CASTS = "tests/test_casts.py"


def test_every_query_has_sql():
    assert sorted(ORACLES) == sorted(REGISTRY)
    assert REGISTRY.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() == 15


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_its_sql(spark, name):
    assert compare(spark, name, SF_DIR) in (None, "no rows")


@pytest.fixture
def rest(tmp_path) -> Path:
    """A copy of the repository without the subpackage, its pipeline and its tests."""
    for name in ("eventmart", "parity", "tests"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    return tmp_path


def run(folder: Path, *args: str) -> str:
    return subprocess.run([sys.executable, *args], cwd=folder, capture_output=True, text=True, check=True).stdout


def test_the_rest_stands_alone(rest):
    asked = "import __spark_entry__ as e, parity.queries as q; print(sorted(e.queries()) == sorted(q.REGISTRY) == sorted(e.oracle_sql()))"
    assert run(rest, "-W", "ignore", "-c", asked).strip() == "True"
    found = run(rest, "-m", "pytest", "tests", "--collect-only", "-q")
    assert "tests/test_streaming.py" in found and "tests/llm" not in found
    assert "failed" not in run(rest, "-m", "pytest", CASTS, "-q")


def test_a_missing_library_leaves_the_event_queries(rest):
    """The subpackage is there, but something that it imports isn't."""
    shutil.copytree(ROOT / "eventmart", rest / "eventmart", dirs_exist_ok=True)
    shutil.copy(ROOT / "corpus_pipeline.py", rest) if (ROOT / "corpus_pipeline.py").exists() else None
    asked = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e, parity.queries as q; print(sorted(e.queries()) == sorted(q.REGISTRY))"
    assert run(rest, "-W", "ignore", "-c", asked).strip() == "True"
