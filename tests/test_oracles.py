"""Every registered query against its SQL, on the smallest scale factor."""

import dataclasses
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from tests.oracle_check import differences, duck

import __spark_entry__ as entry
from tallywright.plans import fees, franchise
from tallywright.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_a_wrong_rule_turns_its_row_red(spark, con, sf_dir, monkeypatch):
    """The SQL has its own rules: a rule, a category and a brand that are wrong in the library differ from it."""
    rules = fees.processing_rules()
    wrong = [dataclasses.replace(r, tests=r.tests[1:]) if k == 3 else r for k, r in enumerate(rules)]
    monkeypatch.setattr(fees, "processing_rules", lambda: wrong)
    assert differences(QUERIES["merchant_processing_view"](spark, sf_dir), con, ORACLES["merchant_processing_view"])
    monkeypatch.setattr(franchise, "CATEGORIES", franchise.CATEGORIES[1:])
    assert differences(QUERIES["ff_category_skeleton"](spark, sf_dir), con, ORACLES["ff_category_skeleton"])
    monkeypatch.setattr(franchise, "NAMED_FEES", {**franchise.NAMED_FEES, "EmmaFee": (3, "emm%x")})
    assert differences(QUERIES["ff_settlement_wide"](spark, sf_dir), con, ORACLES["ff_settlement_wide"])


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("gone", [("tallywright/llm",), ("tallywright/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",), ()])
def test_entry_without_optional_parts(tmp_path, gone):
    """The entry imports, with all other queries, where the optional subpackage or the pipeline is missing."""
    root, copy = Path(__file__).resolve().parents[1], tmp_path / "copy"
    copy.mkdir()
    shutil.copy(root / "__spark_entry__.py", copy)
    there = [p for p in ("tallywright/llm", "corpus_pipeline.py") if (root / p).exists() and p not in gone]
    left_out = [str(root / p) for p in gone]
    shutil.copytree(root / "tallywright", copy / "tallywright", ignore=lambda d, names: [n for n in names if f"{d}/{n}" in left_out])
    if "corpus_pipeline.py" in there:
        shutil.copy(root / "corpus_pipeline.py", copy)
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    names, with_sql = (set(line.split()) for line in run.stdout.splitlines())
    assert set(QUERIES) <= names and set(ORACLES) <= with_sql
    assert ("pipeline" in names) == (len(there) == 2) and any(n.startswith("op1_") for n in names) == ("tallywright/llm" in there)
