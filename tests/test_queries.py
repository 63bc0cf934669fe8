"""All registered queries against their SQL."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from bench import HEADLINE
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", entry.queries())
def test_query_agrees_with_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.columns and df.count() > 0
    else:
        assert difference(df, con, sql) is None


def test_headline_queries_exist():
    assert set(HEADLINE) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_the_corpus_part_can_be_left_out():
    """Nothing else imports it, and the entry does without it."""
    root = Path(entry.__file__).parent
    others = [f for f in (root / "shelfline").rglob("*.py") if "llm" not in f.relative_to(root).parts]
    assert others and not [f for f in others if "shelfline.llm" in f.read_text(encoding="utf-8")]
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
        "print(len(e.queries()), sum(q.startswith('op') for q in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    )
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) > 150 and said[1:] == ["0", "True"]


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
