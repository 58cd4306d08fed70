"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with compare.connect(SF_DIR) as opened:
        yield opened


OWN = [name for name in entry.queries() if name not in entry.LLM_QUERIES]


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_agrees_with_sql(spark, connection, name):
    # A few answers are empty on the smallest tables; both sides must say so.
    assert compare.compare(spark, connection, SF_DIR, name, {}) in ("", "no rows on either side")


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 3
    assert [row.n_revisions for row in rows] == sorted((r.n_revisions for r in rows), reverse=True)
