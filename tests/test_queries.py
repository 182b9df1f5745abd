"""Every query with SQL against DuckDB on the smallest tables; the rest run."""

from __future__ import annotations

import os
import sys

import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="no test data here")
QUERIES = {k: q for m in entry._modules() if ".llm." not in m.__name__ for k, q in m.QUERIES.items()}
SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k in SQL))
def test_equal_to_sql(spark, name):
    import compare

    assert compare.same(QUERIES[name](spark, DATA).toPandas(), compare.connect(DATA).sql(SQL[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k not in SQL and k not in ("ridge_fill", "forest_fill")))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_all_periods_and_bins(spark):
    """All periods and all bins of the day take part."""
    for name in ("reconstructed_speeds", "unmatched_override_keys", "class_propagation", "boundary_overlay"):
        assert {r["period"] for r in QUERIES[name](spark, DATA).select("period").distinct().collect()} >= {"AM", "MD", "PM", "NT"}, name
    assert len(QUERIES["profile_panel"](spark, DATA).columns) == 97
    assert QUERIES["wide_profile_to_long"](spark, DATA).select("t_min").distinct().count() == 96
