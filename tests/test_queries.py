"""Registered queries against their check SQL on the smallest data set."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry_points  # noqa: E402
from check_queries import canonical, oracle  # noqa: E402

DATA = "/root/testdata/sf0.001"
# One query per module; tools/check_queries.py compares all of them.
SAMPLE = ("daily_sales_summary", "silver_detailed_invoices", "whitespace_profile", "daily_log_stats", "changed_files",
          "standardize_table", "warehouse_table_name")


def test_every_check_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns[0] == "transaction_date"


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, name):
    expected = oracle(DATA).execute(entry_points.oracle_sql()[name]).to_arrow_table().to_pandas()
    got = entry_points.queries()[name](spark, DATA).toArrow().to_pandas()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canonical(got) == canonical(expected)
