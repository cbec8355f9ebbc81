"""Casts: rounding, overflow and date forms."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstone.functions import casts


def evaluate(spark, values, kind, cast):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(cast(F.col("v")).alias("out"), "i").orderBy("i").collect()]


def test_double_to_money(spark):
    values = [1.005, 2.675, -1.005, 0.125, -0.125, 1e15, 9999999999999.994, 9999999999999.996, float("nan"),
              float("inf"), 0.0049999999999999994, None, -0.0, 1e300]
    got = evaluate(spark, values, "double", lambda c: casts.decimal_from_double(c, 15, 2))
    want = ["1.00", "2.68", "-1.00", "0.13", "-0.13", None, "9999999999999.99", None, None, None, "0.00", None, "0.00",
            None]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_text_to_money(spark):
    got = evaluate(spark, ["1.005", " 12 ", "abc", "", "1e3", None], "string",
                   lambda c: casts.decimal_from_text(c, 15, 2))
    assert got == [Decimal("1.01"), Decimal("12.00"), None, None, Decimal("1000.00"), None]


def test_integers(spark):
    texts = ["12.7", "12.5", "-12.5", "abc", " 12 ", "1e3", "3000000000", None]
    assert evaluate(spark, texts, "string", casts.integer_from_text) == [13, 13, -13, None, 12, 1000, None, None]
    doubles = [12.5, 13.5, -12.5, 12.7, float("nan"), 1e10]
    assert evaluate(spark, doubles, "double", casts.integer_from_double) == [12, 14, -12, 13, None, None]


@pytest.mark.parametrize("text,day", [
    ("2025-01-31", dt.date(2025, 1, 31)), ("2025-01-31 10:00:00", dt.date(2025, 1, 31)),
    ("2025-1-3", dt.date(2025, 1, 3)), (" 2025-01-31", dt.date(2025, 1, 31)), ("2025/01/31", dt.date(2025, 1, 31)),
    ("2025 01 31", dt.date(2025, 1, 31)), ("2025-01-31T10:00", dt.date(2025, 1, 31)), ("2025/01-31", None),
    ("31/01/2025", None), ("20250131", None), ("45321", None), ("2025", None), ("2025-02-30", None),
    ("2025-01-31abc", None), ("2025-01-315", None), ("", None), (None, None),
])
def test_dates(spark, text, day):
    assert evaluate(spark, [text], "string", casts.date_from_text) == [day]


def test_transaction_date_cascade(spark):
    values = ["2025-01-31abc", "bad", None, "  2025-01-31"]
    missing = dt.date(1900, 1, 1)
    got = evaluate(spark, values, "string", casts.transaction_date)
    assert got == [dt.date(2025, 1, 31), missing, missing, dt.date(2025, 1, 31)]


def test_timestamps(spark):
    values = ["2025-01-31", "2025-01-31T10:00:00.123456", "2025/01/31 10:00", "2025", "bad", "2025-01-31T10:00:00Z"]
    got = evaluate(spark, values, "string", casts.timestamp_from_text)
    assert got == [
        dt.datetime(2025, 1, 31), dt.datetime(2025, 1, 31, 10, 0, 0, 123456), dt.datetime(2025, 1, 31, 10), None, None,
        dt.datetime(2025, 1, 31, 10),
    ]


def test_phone_and_email(spark):
    assert evaluate(spark, [" +254 700-111 "], "string", casts.phone_first) == ["254 700-111"]
    assert evaluate(spark, [" +254 700-111 "], "string", casts.phone_all) == ["254700111"]
    assert evaluate(spark, [" A@B.Com "], "string", casts.email) == ["a@b.com"]
    assert evaluate(spark, ["\tx "], "string", F.trim) == ["\tx"]
