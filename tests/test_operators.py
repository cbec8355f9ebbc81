"""Quality, profile, manifest, standardisation and schema operators on small frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from tillstone.operators import manifest, oplog, profile, quality, schema_evolution, standardize
from tillstone.sources.nested import flatten_nested, with_landing_lineage


def test_whitespace_profile(spark):
    df = spark.createDataFrame([(" a", "x", 1), ("b ", r"y\t", 2), ("b ", "z", 3), ("c\t", None, 4)], "p string, q string, n int")
    found = {r.column_name: (r.affected_rows, r.sample_data) for r in quality.whitespace_profile(df).collect()}
    assert found == {"p": (3, " a, b "), "q": (1, r"y\t")}
    tabs = {r.column_name: r.affected_rows for r in quality.whitespace_profile(df, real_tabs=True).collect()}
    assert tabs == {"p": 4}
    many = spark.createDataFrame([(f"v{i:02d} ",) for i in range(20)], "p string")
    assert quality.whitespace_profile(many).first().sample_data == "v00 , v01 , v02 , v03 , v04 "
    assert quality.whitespace_profile(spark.range(3)).count() == 0


def test_profiles(spark):
    df = spark.createDataFrame(
        [("2025-01-01", "yes", 0.0, 0.0, None), ("bad", "no", 0.0, None, None)],
        "d string, b string, z double, y double, e string",
    )
    nulls = {r.column_name: r.null_percentage for r in profile.null_percentages(df).collect()}
    assert nulls == {"d": 0.0, "b": 0.0, "z": 0.0, "y": 50.0, "e": 100.0}
    assert profile.drop_sparse(df, 50.0).columns == ["d", "b", "z", "y"]
    assert profile.drop_empty_columns(df).columns == ["d", "b", "z", "y"]
    zeros = {r.column_name: r.all_zero for r in profile.all_zero_columns(df).collect()}
    assert zeros == {"z": True, "y": False}
    assert profile.drop_if_all_zero(df, ["z", "y"]).columns == df.columns
    assert "z" not in profile.drop_if_all_zero(df, ["z"]).columns
    dates = {r.column_name: r.is_date_like for r in profile.looks_like_date(df).collect()}
    assert dates == {"d": False, "b": False, "e": False}
    assert profile.looks_like_date(df, ["d"], min_share=0.5).first().is_date_like
    booleans = {r.column_name: r.is_boolean_like for r in profile.looks_like_boolean(df).collect()}
    assert booleans == {"d": False, "b": True, "e": False}
    assert profile.columns_equal(df, "z", "y").first().different_rows == 1
    assert profile.columns_only_in(df, df.drop("z")) == ["z"]
    assert profile.any_null_rows(df, ["d", "b"]).count() == 0
    assert profile.any_negative_rows(df).count() == 0
    assert profile.distinct_count(df, "z").first()[0] == 1


def test_column_tests(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id int")
    assert profile.check_unique(df, "id").first()[0] == 1
    assert profile.check_not_null(df, "id").first()[0] == 2


def test_standardize(spark):
    df = spark.createDataFrame(
        [("2025-01-01", "1", 1, None), ("2025-01-02", "0", None, "x"), ("2025-01-02", "0", None, "x")],
        "`Sale Date` string, `Is-Paid` string, n int, t string",
    )
    full, applied = standardize.standardize(df, "in/x.parquet", "now", standardize.STEPS_FULL)
    assert applied == [
        "column_name_standardization", "missing_value_handling", "data_type_standardization", "duplicate_removal(1 rows)"
    ]
    assert {tuple(r) for r in full.collect()} == {
        (dt.datetime(2025, 1, 1), True, 1, "Unknown", "now", "x.parquet"),
        (dt.datetime(2025, 1, 2), False, 0, "x", "now", "x.parquet"),
    }
    basic, applied = standardize.standardize(df, "x", "now")
    assert applied == ["missing_value_handling"] and basic.count() == 3
    assert standardize.trim_all(spark.createDataFrame([(" a ", 1)], "s string, n int")).first() == ("a", 1)


def test_manifest(spark):
    listing = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "file_path string, file_hash string")
    known = spark.createDataFrame(
        [("a", "1", "SUCCESS", ["o1", "o2"]), ("b", "x", "FAILED", ["o3"]), ("gone", "1", "SUCCESS", ["o4"])],
        "file_path string, file_hash string, status string, output_files array<string>",
    )
    assert sorted(r.file_path for r in manifest.new_files(listing, known).collect()) == ["b", "c"]
    states = {r.file_path: r.state for r in manifest.classify_files(listing, known, ["file_hash"]).collect()}
    assert states == {"a": "UNCHANGED", "b": "CHANGED", "c": "NEW"}
    assert [tuple(r) for r in manifest.orphaned_outputs(known, listing).collect()] == [("gone", "o4")]
    assert manifest.without_orphans(known, listing).count() == 2


def test_latest_wins(spark):
    old = spark.createDataFrame([("a", 1, "STARTED"), ("b", 5, "SUCCESS")], "k string, at int, status string")
    new = spark.createDataFrame([("a", 2, "SUCCESS"), ("a", 1, "FAILED")], "k string, at int, status string")
    got = {(r.k, r.at, r.status) for r in manifest.upsert_latest(old, new, "k", "at").collect()}
    assert got == {("a", 2, "SUCCESS"), ("b", 5, "SUCCESS")}


def test_reconcile(spark):
    source = spark.createDataFrame([("a", 3), ("b", 2)], "file_path string, rows long")
    target = spark.createDataFrame([("a", 3), ("c", 1)], "file_path string, rows long")
    got = {r.file_path: r.row_difference for r in manifest.reconcile(source, target).collect()}
    assert got == {"a": 0, "b": 2, "c": -1}


def test_schema_diff(spark):
    current = T.StructType.fromDDL("a int, b string, c double, source_file_path string, batch_id int")
    new = T.StructType.fromDDL("a int, b bigint, d string")
    rows = [schema_evolution.schema_rows(spark, s) for s in (current, new)]
    found = {(r.change_type, r.column_name, r.old_data_type, r.new_data_type)
             for r in schema_evolution.schema_diff(*rows).collect()}
    assert found == {
        ("TYPE_CHANGE", "b", "string", "bigint"), ("REMOVE_COLUMN", "c", "double", None),
        ("ADD_COLUMN", "d", None, "string"),
    }
    grown = schema_evolution.ensure_columns(spark.range(1), T.StructType.fromDDL("id bigint, x date"))
    assert grown.dtypes == [("id", "bigint"), ("x", "date")]
    assert schema_evolution.widens_to(T.IntegerType(), T.DoubleType())
    assert not schema_evolution.widens_to(T.StringType(), T.DoubleType())


def test_run_checks(spark):
    files = spark.createDataFrame(
        [("a", ["s"], ["o"], 5, 5, "SUCCESS")],
        "file_path string, sheets_processed array<string>, output_files array<string>, excel_row_count long, "
        "parquet_row_count long, status string",
    )
    assert oplog.run_invariants(oplog.run_stats(files)).first().run_passed
    empty = oplog.run_stats(files.limit(0)).first()
    assert (empty.total_files, empty.total_sheets, empty.total_row_difference) == (0, 0, 0)


def test_issue_rows(spark):
    df = spark.createDataFrame([(" a",), ("b",)], "p string")
    issue = quality.issue_rows(quality.whitespace_profile(df), 4, "t", "2025-01-01 00:00:00").first()
    assert (issue.process_id, issue.issue_type, issue.affected_rows) == (4, "TRAILING_WHITESPACE", 1)
    assert issue.issue_description == "1 rows begin or end with white space"
    none = spark.createDataFrame([(0,)], "n long")
    assert quality.duplicate_issue(none, 4, "t", "2025-01-01 00:00:00").count() == 0


def test_nested(spark):
    df = spark.createDataFrame([({"a": 1}, [1, 2], "x")], "m map<string,int>, l array<int>, s string")
    row = with_landing_lineage(flatten_nested(df), "Sheet1", "now").first()
    assert tuple(row) == ('{"a":1}', "[1,2]", "x", "Sheet1", "now")


def test_recent(spark):
    logs = spark.createDataFrame(
        [("1", 5, "INFO"), ("2", 9, "ERROR"), ("3", 9, "ERROR")], "log_id string, timestamp int, level string"
    )
    assert [r.log_id for r in oplog.recent_logs(logs, 2).collect()] == ["2", "3"]
    assert [r.log_id for r in oplog.recent_errors(logs).collect()] == ["2", "3"]


def test_working_folder_follows_the_session(spark):
    from tillstone.session import working_folder

    first, second = working_folder(spark, "x"), working_folder(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
    with pytest.raises(ValueError):
        from tillstone.queries.registry import query

        from tillstone.queries import load_all

        load_all()
        query("daily_sales_summary")(lambda s, d: None)
