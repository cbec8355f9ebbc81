"""Lines are shuffled once, and paths cost little per row."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstone.functions.naming import plain_path, strip_scheme
from tillstone.sources import tables

ROWS = {
    "lineitem": "1L l_orderkey, 1L l_partkey, 1L l_suppkey, 1L l_linenumber, 1D l_quantity, 2D l_extendedprice, 0D l_discount, 0D l_tax, 'N' l_returnflag, 'O' l_linestatus",
    "orders": "1L o_orderkey, 1L o_custkey, 'O' o_orderstatus, 2D o_totalprice, timestamp_ntz'2024-01-01' o_orderdate",
    "customer": "1L c_custkey, 'c' c_name, 1L c_nationkey, 'm' c_mktsegment",
    "part": "1L p_partkey, 'p' p_name, 't' p_type, 3D p_retailprice", "supplier": "1L s_suppkey, 's' s_name",
}


def _bronze_plan(spark, folder) -> str:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = tables.bronze_detailed(spark, str(folder))
        assert found.count() == 1
        return found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_shuffled_once(spark, tmp_path, monkeypatch):
    for name, columns in ROWS.items():
        spark.sql(f"SELECT {columns}").write.parquet(str(tmp_path / f"{name}.parquet"))
    shuffled = "Exchange hashpartitioning(l_"
    assert _bronze_plan(spark, tmp_path).count(shuffled) == 1
    # dimensions above the size are left to Spark
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)
    assert _bronze_plan(spark, tmp_path).count(shuffled) == 3


def test_plain_paths_meet_no_pattern(spark):
    uris = ["file:///tmp/a/b.parquet", "file:/tmp/x", "s3a://bucket/x/y:/z", "viewfs://store/in/1", "hdfs:////a//b", "/plain/p", "/a:/b", "abc", "",
            ":/x", "a+b:/x+y", "file:///tmp/a%20b+c%2Bd", "s3a://b/%C3%A4/x", "file:///tmp/ä+ö/x", "file:///", "file:"]
    rows = spark.createDataFrame([(u,) for u in uris], "u string")
    old = strip_scheme(F.url_decode(F.replace(F.col("u"), F.lit("+"), F.lit("%2B"))))
    for row in rows.select("u", plain_path(F.col("u")).alias("new"), old.alias("old")).collect():
        assert row.new == row.old, row.u


def test_rows_of_plain_paths_are_not_decoded(spark):
    # an invalid code raises where it is decoded; without a code nothing is
    plan = spark.range(1).select(plain_path(F.format_string("file:/x/%d", F.col("id"))).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN Contains") < plan.index("regexp_replace")
