"""Reading the given tables and the bronze-shaped views derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Parts and suppliers are broadcast only after they were counted, up to this many narrow rows each (about 150 MB).
BROADCAST_ROWS = 2_000_000


def _counted(dimension: DataFrame) -> DataFrame:
    """With a broadcast hint if it was counted and is small; Spark's own choice otherwise.

    Lines are as wide as they get when they meet a dimension, so a shuffle of them costs far more than the dimension.
    """
    return F.broadcast(dimension) if dimension.count() <= BROADCAST_ROWS else dimension


def _text(value: Column) -> Column:
    return value.cast("string")


def _when(condition: Column, value: object, otherwise: Column) -> Column:
    return F.when(condition, value).otherwise(otherwise)


def _copies(key: Column) -> Column:
    """Two copies of some documents, one of all others: every source row stays in."""
    twice = (key % 13 == 0) & (key % 97 != 0)
    return F.explode(_when(twice, F.array(F.lit(0), F.lit(1)), F.array(F.lit(0))))


def _document_number(key: Column, is_credit: Column) -> Column:
    number = F.concat(
        _when(is_credit, F.lit("CN"), F.lit("INV")),
        _text(key),
        _when(key % 5 == 0, F.lit(" "), F.lit("")),
    )
    return F.when(key % 97 != 0, number)


def _date_text(key: Column, day: Column) -> Column:
    last = key % 10
    iso = F.date_format(day, "yyyy-MM-dd")
    return (
        F.when(last <= 4, iso)
        .when(last == 5, F.concat(F.lit(" "), iso))
        .when(last <= 7, F.concat(iso, F.lit(" 00:00:00")))
        .when(last == 8, F.translate(iso, "-", "/"))
        .otherwise(F.lit("bad"))
    )


def _customer_columns(custkey: Column) -> dict[str, Column]:
    code = F.when(custkey % 11 == 0, F.lit("  ")).when(custkey % 41 == 0, F.lit(None)).otherwise(_text(custkey))
    return {
        "CUS_CODE": code,
        "CUSTOMER_NAME": F.concat(F.lit(" "), F.col("c_name")),
        "TELEPHONE": F.concat(F.lit("+254 7-"), _text(custkey)),
        "EMAIL": F.concat(F.lit(" User"), _text(custkey), F.lit("@Example.COM ")),
        "COMPANY": F.col("c_mktsegment"),
        "ADDRESS": F.concat(F.lit("Nation "), _text(F.col("c_nationkey"))),
    }


def _processed_at() -> Column:
    return F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss")


def export_year(processed_at: Column) -> Column:
    """The year that a row is exported with."""
    return F.substring(processed_at, 1, 4)


def _load_columns(key: Column, minutes: Column) -> dict[str, Column]:
    path = F.concat(_when(F.col("copy") == 1, F.lit("g"), F.lit("")), F.lit("f"), _text(key % 3))
    loaded = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.col("copy"), F.lit(0), minutes.cast("int")
    )
    return {
        "_source_sheet": F.lit("Sheet1"),
        "_processed_at": _processed_at(),
        "source_file_path": path,
        "load_timestamp": loaded,
        "batch_id": (key % 3).cast("int"),
    }


def _calendar_columns(key: Column) -> dict[str, Column]:
    day = F.col("o_orderdate")
    return {
        "TRN_DATE": _date_text(key, day),
        "TRN_YEAR": _when(key % 17 == 0, F.lit("n/a"), _text(F.year(day))),
        "TRN_MONTH": F.month(day) + F.lit(0.25),
    }


# Columns that tell every bronze row from every other.
ROW_ID = ("_row_file", "_row_index", "_row_copy")


def bronze_detailed(spark: SparkSession, sf_dir: str, by_year: bool = False, with_row_id: bool = False) -> DataFrame:
    """One row per invoice line, with the dirt the silver layer has to deal with.

    ``by_year`` brings the rows of an export year into one task, while they are as narrow as the tables. Lines meet orders that have met their customers by then, so customers are shuffled with orders and never
    with lines. Parts and suppliers are broadcast up to a size, so that lines are shuffled once. Copies are made
    after the joins.
    """
    lines = read_table(spark, sf_dir, "lineitem")
    position = [F.col("_metadata.file_path").alias(ROW_ID[0]), F.col("_metadata.row_index").alias(ROW_ID[1])]
    lines = lines.select("*", *(position if with_row_id else []))
    orders = read_table(spark, sf_dir, "orders").join(
        read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_counted(read_table(spark, sf_dir, "part")), F.col("l_partkey") == F.col("p_partkey"))
        .join(_counted(read_table(spark, sf_dir, "supplier")), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    if by_year:
        joined = joined.repartition(export_year(_processed_at()))
    joined = joined.select("*", _copies(F.col("l_orderkey")).alias("copy"))
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    returned = F.col("l_returnflag") == "R"
    sign = _when(returned & (line % 2 == 1), F.lit(-1.0), F.lit(1.0))
    price, tax, discount = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
    amount = F.when(key % 89 == 0, F.lit(None)).when(key % 31 == 0, F.lit(0.0)).otherwise(price * sign)
    partkey, suppkey = F.col("l_partkey"), F.col("l_suppkey")
    columns = {
        "DOCUMENT_NUMBER": _document_number(key, returned & (line % 3 == 0)),
        "ITEM_CODE": F.concat(_when(partkey % 7 == 0, F.lit(" P"), F.lit("P")), _text(partkey)),
        **_calendar_columns(key),
        "AMOUNT": amount,
        "AMOUNT_INCLUSIVE": price * (1 + tax) * sign,
        "AMOUNT_EXCLUSIVE": price * sign,
        "VAT": price * tax * sign,
        "DISC": price * discount * sign,
        "TAX_AMOUNT": price * tax * sign,
        "QUANTITY": _when(key % 19 == 0, F.lit(0.0), F.col("l_quantity")),
        "DISCOUNT_PERCENT": discount * 100 + _when(key % 83 == 0, F.lit(1000.0), F.lit(0.0)),
        "DISCOUNT": price * discount * sign,
        "AMOUNT_VALUE": F.col("l_quantity") * F.col("p_retailprice"),
        "AMT_EXCL": price * (1 - discount) * sign,
        "DESCRIPTION": F.concat(F.col("p_name"), _when(partkey % 29 == 0, F.lit(r"\t"), F.lit(""))),
        "ITEM_PRICE": F.when(partkey % 23 != 0, F.col("p_retailprice")),
        "PW": F.concat(F.lit(" "), F.col("p_type")),
        "PWQTY": F.col("l_quantity") * 0.5,
        "TRN_TYPE": F.concat(F.col("l_linestatus"), F.lit(" ")),
        "BCODE": F.when(key % 53 != 0, _text(suppkey)),
        "USERNAME": F.concat(F.lit("user"), _text(key % 7), F.lit(" ")),
        "BRANCH_NAME": F.col("s_name"),
        "MPESA_TILL": F.concat(F.lit("T"), _text(suppkey % 9)),
        **_customer_columns(F.col("o_custkey")),
        **_load_columns(key, line),
    }
    if with_row_id:
        columns |= {ROW_ID[0]: F.col(ROW_ID[0]), ROW_ID[1]: F.col(ROW_ID[1]), ROW_ID[2]: F.col("copy")}
    return joined.select([column.alias(name) for name, column in columns.items()])


def bronze_summarized(spark: SparkSession, sf_dir: str, by_year: bool = False) -> DataFrame:
    """One row per invoice document; ``by_year`` as for lines."""
    orders = read_table(spark, sf_dir, "orders")
    joined = orders.join(read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if by_year:
        joined = joined.repartition(export_year(_processed_at()))
    joined = joined.select("*", _copies(F.col("o_orderkey")).alias("copy"))
    key = F.col("o_orderkey")
    finished = F.col("o_orderstatus") == "F"
    sign = _when(finished & (key % 4 == 1), F.lit(-1.0), F.lit(1.0))
    total = F.col("o_totalprice")
    amount = F.when(key % 89 == 0, F.lit(None)).when(key % 31 == 0, F.lit(0.0)).otherwise(total * sign)
    columns = {
        "DOCUMENT_NUMBER": _document_number(key, finished & (key % 6 == 0)),
        **_calendar_columns(key),
        "AMOUNT": amount,
        "AMOUNT_INCLUSIVE": total * 1.16 * sign,
        "AMOUNT_EXCLUSIVE": _when(key % 43 == 0, F.lit(0.0), total * sign),
        "VAT": total * 0.16 * sign,
        "DISC": total * 0.035 * sign,
        "BCODE": F.when(key % 53 != 0, _text(key % 100)),
        "USERNAME": F.concat(F.lit("user"), _text(key % 7), F.lit(" ")),
        "BRANCH_NAME": F.concat(F.lit("Supplier#"), F.lpad(_text(key % 100), 9, "0")),
        "MPESA_TILL": F.concat(F.lit("T"), _text(key % 9)),
        **_customer_columns(F.col("o_custkey")),
        **_load_columns(key, key % 5),
    }
    return joined.select([column.alias(name) for name, column in columns.items()])


# The same two views for the checking engine.
_SQL_SHARED = """
  CASE k % 10 WHEN 5 THEN ' ' || d WHEN 6 THEN d || ' 00:00:00' WHEN 7 THEN d || ' 00:00:00'
              WHEN 8 THEN replace(d, '-', '/') WHEN 9 THEN 'bad' ELSE d END AS TRN_DATE,
  CASE WHEN k % 17 = 0 THEN 'n/a' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS TRN_YEAR,
  CAST(month(o_orderdate) AS DOUBLE) + 0.25 AS TRN_MONTH,
  CASE WHEN o_custkey % 11 = 0 THEN '  ' WHEN o_custkey % 41 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CUS_CODE,
  ' ' || c_name AS CUSTOMER_NAME,
  '+254 7-' || CAST(o_custkey AS VARCHAR) AS TELEPHONE,
  ' User' || CAST(o_custkey AS VARCHAR) || '@Example.COM ' AS EMAIL,
  c_mktsegment AS COMPANY,
  'Nation ' || CAST(c_nationkey AS VARCHAR) AS ADDRESS,
  CASE WHEN k % 53 <> 0 THEN CAST(branch AS VARCHAR) END AS BCODE,
  'user' || CAST(k % 7 AS VARCHAR) || ' ' AS USERNAME,
  'T' || CAST(till AS VARCHAR) AS MPESA_TILL,
  'Sheet1' AS _source_sheet,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS _processed_at,
  (CASE WHEN copy = 1 THEN 'g' ELSE '' END) || 'f' || CAST(k % 3 AS VARCHAR) AS source_file_path,
  TIMESTAMP '2025-01-01 00:00:00' + to_days(copy) + to_minutes(mins) AS load_timestamp,
  CAST(k % 3 AS INTEGER) AS batch_id,
  CASE WHEN k % 97 <> 0 THEN (CASE WHEN credit THEN 'CN' ELSE 'INV' END) || CAST(k AS VARCHAR)
       || (CASE WHEN k % 5 = 0 THEN ' ' ELSE '' END) END AS DOCUMENT_NUMBER,
  CASE WHEN k % 89 = 0 THEN NULL WHEN k % 31 = 0 THEN 0.0 ELSE base * sign END AS AMOUNT,
"""

SQL_BRONZE_DETAILED = f"""bronze_detailed AS (
SELECT {_SQL_SHARED}
  (CASE WHEN l_partkey % 7 = 0 THEN ' P' ELSE 'P' END) || CAST(l_partkey AS VARCHAR) AS ITEM_CODE,
  base * (1 + l_tax) * sign AS AMOUNT_INCLUSIVE,
  base * sign AS AMOUNT_EXCLUSIVE,
  base * l_tax * sign AS VAT,
  base * l_discount * sign AS DISC,
  base * l_tax * sign AS TAX_AMOUNT,
  CASE WHEN k % 19 = 0 THEN 0.0 ELSE l_quantity END AS QUANTITY,
  l_discount * 100 + (CASE WHEN k % 83 = 0 THEN CAST(1000 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS DISCOUNT_PERCENT,
  base * l_discount * sign AS DISCOUNT,
  l_quantity * p_retailprice AS AMOUNT_VALUE,
  base * (1 - l_discount) * sign AS AMT_EXCL,
  p_name || (CASE WHEN l_partkey % 29 = 0 THEN '\\t' ELSE '' END) AS DESCRIPTION,
  CASE WHEN l_partkey % 23 <> 0 THEN p_retailprice END AS ITEM_PRICE,
  ' ' || p_type AS PW,
  l_quantity * 0.5 AS PWQTY,
  l_linestatus || ' ' AS TRN_TYPE,
  s_name AS BRANCH_NAME
FROM (
  SELECT *, l_orderkey AS k, l_extendedprice AS base, l_suppkey AS branch, l_suppkey % 9 AS till,
         l_linenumber AS mins, strftime(o_orderdate, '%Y-%m-%d') AS d,
         l_returnflag = 'R' AND l_linenumber % 3 = 0 AS credit,
         CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 1 THEN -1 ELSE 1 END AS DOUBLE) AS sign,
         unnest(CASE WHEN l_orderkey % 13 = 0 AND l_orderkey % 97 <> 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey))"""

SQL_BRONZE_SUMMARIZED = f"""bronze_summarized AS (
SELECT {_SQL_SHARED}
  base * CAST(1.16 AS DOUBLE) * sign AS AMOUNT_INCLUSIVE,
  CASE WHEN k % 43 = 0 THEN 0.0 ELSE base * sign END AS AMOUNT_EXCLUSIVE,
  base * CAST(0.16 AS DOUBLE) * sign AS VAT,
  base * CAST(0.035 AS DOUBLE) * sign AS DISC,
  'Supplier#' || lpad(CAST(k % 100 AS VARCHAR), 9, '0') AS BRANCH_NAME
FROM (
  SELECT *, o_orderkey AS k, o_totalprice AS base, o_orderkey % 100 AS branch, o_orderkey % 9 AS till,
         CAST(o_orderkey % 5 AS INTEGER) AS mins, strftime(o_orderdate, '%Y-%m-%d') AS d,
         o_orderstatus = 'F' AND o_orderkey % 6 = 0 AS credit,
         CAST(CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 = 1 THEN -1 ELSE 1 END AS DOUBLE) AS sign,
         unnest(CASE WHEN o_orderkey % 13 = 0 AND o_orderkey % 97 <> 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM orders JOIN customer ON o_custkey = c_custkey))"""
