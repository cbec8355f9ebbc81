"""Quality monitors and profiles over the bronze-shaped views and the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.operators import duplicates, oplog, profile, quality, standardize
from tillstone.plans import silver_files
from tillstone.plans.silver import BRONZE_KEYS, DETAILED, SUMMARIZED
from tillstone.queries.registry import query
from tillstone.queries.silver_sql import STAMP, with_tables
from tillstone.session import working_folder
from tillstone.sources.nested import flatten_nested
from tillstone.sources.tables import (
    SQL_BRONZE_DETAILED,
    SQL_BRONZE_SUMMARIZED,
    bronze_detailed,
    bronze_summarized,
    read_table,
)

_S, _D = with_tables(SQL_BRONZE_SUMMARIZED), with_tables(SQL_BRONZE_DETAILED)
_BOTH = with_tables(SQL_BRONZE_SUMMARIZED, SQL_BRONZE_DETAILED)

SUMMARIZED_TEXTS = [
    "DOCUMENT_NUMBER", "TRN_DATE", "TRN_YEAR", "BCODE", "USERNAME", "BRANCH_NAME", "MPESA_TILL", "CUS_CODE",
    "CUSTOMER_NAME", "TELEPHONE", "EMAIL", "COMPANY", "ADDRESS", "_source_sheet", "_processed_at", "source_file_path",
]
SUMMARIZED_NUMBERS = ["TRN_MONTH", "AMOUNT", "AMOUNT_INCLUSIVE", "AMOUNT_EXCLUSIVE", "VAT", "DISC", "batch_id"]
DETAILED_TEXTS = [*SUMMARIZED_TEXTS, "ITEM_CODE", "DESCRIPTION", "PW", "TRN_TYPE"]
DETAILED_NUMBERS = [
    *SUMMARIZED_NUMBERS, "TAX_AMOUNT", "QUANTITY", "DISCOUNT_PERCENT", "DISCOUNT", "AMOUNT_VALUE", "AMT_EXCL", "ITEM_PRICE", "PWQTY",
]


# Written out here, so that a wrong key list in the code does not pass its own check.
SQL_SUMMARIZED_KEYS = ["DOCUMENT_NUMBER", "CUS_CODE", "TRN_DATE", "AMOUNT"]
SQL_DETAILED_KEYS = ["DOCUMENT_NUMBER", "ITEM_CODE", "TRN_DATE", "AMOUNT"]


def _whitespace_sql(table: str, columns: list[str]) -> str:
    def one(c: str) -> str:
        dirty = f"{c} LIKE '% ' OR {c} LIKE ' %' OR ends_with({c}, '\\t') OR starts_with({c}, '\\t')"
        return f"""SELECT '{c}' AS column_name, COUNT(*) AS affected_rows,
  (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM {table} WHERE {dirty} ORDER BY v LIMIT 5))
    AS sample_data FROM {table} WHERE {dirty} HAVING COUNT(*) > 0"""

    return "\nUNION ALL\n".join(one(c) for c in columns)


@query("whitespace_profile", _D + _whitespace_sql("bronze_detailed", DETAILED_TEXTS))
def whitespace_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.whitespace_profile(bronze_detailed(spark, sf_dir))


def _credits_sql(zero: str) -> str:
    return _D + f"""SELECT COUNT(*) AS total_records,
  COUNT(CASE WHEN DOCUMENT_NUMBER LIKE 'CN%' OR AMOUNT < 0 {zero} THEN 1 END) AS credit_notes FROM bronze_detailed"""


@query("credit_note_counts", _credits_sql("OR AMOUNT = 0"))
def credit_note_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.credit_note_counts(bronze_detailed(spark, sf_dir))


@query("credit_note_counts_v1", _credits_sql(""))
def credit_note_counts_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.credit_note_counts(bronze_detailed(spark, sf_dir), count_zero=False)


def _groups_sql(table: str, keys: list[str]) -> str:
    listed = ", ".join(keys)
    return f"""SELECT COUNT(*) AS potential_duplicate_count
FROM (SELECT {listed} FROM {table} GROUP BY {listed} HAVING COUNT(*) > 1)"""


@query("duplicate_groups", _D + _groups_sql("bronze_detailed", SQL_DETAILED_KEYS))
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_groups(bronze_detailed(spark, sf_dir), BRONZE_KEYS[DETAILED])


@query("duplicate_rows", _S + """SELECT CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT DOCUMENT_NUMBER,
  CUS_CODE, TRN_DATE, AMOUNT FROM bronze_summarized)) AS BIGINT) AS duplicate_count FROM bronze_summarized""")
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_rows(bronze_summarized(spark, sf_dir), BRONZE_KEYS[SUMMARIZED])


@query("dedup_keep_first", _S + """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY DOCUMENT_NUMBER, CUS_CODE, TRN_DATE, AMOUNT ORDER BY load_timestamp, source_file_path) AS rn
FROM bronze_summarized) WHERE rn = 1""")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = BRONZE_KEYS[SUMMARIZED]
    return duplicates.dedup_keep_first(bronze_summarized(spark, sf_dir), keys, ["load_timestamp", "source_file_path"])


@query("dedup_first_turn", """SELECT conv_id, role, turn, text FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY conv_id, role ORDER BY turn, text) AS rn FROM conversations) WHERE rn = 1""")
def dedup_first_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.dedup_keep_first(read_table(spark, sf_dir, "conversations"), ["conv_id", "role"], ["turn"])


@query("distinct_rows", "SELECT DISTINCT text, lang, n_chars FROM documents")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.distinct_rows(read_table(spark, sf_dir, "documents").select("text", "lang", "n_chars"))


@query("distinct_row_counts", """SELECT *, rows_before - rows_after AS rows_removed FROM (
  SELECT COUNT(*) AS rows_before, (SELECT COUNT(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS rows_after
  FROM documents)""")
def distinct_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.distinct_row_counts(read_table(spark, sf_dir, "documents").select("text", "lang"))


_ISSUES_SQL = f"""issues AS (
SELECT 'TRAILING_WHITESPACE' AS issue_type, affected_rows FROM (
  {_whitespace_sql('bronze_detailed', DETAILED_TEXTS)} UNION ALL {_whitespace_sql('bronze_summarized', SUMMARIZED_TEXTS)})
UNION ALL SELECT 'POTENTIAL_DUPLICATES', potential_duplicate_count FROM (
  {_groups_sql('bronze_detailed', SQL_DETAILED_KEYS)} UNION ALL
  {_groups_sql('bronze_summarized', SQL_SUMMARIZED_KEYS)}) WHERE potential_duplicate_count > 0)"""


@query("dq_issue_summary", with_tables(SQL_BRONZE_SUMMARIZED, SQL_BRONZE_DETAILED, _ISSUES_SQL) + """SELECT issue_type,
  COUNT(*) AS issue_count, CAST(SUM(affected_rows) AS BIGINT) AS total_rows_affected FROM issues GROUP BY issue_type""")
def dq_issue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = []
    for grain, bronze in ((SUMMARIZED, bronze_summarized(spark, sf_dir)), (DETAILED, bronze_detailed(spark, sf_dir))):
        found = duplicates.duplicate_groups(bronze, BRONZE_KEYS[grain])
        issues.append(quality.issue_rows(quality.whitespace_profile(bronze), 1, grain, STAMP))
        issues.append(quality.duplicate_issue(found, 1, grain, STAMP))
    return oplog.dq_issue_summary(reduce(DataFrame.unionByName, issues))


@query("trim_all_strings", _S + "SELECT " + ", ".join(f"TRIM({c}) AS {c}" for c in SUMMARIZED_TEXTS)
       + ", AMOUNT, batch_id FROM bronze_summarized")
def trim_all_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = standardize.trim_all(bronze_summarized(spark, sf_dir))
    return trimmed.select(*SUMMARIZED_TEXTS, "AMOUNT", "batch_id")


def _nulls_sql(table: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS null_rows,
  ROUND(CAST(COUNT(*) FILTER ({c} IS NULL) AS DOUBLE) / COUNT(*) * 100, 6) AS null_percentage FROM {table}"""
        for c in columns
    )


@query("null_percentages", _D + _nulls_sql("bronze_detailed", [*DETAILED_TEXTS, *DETAILED_NUMBERS, "load_timestamp"]))
def null_percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_percentages(bronze_detailed(spark, sf_dir))


@query("drop_sparse_columns", _D + """SELECT DOCUMENT_NUMBER, ITEM_CODE, CUS_CODE, BCODE, AMOUNT, QUANTITY
FROM bronze_detailed""")
def drop_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["DOCUMENT_NUMBER", "ITEM_CODE", "CUS_CODE", "BCODE", "AMOUNT", "QUANTITY", "ITEM_PRICE"]
    return profile.drop_sparse(bronze_detailed(spark, sf_dir).select(*columns), 3.0)


@query("drop_empty_columns", "SELECT * FROM documents")
def drop_empty_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    padded = documents.withColumn("unused", F.when(F.col("doc_id") < 0, F.col("lang")))
    hollow = padded.select(*[F.lit(None).cast(kind).alias(name) for name, kind in padded.dtypes])
    return profile.drop_empty_columns(profile.drop_empty_rows(padded.unionByName(hollow)))


@query("all_zero_columns", """SELECT 'l_tax' AS column_name, bool_and(COALESCE(l_tax = 0, FALSE)) AS all_zero FROM lineitem
UNION ALL SELECT 'l_discount', bool_and(COALESCE(l_discount = 0, FALSE)) FROM lineitem
UNION ALL SELECT 'no_tax', bool_and(COALESCE(l_tax * 0 = 0, FALSE)) FROM lineitem""")
def all_zero_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").withColumn("no_tax", F.col("l_tax") * 0)
    return profile.all_zero_columns(lines, ["l_tax", "l_discount", "no_tax"])


@query("infer_date_columns", _S + "\nUNION ALL\n".join(
    f"""SELECT *, value_rows > 0 AND date_rows >= value_rows AS is_date_like FROM (
  SELECT '{c}' AS column_name, COUNT({c}) AS value_rows, COUNT(TRY_CAST({c} AS TIMESTAMP)) AS date_rows
  FROM bronze_summarized)""" for c in ["TRN_DATE", "_processed_at", "BRANCH_NAME", "TRN_YEAR"]))
def infer_date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_summarized(spark, sf_dir)
    return profile.looks_like_date(bronze, ["TRN_DATE", "_processed_at", "BRANCH_NAME", "TRN_YEAR"])


@query("infer_bool_columns", """WITH texts AS (SELECT CAST(quality AS VARCHAR) AS quality,
  CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS toxic, CAST(doc_id AS VARCHAR) AS doc FROM labels),
known AS (SELECT ['true', 'false', 'True', 'False', '1', '0', 'yes', 'no'] AS words)
""" + " UNION ALL ".join(f"""SELECT '{c}' AS column_name, COUNT({c}) AS value_rows,
  bool_and(list_contains(words, {c})) AS is_boolean_like FROM texts, known""" for c in ("quality", "toxic", "doc")))
def infer_bool_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read_table(spark, sf_dir, "labels").select(
        F.col("quality").cast("string").alias("quality"),
        F.when(F.col("toxic") == 1, "yes").otherwise("no").alias("toxic"),
        F.col("doc_id").cast("string").alias("doc"),
    )
    return profile.looks_like_boolean(texts)


@query("fill_missing", _D + "SELECT * REPLACE (" + ", ".join(
    [f"COALESCE({c}, 'Unknown') AS {c}" for c in DETAILED_TEXTS if c not in ("_source_sheet", "_processed_at")]
    + [f"COALESCE({c}, 0) AS {c}" for c in DETAILED_NUMBERS]) + ") FROM bronze_detailed")
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.fill_missing(bronze_detailed(spark, sf_dir))


@query("any_negative_rows", "SELECT * FROM customer WHERE c_custkey < 0 OR c_nationkey < 0 OR c_acctbal < 0")
def any_negative_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.any_negative_rows(read_table(spark, sf_dir, "customer"))


@query("negative_amounts", _D + "SELECT DOCUMENT_NUMBER, ITEM_CODE, AMOUNT FROM bronze_detailed WHERE AMOUNT < 0")
def negative_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_detailed(spark, sf_dir).select("DOCUMENT_NUMBER", "ITEM_CODE", "AMOUNT")
    return profile.any_negative_rows(bronze, ["AMOUNT"])


@query("any_null_rows", _S + "SELECT * FROM bronze_summarized WHERE " + " OR ".join(
    f"{c} IS NULL" for c in SUMMARIZED_TEXTS))
def any_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.any_null_rows(bronze_summarized(spark, sf_dir))


@query("nonpositive_counts", _BOTH + " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, COUNT(*) FILTER ({column} <= 0) AS nonpositive_rows FROM {table}"
    for table, column in (("bronze_summarized", "AMOUNT"), ("bronze_detailed", "AMOUNT"), ("customer", "c_acctbal"),
                          ("supplier", "s_acctbal"))))
def nonpositive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.nonpositive_counts({
        "bronze_summarized": (bronze_summarized(spark, sf_dir), "AMOUNT"),
        "bronze_detailed": (bronze_detailed(spark, sf_dir), "AMOUNT"),
        "customer": (read_table(spark, sf_dir, "customer"), "c_acctbal"),
        "supplier": (read_table(spark, sf_dir, "supplier"), "s_acctbal"),
    })


@query("distinct_values", _D + "SELECT BCODE, COUNT(*) AS value_rows FROM bronze_detailed GROUP BY BCODE")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_values(bronze_detailed(spark, sf_dir), "BCODE")


@query("distinct_count", _D + "SELECT COUNT(DISTINCT TRN_TYPE) AS distinct_values FROM bronze_detailed")
def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_count(bronze_detailed(spark, sf_dir), "TRN_TYPE")


@query("columns_equal", _S + """SELECT different_rows, different_rows = 0 AS equal FROM (
  SELECT COUNT(*) FILTER (AMOUNT IS DISTINCT FROM AMOUNT_EXCLUSIVE) AS different_rows FROM bronze_summarized)""")
def columns_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.columns_equal(bronze_summarized(spark, sf_dir), "AMOUNT", "AMOUNT_EXCLUSIVE")


@query("test_unique", _S + """SELECT COUNT(*) AS failures FROM (SELECT DOCUMENT_NUMBER FROM bronze_summarized
WHERE DOCUMENT_NUMBER IS NOT NULL GROUP BY DOCUMENT_NUMBER HAVING COUNT(*) > 1)""")
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.check_unique(bronze_summarized(spark, sf_dir), "DOCUMENT_NUMBER")


@query("test_not_null", _S + "SELECT COUNT(*) FILTER (DOCUMENT_NUMBER IS NULL) AS failures FROM bronze_summarized")
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.check_not_null(bronze_summarized(spark, sf_dir), "DOCUMENT_NUMBER")


@query("model_filter", """WITH source_data AS (SELECT c_nationkey AS id FROM customer UNION ALL
  SELECT CASE WHEN s_nationkey > 0 THEN s_nationkey END FROM supplier) SELECT id FROM source_data WHERE id = 1""")
def model_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read_table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("id"))
    nation = F.col("s_nationkey")
    suppliers = read_table(spark, sf_dir, "supplier").select(F.when(nation > 0, nation).alias("id"))
    return customers.unionByName(suppliers).filter(F.col("id") == 1)


_FILLED = ", ".join(
    [f"COALESCE({c}, 'Unknown') AS {c.lower().strip('_')}" for c in SUMMARIZED_TEXTS if c != "_processed_at"]
    + [f"COALESCE({c}, 0) AS {c.lower()}" for c in SUMMARIZED_NUMBERS]
)


@query("standardize_table", _S + f"""SELECT DISTINCT {_FILLED}, TRY_CAST(_processed_at AS TIMESTAMP) AS processed_at,
  load_timestamp, '{STAMP}' AS _silver_processed_at, 'sums.parquet' AS _silver_input_file FROM bronze_summarized""")
def standardize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_summarized(spark, sf_dir)
    return standardize.standardize(
        bronze, "sales/sums.parquet", STAMP, steps=standardize.STEPS_FULL, report=False
    )[0]


@query("flatten_json", """SELECT vec_id, 'v' || label AS map_key, label AS map_value, vec_id AS struct_id, place::INTEGER AS place,
  CAST(embedding[place] AS DOUBLE) AS value
FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS place FROM embeddings)""")
def flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An array, a map and a struct as JSON text, read back value by value."""
    vectors = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("vector"), F.create_map(F.concat(F.lit("v"), F.col("label").cast("string")), "label").alias("named"),
        F.struct(F.col("vec_id").alias("id"), F.col("label").alias("kind")).alias("pair"))
    texts = flatten_nested(vectors)
    named = F.from_json("named", "map<string,int>")
    return texts.select(
        "vec_id", F.map_keys(named)[0].alias("map_key"), F.map_values(named)[0].alias("map_value"),
        F.from_json("pair", "id bigint, kind int")["id"].alias("struct_id"),
        F.posexplode(F.from_json("vector", "array<float>")).alias("place", "value"),
    ).withColumns({"place": F.col("place") + 1, "value": F.col("value").cast("double")})


@query("standardize_report", _S + """SELECT step FROM (SELECT unnest(['column_name_standardization', 'missing_value_handling', 'data_type_standardization',
  'duplicate_removal(' || (SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT """ + _FILLED + """, TRY_CAST(_processed_at AS TIMESTAMP) AS processed_at, load_timestamp
   FROM bronze_summarized)) FROM bronze_summarized) || ' rows)']) AS step) WHERE step <> 'duplicate_removal(0 rows)'""")
def standardize_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps that changed something, as the standardisation reports them."""
    applied = standardize.standardize(bronze_summarized(spark, sf_dir), "sales/sums.parquet", STAMP, steps=standardize.STEPS_FULL)[1]
    return spark.createDataFrame([(step,) for step in applied], "step string")


@query("silver_file_run", """SELECT 'customer.parquet' AS file_name, 'SUCCESS' AS status, COUNT(*) AS row_count, 7 AS column_count FROM customer
UNION ALL SELECT 'supplier.parquet', 'SUCCESS', COUNT(*), 6 FROM supplier""")
def silver_file_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the given files standardised into a silver tree, as the manifest has them; a second run finds nothing."""
    root, target, log_path = (working_folder(spark, name) for name in ("bronze-files", "silver-files", "silver-manifest"))
    for name in ("customer", "supplier"):
        read_table(spark, sf_dir, name).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    silver_files.run_silver_files(spark, root, target, log_path, "2025-01-01 00:00:00")
    silver_files.run_silver_files(spark, root, target, log_path, "2025-01-02 00:00:00")
    done = silver_files.manifest(spark, log_path)
    folder = F.element_at(F.split("output_path", "/"), -2)
    return done.filter(F.col("processed_at") == "2025-01-01 00:00:00").select(folder.alias("file_name"), "status", "row_count", "column_count")
