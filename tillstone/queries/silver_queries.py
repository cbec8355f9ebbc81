"""Silver tables and daily summary over the bronze-shaped views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.casts import ColumnCasts, email, phone_all, phone_first, transaction_date
from tillstone.operators.duplicates import flag_duplicates
from tillstone.plans import silver, summary
from tillstone.queries import silver_sql as sql
from tillstone.queries.registry import query
from tillstone.sources.tables import ROW_ID, bronze_detailed, bronze_summarized

RUN = silver.Run(process_id=sql.PROCESS_ID, load_timestamp=sql.STAMP)


def _detailed_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_detailed(spark, sf_dir, with_row_id=True)


def _summarized_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    bronze = bronze_summarized(spark, sf_dir)
    return silver.summarized_invoices(bronze, RUN), silver.summarized_credit_notes(bronze, RUN)


def _detailed_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Daily totals do not read the duplicate flag, so the invoices come without it."""
    bronze = bronze_detailed(spark, sf_dir)
    positive = bronze.filter(ColumnCasts(bronze).money("AMOUNT") > 0)
    return silver.clean_detailed(positive, RUN), silver.detailed_credit_notes(bronze, RUN)


_S, _D = sql.with_tables(sql.BRONZE_S), sql.with_tables(sql.BRONZE_D)


@query("trim_text", _D + """SELECT DOCUMENT_NUMBER, TRIM(DOCUMENT_NUMBER) AS document_trimmed,
  TRIM(ITEM_CODE) AS item_trimmed, TRIM(DESCRIPTION) AS description_trimmed FROM bronze_detailed""")
def trim_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_detailed(spark, sf_dir)
    return bronze.select(
        "DOCUMENT_NUMBER",
        F.trim("DOCUMENT_NUMBER").alias("document_trimmed"),
        F.trim("ITEM_CODE").alias("item_trimmed"),
        F.trim("DESCRIPTION").alias("description_trimmed"),
    )


@query("normalize_email", _S + "SELECT CUS_CODE, LOWER(TRIM(EMAIL)) AS email FROM bronze_summarized")
def normalize_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_summarized(spark, sf_dir).select("CUS_CODE", email(F.col("EMAIL")).alias("email"))


@query("phone_first", _S + """SELECT CUS_CODE, REGEXP_REPLACE(TRIM(TELEPHONE), '[^0-9]', '') AS phone
FROM bronze_summarized""")
def phone_first_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_summarized(spark, sf_dir).select("CUS_CODE", phone_first(F.col("TELEPHONE")).alias("phone"))


@query("phone_all", _S + """SELECT CUS_CODE, REGEXP_REPLACE(TRIM(TELEPHONE), '[^0-9]', '', 'g') AS phone
FROM bronze_summarized""")
def phone_all_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_summarized(spark, sf_dir).select("CUS_CODE", phone_all(F.col("TELEPHONE")).alias("phone"))


@query("try_cast_money", _D + f"""SELECT DOCUMENT_NUMBER, {sql.money('AMOUNT')} AS amount,
  {sql.money('AMOUNT_INCLUSIVE')} AS amount_inclusive, {sql.money('VAT')} AS vat,
  {sql.money('CAST(AMT_EXCL AS VARCHAR)')} AS amount_from_text FROM bronze_detailed""")
def try_cast_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_detailed(spark, sf_dir)
    bronze = bronze.withColumn("AMT_TEXT", F.col("AMT_EXCL").cast("string"))
    casts = ColumnCasts(bronze)
    return bronze.select(
        "DOCUMENT_NUMBER",
        casts.money("AMOUNT").alias("amount"),
        casts.money("AMOUNT_INCLUSIVE").alias("amount_inclusive"),
        casts.money("VAT").alias("vat"),
        casts.money("AMT_TEXT").alias("amount_from_text"),
    )


@query("try_cast_qty", _D + f"""SELECT DOCUMENT_NUMBER, {sql.quantity('QUANTITY')} AS quantity,
  {sql.quantity('PWQTY')} AS price_weight_quantity, {sql.percent('DISCOUNT_PERCENT')} AS discount_percent
FROM bronze_detailed""")
def try_cast_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_detailed(spark, sf_dir)
    casts = ColumnCasts(bronze)
    return bronze.select(
        "DOCUMENT_NUMBER",
        casts.quantity("QUANTITY").alias("quantity"),
        casts.quantity("PWQTY").alias("price_weight_quantity"),
        casts.percent("DISCOUNT_PERCENT").alias("discount_percent"),
    )


@query("try_cast_int", _D + """SELECT DOCUMENT_NUMBER, TRY_CAST(TRN_YEAR AS INTEGER) AS transaction_year,
  TRY_CAST(TRN_MONTH AS INTEGER) AS transaction_month, TRY_CAST(BCODE AS INTEGER) AS branch_code,
  TRY_CAST(PWQTY AS INTEGER) AS half_even, TRY_CAST(CAST(PWQTY AS VARCHAR) AS INTEGER) AS half_up
FROM bronze_detailed""")
def try_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_detailed(spark, sf_dir)
    bronze = bronze.withColumn("PWQTY_TEXT", F.col("PWQTY").cast("string"))
    casts = ColumnCasts(bronze)
    return bronze.select(
        "DOCUMENT_NUMBER",
        casts.integer("TRN_YEAR").alias("transaction_year"),
        casts.integer("TRN_MONTH").alias("transaction_month"),
        casts.integer("BCODE").alias("branch_code"),
        casts.integer("PWQTY").alias("half_even"),
        casts.integer("PWQTY_TEXT").alias("half_up"),
    )


@query("parse_txn_date", _S + f"""SELECT DOCUMENT_NUMBER, TRN_DATE, {sql.day('TRN_DATE')} AS transaction_date,
  SUBSTR(TRIM(TRN_DATE), 1, 10) AS first_ten, TRY_CAST(_processed_at AS TIMESTAMP) AS processed_at
FROM bronze_summarized""")
def parse_txn_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_summarized(spark, sf_dir)
    return bronze.select(
        "DOCUMENT_NUMBER",
        "TRN_DATE",
        transaction_date(F.col("TRN_DATE")).alias("transaction_date"),
        F.substring(F.trim("TRN_DATE"), 1, 10).alias("first_ten"),
        ColumnCasts(bronze).timestamp("_processed_at").alias("processed_at"),
    )


@query("classify_document", _D + f"""SELECT document_type, CAST(document_type = 'CREDIT_NOTE' AS INTEGER)
  AS is_credit_note, COUNT(*) AS documents
FROM (SELECT {sql.DOCUMENT_TYPE} AS document_type FROM bronze_detailed) GROUP BY document_type""")
def classify_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_detailed(spark, sf_dir)
    kinds = bronze.groupBy(silver.document_type(ColumnCasts(bronze)).alias("document_type"))
    counted = kinds.agg(F.count(F.lit(1)).alias("documents"))
    return counted.withColumn("is_credit_note", (F.col("document_type") == silver.CREDIT_NOTE).cast("int"))


@query("quality_flags", _D + f"""SELECT {sql._FLAGS}, {sql._LINE_FLAGS}, COUNT(*) AS line_count
FROM bronze_detailed GROUP BY ALL""")
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_detailed(spark, sf_dir)
    casts = ColumnCasts(bronze)
    flags = silver.quality_flags(casts.money("AMOUNT"), casts.day("TRN_DATE"), casts.raw("CUS_CODE"))
    flags |= silver.line_quality_flags(casts.quantity("QUANTITY"), casts.money("ITEM_PRICE"))
    return bronze.groupBy([flag.alias(name) for name, flag in flags.items()]).agg(
        F.count(F.lit(1)).alias("line_count")
    )


@query("line_identifier", sql.with_tables(*sql.FROM_DETAILED)
       + "SELECT invoice_number, product_code, invoice_line_identifier FROM clean_detailed")
def line_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = silver.clean_detailed(bronze_detailed(spark, sf_dir), RUN)
    return lines.select("invoice_number", "product_code", "invoice_line_identifier")


@query("invoice_derived", sql.with_tables(*sql.FROM_SUMMARIZED)
       + "SELECT invoice_number, vat_calculated, discount_percentage, is_credit_note FROM summarized_invoices")
def invoice_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices = silver.summarized_invoices(bronze_summarized(spark, sf_dir), RUN)
    return invoices.select("invoice_number", "vat_calculated", "discount_percentage", "is_credit_note")


@query("line_derived", sql.with_tables(*sql.FROM_DETAILED) + """SELECT invoice_number, product_code,
  calculated_line_total, effective_amount, discounted_unit_price, net_line_amount FROM clean_detailed""")
def line_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = silver.clean_detailed(bronze_detailed(spark, sf_dir), RUN)
    return lines.select("invoice_number", "product_code", *silver.line_calculations())


@query("silver_summarized_invoices", sql.with_tables(*sql.FROM_SUMMARIZED) + "SELECT * FROM summarized_invoices")
def silver_summarized_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.summarized_invoices(bronze_summarized(spark, sf_dir), RUN)


@query("silver_summarized_credit_notes", sql.with_tables(sql.BRONZE_S, sql.SUMMARIZED_CREDIT_NOTES)
       + "SELECT * FROM summarized_credit_notes")
def silver_summarized_credit_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.summarized_credit_notes(bronze_summarized(spark, sf_dir), RUN)


@query("silver_detailed_invoices", sql.with_tables(*sql.FROM_DETAILED) + "SELECT * FROM detailed_invoices")
def silver_detailed_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line and its copy have neighbouring places in their file, so first rows are found by place and lines are not shuffled for it."""
    file, index, copy = ROW_ID
    placed = _detailed_with_id(spark, sf_dir).withColumn("_row_place", F.col(index) * 2 + F.col(copy))
    return silver.detailed_invoices(placed, RUN, position=(file, "_row_place"))


@query("silver_detailed_credit_notes", sql.with_tables(sql.BRONZE_D, sql.DETAILED_CREDIT_NOTES)
       + "SELECT * FROM detailed_credit_notes")
def silver_detailed_credit_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.detailed_credit_notes(bronze_detailed(spark, sf_dir), RUN)


@query("silver_invoices", sql.with_tables(*sql.FROM_SUMMARIZED)
       + "SELECT invoice_number, document_type, amount FROM summarized_invoices")
def silver_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.summarized_invoices(bronze_summarized(spark, sf_dir), RUN).select(
        "invoice_number", "document_type", "amount"
    )


@query("silver_credit_notes", sql.with_tables(sql.BRONZE_S, sql.SUMMARIZED_CREDIT_NOTES)
       + "SELECT credit_note_number, credit_amount, credit_note_type FROM summarized_credit_notes")
def silver_credit_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.summarized_credit_notes(bronze_summarized(spark, sf_dir), RUN).select(
        "credit_note_number", "credit_amount", "credit_note_type"
    )


@query("silver_rejects", _D + f"""SELECT DOCUMENT_NUMBER, ITEM_CODE, source_file_path, reject_reason FROM (
  SELECT *, CASE WHEN DOCUMENT_NUMBER IS NULL THEN 'DOCUMENT_NUMBER_MISSING' WHEN ITEM_CODE IS NULL
    THEN 'ITEM_CODE_MISSING' WHEN {sql.money('AMOUNT')} IS NULL THEN 'AMOUNT_UNREADABLE' END AS reject_reason
  FROM bronze_detailed) WHERE reject_reason IS NOT NULL""")
def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.rejects(bronze_detailed(spark, sf_dir), silver.DETAILED).select(
        "DOCUMENT_NUMBER", "ITEM_CODE", "source_file_path", "reject_reason"
    )


_OLD_S = sql.with_tables(sql.BRONZE_S, sql.CLEAN_SUMMARIZED)
_OLD_D = sql.with_tables(sql.BRONZE_D, sql.CLEAN_DETAILED)
_OLD_AUDIT = "original_document_number, original_cus_code"


@query("split_by_type_invoices", _OLD_S + f"""SELECT * EXCLUDE (signed_amount, {_OLD_AUDIT},
  original_customer_name, original_trn_date) FROM clean_summarized WHERE is_credit_note = 0""")
def split_by_type_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.split_by_document_type(bronze_summarized(spark, sf_dir), silver.SUMMARIZED, RUN)[0]


@query("split_by_type_credits", _OLD_D + """SELECT invoice_number, product_code AS credit_product_code, branch_code,
  amount AS credit_amount, quantity AS credit_quantity, calculated_line_total AS credit_calculated_total,
  net_line_amount AS credit_net_line_amount FROM clean_detailed WHERE is_credit_note = 1""")
def split_by_type_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    credits = silver.split_by_document_type(bronze_detailed(spark, sf_dir), silver.DETAILED, RUN)[1]
    return credits.select(
        "invoice_number", "credit_product_code", "branch_code", "credit_amount", "credit_quantity",
        "credit_calculated_total", "credit_net_line_amount",
    )


@query("potential_duplicate_flag", sql.with_tables(*sql.FROM_DETAILED) + """SELECT invoice_number, product_code,
  transaction_date, amount, bronze_load_timestamp, source_file_path, potential_duplicate_flag
FROM detailed_invoices""")
def potential_duplicate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_detailed(spark, sf_dir)
    positive = bronze.filter(ColumnCasts(bronze).money("AMOUNT") > 0)
    order = ["bronze_load_timestamp", "source_file_path"]
    lines = silver.clean_detailed(positive, RUN).select(*silver.LINE_KEYS, *order)
    return flag_duplicates(lines, silver.LINE_KEYS, order)


@query("daily_invoices_summarized", sql.with_tables(*sql.FROM_SUMMARIZED)
       + sql.daily_invoices("summarized_invoices", "SUMMARIZED", "COUNT(*)"))
def daily_invoices_summarized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.daily_invoices_summarized(_summarized_pair(spark, sf_dir)[0])


@query("daily_invoices_detailed", sql.with_tables(*sql.FROM_DETAILED)
       + sql.daily_invoices("detailed_invoices", "DETAILED", "COUNT(DISTINCT invoice_number)"))
def daily_invoices_detailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.daily_invoices_detailed(_detailed_pair(spark, sf_dir)[0])


@query("daily_invoices_union", sql.with_tables(*sql.FROM_SUMMARIZED, *sql.FROM_DETAILED) + sql.DAILY_INVOICES_UNION)
def daily_invoices_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.daily_invoices_summarized(_summarized_pair(spark, sf_dir)[0]).unionByName(
        summary.daily_invoices_detailed(_detailed_pair(spark, sf_dir)[0])
    )


_CREDITS = (
    sql.daily_credits("summarized_credit_notes", "transaction_date, branch_code", sql.ONLY_CREDITS)
    + "\nUNION ALL\n"
    + sql.daily_credits("detailed_credit_notes", "transaction_date, branch_code", sql.ONLY_CREDITS)
)


@query("daily_credits", sql.with_tables(
    sql.BRONZE_S, sql.BRONZE_D, sql.SUMMARIZED_CREDIT_NOTES, sql.DETAILED_CREDIT_NOTES) + _CREDITS)
def daily_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.daily_credits(_summarized_pair(spark, sf_dir)[1]).unionByName(
        summary.daily_credits(_detailed_pair(spark, sf_dir)[1])
    )


@query("daily_sales_summary", sql.with_tables(*sql.ALL_SILVER) + sql.summary(sql.DAILY_INVOICES_UNION, _CREDITS))
def daily_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.daily_sales_summary(_summarized_pair(spark, sf_dir), _detailed_pair(spark, sf_dir), sql.STAMP)


_MATCHED_CREDITS = " UNION ALL ".join(
    "SELECT *, '{}' AS data_source FROM ({})".format(
        source, sql.daily_credits(table, "transaction_date, branch_code", sql.ONLY_CREDITS)
    )
    for source, table in (("SUMMARIZED", "summarized_credit_notes"), ("DETAILED", "detailed_credit_notes"))
)


@query("daily_sales_summary_matched", sql.with_tables(*sql.ALL_SILVER)
       + sql.summary(sql.DAILY_INVOICES_UNION, _MATCHED_CREDITS, "transaction_date, branch_code, data_source"))
def daily_sales_summary_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.daily_sales_summary(
        _summarized_pair(spark, sf_dir), _detailed_pair(spark, sf_dir), sql.STAMP, match_source=True
    )


_OLD_TABLES = (
    sql.BRONZE_S, sql.BRONZE_D, sql.CLEAN_SUMMARIZED, sql.CLEAN_DETAILED,
    "old_s AS (SELECT * FROM clean_summarized WHERE is_credit_note = 0)",
    "old_d AS (SELECT * FROM clean_detailed WHERE is_credit_note = 0)",
    "old_cs AS (SELECT *, amount AS credit_amount FROM clean_summarized WHERE is_credit_note = 1)",
    "old_cd AS (SELECT *, amount AS credit_amount FROM clean_detailed WHERE is_credit_note = 1)",
)
_OLD_KEYS = "transaction_date, branch_name, branch_code"


@query("daily_sales_summary_v1", sql.with_tables(*_OLD_TABLES) + sql.summary(
    sql.daily_invoices("old_s", "SUMMARIZED", "COUNT(*)") + "\nUNION ALL\n"
    + sql.daily_invoices("old_d", "DETAILED", "COUNT(*)"),
    sql.daily_credits("old_cs", _OLD_KEYS) + "\nUNION ALL\n" + sql.daily_credits("old_cd", _OLD_KEYS),
    _OLD_KEYS, share=True))
def daily_sales_summary_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.daily_sales_summary(
        silver.split_by_document_type(bronze_summarized(spark, sf_dir), silver.SUMMARIZED, RUN),
        silver.split_by_document_type(bronze_detailed(spark, sf_dir), silver.DETAILED, RUN),
        sql.STAMP,
        keys=("transaction_date", "branch_name", "branch_code"),
        count_lines=True,
        credit_share=True,
    )
