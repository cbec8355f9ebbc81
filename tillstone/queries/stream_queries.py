"""Streams with memory: duplicate flags and daily totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.casts import ColumnCasts
from tillstone.plans import silver, summary
from tillstone.queries import silver_sql as sql
from tillstone.queries.registry import CHECKS, query
from tillstone.session import working_folder
from tillstone.sources import sinks
from tillstone.sources.tables import bronze_detailed, bronze_summarized
from tillstone.streaming import stateful

RUN = silver.Run(process_id=sql.PROCESS_ID, load_timestamp=sql.STAMP)
_ORDER = ["bronze_load_timestamp", "source_file_path"]


@query("stream_duplicate_flag", None)
def stream_duplicate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines arrive as they were loaded, day by day, and the stream is started anew for each day."""
    landing, target, state, checkpoint = (working_folder(spark, name) for name in ("lines", "flagged", "seen", "stream"))
    bronze = bronze_detailed(spark, sf_dir)
    positive = bronze.filter(ColumnCasts(bronze).money("AMOUNT") > 0)
    lines = silver.clean_detailed(positive, RUN).select(*silver.LINE_KEYS, *_ORDER)
    dated, staged = lines.withColumn("day", F.to_date("bronze_load_timestamp").cast("string")), working_folder(spark, "loaded")
    with sinks.unsorted_partitions(spark):
        sinks.write_tree(dated, staged, partitions=["day"])
    for day in ("2025-01-01", "2025-01-02"):
        of_day = spark.read.schema(dated.schema).parquet(staged).filter(F.col("day") == day)
        sinks.write_tree(of_day.drop("day"), f"{landing}/{day}")
        arriving = stateful.read_lines(spark, landing, lines.schema)
        stateful.flag_stream(arriving, silver.LINE_KEYS, _ORDER, _ORDER[0], target, state, checkpoint, 7 * 86400).awaitTermination()
    return spark.read.parquet(target).drop(stateful.EPOCH)


CHECKS["stream_duplicate_flag"] = (sql.with_tables(*sql.FROM_DETAILED) + """SELECT invoice_number, product_code,
  transaction_date, amount, bronze_load_timestamp, source_file_path, potential_duplicate_flag FROM detailed_invoices""").strip()


@query("stream_daily_totals", sql.with_tables(*sql.FROM_SUMMARIZED) + f"""SELECT transaction_date AS day, branch_code, count(*) AS rows,
  {", ".join(f"sum({column})::DECIMAL(25,2) AS {name}" for name, column in summary.TOTALS.items())}
FROM summarized_invoices WHERE transaction_date <> DATE '1900-01-01' GROUP BY ALL""")
def stream_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices arrive in three deliveries of some years each; the stream is started anew for each."""
    landing, target, checkpoint = (working_folder(spark, name) for name in ("invoices", "totals", "stream"))
    bronze = bronze_summarized(spark, sf_dir)
    years = F.substring("_processed_at", 1, 4).cast("int")
    for first, last in ((0, 1996), (1997, 1998), (1999, 9999)):
        sinks.write_tree(bronze.filter(years.between(first, last)), f"{landing}/{first}")
        arriving = spark.readStream.schema(bronze.schema).option("recursiveFileLookup", True).parquet(landing)
        invoices = silver.summarized_invoices(arriving, RUN).filter(F.col("transaction_date") != F.lit("1900-01-01").cast("date"))
        totals = stateful.daily_totals(invoices, "transaction_date", ["branch_code"], summary.TOTALS, "7 days")
        stateful.upsert_stream(totals, target, checkpoint).awaitTermination()
    return stateful.read_totals(spark, target, ["branch_code"])
