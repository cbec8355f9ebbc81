"""File manifests and schema comparison, over listings derived from documents, labels and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.operators import manifest
from tillstone.operators.oplog import schema_change_history
from tillstone.operators.schema_evolution import schema_diff
from tillstone.queries.log_queries import _SQL_FILES, processed_files
from tillstone.queries.registry import query
from tillstone.sources.tables import read_table

_SQL_LISTING = """listing AS (
SELECT 'in/' || source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.parquet' AS file_path,
  md5(text) AS file_hash, n_chars AS last_modified FROM documents)"""
_SQL_MANIFEST = """manifest AS (
SELECT 'in/' || source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.parquet' AS file_path,
  CASE WHEN quality = 1 THEN md5(text) ELSE 'stale' END AS file_hash, n_chars + toxic AS last_modified,
  CASE WHEN toxic = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM documents JOIN labels USING (doc_id))"""


def _path() -> F.Column:
    return F.concat(
        F.lit("in/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"),
        F.lit(".parquet"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(
        _path().alias("file_path"), F.md5("text").alias("file_hash"), F.col("n_chars").alias("last_modified")
    )


def known_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = read_table(spark, sf_dir, "documents").join(read_table(spark, sf_dir, "labels"), "doc_id")
    return labelled.select(
        _path().alias("file_path"),
        F.when(F.col("quality") == 1, F.md5("text")).otherwise("stale").alias("file_hash"),
        (F.col("n_chars") + F.col("toxic")).alias("last_modified"),
        F.when(F.col("toxic") == 1, "FAILED").otherwise("SUCCESS").alias("status"),
    )


@query("new_files", f"""WITH {_SQL_LISTING}, {_SQL_MANIFEST} SELECT * FROM listing
WHERE file_path NOT IN (SELECT file_path FROM manifest WHERE status = 'SUCCESS')""")
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.new_files(listing(spark, sf_dir), known_files(spark, sf_dir))


@query("changed_files", f"""WITH {_SQL_LISTING}, {_SQL_MANIFEST} SELECT l.*, CASE WHEN m.file_path IS NULL THEN 'NEW'
  WHEN m.file_hash <> l.file_hash OR m.last_modified <> l.last_modified THEN 'CHANGED' ELSE 'UNCHANGED' END AS state
FROM listing l LEFT JOIN manifest m ON l.file_path = m.file_path""")
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.classify_files(listing(spark, sf_dir), known_files(spark, sf_dir))


@query("files_to_process", f"""WITH {_SQL_LISTING}, {_SQL_MANIFEST} SELECT l.* FROM listing l
LEFT JOIN manifest m ON l.file_path = m.file_path WHERE m.file_path IS NULL OR m.file_hash <> l.file_hash""")
def files_to_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.files_to_process(listing(spark, sf_dir), known_files(spark, sf_dir), by=("file_hash",))


@query("orphaned_outputs", f"""WITH {_SQL_LISTING}, {_SQL_MANIFEST} SELECT file_path,
  unnest([file_path || '.a', file_path || '.b']) AS output_file FROM listing
WHERE file_path NOT IN (SELECT file_path FROM manifest)""")
def orphaned_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = F.array(F.concat("file_path", F.lit(".a")), F.concat("file_path", F.lit(".b")))
    written = listing(spark, sf_dir).withColumn("output_files", outputs)
    return manifest.orphaned_outputs(written, known_files(spark, sf_dir))


@query("manifest_upsert", f"""WITH {_SQL_FILES} SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY file_path ORDER BY processed_at DESC) AS rn FROM processed_files)
WHERE rn = 1""")
def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = processed_files(spark, sf_dir)
    finished = F.col("status") == manifest.SUCCESS
    return manifest.upsert_latest(entries.filter(finished), entries.filter(~finished), "file_path", "processed_at")


@query("manifest_upsert_ties", f"""WITH {_SQL_FILES} SELECT file_path, 'again' AS status, MAX(processed_at) AS processed_at
FROM processed_files GROUP BY file_path""")
def manifest_upsert_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each file's latest entry arrives once more with the same stamp and another status: the new row wins."""
    entries = processed_files(spark, sf_dir).select("file_path", "status", "processed_at")
    again = entries.groupBy("file_path").agg(F.max("processed_at").alias("processed_at")).withColumn("status", F.lit("again"))
    return manifest.upsert_latest(entries, again, "file_path", "processed_at").select("file_path", "status", "processed_at")


@query("row_reconciliation", """SELECT COALESCE(s.file_path, t.file_path) AS file_path,
  COALESCE(source_rows, 0) AS source_rows, COALESCE(target_rows, 0) AS target_rows,
  COALESCE(source_rows, 0) - COALESCE(target_rows, 0) AS row_difference
FROM (SELECT source AS file_path, COUNT(*) AS source_rows FROM documents GROUP BY source) s
FULL JOIN (SELECT source AS file_path, COUNT(*) AS target_rows FROM documents JOIN labels USING (doc_id)
  WHERE quality = 1 GROUP BY source) t ON s.file_path = t.file_path""")
def row_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    good = documents.join(read_table(spark, sf_dir, "labels").filter("quality = 1"), "doc_id")
    counts = [
        df.groupBy(F.col("source").alias("file_path")).agg(F.count(F.lit(1)).alias("rows"))
        for df in (documents, good)
    ]
    return manifest.reconcile(*counts)


# Column catalogs: the columns each event type carried before and after a date.
_CUT = "2024-01-15 00:00:00"
_SQL_CATALOG = """SELECT event_type AS table_name, 'c' || CAST(user_id % 400 AS VARCHAR) AS column_name,
  CASE WHEN MAX(value) > 100 THEN 'double' ELSE 'bigint' END AS data_type FROM events
  WHERE ts {} TIMESTAMP '{}' GROUP BY ALL"""
_SQL_DIFF = f"""WITH old AS ({_SQL_CATALOG.format('<', _CUT)}), new AS ({_SQL_CATALOG.format('>=', _CUT)}),
diff AS (SELECT COALESCE(o.table_name, n.table_name) AS table_name, CASE WHEN o.column_name IS NULL THEN 'ADD_COLUMN'
  WHEN n.column_name IS NULL THEN 'REMOVE_COLUMN' ELSE 'TYPE_CHANGE' END AS change_type,
  COALESCE(o.column_name, n.column_name) AS column_name, o.data_type AS old_data_type, n.data_type AS new_data_type
FROM old o FULL JOIN new n ON o.table_name = n.table_name AND o.column_name = n.column_name
WHERE o.data_type IS DISTINCT FROM n.data_type)"""


def _catalogs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = read_table(spark, sf_dir, "events")
    cut = F.lit(_CUT).cast("timestamp_ntz")

    def catalog(rows: DataFrame) -> DataFrame:
        column = F.concat(F.lit("c"), (F.col("user_id") % 400).cast("string"))
        return rows.groupBy(F.col("event_type").alias("table_name"), column.alias("column_name")).agg(
            F.when(F.max("value") > 100, "double").otherwise("bigint").alias("data_type")
        )

    return catalog(events.filter(F.col("ts") < cut)), catalog(events.filter(F.col("ts") >= cut))


@query("schema_diff", _SQL_DIFF + " SELECT * FROM diff")
def schema_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_diff(*_catalogs(spark, sf_dir), by=["table_name"])


@query("schema_changes", _SQL_DIFF + f""" SELECT 'sales' AS feature_name, table_name, change_type, column_name,
  TIMESTAMP '{_CUT}' AS change_date FROM diff""")
def schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = schema_diff(*_catalogs(spark, sf_dir), by=["table_name"])
    logged = changes.withColumns({"feature_name": F.lit("sales"), "change_date": F.lit(_CUT).cast("timestamp_ntz")})
    return schema_change_history(logged)
