"""Bronze load: new files into one table per feature, type and detail level.

Every batch writes its own ``batch_id`` partition and its own log partitions, and a batch that is
run again replaces them. The file log is written last, so files of a batch that died midway are
still new to the next one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.functions.naming import bronze_table_name, feature_name, quoted, relative_path, source_path
from tillstone.operators.manifest import COMPLETED, FAILED, STARTED, SUCCESS, files_to_process, latest, new_files
from tillstone.operators.schema_evolution import LINEAGE, schema_diff, schema_rows, widens_to
from tillstone.sources.files import (
    damaged_files,
    file_row_counts,
    file_schemas,
    fingerprints,
    group_schema,
    list_files,
    readable,
    schema_groups,
    settled,
)
from tillstone.sources.sinks import SILVER_CODEC, SILVER_ZSTD_LEVEL, read_table_or_none, tidy, unsorted_partitions

# Features in load order.
FEATURES = ("sales", "supplies", "inventory")

# Batch ids from here on belong to streams, so that a load never writes into a stream's partitions. Each
# stream has a range of its own, one id a micro-batch.
FIRST_STREAM_BATCH = 1_000_000_000
STREAM_RANGE = 1_000_000
LAST_STREAM_BATCH = 2_147_483_647
_SOURCE = "__source_file"

OPERATION_SCHEMA = (
    "operation_id int, feature_name string, status string, files_processed int, rows_loaded bigint, "
    "started_at timestamp_ntz, completed_at timestamp_ntz, error_message string"
)
FILE_LOG_SCHEMA = (
    "file_path string, file_size bigint, last_modified timestamp, file_hash string, table_name string, feature string, "
    "records_count bigint, processed_at timestamp_ntz, status string, error_message string, operation_id int"
)


@dataclass(frozen=True)
class BronzeStore:
    """Where bronze tables and their logs live."""

    tables: str
    logs: str

    def table(self, name: str) -> str:
        return f"{self.tables}/{name}"

    def log(self, name: str) -> str:
        return f"{self.logs}/{name}"


def with_lineage(df: DataFrame, load_timestamp: str, batch_id: int) -> DataFrame:
    """Source file, load time and batch next to the file's own columns."""
    if _SOURCE in df.columns:
        df = df.drop("source_file_path").withColumnRenamed(_SOURCE, "source_file_path")
    elif "source_file_path" not in df.columns:
        df = df.select("*", source_path().alias("source_file_path"))
    return df.withColumns({
        "load_timestamp": F.lit(load_timestamp).cast("timestamp_ntz"),
        "batch_id": F.lit(batch_id).cast("int"),
    })


def append_by_name(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Rows of both frames, columns matched by name; a column one side lacks is NULL there."""
    if existing is None:
        return incoming
    return existing.unionByName(incoming, allowMissingColumns=True)


def write_batch(df: DataFrame, path: str, partitions: Sequence[str] = ("batch_id",)) -> None:
    """Write the partitions present in ``df``, replacing what an earlier try of the batch left."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.option("compression", SILVER_CODEC).option("parquet.compression.codec.zstd.level", SILVER_ZSTD_LEVEL)
    with tidy(df.sparkSession), unsorted_partitions(df.sparkSession):
        writer.partitionBy(*partitions).parquet(path)


def landing_files(spark: SparkSession, root: str, features: Sequence[str] = FEATURES, hashed: bool = False) -> DataFrame:
    """Listed Parquet files of the features, with the table each belongs to."""
    if hashed:
        listing = fingerprints(spark, root)
    else:
        listing = list_files(spark, root).withColumn("file_hash", F.lit(None).cast("string"))
    relative = relative_path(F.col("file_path"), root)
    routed = listing.withColumns({"feature": feature_name(relative), "table_name": bronze_table_name(relative)})
    return routed.filter(F.col("feature").isin(*features))


def read_file_log(spark: SparkSession, store: BronzeStore) -> DataFrame:
    log = read_table_or_none(spark, store.log("file_processing"))
    return spark.createDataFrame([], FILE_LOG_SCHEMA) if log is None else log


def _narrowing(source: T.StructType, target: T.StructType) -> list[str]:
    types = {field.name: field.dataType for field in target.fields}
    return [f.name for f in source.fields if f.name in types and not widens_to(f.dataType, types[f.name])]


def _misfits(df: DataFrame, names: Sequence[str], target: T.StructType) -> DataFrame:
    """Files holding a value their table's type cannot take."""
    types = {field.name: field.dataType for field in target.fields}
    lost = [F.col(n).isNotNull() & F.col(n).try_cast(types[n]).isNull() for n in names]
    bad = df.filter(reduce(Column.__or__, lost))
    return bad.groupBy(source_path().alias("file_path")).agg(
        F.lit("a value does not fit the table's type").alias("error_message")
    )


def _evolved(target: T.StructType | None, source: T.StructType) -> T.StructType:
    """Table schema after a file: new columns keep the file's type."""
    if target is None:
        return source
    known = set(target.names)
    return T.StructType(target.fields + [field for field in source.fields if field.name not in known])


def _batch_schemas(spark: SparkSession, store: BronzeStore, todo: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """The batch's files and their columns, written once so that later steps see the same list."""
    frames = []
    for name, rows in (("batch_files", todo), ("file_schemas", None)):
        rows = file_schemas(frames[0]) if rows is None else rows
        write_batch(rows.withColumn("batch_id", F.lit(batch_id)), store.log(name))
        written = read_table_or_none(spark, store.log(name))
        if written is None:
            written = spark.createDataFrame([], rows.withColumn("batch_id", F.lit(batch_id)).schema)
        frames.append(written.filter(F.col("batch_id") == batch_id).drop("batch_id"))
    return frames[0], frames[1]


def _read_group(
    spark: SparkSession, uris: Sequence[str], source: T.StructType, target: T.StructType
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of files that share a schema, in the table's types, and the files that do not fit."""
    frame = spark.read.option("recursiveFileLookup", True).schema(source).parquet(*readable(uris))
    narrowing = _narrowing(source, target)
    misfits = _misfits(frame, narrowing, target) if narrowing else None
    typed = [F.col(quoted(name)).try_cast(target[name].dataType).alias(name) for name in source.names if name not in LINEAGE]
    rows = frame.select(*typed, source_path().alias(_SOURCE))
    if misfits is not None:
        rows = rows.join(misfits.select(F.col("file_path").alias(_SOURCE)), _SOURCE, "left_anti")
    return rows, misfits


def _file_log(
    spark: SparkSession, store: BronzeStore, files: DataFrame, failures: Sequence[DataFrame], tables: Sequence[str],
    batch_id: int, load_timestamp: str,
) -> DataFrame:
    counts = [
        file_row_counts(table.filter(F.col("batch_id") == batch_id))
        for table in (read_table_or_none(spark, store.table(name)) for name in tables)
        if table is not None
    ]
    log = files.join(reduce(DataFrame.unionByName, failures), "file_path", "left")
    if counts:
        log = log.join(reduce(DataFrame.unionByName, counts), "file_path", "left")
    else:
        log = log.withColumn("rows", F.lit(None).cast("bigint"))
    failed = F.col("error_message").isNotNull()
    return log.select(
        "file_path", "file_size", "last_modified", "file_hash", "table_name", "feature",
        F.when(~failed, F.coalesce("rows", F.lit(0))).alias("records_count"),
        F.lit(load_timestamp).cast("timestamp_ntz").alias("processed_at"),
        F.when(failed, FAILED).otherwise(SUCCESS).alias("status"),
        "error_message",
        F.lit(batch_id).cast("int").alias("operation_id"),
    )


def _log_operations(spark: SparkSession, store: BronzeStore, rows: DataFrame | list[dict]) -> None:
    if isinstance(rows, list):
        text = OPERATION_SCHEMA.replace("timestamp_ntz", "string")
        names = T.StructType.fromDDL(text).names
        rows = spark.createDataFrame([{**dict.fromkeys(names), **row} for row in rows], text)
    columns = T.StructType.fromDDL(OPERATION_SCHEMA)
    write_batch(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns]), store.log("load_operations"), ("operation_id", "status"))


def load_operations(spark: SparkSession, store: BronzeStore) -> DataFrame:
    """Latest state of every batch and feature: STARTED, COMPLETED or FAILED."""
    events = read_table_or_none(spark, store.log("load_operations"))
    if events is None:
        return spark.createDataFrame([], OPERATION_SCHEMA)
    ended = events.withColumn("__ended", F.col("completed_at").isNotNull())
    return latest(ended, ["operation_id", "feature_name"], ["__ended", "completed_at"]).drop("__ended")


def load_bronze(
    spark: SparkSession,
    root: str,
    store: BronzeStore,
    batch_id: int,
    load_timestamp: str,
    features: Sequence[str] = FEATURES,
    path_only: bool = False,
    settle_seconds: int = 0,
) -> DataFrame:
    """Load files that are new or changed since the logged batches; returns the batch's file log.

    Changed means another size or modification time; ``path_only`` never reloads a known path.
    A file that cannot be read, or holds values its table cannot take, is logged as FAILED and does
    not stop the others. Files written less than ``settle_seconds`` ago may not be whole yet; they are left
    to the next batch. The operation log gets STARTED first, and COMPLETED or FAILED at the end.
    Spark's own file index keeps the paths of a read on the driver, so the new files of one batch are
    named there as well; contents and counts stay on executors.
    """
    if batch_id >= FIRST_STREAM_BATCH:
        raise ValueError(f"batch ids from {FIRST_STREAM_BATCH} on belong to streams")
    started = [{"operation_id": batch_id, "feature_name": f, "status": STARTED, "started_at": load_timestamp} for f in features]
    _log_operations(spark, store, started)
    try:
        log = _load(spark, root, store, batch_id, load_timestamp, features, path_only, settle_seconds)
    except Exception as error:
        _log_operations(spark, store, [{**row, "status": FAILED, "completed_at": load_timestamp, "error_message": str(error)} for row in started])
        raise
    loaded = F.col("status") == SUCCESS
    figures = log.groupBy(F.col("feature").alias("feature_name")).agg(
        F.count_if(loaded).cast("int").alias("files_processed"), F.sum(F.when(loaded, F.col("records_count"))).alias("rows_loaded"))
    named = spark.createDataFrame([(f,) for f in features], "feature_name string")
    stamp = F.lit(load_timestamp)
    _log_operations(spark, store, named.join(figures, "feature_name", "left").select(
        F.lit(batch_id).alias("operation_id"), "feature_name", F.lit(COMPLETED).alias("status"),
        F.coalesce("files_processed", F.lit(0)).alias("files_processed"), F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"),
        stamp.alias("started_at"), stamp.alias("completed_at"), F.lit(None).cast("string").alias("error_message")))
    return log


def _load(
    spark: SparkSession, root: str, store: BronzeStore, batch_id: int, load_timestamp: str, features: Sequence[str], path_only: bool,
    settle_seconds: int,
) -> DataFrame:
    listing = landing_files(spark, root, features)
    if settle_seconds:
        listing = settled(listing, F.current_timestamp(), settle_seconds)
    previous = read_file_log(spark, store)
    previous = previous.filter((F.col("operation_id") != batch_id) & (F.col("status") == SUCCESS))
    if path_only:
        todo = new_files(listing, previous)
    else:
        newest = F.struct("processed_at", "operation_id")
        loaded = previous.groupBy("file_path").agg(
            F.max_by("file_size", newest).alias("file_size"),
            F.max_by("last_modified", newest).alias("last_modified"),
        )
        todo = files_to_process(listing, loaded, by=("file_size", "last_modified"))
    files, schemas = _batch_schemas(spark, store, todo, batch_id)
    try:
        return _load_files(spark, store, files, schemas, batch_id, load_timestamp)
    except Exception:
        # a good footer does not say that all pages can be read: find the files that stopped the batch
        bad = damaged_files(files.join(schemas.filter(F.col("error_message").isNotNull()), "file_path", "left_anti"))
        write_batch(bad.withColumn("batch_id", F.lit(batch_id)), store.log("damaged_files"))
        found = read_table_or_none(spark, store.log("damaged_files"))
        found = None if found is None else found.filter(F.col("batch_id") == batch_id).drop("batch_id")
        if found is None or found.isEmpty():
            raise
        sound = schemas.join(found.select("file_path"), "file_path", "left_anti")
        errors = found.select("file_path", F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("column_name"),
                              F.lit(None).cast("string").alias("data_type"), "error_message")
        return _load_files(spark, store, files, sound.unionByName(errors), batch_id, load_timestamp)


def _load_files(
    spark: SparkSession, store: BronzeStore, files: DataFrame, schemas: DataFrame, batch_id: int, load_timestamp: str
) -> DataFrame:
    failures = [schemas.filter(F.col("error_message").isNotNull()).select("file_path", "error_message")]
    tables: dict[str, list] = {}
    for group in schema_groups(schemas, files, ["table_name"]).orderBy("table_name", "first_path").collect():
        tables.setdefault(group.table_name, []).append(group)
    for table_name, groups in tables.items():
        existing = read_table_or_none(spark, store.table(table_name))
        target = None
        if existing is not None:
            target = T.StructType([f for f in existing.schema.fields if f.name not in LINEAGE])
        parts, changes = [], []
        for group in groups:
            source = group_schema(group.columns)
            if target is not None and set(target.fields) != set(source.fields):
                changes.append(schema_diff(schema_rows(spark, target), schema_rows(spark, source)))
            target = _evolved(target, source)
            part, misfits = _read_group(spark, group.uris, source, target)
            parts.append(part)
            if misfits is not None:
                failures.append(misfits)
        rows = reduce(append_by_name, parts)
        write_batch(with_lineage(rows, load_timestamp, batch_id), store.table(table_name))
        if changes:
            log = reduce(DataFrame.unionByName, changes).select(
                F.lit(table_name.split("_")[1] if "_" in table_name else table_name).alias("feature_name"),
                F.lit(table_name).alias("table_name"), "change_type", "column_name", "old_data_type", "new_data_type",
                F.lit(load_timestamp).cast("timestamp_ntz").alias("change_date"), F.lit(batch_id).alias("operation_id"),
            )
            write_batch(log, store.log("schema_evolution"), ("operation_id", "table_name"))

    log = _file_log(spark, store, files, failures, list(tables), batch_id, load_timestamp)
    write_batch(log, store.log("file_processing"), ("operation_id",))
    return read_file_log(spark, store).filter(F.col("operation_id") == batch_id)


def current_rows(bronze: DataFrame, file_log: DataFrame) -> DataFrame:
    """Rows of each file's latest load, where a changed file was loaded more than once.

    Rows of files that the log does not name stay.
    """
    loads = file_log.filter(F.col("status") == SUCCESS).select(F.col("file_path").alias("source_file_path"), F.col("operation_id").alias("batch_id"), "processed_at")
    # without a join of the log with itself, whose size Spark guesses as a product: too large to broadcast
    by_file = loads.groupBy("source_file_path").agg(
        F.max_by("batch_id", F.struct("processed_at", "batch_id")).alias("__newest"), F.collect_set("batch_id").alias("__loads"))
    older = by_file.select("source_file_path", "__newest", F.explode("__loads").alias("batch_id")).filter(
        F.col("batch_id") != F.col("__newest")).select("source_file_path", "batch_id")
    return bronze.join(older, ["source_file_path", "batch_id"], "left_anti")


def first_stream_batch(spark: SparkSession, store: BronzeStore, stream: str) -> int:
    """First batch id of the range of a stream: as logged for its checkpoint, or the next free range.

    Ranges are told apart by the log alone, so streams of one store are started one after the other. Files
    that an older log holds beyond the ranges it names push the next range behind them.
    """
    known = read_table_or_none(spark, store.log("streams"))
    if known is not None:
        held = known.filter(F.col("stream") == stream).agg(F.min("first_batch_id")).first()[0]
        if held is not None:
            return held
    used = read_file_log(spark, store).agg(F.max("operation_id")).first()[0] or 0
    reserved = None if known is None else known.agg(F.max("first_batch_id")).first()[0]
    taken = max(used + 1, FIRST_STREAM_BATCH if reserved is None else reserved + STREAM_RANGE) - FIRST_STREAM_BATCH
    first = FIRST_STREAM_BATCH + -(-max(taken, 0) // STREAM_RANGE) * STREAM_RANGE
    if first + STREAM_RANGE - 1 > LAST_STREAM_BATCH:
        raise ValueError("all ranges of stream batch ids are in use")
    write_batch(spark.createDataFrame([(stream, first)], "stream string, first_batch_id int"), store.log("streams"), ("first_batch_id",))
    return first


def stream_batch(first: int, epoch: int) -> int:
    """Batch id of a micro-batch; a stream never leaves its range."""
    if not 0 <= epoch < STREAM_RANGE:
        raise ValueError(f"epoch {epoch} is outside a stream's range of {STREAM_RANGE} batches; start a new checkpoint")
    return first + epoch
