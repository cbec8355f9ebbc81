"""Tables kept as whole versions: readers see a version only once all of it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.sources.sinks import SILVER_CODEC, read_table_or_none, write_tree


class VersionedTable:
    """Versions below ``path``. A version that is written again replaces itself; older ones stay readable.

    The log row that makes a version visible is written after its rows, so a job that dies midway leaves
    readers at the version before.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self, version: int) -> str:
        return f"{self.path}/rows/{version}"

    def write(self, df: DataFrame, version: int, stamp: str) -> None:
        write_tree(df, self._rows(version), codec=SILVER_CODEC)
        logged = self.spark.createDataFrame([(version, stamp)], "version int, written_at string")
        writer = logged.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version")
        writer.parquet(f"{self.path}/log")

    def versions(self) -> DataFrame | None:
        return read_table_or_none(self.spark, f"{self.path}/log")

    def latest(self) -> int | None:
        log = self.versions()
        return None if log is None else log.agg(F.max("version")).first()[0]

    def read(self, version: int | None = None) -> DataFrame | None:
        """Rows of a version, the latest by default; None where none was written."""
        version = self.latest() if version is None else version
        return None if version is None else self.spark.read.parquet(self._rows(version))
