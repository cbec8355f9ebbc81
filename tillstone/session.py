"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Memory, executor and shuffle-partition counts are left to the
# cluster; AQE coalesces small shuffle partitions and splits skewed join partitions at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods above 8000 bytes. Wide projections reach that, and then run
    # several times faster as many small methods than as one interpreted one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def build_session(app_name: str = "tillstone", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above. ``master`` is only for local runs; spark-submit sets its own."""
    builder = SparkSession.builder.appName(app_name)
    settings = dict(BASE_CONF)
    if master is not None:
        builder = builder.master(master)
        settings.update(LOCAL_CONF)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder the cluster names in ``spark.checkpoint.dir``.

    Executors must see the folder, so a machine-local one is used only where the setting is unset
    and the session runs in local mode.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tillstone-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
