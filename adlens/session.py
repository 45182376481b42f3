"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes, splits
# skewed shuffle partitions and coalesces small ones; ANSI stays on, so all
# casts and divisions in the library use the try_* forms.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "adlens", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass ``master=None`` and let
    spark-submit supply master, memory and ``spark.checkpoint.dir``."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stream state: ``spark.checkpoint.dir``. Machine-local
    folders would not survive a lost executor, so there is no other default."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder


_scratch: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Where derived tables are kept: ``spark.checkpoint.dir``. Only in local mode, where driver and executors are one
    process, a scratch folder stands in for it."""
    master = spark.sparkContext.master
    if spark.conf.get("spark.checkpoint.dir", None) or not (master == "local" or master.startswith("local[")):
        return checkpoint_dir(spark)
    if not _scratch:
        _scratch.append(tempfile.mkdtemp(prefix="adlens-store-"))
        atexit.register(shutil.rmtree, _scratch[0], ignore_errors=True)
    return "file://" + _scratch[0]
