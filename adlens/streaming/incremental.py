"""Incremental refresh of monthly staging partitions (weekly export drops).

New export files land in a drop folder. A Structured Streaming query over the
file listing picks up only files it has not seen (its checkpoint keeps that);
each micro-batch reads its files by column name and writes them to partitions
``month_start / source_key`` of the target. A file owns its partition, so
several files of one month stay side by side, and re-delivering a file
replaces that file's rows only (dynamic partition overwrite). Files whose name
has no month go to a quarantine table and are reported as issues.

The checkpoint has a fixed place under the cluster's ``spark.checkpoint.dir``,
so a later application goes on where the last one stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import checkpoint_dir
from adlens.sources.files import existing, read_group

LISTING = "path string, modificationTime timestamp, length long, content binary"
NO_MONTH_DETAIL = "The file name has no month; rows are in quarantine."


def quarantine_path(target: str) -> str:
    return target.rstrip("/") + "_quarantine"


def drop_stream(spark: SparkSession, drop_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the paths of new CSV files; contents are not loaded."""
    r = spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(drop_dir).select("path")


def source_key() -> Column:
    """Partition name of a file: its name made safe, and a hash of its path."""
    name = F.regexp_replace(F.regexp_extract("source_file", r"([^/]*)$", 1), r"[^0-9A-Za-z._-]", "_")
    return F.concat(name, F.lit("-"), F.hex(F.xxhash64("source_file")))


def store_files(spark: SparkSession, paths: list[str], target: str, columns: list[str]) -> None:
    """Write each file's rows to its own partition; files without a month to quarantine."""
    rows = read_group(spark, paths, columns).withColumn("source_key", source_key())

    def write(df: DataFrame, path: str, *by: str) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
    write(rows.where(F.col("month_start") != ""), target, "month_start", "source_key")
    lost = rows.where(F.col("month_start") == "").drop("month_start")
    if not lost.isEmpty():
        write(lost, quarantine_path(target), "source_key")


def quarantine_issues(spark: SparkSession, target: str) -> DataFrame:
    """An issue row per file in quarantine, in the shape of the data-quality issues."""
    schema = "issue_type string, source_group string, month_start string, severity string, details string"
    if not existing(spark, quarantine_path(target) + "/*/*.parquet"):
        return spark.createDataFrame([], schema)
    files = spark.read.parquet(quarantine_path(target)).select("source_file").distinct()
    return files.select(F.lit("file_without_month").alias("issue_type"), F.col("source_file").alias("source_group"),
                        F.lit("").alias("month_start"), F.lit("high").alias("severity"),
                        F.lit(NO_MONTH_DETAIL).alias("details"))


def refresh(spark: SparkSession, drop_dir: str, target: str, columns: list[str],
            name: str = "staging_refresh", once: bool = True, max_files_per_trigger: int | None = None):
    """Start (and with ``once`` run to completion) the refresh query."""
    return on_new_files(spark, drop_dir, lambda s, paths: store_files(s, paths, target, columns), name, once, max_files_per_trigger)


def on_new_files(spark: SparkSession, drop_dir: str, work: Callable[[SparkSession, list[str]], None], name: str, once: bool = True,
                 max_files_per_trigger: int | None = None):
    """Start (and with ``once`` run to completion) a query that hands the paths of new files to ``work``."""
    def batch(listing: DataFrame, _: int) -> None:
        paths = [r.path for r in listing.collect()]  # names of the new files
        if paths:
            work(listing.sparkSession, paths)
    place = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    q = (drop_stream(spark, drop_dir, max_files_per_trigger).writeStream.foreachBatch(batch)
         .option("checkpointLocation", place))
    q = q.trigger(availableNow=True) if once else q.trigger(processingTime="1 minute")
    handle = q.queryName(name).start()
    if once:
        handle.awaitTermination()
    return handle
