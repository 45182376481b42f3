"""Marts kept up to date by deltas: a delivered file changes only its own partial sums and its month.

* ``partials``  sums by the fact's keys of every file, in partitions ``month_start / source_key``. A file owns its
  partition: delivering it again replaces (so retracts) what it gave before and adds what it gives now, in one dynamic
  overwrite. A file that gives nothing any more leaves a row without keys, so that its old sums go too.
* ``fact``, ``reconciliation``, ``exec_summary``  (K1, K4, K5) in partitions by month. Only the months of the delivered
  files are written again, from their partial sums; exports are not read again, other months aren't touched.

Sums are decimals, so adding them up in parts gives the totals of a full rebuild to the last digit. A batch that is lost
half-way is delivered again by the stream, and writing the same files twice changes nothing. Files without a month in
their name are skipped here (the staging refresh puts them in quarantine).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions.dates import month_from_name
from adlens.operators import marts
from adlens.operators.fact import FACT_KEYS, ExportSource, finished, stage_export
from adlens.operators.mapping import BrandMap
from adlens.params import Params
from adlens.sources.files import read_group
from adlens.streaming.incremental import on_new_files, source_key

MEASURES = ("spend", "revenue", "orders")
_SUMS = ", ".join(f"{m} decimal(38,4)" for m in MEASURES)
PARTIALS = ", ".join(f"{k} string" for k in FACT_KEYS if k != "month_start") + f", {_SUMS}, month_start string, source_key string"


class DeltaMarts:
    """The marts of one focus brand under ``root``."""

    def __init__(self, spark: SparkSession, root: str, params: Params):
        self.spark, self.root, self.p = spark, root.rstrip("/"), params

    def _bmap(self) -> BrandMap:
        return BrandMap.from_rows(self.spark, self.p.brand_rules)

    def partial_sums(self, paths: Sequence[str], source: ExportSource) -> DataFrame:
        """Sums by fact key and file of the focus brand's rows, and a row without keys for each file."""
        rows = read_group(self.spark, list(paths)).where("month_start <> ''").withColumn("source_key", source_key())
        staged = stage_export(rows, source, self._bmap(), self.p.focus_brand, self.p.generation_tokens, keep=("source_key",))
        own = staged.where(F.col("mapped_brand") == self.p.focus_brand)
        # a null measure stays null, as in the full fact
        sums = own.groupBy(*FACT_KEYS, "source_key").agg(
            *[F.sum(F.col(m).cast("decimal(18,4)")).cast("decimal(38,4)").alias(m) for m in MEASURES])
        names = sums.columns
        # from the names of the files: a file may have no rows left
        files = self.spark.createDataFrame([(self._as_listed(p),) for p in paths], "source_file string")
        marks = (files.withColumn("month_start", month_from_name(F.regexp_extract("source_file", r"([^/]*)$", 1)))
                 .where("month_start <> ''").select("month_start", source_key().alias("source_key")))
        return sums.unionByName(marks, allowMissingColumns=True).select(*names)

    def _as_listed(self, path: str) -> str:
        """A file's path as Spark's readers report it, with its file system, decoded."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).makeQualified(place).toString()

    def partials(self, months: Sequence[str] | None = None) -> DataFrame:
        df = self.spark.read.schema(PARTIALS).parquet(f"{self.root}/partials").where("channel is not null")
        return df.where(F.col("month_start").isin(list(months))) if months else df

    def deliver(self, paths: Sequence[str], source: ExportSource) -> list[str]:
        """Take in new or corrected files of one source; returns the months that were written again."""
        sums = self.partial_sums(paths, source)
        _replace(sums, f"{self.root}/partials", "month_start", "source_key")
        months = sorted(r.month_start for r in sums.select("month_start").distinct().collect())  # of the delivered files
        if months:
            self._rebuild(months)
        return months

    def fact_of(self, months: Sequence[str] | None = None) -> DataFrame:
        sums = self.partials(months).groupBy(*FACT_KEYS).agg(*[F.sum(m).cast("double").alias(m) for m in MEASURES])
        return finished(sums, self.p.brand_label)

    def _rebuild(self, months: list[str]) -> None:
        fact = self.fact_of(months)
        for name, df in (("fact", fact), ("reconciliation", marts.reconciliation(fact, self.p.brand_label)),
                         ("exec_summary", marts.exec_summary(fact, self.p.brand_label))):
            none = self.spark.createDataFrame([(m,) for m in months], "month_start string").withColumn("_live", F.lit(False))
            every = df.withColumn("_live", F.lit(True)).unionByName(none, allowMissingColumns=True)
            _replace(every.coalesce(1), f"{self.root}/{name}", "month_start")  # a month of a mart is some rows

    def mart(self, name: str) -> DataFrame:
        """``fact``, ``reconciliation`` or ``exec_summary`` as it stands."""
        empty = self.partials().limit(0)
        fact = finished(empty.groupBy(*FACT_KEYS).agg(*[F.sum(m).cast("double").alias(m) for m in MEASURES]), self.p.brand_label)
        like = {"fact": lambda: fact, "reconciliation": lambda: marts.reconciliation(fact, self.p.brand_label),
                "exec_summary": lambda: marts.exec_summary(fact, self.p.brand_label)}[name]()
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema if f.name != "month_start"]
        kept = self.spark.read.schema(", ".join([*fields, "_live boolean", "month_start string"])).parquet(f"{self.root}/{name}")
        return kept.where("_live").select(*like.columns)


def _replace(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def refresh_marts(spark: SparkSession, drop_dir: str, target: DeltaMarts, source: ExportSource, name: str, once: bool = True,
                  max_files_per_trigger: int | None = None):
    """Deliver every new file of a drop folder to ``target``."""
    return on_new_files(spark, drop_dir, lambda s, paths: target.deliver(paths, source), name, once, max_files_per_trigger)
