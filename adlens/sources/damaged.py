"""Damaged rows of CSV exports, set aside with their file, reason and raw text.

A row is damaged if it has more or fewer fields than its file's header (``fields``) or holds bytes that its file's
encoding doesn't know (``bytes``). All other rows load, also those of the same file. A file whose header has none of
the wanted columns loads no row: each of its rows is set aside (``header``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.sources.files import _escaped, _reader, by_head, existing

DAMAGED = "source_file string, reason string, record string"
ISSUES = "issue_type string, source_group string, month_start string, severity string, details string"
RAW = "_damaged_record"
#: What a decoder puts in place of bytes that it doesn't know.
UNKNOWN = "�"


def read_checked(spark: SparkSession, paths, columns: list | None = None, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, damaged): the sound rows as ``read_csv_strings`` gives them, and (source_file, reason, record) of the
    damaged ones, from one declared read of each header. Neither is computed before it is used. Paths that don't exist
    and empty files have no rows of either kind."""
    rows = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*(columns or []), "source_file"]))
    damaged = spark.createDataFrame([], DAMAGED)
    for group in by_head(spark, existing(spark, paths)):
        own = [_escaped(p) for p in group.paths]
        # all columns are parsed: with fewer, Spark doesn't count a row's fields
        reader = (_reader(spark, multi_line).option("encoding", group.encoding).option("columnPruning", False)
                  .option("columnNameOfCorruptRecord", RAW))
        header = reader.csv(own[0]).columns
        if not header:
            continue
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, RAW]])
        fields = [F.col(f"`{c}`") for c in header]
        held = F.concat_ws(",", *fields)
        known = not columns or any(c in header for c in columns)
        reason = (F.when(~F.lit(known), "header").when(F.col(RAW).isNotNull(), "fields")
                  .when(F.contains(held, F.lit(UNKNOWN)), "bytes"))
        df = reader.schema(schema).csv(own).select(
            *fields, F.url_decode(F.col("_metadata.file_path")).alias("source_file"),
            reason.alias("_reason"), F.coalesce(RAW, held).alias("_record"))
        damaged = damaged.unionAll(df.where("_reason is not null").select("source_file", "_reason", "_record"))
        if known:
            rows = rows.unionByName(df.where("_reason is null").drop("_reason", "_record"), allowMissingColumns=True)
    return rows.select(*(columns or [c for c in rows.columns if c != "source_file"]), "source_file"), damaged


def damage_issues(damaged: DataFrame) -> DataFrame:
    """An issue row per file and reason, in the shape of the data-quality issues."""
    return (damaged.groupBy("source_file", "reason").agg(F.count("*").alias("n"))
            .select(F.concat(F.lit("damaged_rows_"), "reason").alias("issue_type"), F.col("source_file").alias("source_group"),
                    F.lit("").alias("month_start"), F.lit("high").alias("severity"),
                    F.concat(F.col("n").cast("string"), F.lit(" rows set aside.")).alias("details")))


def store_damaged(damaged: DataFrame, path: str) -> None:
    """Keep damaged rows as Parquet, to be looked at or mended."""
    damaged.write.mode("overwrite").parquet(path)
