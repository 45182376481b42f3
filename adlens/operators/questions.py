"""The twelve canned business questions as DataFrame functions.

Inputs are the campaign reports (columns ``channel``, ``campaign``, ``spend``,
``month_start``, ``mapped_brand``) and the monthly paid-spend view. A top-n
question is ``orderBy(desc).limit(n)``, which plans as one
TakeOrderedAndProject (per-partition top-n, then a merge of n rows each); n is
taken as given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions.numeric import sum_money
from adlens.operators.marts import spend_by_brand, spend_by_brand_combined


def _top(df: DataFrame, by: str, n: int) -> DataFrame:
    if n < 1:
        raise ValueError("n must be 1 or more")
    return df.orderBy(F.desc(by)).limit(n)


def named_campaigns(df: DataFrame, month: str | None = None) -> DataFrame:
    """Campaign rows with a usable name (not null, not blank, not ``--``)."""
    t = F.trim(F.col("campaign").cast("string"))
    out = df.where(F.col("campaign").isNotNull() & (t != "") & (t != "--"))
    return out.where(F.col("month_start") == month) if month else out


def brand_spend(rows: DataFrame, n: int = 10) -> DataFrame:
    """Top brands by spend on one platform (brand_spend_meta / _google)."""
    return _top(spend_by_brand(rows, "spend_inr"), "spend_inr", n)


def brand_spend_combined(rows: DataFrame, n: int = 10) -> DataFrame:
    """Top brands by spend over rows of both channels."""
    return _top(spend_by_brand_combined(rows), "total_spend_inr", n)


def top_campaigns(df: DataFrame, n: int = 10, month: str | None = None) -> DataFrame:
    return _top(named_campaigns(df, month).groupBy("campaign").agg(sum_money("spend").alias("spend_inr")), "spend_inr", n)


def top_campaigns_combined(rows: DataFrame, n: int = 10, month: str | None = None) -> DataFrame:
    """Top campaigns of both channels: one pass, grouped by channel and name."""
    return _top(named_campaigns(rows, month).groupBy("channel", "campaign").agg(sum_money("spend").alias("spend_inr")),
                "spend_inr", n)


def total_spend_month(paid: DataFrame, month: str, scope: str) -> DataFrame:
    """One month's row of the monthly paid-spend view; scope meta, google or combined."""
    row = paid.where(F.col("month_start") == month)
    if scope == "meta":
        return row.select("month_start", F.col("meta_spend_inr").alias("spend_inr"))
    if scope == "google":
        return row.select("month_start", F.col("google_spend_inr").alias("spend_inr"))
    return row.select("month_start", "meta_spend_inr", "google_spend_inr", "total_spend_inr")


def total_spend(df: DataFrame, channel: str) -> DataFrame:
    """Spend and row count over a whole campaign report."""
    return df.agg(F.lit(channel).alias("channel"), sum_money("spend").alias("spend_inr"),
                  F.count(F.lit(1)).alias("campaign_count"))


def total_spend_combined(rows: DataFrame) -> DataFrame:
    """meta, google and combined rows in one aggregate: grouping sets
    ((channel), ()) over one scan of both reports."""
    g = (rows.rollup("channel").agg(sum_money("spend").alias("spend_inr"),
                                    F.count(F.lit(1)).alias("campaign_count")))
    return g.select(F.coalesce("channel", F.lit("combined")).alias("channel"),
                    "spend_inr", "campaign_count")
