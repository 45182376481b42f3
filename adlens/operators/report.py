"""Period-report numbers: budget split, objective totals, capture by channel,
generation trend and signals, and iROAS by objective with a spend floor.

All inputs are the platform layer of the fact (already aggregated), so the
shuffles here move months x channels, not raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions.dates import month_label
from adlens.functions.metrics import iroas_with_floor, pct, safe_div
from adlens.functions.numeric import money, resum

CAPTURE, GENERATION = "demand_capture", "demand_generation"


def _platform(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("attribution_layer") == "platform")


def _zero(c):
    return F.coalesce(c, F.lit(0.0))


def budget_split(fact: DataFrame, months: DataFrame) -> DataFrame:
    """Capture vs generation platform spend per month of ``months`` (missing
    months and objectives are 0) with both shares of the month total."""
    by = (_platform(fact).groupBy("month_start").agg(
        resum(F.when(F.col("objective_class") == CAPTURE, F.col("spend"))).alias(CAPTURE),
        resum(F.when(F.col("objective_class") == GENERATION, F.col("spend"))).alias(GENERATION)))
    j = months.join(by, "month_start", "left").select(
        "month_start", _zero(F.col(CAPTURE)).alias(CAPTURE), _zero(F.col(GENERATION)).alias(GENERATION))
    total = F.col(CAPTURE) + F.col(GENERATION)
    return j.select("month_start", CAPTURE, GENERATION, total.alias("total"),
                    pct(F.col(CAPTURE), total).alias("capture_share"),
                    pct(F.col(GENERATION), total).alias("generation_share"))


def objective_totals(fact: DataFrame) -> DataFrame:
    """Per objective over the whole period: spend, revenue, orders (0 when
    missing), ROAS and share of all spend."""
    t = (_platform(fact).groupBy("objective_class").agg(
        _zero(resum("spend")).alias("spend"), _zero(resum("revenue")).alias("revenue"),
        _zero(resum("orders")).alias("orders")))
    all_spend = F.sum(money("spend", precision=38)).over(Window.partitionBy()).cast("double")
    return t.select("objective_class", "spend", "revenue", "orders",
                    safe_div("revenue", "spend").alias("roas"),
                    pct(F.col("spend"), all_spend).alias("spend_share"))


def capture_by_channel(fact: DataFrame) -> DataFrame:
    """Capture channels over the period: totals, ROAS, CPA, share of capture spend."""
    t = (_platform(fact).where(F.col("objective_class") == CAPTURE).groupBy("channel").agg(
        _zero(resum("spend")).alias("spend"), _zero(resum("revenue")).alias("revenue"),
        _zero(resum("orders")).alias("orders")))
    all_spend = F.sum(money("spend", precision=38)).over(Window.partitionBy()).cast("double")
    return t.select("channel", "spend", "revenue", "orders",
                    safe_div("revenue", "spend").alias("roas"),
                    safe_div("spend", "orders").alias("cpa"),
                    pct(F.col("spend"), all_spend).alias("spend_share"))


def generation_by_month(fact: DataFrame) -> DataFrame:
    """Generation spend, revenue, orders and ROAS per month (null-preserving)."""
    t = (_platform(fact).where(F.col("objective_class") == GENERATION).groupBy("month_start")
         .agg(resum("spend").alias("spend"), resum("revenue").alias("revenue"),
              resum("orders").alias("orders")))
    return t.withColumn("roas", safe_div("revenue", "spend"))


def generation_signals(gen: DataFrame, months: DataFrame, cells: list) -> DataFrame:
    """Month x (channel, metric) sums for the listed cells; months with no
    value show null. ``cells``: (output column, channel, metric_name)."""
    piv = gen.groupBy("month_start").agg(*[
        resum(F.when((F.col("channel") == ch) & (F.col("metric_name") == m), F.col("metric_value")))
        .alias(name) for name, ch, m in cells])
    return months.join(piv, "month_start", "left")


def iroas_by_objective(fact: DataFrame, floor: float) -> DataFrame:
    """For each objective, every month against the previous present month:
    spend and revenue deltas and iROAS (null under the spend-change floor)."""
    t = (_platform(fact).groupBy("objective_class", "month_start")
         .agg(resum("spend").alias("spend"), resum("revenue").alias("revenue")))
    w = Window.partitionBy("objective_class").orderBy("month_start")
    prev = F.lag("month_start").over(w)
    d = t.select("objective_class", "month_start", prev.alias("prev_month"),
                 (F.col("spend") - F.lag("spend").over(w)).alias("delta_spend"),
                 (F.col("revenue") - F.lag("revenue").over(w)).alias("delta_revenue"))
    return (d.where(F.col("prev_month").isNotNull())
            .select("objective_class",
                    F.concat(month_label("prev_month"), F.lit(" -> "), month_label("month_start"))
                    .alias("period"),
                    "delta_spend", "delta_revenue",
                    iroas_with_floor("delta_revenue", "delta_spend", floor).alias("iroas_proxy")))


def spend_cut_iroas(fact: DataFrame, layer: str = "platform") -> DataFrame:
    """Months where a channel's spend fell: from/to values and the iROAS of
    the cut, -(revenue change) / (spend cut)."""
    t = (fact.where(F.col("attribution_layer") == layer).groupBy("channel", "month_start")
         .agg(resum("spend").alias("spend"), resum("revenue").alias("revenue")))
    w = Window.partitionBy("channel").orderBy("month_start")
    d = t.select("channel", F.lag("month_start").over(w).alias("from_month"),
                 F.col("month_start").alias("to_month"),
                 F.lag("spend").over(w).alias("from_spend"), F.col("spend").alias("to_spend"),
                 F.lag("revenue").over(w).alias("from_revenue"), F.col("revenue").alias("to_revenue"))
    d = d.where(F.col("to_spend") < F.col("from_spend"))
    cut = F.col("from_spend") - F.col("to_spend")
    drop = F.col("from_revenue") - F.col("to_revenue")
    return d.select("*", cut.alias("spend_cut"), drop.alias("revenue_drop"),
                    safe_div(drop, cut).alias("iroas_of_cut"))
