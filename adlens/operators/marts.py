"""Marts built on the conversion fact, plus the spend views of the SQL catalogue.

Layer pivots are written as conditional aggregation with the layer values
given explicitly (what ``pivot(col, values)`` compiles to): one aggregate,
no extra job to discover pivot values, and column names chosen here.
Re-sums of fact values go through fixed-point decimals, so totals do not
depend on partition order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.dates import day_to_month
from adlens.functions.metrics import safe_div
from adlens.functions.numeric import money, resum, sum_money, sum_money_or_zero, to_num

LAYERS = ("platform", "shopify", "blended")


def layer_pivot(df: DataFrame, index: list, measures: list, layers=LAYERS,
                layer_col: str = "attribution_layer") -> DataFrame:
    """index x layer pivot; columns named ``<measure>_<layer>``. A cell whose
    rows are all null, or that has no rows, is null."""
    aggs = [resum(F.when(F.col(layer_col) == l, F.col(m))).alias(f"{m}_{l}")
            for m in measures for l in layers]
    return df.groupBy(*index).agg(*aggs)


def reconciliation(fact: DataFrame, brand_label: str, channels=("google", "meta"),
                   sort: bool = False) -> DataFrame:
    """Platform-claimed vs store-attributed revenue per month and channel."""
    p = layer_pivot(fact.where(F.col("channel").isin(list(channels))),
                    ["month_start", "channel"], ["spend", "revenue"], ("platform", "shopify"))
    out = (p.withColumn("roas_platform", safe_div("revenue_platform", "spend_platform"))
           .withColumn("roas_shopify", safe_div("revenue_shopify", "spend_platform"))
           .withColumn("revenue_delta", F.col("revenue_platform") - F.col("revenue_shopify"))
           .withColumn("roas_delta", F.col("roas_platform") - F.col("roas_shopify"))
           .withColumn("brand", F.lit(brand_label))
           .withColumn("status", F.when(F.col("revenue_shopify").isNull(), "missing_shopify_layer")
                       .otherwise("ok"))
           .select("month_start", "brand", "channel", "spend_platform", "revenue_platform",
                   "revenue_shopify", "roas_platform", "roas_shopify", "revenue_delta",
                   "roas_delta", "status"))
    return out.orderBy("month_start", "channel") if sort else out


def exec_summary(fact: DataFrame, brand_label: str, total_revenue: DataFrame | None = None,
                 sort: bool = False) -> DataFrame:
    """Monthly paid summary across channels. Total revenue and MER stay null
    unless a total-revenue frame (month_start, total_revenue) is given."""
    p = layer_pivot(fact, ["month_start"], ["spend", "revenue"])
    out = p.select(
        "month_start", F.lit(brand_label).alias("brand"),
        F.col("spend_platform").alias("paid_spend_platform"),
        F.col("revenue_platform").alias("paid_revenue_platform"),
        F.col("revenue_shopify").alias("paid_revenue_shopify"),
        safe_div("revenue_platform", "spend_platform").alias("paid_roas_platform"),
        safe_div("revenue_shopify", "spend_platform").alias("paid_roas_shopify"))
    if total_revenue is None:
        out = (out.withColumn("total_revenue_all_channels", F.lit(None).cast("double"))
               .withColumn("mer", F.lit(None).cast("double"))
               .withColumn("status_notes", F.lit("Pending total revenue by channel file.")))
    else:
        out = (out.join(total_revenue.select("month_start", F.col("total_revenue")
                                             .alias("total_revenue_all_channels")),
                        "month_start", "left")
               .withColumn("mer", safe_div("total_revenue_all_channels", "paid_spend_platform"))
               .withColumn("status_notes", F.when(F.col("total_revenue_all_channels").isNull(),
                                                  "Pending total revenue by channel file.")
                           .otherwise("ok")))
    return out.orderBy("month_start") if sort else out


# ---------------------------------------------------------------------------
# Demand-generation mart (long / EAV form)
# ---------------------------------------------------------------------------

GEN_COLUMNS = ["month_start", "brand", "channel", "metric_name", "metric_value",
               "attribution_layer", "source_table"]


def _long(df: DataFrame, metrics: list, brand_label: str, channel: str, layer: str,
          source_table: str) -> DataFrame:
    return (df.unpivot(["month_start"], metrics, "metric_name", "metric_value")
            .select("month_start", F.lit(brand_label).alias("brand"), F.lit(channel).alias("channel"),
                    "metric_name", F.col("metric_value").cast("double").alias("metric_value"),
                    F.lit(layer).alias("attribution_layer"),
                    F.lit(source_table).alias("source_table")))


def engagement_metrics(rows: DataFrame, brand_label: str, months=None,
                       spend="spend", impressions="impressions", reach="reach",
                       channel="meta", source_table="meta_d2c_adset_monthly") -> DataFrame:
    """Monthly spend, impressions and reach (zero-filling sums). Not
    brand-filtered: the export is account-wide."""
    if months:
        rows = rows.where(F.col("month_start").isin(list(months)))
    agg = rows.groupBy("month_start").agg(
        sum_money_or_zero(to_num(F.col(spend))).alias("spend"),
        sum_money_or_zero(to_num(F.col(impressions))).alias("impressions"),
        sum_money_or_zero(to_num(F.col(reach))).alias("reach"))
    return _long(agg, ["spend", "impressions", "reach"], brand_label, channel, "platform", source_table)


def new_customer_metrics(rows: DataFrame, brand_label: str, months=None,
                         col: str = "New customers") -> DataFrame:
    """Monthly store new customers (null-preserving)."""
    if months:
        rows = rows.where(F.col("month_start").isin(list(months)))
    agg = rows.groupBy("month_start").agg(sum_money(to_num(F.col(col))).alias("new_customers"))
    return _long(agg, ["new_customers"], brand_label, "meta", "shopify", "meta_shopify_sales_monthly")


def branded_search_metrics(matrix: DataFrame, label_col: str, token: str, month_columns: dict,
                           brand_label: str, source_table: str = "brand_search_google_raw"
                           ) -> DataFrame:
    """Wide label x period matrix to long monthly rows.

    ``month_columns`` gives the month of every period column; columns of one month
    are added up. Every label containing ``token`` counts (sum, null when all
    null); a period column that is absent gives null. No matching label gives no rows.
    """
    rows = matrix.where(F.lower(F.col(label_col).cast("string")).contains(token.lower()))
    cols = set(matrix.columns)
    cells = F.array(*[F.struct(F.lit(m).alias("month_start"),
                               (to_num(F.col(f"`{c}`")) if c in cols else F.lit(None).cast("double")).alias("v"))
                      for c, m in month_columns.items()])
    if not month_columns:
        cells = F.array().cast("array<struct<month_start:string,v:double>>")
    return (rows.select(F.explode(cells).alias("p")).groupBy(F.col("p.month_start").alias("month_start"))
            .agg(sum_money("p.v").alias("v"))
            .select("month_start", F.lit(brand_label).alias("brand"),
                    F.lit("google").alias("channel"), F.lit("branded_search_volume").alias("metric_name"),
                    F.col("v").alias("metric_value"), F.lit("blended").alias("attribution_layer"),
                    F.lit(source_table).alias("source_table")))


def customer_bucket_metrics(daily: DataFrame, brand_label: str, buckets: dict, months=None,
                            day="Day", bucket="New or returning customer",
                            customers="Customers", month_fallback: str | None = None,
                            source_table: str = "shopify_new_vs_returning_daily") -> DataFrame:
    """Daily new/returning customers to monthly metric rows; buckets not in
    ``buckets`` are dropped."""
    m = F.create_map(*[F.lit(x) for kv in buckets.items() for x in kv])
    month = day_to_month(F.col(day), F.col(month_fallback) if month_fallback else None)
    d = daily.select(month.alias("month_start"),
                     m[F.lower(F.trim(F.col(bucket).cast("string")))].alias("metric_name"),
                     to_num(F.col(customers)).alias("customers"))
    if months:
        d = d.where(F.col("month_start").isin(list(months)))
    d = d.where(F.col("metric_name").isNotNull())
    agg = d.groupBy("month_start", "metric_name").agg(sum_money("customers").alias("metric_value"))
    return agg.select("month_start", F.lit(brand_label).alias("brand"),
                      F.lit("shopify_d2c").alias("channel"), "metric_name", "metric_value",
                      F.lit("shopify").alias("attribution_layer"), F.lit(source_table).alias("source_table"))


def demand_generation(parts: list[DataFrame], sort: bool = False) -> DataFrame:
    u = parts[0].select(*GEN_COLUMNS)
    for p in parts[1:]:
        u = u.unionByName(p.select(*GEN_COLUMNS))
    return u.orderBy("month_start", "channel", "metric_name") if sort else u


# ---------------------------------------------------------------------------
# SQL-catalogue views
# ---------------------------------------------------------------------------

def monthly_channel_spend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("month_start", "channel").agg(resum("spend").alias("spend_inr"))


def monthly_paid_spend(fact: DataFrame) -> DataFrame:
    """Meta, Google and both per month; a null spend in another channel counts as 0."""
    ch = F.lower(F.col("channel"))
    dec = money(F.col("spend"), precision=38)

    def cond(c: Column):
        return F.sum(F.when(c, dec).otherwise(F.lit(0))).cast("double")
    return (fact.groupBy("month_start").agg(
        cond(ch == "meta").alias("meta_spend_inr"),
        cond(ch == "google").alias("google_spend_inr"),
        cond(ch.isin("meta", "google")).alias("total_spend_inr")))


def spend_by_brand(rows: DataFrame, out_col: str) -> DataFrame:
    """Spend per mapped brand of one platform's rows (unmapped names excluded)."""
    return (rows.where(F.col("mapped_brand").isNotNull()).groupBy(F.col("mapped_brand").alias("brand"))
            .agg(sum_money("spend").alias(out_col)))


def spend_by_brand_combined(rows: DataFrame) -> DataFrame:
    """Spend per mapped brand on meta, on google and in total, in one pass over rows of
    both channels; a missing side is 0."""
    def side(channel: str) -> Column:
        return F.coalesce(sum_money(F.when(F.col("channel") == channel, F.col("spend"))), F.lit(0.0))
    return (rows.where(F.col("mapped_brand").isNotNull()).groupBy(F.col("mapped_brand").alias("brand"))
            .agg(side("meta").alias("meta_spend_inr"), side("google").alias("google_spend_inr"))
            .withColumn("total_spend_inr", F.col("meta_spend_inr") + F.col("google_spend_inr")))
