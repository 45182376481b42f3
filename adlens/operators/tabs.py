"""Dashboard tabs: shares, layer pivots, month-over-month deltas and the
campaign drilldowns that join platform claims to store attribution.

Windows here always run on aggregated frames (month x channel), never on
raw rows, so a window partition is at most one channel's months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions.metrics import safe_div
from adlens.functions.numeric import money, resum, sum_money
from adlens.functions.text import campaign_key, relabel
from adlens.operators.marts import layer_pivot

# Fixed value: the note of the iROAS tab.
IROAS_NOTE = "Directional only: month-on-month proxy with limited data points."


def executive_tab(exec_df: DataFrame) -> DataFrame:
    return exec_df.withColumnsRenamed({
        "paid_spend_platform": "paid_spend",
        "paid_revenue_platform": "paid_revenue_paid_attribution",
        "paid_revenue_shopify": "paid_revenue_shopify_attribution"})


def spend_mix(fact: DataFrame, channel_labels: dict) -> DataFrame:
    """Platform spend per month and channel with its share of the month."""
    mix = (fact.where(F.col("attribution_layer") == "platform")
           .groupBy("month_start", "channel")
           .agg(F.coalesce(resum("spend"), F.lit(0.0)).alias("spend")))
    total = F.sum(money("spend", precision=38)).over(Window.partitionBy("month_start")).cast("double")
    return (mix.select("month_start", relabel("channel", channel_labels).alias("channel"), "spend",
                       total.alias("month_spend_total"))
            .withColumn("channel_spend_pct", safe_div("spend", "month_spend_total") * 100))


def _paid_vs_store(p: DataFrame, with_orders: bool) -> list:
    cols = [F.col("spend_platform").alias("paid_spend")]
    if with_orders:
        cols += [F.col("orders_platform"),
                 safe_div("spend_platform", "orders_platform").alias("cpa_platform")]
    cols += [F.col("revenue_platform").alias("revenue_paid_attribution"),
             F.col("revenue_shopify").alias("revenue_shopify_attribution"),
             safe_div("revenue_platform", "spend_platform").alias("roas_paid_attribution"),
             safe_div("revenue_shopify", "spend_platform").alias("roas_shopify_attribution")]
    if with_orders:
        cols += [(F.col("revenue_platform") - F.col("revenue_shopify"))
                 .alias("revenue_gap_paid_vs_shopify"),
                 safe_div(safe_div("revenue_platform", "spend_platform"),
                          safe_div("revenue_shopify", "spend_platform"))
                 .alias("roas_paid_over_shopify")]
    return cols


def conversion_insights(fact: DataFrame, channel_labels: dict) -> DataFrame:
    """Month x channel: paid spend, platform orders and CPA, both revenues,
    both ROAS, the gap and the ratio of the two ROAS."""
    p = layer_pivot(fact, ["month_start", "channel"], ["spend", "revenue", "orders"],
                    ("platform", "shopify"))
    return p.select("month_start", relabel("channel", channel_labels).alias("channel"),
                    *_paid_vs_store(p, True))


def capture_view(capture: DataFrame, channel_labels: dict) -> DataFrame:
    p = layer_pivot(capture, ["month_start", "channel"], ["spend", "revenue"], ("platform", "shopify"))
    return p.select("month_start", relabel("channel", channel_labels).alias("channel"),
                    *_paid_vs_store(p, False))


GEN_VIEW = [("meta_spend", "meta_spend"), ("meta_impressions", "meta_impressions"),
            ("meta_reach", "meta_reach"), ("Meta_New", "meta_new_customers"),
            ("google_branded_search_volume", "google_branded_search_volume"),
            ("D2C_New", "shopify_d2c_d2c_new_customers"),
            ("D2C_Repeat", "shopify_d2c_d2c_repeat_customers")]


def demand_generation_view(gen: DataFrame) -> DataFrame:
    """Long metrics to one row per month; a cell takes its (single) value."""
    key = F.concat_ws("_", F.lower("channel"), F.lower("metric_name"))
    return gen.groupBy("month_start").agg(*[
        F.max(F.when(key == k, F.col("metric_value"))).alias(name) for name, k in GEN_VIEW])


def incremental_roas(tab: DataFrame) -> DataFrame:
    """Month-over-month deltas per channel and iROAS = delta revenue / delta
    spend. "Previous" is the previous present month of the channel."""
    w = Window.partitionBy("channel").orderBy("month_start")
    d = lambda c: F.col(c) - F.lag(c).over(w)
    out = tab.select(
        "month_start", "channel", "paid_spend", "revenue_paid_attribution",
        "revenue_shopify_attribution",
        d("paid_spend").alias("delta_spend"),
        d("revenue_paid_attribution").alias("delta_revenue_paid_attribution"),
        d("revenue_shopify_attribution").alias("delta_revenue_shopify_attribution"),
        F.row_number().over(w).alias("data_points_used"))
    return out.select(
        "month_start", "channel", "paid_spend", "revenue_paid_attribution",
        "revenue_shopify_attribution", "delta_spend", "delta_revenue_paid_attribution",
        "delta_revenue_shopify_attribution",
        safe_div("delta_revenue_paid_attribution", "delta_spend").alias("iroas_paid_attribution"),
        safe_div("delta_revenue_shopify_attribution", "delta_spend").alias("iroas_shopify_attribution"),
        "data_points_used", F.lit(IROAS_NOTE).alias("notes"))


# ---------------------------------------------------------------------------
# Drilldowns: platform campaign rows joined to store rows on a normalised key.
# Both sides are aggregated to (month, key) before the join, so the join
# input is bounded by the number of campaigns, not the number of rows.
# ---------------------------------------------------------------------------

DRILL_METRICS = ["cpa_platform", "revenue_paid_attribution", "revenue_shopify_attribution",
                 "roas_paid_attribution", "roas_shopify_attribution",
                 "revenue_gap_paid_vs_shopify", "roas_paid_over_shopify"]


def first_present(df: DataFrame, candidates=("Order UTM content", "Order UTM campaign", "Order UTM medium")) -> str:
    """The first of the candidate UTM columns that a store export has; older exports lack some."""
    found = next((c for c in candidates if c in df.columns), None)
    if found is None:
        raise ValueError(f"none of {', '.join(candidates)} is a column")
    return found


def in_report_order(df: DataFrame, spend: str = "paid_spend") -> DataFrame:
    """A drilldown or mapping tab as it is shown: by month, then by falling spend. A global sort, so it is
    for presentation only and no other operator applies it."""
    return df.orderBy("month_start", F.desc(spend))


def _drill_metrics(df: DataFrame) -> list:
    return [
        safe_div("paid_spend", "orders_platform").alias("cpa_platform"),
        F.col("revenue_paid_attribution"), F.col("revenue_shopify_attribution"),
        safe_div("revenue_paid_attribution", "paid_spend").alias("roas_paid_attribution"),
        safe_div("revenue_shopify_attribution", "paid_spend").alias("roas_shopify_attribution"),
        (F.col("revenue_paid_attribution") - F.col("revenue_shopify_attribution"))
        .alias("revenue_gap_paid_vs_shopify"),
        safe_div(safe_div("revenue_paid_attribution", "paid_spend"),
                 safe_div("revenue_shopify_attribution", "paid_spend")).alias("roas_paid_over_shopify"),
    ]


def _store_by_key(store: DataFrame, key_col: str, revenue_col: str, aliases: dict) -> DataFrame:
    return (store.select("month_start", relabel(campaign_key(F.col(key_col)), aliases).alias("campaign_key"),
                         F.col(revenue_col).alias("_r"))
            .groupBy("month_start", "campaign_key")
            .agg(sum_money("_r").alias("revenue_shopify_attribution")))


def campaign_drilldown(platform: DataFrame, store: DataFrame, *, name_col: str, type_col: str,
                       spend_col: str, revenue_col: str, orders_col: str, store_key_col: str,
                       store_revenue_col: str, aliases: dict) -> DataFrame:
    """Search/shopping campaigns: platform rows (already focus-brand filtered)
    grouped by (month, campaign, type) and left-joined to store revenue on
    (month, campaign key); the key alias table applies to the store side."""
    plat = (platform.select("month_start", F.col(name_col).cast("string").alias("campaign_name"),
                            F.coalesce(F.col(type_col), F.lit("")).alias("campaign_type"),
                            F.col(spend_col).alias("_s"), F.col(revenue_col).alias("_r"),
                            F.col(orders_col).alias("_o"))
            .groupBy("month_start", "campaign_name", "campaign_type")
            .agg(sum_money("_s").alias("paid_spend"),
                 sum_money("_r").alias("revenue_paid_attribution"),
                 sum_money("_o").alias("orders_platform"))
            .withColumn("campaign_key", campaign_key("campaign_name")))
    j = plat.join(_store_by_key(store, store_key_col, store_revenue_col, aliases),
                  ["month_start", "campaign_key"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return (j.select("month_start", "campaign_name", "campaign_type", "paid_spend",
                     "orders_platform", *_drill_metrics(j))
            .where((z("paid_spend") > 0)
                   & (z("paid_spend") + z("orders_platform") + z("revenue_paid_attribution")
                      + z("revenue_shopify_attribution") != 0)))


def adset_drilldown(platform: DataFrame, store: DataFrame, *, name_col: str, setting_col: str,
                    spend_col: str, revenue_col: str, orders_col: str, store_key_col: str,
                    store_revenue_col: str) -> DataFrame:
    """Ad sets: as ``campaign_drilldown`` with the attribution setting in the
    grouping. ``store_key_col``: see ``first_present``."""
    plat = (platform.select("month_start", F.col(name_col).cast("string").alias("campaign_name"),
                            F.coalesce(F.col(setting_col), F.lit("")).alias("attribution_setting"),
                            F.col(spend_col).alias("_s"), F.col(revenue_col).alias("_r"),
                            F.col(orders_col).alias("_o"))
            .groupBy("month_start", "campaign_name", "attribution_setting")
            .agg(sum_money("_s").alias("paid_spend"),
                 sum_money("_r").alias("revenue_paid_attribution"),
                 sum_money("_o").alias("orders_platform"))
            .withColumn("campaign_key", campaign_key("campaign_name")))
    j = plat.join(_store_by_key(store, store_key_col, store_revenue_col, {}),
                  ["month_start", "campaign_key"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return (j.select("month_start", "campaign_name", "attribution_setting", "paid_spend",
                     "orders_platform", *_drill_metrics(j))
            .where((z("paid_spend") > 0)
                   & (z("paid_spend") + z("orders_platform") + z("revenue_paid_attribution") != 0)))


def campaign_brand_mapping(parts: list[DataFrame], include_unmapped: bool = False) -> DataFrame:
    """Spend per (month, platform, source, campaign, mapped brand, setting).

    ``parts`` hold those columns plus ``spend``. As in the dashboard,
    unmapped campaigns are dropped unless ``include_unmapped``; zero-spend
    groups are dropped.
    """
    keys = ["month_start", "platform", "source", "campaign_name", "mapped_brand",
            "attribution_setting"]
    u = parts[0].select(*keys, "spend")
    for p in parts[1:]:
        u = u.unionByName(p.select(*keys, "spend"))
    if not include_unmapped:
        u = u.where(F.col("mapped_brand").isNotNull())
    return (u.groupBy(*keys).agg(sum_money("spend").alias("spend"))
            .where(F.coalesce("spend", F.lit(0.0)) != 0))
