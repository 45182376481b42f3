"""Report families known from output files: order gap by campaign type and
the brand x channel metric report (source value next to store value)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from adlens.functions.metrics import safe_div
from adlens.functions.numeric import money, resum, sum_money
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import Driver


@query("order_gap_by_type", S.BASE + f"""
, p AS (SELECT lower(campaign_type) AS campaign_type, {S.dsum("orders")} AS platform_orders
        FROM plat WHERE channel = 'google' AND mapped_brand = '{S.FOCUS}' GROUP BY 1),
s AS (SELECT lower(utm_medium) AS campaign_type, {S.dsum("orders")} AS store_orders
      FROM store WHERE channel = 'google' AND brand_google_campaign = '{S.FOCUS}' GROUP BY 1),
j AS (SELECT coalesce(p.campaign_type, s.campaign_type) AS campaign_type, platform_orders, store_orders,
             coalesce(platform_orders, 0) - coalesce(store_orders, 0) AS gap
      FROM p FULL OUTER JOIN s ON p.campaign_type = s.campaign_type)
SELECT *, abs(gap) / NULLIF(CAST(SUM(CAST(abs(gap) AS DECIMAL(38,4))) OVER () AS DOUBLE), 0) AS abs_gap_share
FROM j""")
def order_gap_by_type(d: Driver):
    """Platform vs store orders per campaign type (full outer), gap and share of absolute gap."""
    p = (d.platform_rows(True).where(F.col("channel") == "google")
         .groupBy(F.lower("campaign_type").alias("campaign_type"))
         .agg(sum_money("orders").alias("platform_orders")))
    s = (d.store_rows(True).where(F.col("channel") == "google")
         .groupBy(F.lower("utm_medium").alias("campaign_type"))
         .agg(sum_money("orders").alias("store_orders")))
    j = p.join(s, "campaign_type", "full").select(
        "campaign_type", "platform_orders", "store_orders",
        (F.coalesce("platform_orders", F.lit(0.0)) - F.coalesce("store_orders", F.lit(0.0))).alias("gap"))
    tot = F.sum(money(F.abs("gap"), precision=38)).over(Window.partitionBy()).cast("double")
    return j.withColumn("abs_gap_share", safe_div(F.abs(F.col("gap")), tot))


@query("brand_metric_long", S.BASE + f"""
, src AS (SELECT mapped_brand AS brand, channel, {S.dsum("spend")} AS spend, {S.dsum("revenue")} AS revenue,
                 {S.dsum("orders")} AS orders
          FROM plat WHERE channel IN ('google', 'meta') AND mapped_brand IS NOT NULL GROUP BY 1, 2),
sto AS (SELECT CASE WHEN channel = 'google' THEN brand_google_campaign ELSE brand_meta_campaign END AS brand,
               channel, {S.dsum("revenue")} AS revenue, {S.dsum("orders")} AS orders
        FROM store WHERE channel IN ('google', 'meta')
          AND (CASE WHEN channel = 'google' THEN brand_google_campaign ELSE brand_meta_campaign END) IS NOT NULL
        GROUP BY 1, 2),
j AS (SELECT coalesce(src.brand, sto.brand) AS brand, coalesce(src.channel, sto.channel) AS channel,
             src.spend AS s_spend, src.revenue AS s_revenue, src.orders AS s_orders,
             sto.revenue AS t_revenue, sto.orders AS t_orders
      FROM src FULL OUTER JOIN sto ON src.brand = sto.brand AND src.channel = sto.channel)
SELECT 'spend' AS metric_type, brand, channel, s_spend AS source_value, CAST(NULL AS DOUBLE) AS shopify_value FROM j
UNION ALL SELECT 'revenue', brand, channel, s_revenue, t_revenue FROM j
UNION ALL SELECT 'orders', brand, channel, s_orders, t_orders FROM j""")
def brand_metric_long(d: Driver):
    """Metric x brand x channel with the platform value next to the store value (all brands)."""
    rows = d.platform_rows().where(F.col("channel").isin("google", "meta"))
    src = (rows.select(F.col("mapped_brand").alias("brand"), "channel", "spend", "revenue", "orders")
           .where(F.col("brand").isNotNull()).groupBy("brand", "channel")
           .agg(sum_money("spend").alias("s_spend"), sum_money("revenue").alias("s_revenue"),
                sum_money("orders").alias("s_orders")))
    st = d.store_rows().where(F.col("channel").isin("google", "meta"))
    sto = (st.select(F.col("campaign_brand").alias("brand"), "channel", "revenue", "orders").where(F.col("brand").isNotNull())
           .groupBy("brand", "channel")
           .agg(sum_money("revenue").alias("t_revenue"), sum_money("orders").alias("t_orders")))
    j = src.join(sto, ["brand", "channel"], "full")
    arr = F.array(
        F.struct(F.lit("spend").alias("metric_type"), F.col("s_spend").alias("source_value"),
                 F.lit(None).cast("double").alias("shopify_value")),
        F.struct(F.lit("revenue").alias("metric_type"), F.col("s_revenue").alias("source_value"),
                 F.col("t_revenue").alias("shopify_value")),
        F.struct(F.lit("orders").alias("metric_type"), F.col("s_orders").alias("source_value"),
                 F.col("t_orders").alias("shopify_value")))
    return (j.select("brand", "channel", F.explode(arr).alias("m"))
            .select("m.metric_type", "brand", "channel", "m.source_value", "m.shopify_value"))
