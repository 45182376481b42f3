"""Dashboard-tab queries: shares, layer pivots, deltas, drilldowns, mapping tab."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlens.operators import tabs
from adlens.operators.fact import demand_capture
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import PLATFORM, Driver

L = S.relabel()


@query("spend_mix", S.BASE + f"""
, mix AS (SELECT month_start, channel, coalesce({S.resum("spend")}, 0) AS spend
          FROM fact WHERE attribution_layer = 'platform' GROUP BY month_start, channel),
tot AS (SELECT *, CAST(SUM(CAST(spend AS DECIMAL(38,4))) OVER (PARTITION BY month_start) AS DOUBLE)
                  AS month_spend_total FROM mix)
SELECT month_start, {L} AS channel, spend, month_spend_total,
       {S.div("spend", "month_spend_total")} * 100 AS channel_spend_pct FROM tot""")
def spend_mix(d: Driver):
    """Platform spend mix per month with channel share (channel labels applied)."""
    return tabs.spend_mix(d.fact(layers=PLATFORM), d.p.channel_labels)


TAB2 = f"""
, piv AS (
  SELECT month_start, channel,
    {S.resum("CASE WHEN attribution_layer = 'platform' THEN spend END")} AS sp,
    {S.resum("CASE WHEN attribution_layer = 'platform' THEN revenue END")} AS rp,
    {S.resum("CASE WHEN attribution_layer = 'shopify' THEN revenue END")} AS rs,
    {S.resum("CASE WHEN attribution_layer = 'platform' THEN orders END")} AS op
  FROM fact GROUP BY month_start, channel),
tab2 AS (
  SELECT month_start, {L} AS channel, sp AS paid_spend, op AS orders_platform,
         {S.div("sp", "op")} AS cpa_platform, rp AS revenue_paid_attribution,
         rs AS revenue_shopify_attribution, {S.div("rp", "sp")} AS roas_paid_attribution,
         {S.div("rs", "sp")} AS roas_shopify_attribution, rp - rs AS revenue_gap_paid_vs_shopify,
         {S.div(S.div("rp", "sp"), S.div("rs", "sp"))} AS roas_paid_over_shopify
  FROM piv)"""


@query("conversion_insights", S.BASE + TAB2 + " SELECT * FROM tab2")
def conversion_insights(d: Driver):
    """Month x channel: paid spend, CPA, both revenues and ROAS, gap and ratio."""
    return tabs.conversion_insights(d.fact(), d.p.channel_labels)


@query("capture_view", S.BASE + f"""
, piv AS (
  SELECT month_start, channel,
    {S.resum("CASE WHEN attribution_layer = 'platform' THEN spend END")} AS sp,
    {S.resum("CASE WHEN attribution_layer = 'platform' THEN revenue END")} AS rp,
    {S.resum("CASE WHEN attribution_layer = 'shopify' THEN revenue END")} AS rs
  FROM fact WHERE objective_class = 'demand_capture' GROUP BY month_start, channel)
SELECT month_start, {L} AS channel, sp AS paid_spend, rp AS revenue_paid_attribution,
       rs AS revenue_shopify_attribution, {S.div("rp", "sp")} AS roas_paid_attribution,
       {S.div("rs", "sp")} AS roas_shopify_attribution FROM piv""")
def capture_view(d: Driver):
    return tabs.capture_view(demand_capture(d.fact()), d.p.channel_labels)


@query("incremental_roas", S.BASE + TAB2 + """
, dl AS (
  SELECT month_start, channel, paid_spend, revenue_paid_attribution, revenue_shopify_attribution,
    paid_spend - lag(paid_spend) OVER w AS delta_spend,
    revenue_paid_attribution - lag(revenue_paid_attribution) OVER w AS delta_revenue_paid_attribution,
    revenue_shopify_attribution - lag(revenue_shopify_attribution) OVER w AS delta_revenue_shopify_attribution,
    row_number() OVER w AS data_points_used
  FROM tab2 WINDOW w AS (PARTITION BY channel ORDER BY month_start))
SELECT month_start, channel, paid_spend, revenue_paid_attribution, revenue_shopify_attribution,
  delta_spend, delta_revenue_paid_attribution, delta_revenue_shopify_attribution,
  delta_revenue_paid_attribution / NULLIF(delta_spend, 0) AS iroas_paid_attribution,
  delta_revenue_shopify_attribution / NULLIF(delta_spend, 0) AS iroas_shopify_attribution,
  data_points_used, 'Directional only: month-on-month proxy with limited data points.' AS notes
FROM dl""")
def incremental_roas(d: Driver):
    """Month-over-month iROAS per channel from the conversion-insights tab."""
    return tabs.incremental_roas(tabs.conversion_insights(d.fact(), d.p.channel_labels))


DRILL_TAIL = """
SELECT month_start, campaign_name, {extra}, paid_spend, orders_platform,
  paid_spend / NULLIF(orders_platform, 0) AS cpa_platform,
  revenue_paid_attribution, revenue_shopify_attribution,
  revenue_paid_attribution / NULLIF(paid_spend, 0) AS roas_paid_attribution,
  revenue_shopify_attribution / NULLIF(paid_spend, 0) AS roas_shopify_attribution,
  revenue_paid_attribution - revenue_shopify_attribution AS revenue_gap_paid_vs_shopify,
  (revenue_paid_attribution / NULLIF(paid_spend, 0))
    / NULLIF(revenue_shopify_attribution / NULLIF(paid_spend, 0), 0) AS roas_paid_over_shopify
FROM j
WHERE coalesce(paid_spend, 0) > 0 AND {nonzero}"""


@query("campaign_drilldown", S.BASE + f"""
, gp AS (
  SELECT month_start, campaign_name, coalesce(campaign_type, '') AS campaign_type,
         {S.dsum("spend")} AS paid_spend, {S.dsum("revenue")} AS revenue_paid_attribution,
         {S.dsum("orders")} AS orders_platform
  FROM plat WHERE channel = 'google' AND mapped_brand = '{S.FOCUS}'
  GROUP BY month_start, campaign_name, coalesce(campaign_type, '')),
gs AS (
  SELECT month_start, {S.alias_key(S.key("utm_campaign"))} AS campaign_key,
         {S.dsum("revenue")} AS revenue_shopify_attribution
  FROM store WHERE channel = 'google' AND brand_google_campaign = '{S.FOCUS}' GROUP BY 1, 2),
j AS (SELECT gp.*, gs.revenue_shopify_attribution FROM gp
      LEFT JOIN gs ON gs.month_start = gp.month_start AND gs.campaign_key = {S.key("gp.campaign_name")})
""" + DRILL_TAIL.format(
    extra="campaign_type",
    nonzero="coalesce(paid_spend, 0) + coalesce(orders_platform, 0) + coalesce(revenue_paid_attribution, 0)"
            " + coalesce(revenue_shopify_attribution, 0) <> 0"))
def campaign_drilldown(d: Driver):
    """Google campaigns of the focus brand: platform claims vs store revenue by campaign key."""
    p = d.platform_rows(True).where(F.col("channel") == "google")
    s = d.store_rows(True).where(F.col("channel") == "google")
    return tabs.campaign_drilldown(
        p, s, name_col="campaign_name", type_col="campaign_type", spend_col="spend",
        revenue_col="revenue", orders_col="orders", store_key_col="utm_campaign",
        store_revenue_col="revenue", aliases=d.p.key_aliases)


@query("adset_drilldown", S.BASE + f"""
, gp AS (
  SELECT month_start, campaign_name, coalesce(attribution_setting, '') AS attribution_setting,
         {S.dsum("spend")} AS paid_spend, {S.dsum("revenue")} AS revenue_paid_attribution,
         {S.dsum("orders")} AS orders_platform
  FROM plat WHERE channel = 'meta' AND mapped_brand = '{S.FOCUS}'
  GROUP BY month_start, campaign_name, coalesce(attribution_setting, '')),
gs AS (
  SELECT month_start, {S.key("utm_campaign")} AS campaign_key,
         {S.dsum("revenue")} AS revenue_shopify_attribution
  FROM store WHERE channel = 'meta' AND brand_meta_campaign = '{S.FOCUS}' GROUP BY 1, 2),
j AS (SELECT gp.*, gs.revenue_shopify_attribution FROM gp
      LEFT JOIN gs ON gs.month_start = gp.month_start AND gs.campaign_key = {S.key("gp.campaign_name")})
""" + DRILL_TAIL.format(
    extra="attribution_setting",
    nonzero="coalesce(paid_spend, 0) + coalesce(orders_platform, 0) + coalesce(revenue_paid_attribution, 0) <> 0"))
def adset_drilldown(d: Driver):
    """Meta ad sets of the focus brand (by attribution setting) vs store revenue."""
    p = d.platform_rows(True).where(F.col("channel") == "meta")
    s = d.store_rows(True).where(F.col("channel") == "meta")
    return tabs.adset_drilldown(
        p, s, name_col="campaign_name", setting_col="attribution_setting", spend_col="spend",
        revenue_col="revenue", orders_col="orders", store_key_col="utm_campaign",
        store_revenue_col="revenue")


@query("campaign_brand_mapping", S.BASE + f"""
, u AS (
  SELECT month_start, 'google' AS platform, 'google_ads_campaigns_monthly' AS source, campaign_name,
         mapped_brand, '' AS attribution_setting, spend FROM plat WHERE channel = 'google'
  UNION ALL
  SELECT month_start, 'meta', 'meta_d2c_adset_monthly', campaign_name, mapped_brand,
         attribution_setting, spend FROM plat WHERE channel = 'meta')
SELECT month_start, platform, source, campaign_name, mapped_brand, attribution_setting,
       {S.dsum("spend")} AS spend
FROM u WHERE mapped_brand IS NOT NULL
GROUP BY month_start, platform, source, campaign_name, mapped_brand, attribution_setting
HAVING coalesce({S.dsum("spend")}, 0) <> 0""")
def campaign_brand_mapping(d: Driver):
    """Spend by campaign and mapped brand for Google campaigns and Meta ad sets."""
    google = F.col("channel") == "google"
    rows = d.platform_rows().where(F.col("channel").isin("google", "meta")).select(
        "month_start", F.col("channel").alias("platform"),
        F.when(google, "google_ads_campaigns_monthly").otherwise("meta_d2c_adset_monthly").alias("source"),
        "campaign_name", "mapped_brand",
        F.when(google, "").otherwise(F.col("attribution_setting")).alias("attribution_setting"), "spend")
    return tabs.campaign_brand_mapping([rows])
