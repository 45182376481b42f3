"""Operators the documents specify without code: MER, weekly grain, tax
adjustment, channel-filtered summary, budget variance, cost per customer,
period-over-period, monthly brand spend, weighted rates, CPA bands, ad-set
roll-up, like-for-like window, spend response and conversion rate."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from adlens.functions.dates import add_months_str
from adlens.functions.metrics import TAX_FACTOR, pct, safe_div
from adlens.functions.numeric import resum, sum_money
from adlens.operators import marts, tabs
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import PLATFORM, Driver
from adlens.plans.q_core import EXEC_SQL, RECON_SQL
from adlens.plans.q_report import GEN_SQL_PARTS, _new_vs_repeat
from adlens.plans.q_tabs import TAB2

LIKE_FOR_LIKE_DAY = 27
CPA_LOW, CPA_HIGH = 70.0, 80.0
FILTER_CHANNELS = ["google", "meta"]


def _total_revenue(d: Driver):
    od = d.table("orders")
    return (od.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month_start"))
            .agg(sum_money("o_totalprice").alias("total_revenue")))


@query("mer", S.BASE + f"""
, piv AS (
  SELECT month_start,
         {S.resum("CASE WHEN attribution_layer = 'platform' THEN spend END")} AS sp,
         {S.resum("CASE WHEN attribution_layer = 'platform' THEN revenue END")} AS rp,
         {S.resum("CASE WHEN attribution_layer = 'shopify' THEN revenue END")} AS rs
  FROM fact GROUP BY month_start),
tr AS (SELECT strftime(o_orderdate, '%Y-%m') AS month_start, {S.dsum("o_totalprice")} AS total_revenue
       FROM orders GROUP BY 1)
SELECT p.month_start, '{S.LABEL}' AS brand, sp AS paid_spend_platform, rp AS paid_revenue_platform,
       rs AS paid_revenue_shopify, {S.div("rp", "sp")} AS paid_roas_platform,
       {S.div("rs", "sp")} AS paid_roas_shopify, tr.total_revenue AS total_revenue_all_channels,
       tr.total_revenue / NULLIF(sp, 0) AS mer,
       CASE WHEN tr.total_revenue IS NULL THEN 'Pending total revenue by channel file.' ELSE 'ok' END AS status_notes
FROM piv p LEFT JOIN tr ON tr.month_start = p.month_start""")
def mer(d: Driver):
    """Executive summary with total revenue (all orders) and MER = total revenue / paid spend."""
    return marts.exec_summary(d.fact(), d.p.brand_label, total_revenue=_total_revenue(d), sort=False)


@query("weekly_fact", S.WEEK_BASE + " SELECT * FROM fact")
def weekly_fact(d: Driver):
    """The conversion fact at week grain (week start, Monday)."""
    return d.fact(period="week")


@query("tax_adjusted_roas", S.BASE + f"""
SELECT month_start, channel, sub_channel, objective_class, spend, revenue,
       spend * {TAX_FACTOR} AS spend_with_tax, revenue / NULLIF(spend * {TAX_FACTOR}, 0) AS roas_tax_adjusted
FROM fact WHERE attribution_layer = 'platform'""")
def tax_adjusted_roas(d: Driver):
    """Platform spend with tax and the tax-adjusted ROAS."""
    f = d.fact(layers=PLATFORM)
    return f.select("month_start", "channel", "sub_channel", "objective_class", "spend", "revenue",
                    (F.col("spend") * TAX_FACTOR).alias("spend_with_tax"),
                    safe_div(F.col("revenue"), F.col("spend") * TAX_FACTOR).alias("roas_tax_adjusted"))


@query("channel_filtered_summary", EXEC_SQL.replace(
    "FROM fact GROUP BY month_start)",
    "FROM fact WHERE channel IN (" + ", ".join(f"'{c}'" for c in FILTER_CHANNELS) + ") GROUP BY month_start)"))
def channel_filtered_summary(d: Driver):
    """Executive summary recomputed for a channel subset (global channel filter)."""
    f = d.fact().where(F.col("channel").isin(FILTER_CHANNELS))
    return marts.exec_summary(f, d.p.brand_label, sort=False)


@query("budget_variance", S.BASE + f"""
, act AS (SELECT month_start, channel, {S.resum("spend")} AS actual_spend
          FROM fact WHERE attribution_layer = 'platform' GROUP BY 1, 2),
pln AS (SELECT strftime(CAST(month_start || '-01' AS DATE) + INTERVAL 12 MONTH, '%Y-%m') AS month_start, channel,
               actual_spend AS planned_spend FROM act)
SELECT a.month_start, a.channel, p.planned_spend, a.actual_spend,
       a.actual_spend - p.planned_spend AS variance,
       (a.actual_spend - p.planned_spend) / NULLIF(p.planned_spend, 0) * 100 AS variance_pct
FROM act a LEFT JOIN pln p ON p.month_start = a.month_start AND p.channel = a.channel""")
def budget_variance(d: Driver):
    """Planned vs actual platform spend per month and channel; the plan is the spend of the same month
    a year before. Every month's spend is its own actual and the plan of a later month, so one
    aggregate does both."""
    act = d.fact(layers=PLATFORM).groupBy("month_start", "channel").agg(resum("spend").alias("spend"))
    none = F.lit(None).cast("double")
    both = F.array(
        F.struct("month_start", F.col("spend").alias("actual_spend"), none.alias("planned_spend")),
        F.struct(add_months_str("month_start", 12).alias("month_start"), none.alias("actual_spend"),
                 F.col("spend").alias("planned_spend")))
    j = (act.select("channel", F.explode(both).alias("b")).groupBy(F.col("b.month_start").alias("month_start"), "channel")
         .agg(F.max("b.actual_spend").alias("actual_spend"), F.max("b.planned_spend").alias("planned_spend"))
         .where(F.col("actual_spend").isNotNull()))
    var = F.col("actual_spend") - F.col("planned_spend")
    return j.select("month_start", "channel", "planned_spend", "actual_spend", var.alias("variance"),
                    pct(var, F.col("planned_spend")).alias("variance_pct"))


@query("cost_per_new_customer", S.BASE + GEN_SQL_PARTS + f"""
, sp AS (SELECT month_start, {S.resum("spend")} AS paid_spend FROM fact
         WHERE attribution_layer = 'platform' GROUP BY 1),
cu AS (SELECT month_start,
              {S.resum("CASE WHEN metric_name = 'd2c_new_customers' THEN metric_value END")} AS new_customers,
              {S.resum("CASE WHEN metric_name = 'd2c_repeat_customers' THEN metric_value END")} AS repeat_customers
       FROM nvr_long GROUP BY 1)
SELECT sp.month_start, paid_spend, new_customers, repeat_customers,
       paid_spend / NULLIF(new_customers, 0) AS cost_per_new_customer,
       paid_spend / NULLIF(repeat_customers, 0) AS cost_per_repeat_customer
FROM sp LEFT JOIN cu ON cu.month_start = sp.month_start""")
def cost_per_new_customer(d: Driver):
    """Platform spend per new and per repeat store customer, by month."""
    sp = (d.fact(layers=PLATFORM).groupBy("month_start")
          .agg(resum("spend").alias("paid_spend")))
    nvr = _new_vs_repeat(d)
    cu = nvr.groupBy("month_start").agg(
        resum(F.when(F.col("metric_name") == "d2c_new_customers", F.col("metric_value"))).alias("new_customers"),
        resum(F.when(F.col("metric_name") == "d2c_repeat_customers", F.col("metric_value")))
        .alias("repeat_customers"))
    j = sp.join(cu, "month_start", "left")
    return j.select("month_start", "paid_spend", "new_customers", "repeat_customers",
                    safe_div("paid_spend", "new_customers").alias("cost_per_new_customer"),
                    safe_div("paid_spend", "repeat_customers").alias("cost_per_repeat_customer"))


@query("period_over_period", S.BASE + TAB2 + """
SELECT month_start, channel, paid_spend, revenue_paid_attribution,
  lag(paid_spend) OVER w AS prev_paid_spend,
  lag(revenue_paid_attribution) OVER w AS prev_revenue_paid_attribution,
  (paid_spend - lag(paid_spend) OVER w) / NULLIF(lag(paid_spend) OVER w, 0) * 100 AS paid_spend_pct_change,
  (revenue_paid_attribution - lag(revenue_paid_attribution) OVER w)
    / NULLIF(lag(revenue_paid_attribution) OVER w, 0) * 100 AS revenue_pct_change
FROM tab2 WINDOW w AS (PARTITION BY channel ORDER BY month_start)""")
def period_over_period(d: Driver):
    """Current vs previous month per channel with percent change."""
    t = tabs.conversion_insights(d.fact(), d.p.channel_labels)
    w = Window.partitionBy("channel").orderBy("month_start")
    ps, pr = F.lag("paid_spend").over(w), F.lag("revenue_paid_attribution").over(w)
    return t.select("month_start", "channel", "paid_spend", "revenue_paid_attribution",
                    ps.alias("prev_paid_spend"), pr.alias("prev_revenue_paid_attribution"),
                    pct(F.col("paid_spend") - ps, ps).alias("paid_spend_pct_change"),
                    pct(F.col("revenue_paid_attribution") - pr, pr).alias("revenue_pct_change"))


@query("brand_spend_monthly", S.BASE + f"""
SELECT month_start, platform, mapped_brand AS brand, {S.dsum("spend")} AS spend_inr
FROM plat WHERE channel IN ('meta', 'google') AND spend > 0 AND mapped_brand IS NOT NULL
GROUP BY 1, 2, 3""")
def brand_spend_monthly(d: Driver):
    """Spend by month, platform and mapped brand (month-filtered brand questions)."""
    rows = d.platform_rows().where(F.col("channel").isin("meta", "google") & (F.col("spend") > 0))
    m = rows.select("month_start", "platform",
                    F.col("mapped_brand").alias("brand"), "spend")
    return (m.where(F.col("brand").isNotNull()).groupBy("month_start", "platform", "brand")
            .agg(sum_money("spend").alias("spend_inr")))


@query("weighted_rates", S.BASE + f"""
, t AS (SELECT month_start, channel, {S.dsum("spend")} AS spend, {S.dsum("impressions")} AS impressions,
               {S.dsum("clicks")} AS clicks, {S.dsum("reach")} AS reach FROM plat GROUP BY 1, 2)
SELECT month_start, channel, spend, impressions, clicks, reach,
       clicks / NULLIF(impressions, 0) * 100 AS ctr, spend / NULLIF(impressions, 0) * 1000 AS cpm,
       spend / NULLIF(clicks, 0) AS cpc, impressions / NULLIF(reach, 0) AS frequency
FROM t""")
def weighted_rates(d: Driver):
    """Volume-weighted CTR, CPM, CPC and frequency per month and channel (sums, then ratios)."""
    t = (d.measures().groupBy("month_start", "channel").agg(
        sum_money("spend").alias("spend"), sum_money("impressions").alias("impressions"),
        sum_money("clicks").alias("clicks"), sum_money("reach").alias("reach")))
    return t.select("month_start", "channel", "spend", "impressions", "clicks", "reach",
                    pct(F.col("clicks"), F.col("impressions")).alias("ctr"),
                    (safe_div("spend", "impressions") * 1000).alias("cpm"),
                    safe_div("spend", "clicks").alias("cpc"),
                    safe_div("impressions", "reach").alias("frequency"))


@query("cpa_band", S.BASE + TAB2 + f"""
SELECT month_start, channel, cpa_platform,
       CASE WHEN cpa_platform IS NULL THEN NULL WHEN cpa_platform < {CPA_LOW} THEN 'scale'
            WHEN cpa_platform > {CPA_HIGH} THEN 'pause' ELSE 'hold' END AS cpa_band
FROM tab2""")
def cpa_band(d: Driver):
    """Scale / hold / pause band of each month-channel CPA."""
    t = tabs.conversion_insights(d.fact(), d.p.channel_labels)
    c = F.col("cpa_platform")
    return t.select("month_start", "channel", "cpa_platform",
                    F.when(c < CPA_LOW, "scale").when(c > CPA_HIGH, "pause")
                    .when(c.isNotNull(), "hold").alias("cpa_band"))


@query("adset_rollup", S.BASE + f"""
SELECT mapped_brand AS brand, campaign_type AS campaign, campaign_name AS adset,
       {S.dsum("spend")} AS spend, CAST(GROUPING(mapped_brand, campaign_type, campaign_name) AS INTEGER) AS level
FROM plat WHERE channel = 'meta' GROUP BY ROLLUP (mapped_brand, campaign_type, campaign_name)""")
def adset_rollup(d: Driver):
    """Ad set -> campaign -> brand spend roll-up (ROLLUP, one aggregate)."""
    rows = d.platform_rows().where(F.col("channel") == "meta").select(
        F.col("mapped_brand").alias("brand"),
        F.col("campaign_type").alias("campaign"), F.col("campaign_name").alias("adset"), "spend")
    return (rows.rollup("brand", "campaign", "adset")
            .agg(sum_money("spend").alias("spend"), F.grouping_id().cast("int").alias("level")))


@query("like_for_like", S.day_window_base(LIKE_FOR_LIKE_DAY) + RECON_SQL[len(S.BASE):])
def like_for_like(d: Driver):
    """Reconciliation with both sources cut to the same days of each month."""
    return marts.reconciliation(d.fact(max_day=LIKE_FOR_LIKE_DAY), d.p.brand_label, sort=False)


@query("spend_response", S.BASE + f"""
, t AS (SELECT channel, month_start, {S.resum("spend")} AS spend, {S.resum("revenue")} AS revenue
        FROM fact WHERE attribution_layer = 'platform' GROUP BY 1, 2),
r AS (SELECT channel, month_start, spend, revenue, revenue / NULLIF(spend, 0) AS roas,
             row_number() OVER (PARTITION BY channel ORDER BY spend, month_start) AS spend_rank,
             spend - lag(spend) OVER (PARTITION BY channel ORDER BY spend, month_start) AS delta_spend,
             revenue - lag(revenue) OVER (PARTITION BY channel ORDER BY spend, month_start) AS delta_revenue
      FROM t)
SELECT *, delta_revenue / NULLIF(delta_spend, 0) AS marginal_roas FROM r""")
def spend_response(d: Driver):
    """Per channel, months ordered by spend level: ROAS and marginal ROAS between levels."""
    t = (d.fact(layers=PLATFORM).groupBy("channel", "month_start")
         .agg(resum("spend").alias("spend"), resum("revenue").alias("revenue")))
    w = Window.partitionBy("channel").orderBy("spend", "month_start")
    r = t.select("channel", "month_start", "spend", "revenue", safe_div("revenue", "spend").alias("roas"),
                 F.row_number().over(w).alias("spend_rank"),
                 (F.col("spend") - F.lag("spend").over(w)).alias("delta_spend"),
                 (F.col("revenue") - F.lag("revenue").over(w)).alias("delta_revenue"))
    return r.withColumn("marginal_roas", safe_div("delta_revenue", "delta_spend"))


@query("conversion_rate", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count_if(event_type = 'view') AS visits,
       count_if(event_type = 'purchase') AS purchases,
       count_if(event_type = 'purchase') / NULLIF(count_if(event_type = 'view'), 0) AS conversion_rate
FROM events GROUP BY 1""")
def conversion_rate(d: Driver):
    """Purchases per page visit by day (event stream)."""
    ev = d.table("events")
    t = ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count_if(F.col("event_type") == "view").alias("visits"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    return t.withColumn("conversion_rate", safe_div(F.col("purchases").cast("double"),
                                                    F.col("visits").cast("double")))
