"""Period-report and demand-generation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlens.operators import marts, report, tabs
from adlens.params import EXPORT_CUSTOMER_BUCKETS
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import PLATFORM, Driver
from adlens.sources import tables

# Labels of the wide search matrix that count as branded search.
SEARCH_TOKEN = "r"


@query("budget_split", S.BASE + f", {S.MONTHS}" + f"""
, byo AS (
  SELECT month_start,
    {S.resum("CASE WHEN objective_class = 'demand_capture' THEN spend END")} AS cap,
    {S.resum("CASE WHEN objective_class = 'demand_generation' THEN spend END")} AS gen
  FROM fact WHERE attribution_layer = 'platform' GROUP BY month_start),
j AS (SELECT m.month_start, coalesce(cap, 0) AS demand_capture, coalesce(gen, 0) AS demand_generation
      FROM months m LEFT JOIN byo b ON b.month_start = m.month_start)
SELECT month_start, demand_capture, demand_generation, demand_capture + demand_generation AS total,
  demand_capture / NULLIF(demand_capture + demand_generation, 0) * 100 AS capture_share,
  demand_generation / NULLIF(demand_capture + demand_generation, 0) * 100 AS generation_share
FROM j""")
def budget_split(d: Driver):
    """Capture vs generation platform spend per report month (gaps are 0) and shares."""
    return report.budget_split(d.fact(layers=PLATFORM), d.months())


@query("objective_totals", S.BASE + f"""
, t AS (SELECT objective_class, coalesce({S.resum("spend")}, 0) AS spend,
               coalesce({S.resum("revenue")}, 0) AS revenue, coalesce({S.resum("orders")}, 0) AS orders
        FROM fact WHERE attribution_layer = 'platform' GROUP BY objective_class)
SELECT objective_class, spend, revenue, orders, revenue / NULLIF(spend, 0) AS roas,
  spend / NULLIF(CAST(SUM(CAST(spend AS DECIMAL(38,4))) OVER () AS DOUBLE), 0) * 100 AS spend_share
FROM t""")
def objective_totals(d: Driver):
    return report.objective_totals(d.fact(layers=PLATFORM))


@query("capture_by_channel", S.BASE + f"""
, t AS (SELECT channel, coalesce({S.resum("spend")}, 0) AS spend,
               coalesce({S.resum("revenue")}, 0) AS revenue, coalesce({S.resum("orders")}, 0) AS orders
        FROM fact WHERE attribution_layer = 'platform' AND objective_class = 'demand_capture'
        GROUP BY channel)
SELECT channel, spend, revenue, orders, revenue / NULLIF(spend, 0) AS roas,
  spend / NULLIF(orders, 0) AS cpa,
  spend / NULLIF(CAST(SUM(CAST(spend AS DECIMAL(38,4))) OVER () AS DOUBLE), 0) * 100 AS spend_share
FROM t""")
def capture_by_channel(d: Driver):
    return report.capture_by_channel(d.fact(layers=PLATFORM))


@query("generation_by_month", S.BASE + f"""
, t AS (SELECT month_start, {S.resum("spend")} AS spend, {S.resum("revenue")} AS revenue,
               {S.resum("orders")} AS orders
        FROM fact WHERE attribution_layer = 'platform' AND objective_class = 'demand_generation'
        GROUP BY month_start)
SELECT month_start, spend, revenue, orders, revenue / NULLIF(spend, 0) AS roas FROM t""")
def generation_by_month(d: Driver):
    return report.generation_by_month(d.fact(layers=PLATFORM))


@query("iroas_by_objective", S.BASE + f"""
, t AS (SELECT objective_class, month_start, {S.resum("spend")} AS spend, {S.resum("revenue")} AS revenue
        FROM fact WHERE attribution_layer = 'platform' GROUP BY objective_class, month_start),
dl AS (SELECT objective_class, month_start, lag(month_start) OVER w AS prev_month,
              spend - lag(spend) OVER w AS delta_spend, revenue - lag(revenue) OVER w AS delta_revenue
       FROM t WINDOW w AS (PARTITION BY objective_class ORDER BY month_start))
SELECT objective_class,
  strftime(CAST(prev_month || '-01' AS DATE), '%b %Y') || ' -> ' || strftime(CAST(month_start || '-01' AS DATE), '%b %Y') AS period,
  delta_spend, delta_revenue,
  CASE WHEN abs(delta_spend) >= {S.P.iroas_floor} THEN delta_revenue / NULLIF(delta_spend, 0) END AS iroas_proxy
FROM dl WHERE prev_month IS NOT NULL""")
def iroas_by_objective(d: Driver):
    """Month-over-month iROAS per objective, null under the spend-change floor."""
    return report.iroas_by_objective(d.fact(layers=PLATFORM), d.p.iroas_floor)


@query("spend_cut_iroas", S.BASE + f"""
, t AS (SELECT channel, month_start, {S.resum("spend")} AS spend, {S.resum("revenue")} AS revenue
        FROM fact WHERE attribution_layer = 'platform' GROUP BY channel, month_start),
dl AS (SELECT channel, lag(month_start) OVER w AS from_month, month_start AS to_month,
              lag(spend) OVER w AS from_spend, spend AS to_spend,
              lag(revenue) OVER w AS from_revenue, revenue AS to_revenue
       FROM t WINDOW w AS (PARTITION BY channel ORDER BY month_start))
SELECT *, from_spend - to_spend AS spend_cut, from_revenue - to_revenue AS revenue_drop,
  (from_revenue - to_revenue) / NULLIF(from_spend - to_spend, 0) AS iroas_of_cut
FROM dl WHERE to_spend < from_spend""")
def spend_cut_iroas(d: Driver):
    """Months where a channel's platform spend fell, with the iROAS of the cut."""
    return report.spend_cut_iroas(d.fact(layers=PLATFORM))


# -- demand generation -------------------------------------------------------

def _engagement(d: Driver):
    # Account-wide engagement needs no campaign attributes: read the ad rows
    # without the part join (every ad row has a campaign, so no row is lost).
    li = d.table("lineitem").where(F.col("l_returnflag") == "R")
    meta = li.select(F.date_format("l_shipdate", "yyyy-MM").alias("month_start"),
                     (F.col("l_extendedprice") * F.col("l_discount")).alias("spend"),
                     (F.col("l_quantity") * 100).alias("impressions"),
                     (F.col("l_quantity") * 60).alias("reach"))
    return marts.engagement_metrics(meta, d.p.brand_label, d.p.months)


def _search(d: Driver):
    weeks = tables.event_weeks(d.spark, d.sf_dir)
    m = tables.search_matrix(d.spark, d.sf_dir, weeks)
    return marts.branded_search_metrics(m, "label", SEARCH_TOKEN, {w: w[:7] for w in weeks}, d.p.brand_label)


def _new_vs_repeat(d: Driver):
    days = tables.customer_days(d.spark, d.sf_dir)
    return marts.customer_bucket_metrics(days, d.p.brand_label, EXPORT_CUSTOMER_BUCKETS, d.p.months,
                                         day="day", bucket="bucket", customers="customers")


GEN_SQL_PARTS = f"""
, eng AS (
  SELECT month_start, coalesce({S.dsum("spend")}, 0) AS spend,
         coalesce({S.dsum("impressions")}, 0) AS impressions, coalesce({S.dsum("reach")}, 0) AS reach
  FROM plat WHERE channel = 'meta' GROUP BY month_start),
eng_long AS (
  SELECT month_start, '{S.LABEL}' AS brand, 'meta' AS channel, metric_name, metric_value,
         'platform' AS attribution_layer, 'meta_d2c_adset_monthly' AS source_table
  FROM eng UNPIVOT (metric_value FOR metric_name IN (spend, impressions, reach))),
wk AS (
  SELECT event_type AS label, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, count(*) AS n
  FROM events GROUP BY 1, 2),
hits AS (SELECT * FROM wk WHERE lower(label) LIKE '%{SEARCH_TOKEN}%'),
search_long AS (
  SELECT p.month_start, '{S.LABEL}' AS brand, 'google' AS channel, 'branded_search_volume' AS metric_name,
         (SELECT {S.dsum("n")} FROM hits WHERE left(hits.week, 7) = p.month_start) AS metric_value,
         'blended' AS attribution_layer, 'brand_search_google_raw' AS source_table
  FROM (SELECT DISTINCT left(week, 7) AS month_start FROM wk) p
  WHERE EXISTS (SELECT 1 FROM hits)),
first AS (SELECT o_custkey, min(o_orderdate) AS first_day FROM orders GROUP BY o_custkey),
cdays AS (
  SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS day,
         CASE WHEN o.o_orderdate = f.first_day THEN 'New' ELSE 'Returning' END AS bucket,
         count(DISTINCT o.o_custkey) AS customers
  FROM orders o JOIN first f ON f.o_custkey = o.o_custkey GROUP BY 1, 2),
nvr_long AS (
  SELECT strftime(CAST(day AS DATE), '%Y-%m') AS month_start, '{S.LABEL}' AS brand,
         'shopify_d2c' AS channel,
         CASE lower(trim(bucket)) WHEN 'new' THEN 'd2c_new_customers'
              WHEN 'returning' THEN 'd2c_repeat_customers' END AS metric_name,
         {S.dsum("customers")} AS metric_value, 'shopify' AS attribution_layer,
         'shopify_new_vs_returning_daily' AS source_table
  FROM cdays GROUP BY 1, 4),
gen AS (SELECT * FROM eng_long UNION ALL SELECT * FROM search_long UNION ALL
        SELECT * FROM nvr_long WHERE metric_name IS NOT NULL)"""


@query("demand_generation_long", S.BASE + GEN_SQL_PARTS + " SELECT * FROM gen")
def demand_generation_long(d: Driver):
    """Long demand-generation metrics: engagement, branded search, new vs repeat customers."""
    return marts.demand_generation([_engagement(d), _search(d), _new_vs_repeat(d)], sort=False)


@query("search_unpivot", S.BASE + GEN_SQL_PARTS + " SELECT * FROM search_long")
def search_unpivot(d: Driver):
    """Wide label x week matrix: labels containing the token, every week's column to monthly rows."""
    return _search(d)


@query("new_vs_repeat", S.BASE + GEN_SQL_PARTS + " SELECT * FROM nvr_long WHERE metric_name IS NOT NULL")
def new_vs_repeat(d: Driver):
    """Daily new/returning customers rolled up to monthly metric rows."""
    return _new_vs_repeat(d)


GEN_VIEW_SQL = ", ".join(
    f"max(CASE WHEN lower(channel) || '_' || lower(metric_name) = '{k}' THEN metric_value END) AS \"{n}\""
    for n, k in tabs.GEN_VIEW)


@query("demand_generation_view", S.BASE + GEN_SQL_PARTS + f" SELECT month_start, {GEN_VIEW_SQL} FROM gen GROUP BY month_start")
def demand_generation_view(d: Driver):
    """One row per month with the demand-generation metrics side by side."""
    gen = marts.demand_generation([_engagement(d), _search(d), _new_vs_repeat(d)], sort=False)
    return tabs.demand_generation_view(gen)


SIGNAL_CELLS = [("meta_spend", "meta", "spend"), ("meta_impressions", "meta", "impressions"),
                ("meta_reach", "meta", "reach"), ("d2c_new", "shopify_d2c", "d2c_new_customers"),
                ("d2c_repeat", "shopify_d2c", "d2c_repeat_customers")]
SIGNAL_SQL = ", ".join(
    f"{S.resum(f'CASE WHEN channel = {S._q(c)} AND metric_name = {S._q(m)} THEN metric_value END')} AS {n}"
    for n, c, m in SIGNAL_CELLS)


@query("generation_signals", S.BASE + GEN_SQL_PARTS + f", {S.MONTHS}" + f"""
, piv AS (SELECT month_start, {SIGNAL_SQL} FROM gen GROUP BY month_start)
SELECT m.month_start, {", ".join("piv." + n for n, _, _ in SIGNAL_CELLS)}
FROM months m LEFT JOIN piv ON piv.month_start = m.month_start""")
def generation_signals(d: Driver):
    """Report months x selected (channel, metric) sums; months without data are null."""
    gen = marts.demand_generation([_engagement(d), _search(d), _new_vs_repeat(d)], sort=False)
    return report.generation_signals(gen, d.months(), SIGNAL_CELLS)
