"""Core named queries: fact, marts and the SQL-catalogue views."""

from __future__ import annotations

from adlens.operators import marts
from adlens.operators.fact import demand_capture
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import Driver


@query("conversion_fact", S.BASE + " SELECT * FROM fact")
def conversion_fact(d: Driver):
    """Monthly conversion fact (month x channel x sub-channel x objective x layer)."""
    return d.fact()


@query("demand_capture", S.BASE + " SELECT * FROM fact WHERE objective_class = 'demand_capture'")
def demand_capture_q(d: Driver):
    return demand_capture(d.fact())


RECON_SQL = S.BASE + f"""
, piv AS (
  SELECT month_start, channel,
         {S.resum("CASE WHEN attribution_layer = 'platform' THEN spend END")} AS spend_platform,
         {S.resum("CASE WHEN attribution_layer = 'platform' THEN revenue END")} AS revenue_platform,
         {S.resum("CASE WHEN attribution_layer = 'shopify' THEN revenue END")} AS revenue_shopify
  FROM fact WHERE channel IN ('google', 'meta') GROUP BY month_start, channel)
SELECT month_start, '{S.LABEL}' AS brand, channel, spend_platform, revenue_platform, revenue_shopify,
       {S.div("revenue_platform", "spend_platform")} AS roas_platform,
       {S.div("revenue_shopify", "spend_platform")} AS roas_shopify,
       revenue_platform - revenue_shopify AS revenue_delta,
       {S.div("revenue_platform", "spend_platform")} - {S.div("revenue_shopify", "spend_platform")} AS roas_delta,
       CASE WHEN revenue_shopify IS NULL THEN 'missing_shopify_layer' ELSE 'ok' END AS status
FROM piv"""


@query("reconciliation", RECON_SQL)
def reconciliation(d: Driver):
    """Platform vs store revenue per month and channel, with deltas and status."""
    return marts.reconciliation(d.fact(), d.p.brand_label)


EXEC_SQL = S.BASE + f"""
, piv AS (
  SELECT month_start,
         {S.resum("CASE WHEN attribution_layer = 'platform' THEN spend END")} AS sp,
         {S.resum("CASE WHEN attribution_layer = 'platform' THEN revenue END")} AS rp,
         {S.resum("CASE WHEN attribution_layer = 'shopify' THEN revenue END")} AS rs
  FROM fact GROUP BY month_start)
SELECT month_start, '{S.LABEL}' AS brand, sp AS paid_spend_platform, rp AS paid_revenue_platform,
       rs AS paid_revenue_shopify, {S.div("rp", "sp")} AS paid_roas_platform,
       {S.div("rs", "sp")} AS paid_roas_shopify,
       CAST(NULL AS DOUBLE) AS total_revenue_all_channels, CAST(NULL AS DOUBLE) AS mer,
       'Pending total revenue by channel file.' AS status_notes
FROM piv"""


@query("exec_summary", EXEC_SQL)
def exec_summary(d: Driver):
    """Monthly paid spend/revenue across channels, both ROAS (MER pending)."""
    return marts.exec_summary(d.fact(), d.p.brand_label)


@query("monthly_channel_spend", S.BASE + f"""
SELECT month_start, channel, {S.resum("spend")} AS spend_inr FROM fact GROUP BY month_start, channel""")
def monthly_channel_spend(d: Driver):
    return marts.monthly_channel_spend(d.fact())


@query("monthly_paid_spend", S.BASE + """
SELECT month_start,
  CAST(SUM(CASE WHEN lower(channel) = 'meta' THEN CAST(spend AS DECIMAL(38,4)) ELSE 0 END) AS DOUBLE) AS meta_spend_inr,
  CAST(SUM(CASE WHEN lower(channel) = 'google' THEN CAST(spend AS DECIMAL(38,4)) ELSE 0 END) AS DOUBLE) AS google_spend_inr,
  CAST(SUM(CASE WHEN lower(channel) IN ('meta', 'google') THEN CAST(spend AS DECIMAL(38,4)) ELSE 0 END) AS DOUBLE) AS total_spend_inr
FROM fact GROUP BY month_start""")
def monthly_paid_spend(d: Driver):
    return marts.monthly_paid_spend(d.fact())
