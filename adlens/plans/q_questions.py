"""The twelve canned questions over the campaign reports (whole tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlens.operators import marts, questions as Q
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import Driver

TOP_N = 10
MONTH = "1998-06"

CAMPAIGNS = """
, mc AS (SELECT campaign_name AS campaign, spend, month_start, mapped_brand FROM plat
         WHERE channel = 'meta' AND spend > 0),
gc AS (SELECT campaign_name AS campaign, spend, month_start, mapped_brand FROM plat
       WHERE channel = 'google' AND spend > 0)"""
BRANDS = CAMPAIGNS + f"""
, msb AS (SELECT mapped_brand AS brand, {S.dsum("spend")} AS meta_spend_inr FROM mc
          WHERE mapped_brand IS NOT NULL GROUP BY 1),
gsb AS (SELECT mapped_brand AS brand, {S.dsum("spend")} AS google_spend_inr FROM gc
        WHERE mapped_brand IS NOT NULL GROUP BY 1),
sb AS (SELECT coalesce(msb.brand, gsb.brand) AS brand, coalesce(meta_spend_inr, 0) AS meta_spend_inr,
              coalesce(google_spend_inr, 0) AS google_spend_inr,
              coalesce(meta_spend_inr, 0) + coalesce(google_spend_inr, 0) AS total_spend_inr
       FROM msb FULL OUTER JOIN gsb ON msb.brand = gsb.brand)"""
NAMED = "WHERE campaign IS NOT NULL AND trim(campaign) <> '' AND trim(campaign) <> '--'"


def _camps(d: Driver, *channels: str):
    return d.campaigns(*channels).select("channel", F.col("campaign_name").alias("campaign"), "spend", "month_start",
                                         "mapped_brand")


@query("ask_brand_spend_meta", S.BASE + BRANDS + f"""
SELECT brand, meta_spend_inr AS spend_inr FROM msb ORDER BY spend_inr DESC LIMIT {TOP_N}""")
def ask_brand_spend_meta(d: Driver):
    """Top brands by Meta spend."""
    return Q.brand_spend(_camps(d, "meta"), TOP_N)


@query("ask_brand_spend_google", S.BASE + BRANDS + f"""
SELECT brand, google_spend_inr AS spend_inr FROM gsb ORDER BY spend_inr DESC LIMIT {TOP_N}""")
def ask_brand_spend_google(d: Driver):
    """Top brands by Google spend."""
    return Q.brand_spend(_camps(d, "google"), TOP_N)


@query("ask_brand_spend_combined", S.BASE + BRANDS + f"""
SELECT * FROM sb ORDER BY total_spend_inr DESC LIMIT {TOP_N}""")
def ask_brand_spend_combined(d: Driver):
    """Top brands by Meta + Google spend (missing side counts 0)."""
    return Q.brand_spend_combined(_camps(d, "meta", "google"), TOP_N)


@query("ask_top_campaigns_meta", S.BASE + CAMPAIGNS + f"""
SELECT campaign, {S.dsum("spend")} AS spend_inr FROM mc {NAMED} GROUP BY 1 ORDER BY 2 DESC LIMIT {TOP_N}""")
def ask_top_campaigns_meta(d: Driver):
    return Q.top_campaigns(_camps(d, "meta"), TOP_N)


@query("ask_top_campaigns_google", S.BASE + CAMPAIGNS + f"""
SELECT campaign, {S.dsum("spend")} AS spend_inr FROM gc {NAMED} GROUP BY 1 ORDER BY 2 DESC LIMIT {TOP_N}""")
def ask_top_campaigns_google(d: Driver):
    return Q.top_campaigns(_camps(d, "google"), TOP_N)


@query("ask_top_campaigns_combined", S.BASE + CAMPAIGNS + f"""
, u AS (SELECT 'meta' AS channel, campaign, {S.dsum("spend")} AS spend_inr FROM mc {NAMED} GROUP BY 1, 2
        UNION ALL
        SELECT 'google', campaign, {S.dsum("spend")} FROM gc {NAMED} GROUP BY 1, 2)
SELECT channel, campaign, spend_inr FROM u ORDER BY spend_inr DESC LIMIT {TOP_N}""")
def ask_top_campaigns_combined(d: Driver):
    return Q.top_campaigns_combined(_camps(d, "meta", "google"), TOP_N)


PAID = S.BASE + """
, paid AS (SELECT month_start,
  CAST(SUM(CASE WHEN lower(channel) = 'meta' THEN CAST(spend AS DECIMAL(38,4)) ELSE 0 END) AS DOUBLE) AS meta_spend_inr,
  CAST(SUM(CASE WHEN lower(channel) = 'google' THEN CAST(spend AS DECIMAL(38,4)) ELSE 0 END) AS DOUBLE) AS google_spend_inr,
  CAST(SUM(CASE WHEN lower(channel) IN ('meta', 'google') THEN CAST(spend AS DECIMAL(38,4)) ELSE 0 END) AS DOUBLE) AS total_spend_inr
  FROM fact GROUP BY month_start)"""


@query("ask_total_spend_meta_month", PAID + f"""
SELECT month_start, meta_spend_inr AS spend_inr FROM paid WHERE month_start = '{MONTH}'""")
def ask_total_spend_meta_month(d: Driver):
    return Q.total_spend_month(marts.monthly_paid_spend(d.fact(months=[MONTH])), MONTH, "meta")


@query("ask_total_spend_google_month", PAID + f"""
SELECT month_start, google_spend_inr AS spend_inr FROM paid WHERE month_start = '{MONTH}'""")
def ask_total_spend_google_month(d: Driver):
    return Q.total_spend_month(marts.monthly_paid_spend(d.fact(months=[MONTH])), MONTH, "google")


@query("ask_total_spend_combined_month", PAID + f"""
SELECT month_start, meta_spend_inr, google_spend_inr, total_spend_inr FROM paid WHERE month_start = '{MONTH}'""")
def ask_total_spend_combined_month(d: Driver):
    return Q.total_spend_month(marts.monthly_paid_spend(d.fact(months=[MONTH])), MONTH, "combined")


@query("ask_total_spend_meta", S.BASE + CAMPAIGNS + f"""
SELECT 'meta' AS channel, {S.dsum("spend")} AS spend_inr, count(*) AS campaign_count FROM mc""")
def ask_total_spend_meta(d: Driver):
    return Q.total_spend(d.spend_rows("meta"), "meta")


@query("ask_total_spend_google", S.BASE + CAMPAIGNS + f"""
SELECT 'google' AS channel, {S.dsum("spend")} AS spend_inr, count(*) AS campaign_count FROM gc""")
def ask_total_spend_google(d: Driver):
    return Q.total_spend(d.spend_rows("google"), "google")


@query("ask_total_spend_combined", S.BASE + CAMPAIGNS + f"""
, totals AS (SELECT 'meta' AS channel, {S.dsum("spend")} AS spend_inr, count(*) AS campaign_count FROM mc
             UNION ALL
             SELECT 'google', {S.dsum("spend")}, count(*) FROM gc)
SELECT * FROM totals
UNION ALL
SELECT 'combined', {S.resum("spend_inr")}, CAST(SUM(campaign_count) AS BIGINT) FROM totals""")
def ask_total_spend_combined(d: Driver):
    """Meta, Google and combined spend and row counts (one grouping-sets aggregate)."""
    return Q.total_spend_combined(d.spend_rows("meta", "google"))
