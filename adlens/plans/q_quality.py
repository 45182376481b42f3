"""Data-quality and mapping-audit queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from adlens.functions.numeric import sum_money
from adlens.operators import audit, quality
from adlens.params import EXPORT_MONTHLY_SOURCES
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import Driver

FIXED_PENDING = [("PENDING::total_revenue_by_channel::all", "total_revenue_by_channel", "all",
                  "Pending total revenue by month across channels.",
                  "Share the monthly total revenue file.")]


def _found(d: Driver):
    li = d.table("lineitem")
    f = F.col("l_returnflag")
    plat = li.select(F.when(f == "A", "google_ads_campaign").when(f == "R", "meta_d2c_adset")
                     .when(f == "N", "meta_blinkit").alias("source_group"),
                     F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    od = d.table("orders")
    pr = F.col("o_orderpriority")
    store = od.select(F.when(pr.isin("1-URGENT", "2-HIGH"), "google_shopify")
                      .when(pr == "3-MEDIUM", "meta_shopify_sales").alias("source_group"),
                      F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return plat.unionByName(store).where(F.col("source_group").isNotNull())


def _coverage(d: Driver):
    return quality.coverage_grid(_found(d), EXPORT_MONTHLY_SOURCES, d.months())


COV_SQL = S.with_ctes(S.MONTHS) + """
, found AS (
  SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 'google_ads_campaign' WHEN 'R' THEN 'meta_d2c_adset'
                  WHEN 'N' THEN 'meta_blinkit' END AS source_group, strftime(l_shipdate, '%Y-%m') AS month
  FROM lineitem
  UNION
  SELECT DISTINCT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'google_shopify'
                  WHEN o_orderpriority = '3-MEDIUM' THEN 'meta_shopify_sales' END, strftime(o_orderdate, '%Y-%m')
  FROM orders),
srcs AS (SELECT * FROM (VALUES """ + ", ".join(f"('{s}')" for s in EXPORT_MONTHLY_SOURCES) + """) t(source_group)),
cov AS (
  SELECT s.source_group, m.month_start AS month,
         CASE WHEN f.source_group IS NULL THEN 'missing' ELSE 'available' END AS status
  FROM srcs s CROSS JOIN months m
  LEFT JOIN found f ON f.source_group = s.source_group AND f.month = m.month_start)"""


@query("coverage_grid", COV_SQL + " SELECT * FROM cov")
def coverage_grid(d: Driver):
    """available/missing per expected (source group, month)."""
    return _coverage(d)


@query("dq_issues", COV_SQL + f"""
, pend AS (
  SELECT 'PENDING::' || source_group || '::' || month AS relative_path, source_group, month AS parsed_month,
         '{quality.PENDING_ACTION}' AS action_required FROM cov WHERE status = 'missing'
  UNION ALL SELECT '{FIXED_PENDING[0][0]}', '{FIXED_PENDING[0][1]}', '{FIXED_PENDING[0][2]}',
                   '{FIXED_PENDING[0][4]}')
SELECT 'missing_source_month' AS issue_type, source_group, month AS month_start, 'high' AS severity,
       '{quality.MISSING_DETAIL}' AS details FROM cov WHERE status = 'missing'
UNION ALL
SELECT 'awaited_file', source_group, parsed_month, 'high', action_required FROM pend""")
def dq_issues(d: Driver):
    """Missing source-months and awaited files (coverage gaps plus a fixed pending file)."""
    return quality.gap_issues(_coverage(d), FIXED_PENDING)


@query("manifest_pending", COV_SQL + f"""
SELECT 'PENDING::' || source_group || '::' || month AS relative_path, source_group, month AS parsed_month,
       '{quality.PENDING_NOTE}' AS notes, '{quality.PENDING_ACTION}' AS action_required, 'awaited' AS status
FROM cov WHERE status = 'missing'
UNION ALL SELECT {", ".join(S._q(v) for v in FIXED_PENDING[0])}, 'awaited'""")
def manifest_pending(d: Driver):
    """Pending manifest rows derived from coverage gaps, plus the fixed awaited file."""
    return quality.pending_rows(_coverage(d), FIXED_PENDING)


def _entities(d: Driver):
    return d.platform_rows().select(F.col("source_table").alias("source"), "platform", "month_start",
                                    F.col("campaign_name").alias("entity_name"), "mapped_brand")


GUARD_SQL = S.BASE + f"""
, e AS (SELECT source_table AS source, month_start, coalesce(campaign_name, '') AS entity_name, mapped_brand, count(*) AS n_rows
        FROM plat GROUP BY 1, 2, 3, 4),
v AS (
  SELECT 'must_map_to_focus' AS rule, source, month_start, entity_name, mapped_brand, 'violation' AS status,
         'Entity contains {'/'.join(S.P.must_map_tokens)} but did not map to {S.FOCUS}.' AS details, n_rows
  FROM e WHERE ({" OR ".join(f"lower(entity_name) LIKE '%{t}%'" for t in S.P.must_map_tokens)})
    AND NOT coalesce(mapped_brand = '{S.FOCUS}', false)
  UNION ALL
  SELECT 'must_not_map_to_focus', source, month_start, entity_name, mapped_brand, 'violation',
         'Entity contains {'/'.join(S.P.must_not_map_tokens)} but mapped to {S.FOCUS}.', n_rows
  FROM e WHERE ({" OR ".join(f"lower(entity_name) LIKE '%{t}%'" for t in S.P.must_not_map_tokens)})
    AND coalesce(mapped_brand = '{S.FOCUS}', false))
SELECT * FROM v
UNION ALL
SELECT 'all', '', '', '', NULL, 'ok', '{quality.GUARDRAIL_OK}', 0
WHERE NOT EXISTS (SELECT 1 FROM v)"""


@query("guardrails", GUARD_SQL)
def guardrails(d: Driver):
    """Brand-map guardrails per name and month; one ok row when nothing is violated."""
    return quality.guardrails(_entities(d), d.p.focus_brand, d.p.must_map_tokens, d.p.must_not_map_tokens,
                              rules=d.bmap.candidates)


def _conf_sql(col: str) -> str:
    hi = " OR ".join(f"lower({col}) LIKE '%{t}%'" for t in S.P.high_tokens)
    lo = " OR ".join(f"lower({col}) LIKE '%{t}%'" for t in S.P.low_tokens)
    return f"CASE WHEN {hi} THEN 'high' WHEN {lo} THEN 'low' ELSE 'medium' END"


AUDIT_SQL = S.BASE + f"""
, ents AS (SELECT DISTINCT source_table AS source, platform, month_start, campaign_name AS entity_name
           FROM plat WHERE campaign_name IS NOT NULL),
ea AS (SELECT e.source, e.platform, e.month_start, e.entity_name, b.brand AS mapped_brand,
              {_conf_sql("e.entity_name")} AS confidence,
              coalesce(regexp_matches(e.entity_name, '{S.P.signal_regex}'), false) AS signal
       FROM ents e LEFT JOIN map_best b ON b.n = lower(e.entity_name) AND b.platform = e.platform),
cand AS (SELECT * FROM ea WHERE signal AND mapped_brand IS DISTINCT FROM '{S.FOCUS}')"""


def _audit(d: Driver):
    ents = audit.audit_entities([_entities(d)], d.p.high_tokens, d.p.low_tokens,
                                d.p.signal_regex)
    return audit.audit_candidates(ents, d.p.focus_brand)


@query("audit_candidates", AUDIT_SQL + " SELECT * FROM cand")
def audit_candidates(d: Driver):
    """Entities with a focus-brand signal that do not map to the focus brand."""
    return _audit(d)


@query("mapping_audit", AUDIT_SQL + """
SELECT source, mapped_brand, confidence, count(*) AS entities FROM cand GROUP BY 1, 2, 3""")
def mapping_audit(d: Driver):
    """Audit summary: candidate counts per source, mapped brand and confidence."""
    return audit.audit_summary(_audit(d))


@query("duplicate_keys", S.BASE + """
SELECT month_start, channel, campaign_name, attribution_setting, count(*) AS n_rows
FROM plat GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""")
def duplicate_keys(d: Driver):
    """Curated keys that repeat (ad rows per month, channel, campaign, setting)."""
    return quality.duplicate_keys(d.raw_platform_rows(),
                                  ["month_start", "channel", "campaign_name", "attribution_setting"])


NULL_KEYS = ["month_start", "channel", "campaign_name", "campaign_type", "attribution_setting"]


@query("null_keys", S.BASE + " UNION ALL ".join(
    f" SELECT '{k}' AS key_column, count(*) AS n_rows, count_if({k} IS NULL) AS n_null FROM plat"
    for k in NULL_KEYS))
def null_keys(d: Driver):
    """Null counts per required key column (one scan)."""
    return quality.null_keys(d.raw_platform_rows(), NULL_KEYS)


BOUNDS = {"spend": (0.0, 5000.0), "revenue": (0.0, 100000.0), "orders": (1.0, 50.0)}


@query("sanity_bounds", S.BASE + " SELECT channel, count(*) AS n_rows, " + ", ".join(
    f"count_if({c} < {lo}) AS {c}_below, count_if({c} > {hi}) AS {c}_above"
    for c, (lo, hi) in BOUNDS.items()) + " FROM plat GROUP BY channel")
def sanity_bounds(d: Driver):
    """Rows outside sanity bounds per channel for spend, revenue and orders."""
    return quality.sanity_bounds(d.measures(), BOUNDS, ["channel"])


EXPECTED_LAYERS = [("google", "platform"), ("google", "shopify"), ("meta", "platform"),
                   ("meta", "shopify"), ("blinkit", "platform")]


@query("layer_completeness", S.BASE + """
, want AS (SELECT m.month_start, p.channel, p.attribution_layer
           FROM (SELECT DISTINCT month_start FROM fact) m CROSS JOIN (VALUES """ + ", ".join(
    f"('{c}', '{l}')" for c, l in EXPECTED_LAYERS) + """) p(channel, attribution_layer))
SELECT * FROM want w WHERE NOT EXISTS (
  SELECT 1 FROM fact f WHERE f.month_start = w.month_start AND f.channel = w.channel
                         AND f.attribution_layer = w.attribution_layer)""")
def layer_completeness(d: Driver):
    """(month, channel, layer) triples expected in the fact but absent."""
    return quality.layer_completeness(d.fact(), EXPECTED_LAYERS)


@query("prefer_revised", """
WITH li AS (SELECT strftime(l_shipdate, '%Y-%m') AS month_start, l_linestatus = 'F' AS is_revised,
                   l_linestatus, l_extendedprice FROM lineitem),
rev AS (SELECT DISTINCT month_start FROM li WHERE is_revised)
SELECT month_start, l_linestatus, count(*) AS n_rows,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS amount
FROM li WHERE is_revised OR month_start NOT IN (SELECT month_start FROM rev)
GROUP BY 1, 2""")
def prefer_revised(d: Driver):
    """Per month, revised rows (status F) replace the legacy ones when present. Whether a row is
    revised depends on its status, so the choice is made on the sums per month and status."""
    by = (d.table("lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month_start"), "l_linestatus")
          .agg(F.count(F.lit(1)).alias("n_rows"), sum_money("l_extendedprice").alias("amount")))
    revised = F.col("l_linestatus") == "F"
    some = F.coalesce(F.max(revised).over(Window.partitionBy("month_start")), F.lit(False))  # a row per status
    return by.withColumn("_some", some).where(F.coalesce(revised, F.lit(False)) == F.col("_some")).drop("_some")
