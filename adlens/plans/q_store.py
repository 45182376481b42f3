"""Queries that read the kept tables: the mapped fact by month, bucketed lines and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlens.functions.text import campaign_key
from adlens.operators import marts, resolve
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import Driver
from adlens.plans.q_core import EXEC_SQL, RECON_SQL
from adlens.sources.store import Store


@query("fact_bucketed", S.BASE + " SELECT * FROM fact")
def fact_bucketed(d: Driver):
    """The conversion fact from lines and orders that share their buckets: no exchange below the aggregate."""
    return Store(d).build_fact()


@query("reconciliation_stored", RECON_SQL)
def reconciliation_stored(d: Driver):
    """Reconciliation from the kept fact: one scan."""
    return marts.reconciliation(Store(d).fact(), d.p.brand_label)


@query("exec_summary_stored", EXEC_SQL)
def exec_summary_stored(d: Driver):
    """Executive summary from the kept fact: one scan."""
    return marts.exec_summary(Store(d).fact(), d.p.brand_label)


@query("reconciliation_of_sales_peaks", S.BASE + f"""
, om AS (SELECT strftime(o_orderdate, '%Y-%m') AS month_start, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1),
piv AS (
  SELECT month_start, channel,
         {S.resum("CASE WHEN attribution_layer = 'platform' THEN spend END")} AS spend_platform,
         {S.resum("CASE WHEN attribution_layer = 'platform' THEN revenue END")} AS revenue_platform,
         {S.resum("CASE WHEN attribution_layer = 'shopify' THEN revenue END")} AS revenue_shopify
  FROM fact WHERE channel IN ('google', 'meta') AND month_start IN (SELECT month_start FROM om WHERE 10 * total > 9 * (SELECT max(total) FROM om))
  GROUP BY month_start, channel)
SELECT month_start, '{S.LABEL}' AS brand, channel, spend_platform, revenue_platform, revenue_shopify,
       {S.div("revenue_platform", "spend_platform")} AS roas_platform,
       {S.div("revenue_shopify", "spend_platform")} AS roas_shopify,
       revenue_platform - revenue_shopify AS revenue_delta,
       {S.div("revenue_platform", "spend_platform")} - {S.div("revenue_shopify", "spend_platform")} AS roas_delta,
       CASE WHEN revenue_shopify IS NULL THEN 'missing_shopify_layer' ELSE 'ok' END AS status
FROM piv""")
def reconciliation_of_sales_peaks(d: Driver):
    """Reconciliation of the months with over nine tenths of the best month's store sales. The months come from the orders,
    and only their folders of the kept fact are read."""
    months = (d.table("orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month_start"))
              .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")))
    best = months.agg(F.max("total").alias("most")).scalar()
    return marts.reconciliation(Store(d).fact(months.where(10 * F.col("total") > 9 * best)), d.p.brand_label)


# every campaign text with one letter left out, and with one letter doubled and another wrong
MISSPELT = ["concat(substring({t}, 1, p_partkey % length({t})), substring({t}, p_partkey % length({t}) + 2))",
            "concat(substring({t}, 1, 1 + p_partkey % 7), substring({t}, 1 + p_partkey % 7, length({t}) - 2 - p_partkey % 7), 'z', right({t}, 1))"]
SPELT = "concat(p_name, ' ', p_brand)"


@query("campaign_type_fuzzy", f"""
WITH known AS (SELECT {S.key(SPELT)} AS matched_key, min(p_type) AS campaign_type FROM part GROUP BY 1),
texts AS (SELECT DISTINCT unnest([{", ".join(m.format(t=SPELT) for m in MISSPELT)}]) AS text FROM part),
keys AS (SELECT text, {S.key("text")} AS key FROM texts),
pairs AS (SELECT text, matched_key, campaign_type, levenshtein(key, matched_key) AS distance,
                 greatest(length(key), length(matched_key)) AS n
          FROM keys JOIN known ON abs(length(key) - length(matched_key)) <= {resolve.MOST_EDITS}),
best AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY distance, matched_key) AS rk FROM pairs
         WHERE distance <= least(n // {resolve.PER_EDIT}, {resolve.MOST_EDITS}) AND matched_key <> '')
SELECT k.text, k.key, campaign_type, matched_key, CAST(distance AS INTEGER) AS distance
FROM keys k LEFT JOIN best b ON b.text = k.text AND rk = 1""")
def campaign_type_fuzzy(d: Driver):
    """Misspelt campaign texts resolved to a campaign type by bounded edit distance; texts and known names are one frame."""
    pt = d.table("part").select("p_partkey", "p_name", "p_brand", "p_type")
    spelt = [f"struct({m.format(t=SPELT)} as text, {m.format(t=SPELT)} as name, cast(null as string) as campaign_type)" for m in MISSPELT]
    each = pt.selectExpr(f"inline(array({', '.join(spelt)}, struct(cast(null as string) as text, {SPELT} as name, p_type as campaign_type)))")
    return resolve.fuzzy_tagged(each.select(campaign_key("name").alias("key"), "text", "campaign_type"))
