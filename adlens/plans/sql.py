"""Oracle SQL (DuckDB dialect) for the named queries.

Written independently of the DataFrame code: brand mapping here ranks
LIKE hits with ROW_NUMBER, sums use DECIMAL(18,4) (re-sums DECIMAL(38,4))
and every ratio is ``x / NULLIF(y, 0)``. Shared shapes are CTE fragments.
"""

from __future__ import annotations

from adlens.params import DRIVER_PARAMS

P = DRIVER_PARAMS
FOCUS = P.focus_brand.replace("'", "''")
LABEL = P.brand_label


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


RULES = "brand_rules(brand, platform, pattern, priority, ord) AS (VALUES " + ", ".join(
    f"({_q(b)}, {_q(pl.lower())}, {_q(pat.lower())}, {pr}, {i})"
    for i, (b, pl, pat, pr) in enumerate(P.brand_rules)) + ")"

# Every text that is mapped anywhere, lower-cased; mapped once per platform.
MAP = """
map_names AS (
  SELECT DISTINCT lower(p_name) AS n FROM part
  UNION SELECT DISTINCT lower(p_brand) FROM part
  UNION SELECT DISTINCT lower(p_type) FROM part),
map_hits AS (
  SELECT m.n, r.platform, r.brand, r.pattern, r.priority,
         ROW_NUMBER() OVER (PARTITION BY m.n, r.platform
                            ORDER BY r.priority DESC, length(r.pattern) DESC, r.ord) AS rk
  FROM map_names m JOIN brand_rules r ON m.n LIKE r.pattern),
map_best AS (SELECT n, platform, brand, pattern, priority FROM map_hits WHERE rk = 1),
mg AS (SELECT n, brand, pattern, priority FROM map_best WHERE platform = 'google'),
mm AS (SELECT n, brand, pattern, priority FROM map_best WHERE platform = 'meta')"""

PLAT = """
plat AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS month_start,
         CAST(l_shipdate AS TIMESTAMP) AS day,
         CASE l_returnflag WHEN 'A' THEN 'google' WHEN 'R' THEN 'meta' WHEN 'N' THEN 'blinkit' END AS channel,
         CASE WHEN l_returnflag = 'A' THEN 'google' ELSE 'meta' END AS platform,
         CASE l_returnflag WHEN 'A' THEN 'google_ads_campaigns_monthly'
              WHEN 'R' THEN 'meta_d2c_adset_monthly' WHEN 'N' THEN 'meta_blinkit_monthly' END AS source_table,
         p_name AS campaign_name, p_type AS campaign_type,
         CASE WHEN l_linestatus = 'F' THEN '7-day click or 1-day view' ELSE '1-day click' END AS attribution_setting,
         l_orderkey, l_linenumber,
         l_extendedprice * l_discount AS spend,
         l_extendedprice * (1 - l_discount) AS revenue,
         l_quantity AS orders,
         l_quantity * 100 AS impressions, l_quantity * 60 AS reach, l_quantity * l_linenumber AS clicks,
         CASE WHEN l_returnflag = 'A' THEN g.brand ELSE m.brand END AS mapped_brand
  FROM lineitem JOIN part ON l_partkey = p_partkey
  LEFT JOIN mg g ON g.n = lower(p_name)
  LEFT JOIN mm m ON m.n = lower(p_name))"""

STORE = f"""
store AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month_start,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'google'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'meta' ELSE 'direct' END AS channel,
         upper(p_name) AS utm_campaign, p_brand AS utm_content, lower(p_type) AS utm_medium,
         o_orderkey, o_custkey, l_linenumber, o_orderdate AS day,
         l_extendedprice AS revenue, CAST(1 AS DOUBLE) AS orders,
         g.brand AS brand_google_campaign, mn.brand AS brand_meta_campaign,
         (coalesce(mc.brand = '{FOCUS}', false) OR coalesce(mn.brand = '{FOCUS}', false)
          OR coalesce(mt.brand = '{FOCUS}', false)) AS meta_hit
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN mg g ON g.n = lower(p_name)
  LEFT JOIN mm mc ON mc.n = lower(p_brand)
  LEFT JOIN mm mn ON mn.n = lower(p_name)
  LEFT JOIN mm mt ON mt.n = lower(p_type))"""

GEN_TYPE = " OR ".join(f"lower(campaign_type) LIKE '%{t}%'" for t in P.generation_tokens)

FACT = f"""
plat_staged AS (
  SELECT month_start, channel,
         CASE channel WHEN 'google' THEN lower(coalesce(campaign_type, 'unknown'))
                      WHEN 'meta' THEN 'd2c' ELSE 'cpa' END AS sub_channel,
         CASE WHEN channel = 'google' THEN
                   CASE WHEN coalesce({GEN_TYPE}, false) THEN 'demand_generation' ELSE 'demand_capture' END
              WHEN channel = 'meta' THEN 'demand_generation' ELSE 'demand_capture' END AS objective_class,
         'platform' AS attribution_layer, source_table, mapped_brand, spend, revenue, orders
  FROM plat),
store_staged AS (
  SELECT month_start, channel,
         CASE WHEN channel = 'google' THEN lower(coalesce(utm_medium, 'unknown')) ELSE 'd2c' END AS sub_channel,
         CASE WHEN channel = 'google' THEN 'demand_capture' ELSE 'demand_generation' END AS objective_class,
         'shopify' AS attribution_layer,
         CASE WHEN channel = 'google' THEN 'google_shopify_monthly' ELSE 'meta_shopify_sales_monthly' END AS source_table,
         CASE WHEN channel = 'google' THEN brand_google_campaign
              WHEN channel = 'meta' AND meta_hit THEN '{FOCUS}' END AS mapped_brand,
         CAST(NULL AS DOUBLE) AS spend, revenue, orders
  FROM store),
fact_agg AS (
  SELECT month_start, channel, sub_channel, objective_class, attribution_layer, source_table,
         CAST(SUM(CAST(spend AS DECIMAL(18,4))) AS DOUBLE) AS spend,
         CAST(SUM(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) AS revenue,
         CAST(SUM(CAST(orders AS DECIMAL(18,4))) AS DOUBLE) AS orders
  FROM plat_staged WHERE mapped_brand = '{FOCUS}'
  GROUP BY month_start, channel, sub_channel, objective_class, attribution_layer, source_table
  UNION ALL
  SELECT month_start, channel, sub_channel, objective_class, attribution_layer, source_table,
         CAST(SUM(CAST(spend AS DECIMAL(18,4))) AS DOUBLE),
         CAST(SUM(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE),
         CAST(SUM(CAST(orders AS DECIMAL(18,4))) AS DOUBLE)
  FROM store_staged WHERE mapped_brand = '{FOCUS}'
  GROUP BY month_start, channel, sub_channel, objective_class, attribution_layer, source_table),
fact AS (
  SELECT month_start, '{LABEL}' AS brand, channel, sub_channel, objective_class, attribution_layer,
         spend, revenue, orders,
         CASE WHEN spend > 0 THEN revenue / spend END AS roas,
         CASE WHEN orders > 0 AND spend IS NOT NULL THEN spend / orders END AS cpa,
         CASE WHEN attribution_layer = 'shopify' THEN 'high' ELSE 'medium' END AS data_confidence,
         source_table
  FROM fact_agg
  WHERE NOT (coalesce(spend, 0) = 0 AND coalesce(revenue, 0) = 0 AND coalesce(orders, 0) = 0))"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join([RULES] + list(parts))


BASE = with_ctes(MAP, PLAT, STORE, FACT)
WEEK_BASE = with_ctes(
    MAP,
    PLAT.replace("strftime(l_shipdate, '%Y-%m') AS month_start",
                 "strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS month_start"),
    STORE.replace("strftime(o_orderdate, '%Y-%m') AS month_start",
                  "strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS month_start"),
    FACT)


def day_window_base(max_day: int) -> str:
    f = (FACT.replace("  FROM plat),", f"  FROM plat WHERE dayofmonth(day) <= {max_day}),")
         .replace("  FROM store),", f"  FROM store WHERE dayofmonth(day) <= {max_day}),"))
    return with_ctes(MAP, PLAT, STORE, f)


def resum(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(38,4))) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"({a}) / NULLIF({b}, 0)"


def relabel(col: str = "channel") -> str:
    arms = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in P.channel_labels.items())
    return f"CASE {col} {arms} ELSE {col} END"


def key(expr: str) -> str:
    """campaign_key: lower, trim, runs of non [a-z0-9] to _, outer _ removed."""
    return f"trim(regexp_replace(lower(trim({expr})), '[^a-z0-9]+', '_', 'g'), '_')"


def alias_key(expr: str) -> str:
    arms = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in P.key_aliases.items())
    return f"CASE {expr} {arms} ELSE {expr} END" if arms else expr


# Every month from the first to the last of the data.
MONTHS = """months AS (
  SELECT strftime(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)), '%Y-%m') AS month_start
  FROM (SELECT min(CAST(d AS TIMESTAMP)) AS lo, max(CAST(d AS TIMESTAMP)) AS hi
        FROM (SELECT l_shipdate AS d FROM lineitem UNION ALL SELECT o_orderdate FROM orders)))"""


def dsum(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,4))) AS DOUBLE)"
