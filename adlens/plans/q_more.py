"""Queries over the remaining operators: executive tab, report text, month filter, revenue from reported ROAS,
campaign-type resolution, per-channel costs and conversion, search against spend, the full file manifest,
new customers and mapping comparisons."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from adlens.functions import fmt
from adlens.functions.metrics import revenue_from_roas, safe_div
from adlens.functions.numeric import resum, sum_money
from adlens.operators import audit, marts, quality, report, resolve, tabs
from adlens.operators.mapping import BrandMap
from adlens.params import EXPORT_STATUS_ORDER
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import PLATFORM, Driver
from adlens.plans.q_core import EXEC_SQL
from adlens.plans.q_quality import AUDIT_SQL, COV_SQL, _audit, _coverage, _found
from adlens.sources import tables
from adlens.sources.files import parseability

FACT_MONTHS = ["1996-02", "1997-07"]
#: Proposed priorities, compared with the current rules.
PROPOSED = [(b, p, x, 130 if b == "Rod" else r) for b, p, x, r in S.P.brand_rules if b != "Widget"]


@query("executive_tab", f"""SELECT month_start, brand, paid_spend_platform AS paid_spend,
  paid_revenue_platform AS paid_revenue_paid_attribution, paid_revenue_shopify AS paid_revenue_shopify_attribution,
  paid_roas_platform, paid_roas_shopify, total_revenue_all_channels, mer, status_notes FROM ({EXEC_SQL})""")
def executive_tab(d: Driver):
    """The executive summary under its dashboard column names."""
    return tabs.executive_tab(marts.exec_summary(d.fact(), d.p.brand_label, sort=False))


@query("report_text", S.BASE + f"""
, t AS (SELECT objective_class, coalesce({S.resum("spend")}, 0) AS spend, coalesce({S.resum("revenue")}, 0) AS revenue
        FROM fact WHERE attribution_layer = 'platform' GROUP BY objective_class)
SELECT objective_class, 'Rs ' || format('{{:,.0f}}', spend) AS spend_text,
  printf('%.2f', revenue / NULLIF(spend, 0)) || 'x' AS roas_text,
  printf('%.1f', spend / NULLIF(CAST(SUM(CAST(spend AS DECIMAL(38,4))) OVER () AS DOUBLE), 0) * 100) || '%' AS share_text
FROM t""")
def report_text(d: Driver):
    """Objective totals as report text."""
    t = report.objective_totals(d.fact(layers=PLATFORM))
    return t.select("objective_class", fmt.currency("spend").alias("spend_text"), fmt.multiple("roas").alias("roas_text"),
                    fmt.percent("spend_share").alias("share_text"))


@query("fact_of_months", S.BASE + f" SELECT * FROM fact WHERE month_start IN ({', '.join(map(S._q, FACT_MONTHS))})")
def fact_of_months(d: Driver):
    """The conversion fact of given months: the filter reaches the scans as date ranges."""
    return d.fact(months=FACT_MONTHS)


@query("revenue_from_reported_roas", S.BASE + f"""
, t AS (SELECT month_start, channel, spend, revenue, floor(revenue / NULLIF(spend, 0) * 100) / 100 AS reported_roas FROM plat)
SELECT month_start, channel, {S.dsum("spend")} AS spend, {S.dsum("revenue")} AS revenue,
       {S.dsum("floor(spend * reported_roas * 10000) / 10000")} AS revenue_rebuilt
FROM t GROUP BY 1, 2""")
def revenue_from_reported_roas(d: Driver):
    """Revenue rebuilt as spend x reported ROAS (two decimals, as platforms print it), next to the true one."""
    roas = F.floor(safe_div("revenue", "spend") * 100) / 100
    return d.measures().groupBy("month_start", "channel").agg(
        sum_money("spend").alias("spend"), sum_money("revenue").alias("revenue"),
        sum_money(F.floor(revenue_from_roas("spend", roas) * 10000) / 10000).alias("revenue_rebuilt"))


@query("campaign_type_resolution", f"""
WITH known AS (SELECT {S.key("p_name")} AS matched_key, min(p_type) AS campaign_type FROM part GROUP BY 1),
texts AS (SELECT DISTINCT unnest([upper(p_name), p_name || ' - ' || p_brand, p_brand || ': ' || p_name,
                                  p_brand || ' ' || split_part(p_name, ' ', 2), p_brand]) AS text FROM part),
keys AS (SELECT text, {S.key("text")} AS key FROM texts),
lead0 AS (SELECT text, k.matched_key, campaign_type, row_number() OVER (PARTITION BY text ORDER BY length(k.matched_key) DESC) AS rk
         FROM keys JOIN known k ON key = k.matched_key OR starts_with(key, k.matched_key || '_')),
tok AS (SELECT matched_key, campaign_type, unnest(list_distinct(string_split(matched_key, '_'))) AS token FROM known),
cnt AS (SELECT token, count(*) AS n FROM tok GROUP BY 1),
rare AS (SELECT matched_key, campaign_type, token, n,
                row_number() OVER (PARTITION BY matched_key ORDER BY n, token) AS rk FROM tok JOIN cnt USING (token)),
ktok AS (SELECT text, unnest(list_distinct(string_split(key, '_'))) AS token FROM keys),
near AS (SELECT text, r.matched_key, r.campaign_type, row_number() OVER (PARTITION BY text ORDER BY r.n, r.matched_key) AS rk
         FROM ktok JOIN rare r ON ktok.token = r.token AND r.rk = 1)
SELECT k.text, k.key, coalesce(l.campaign_type, n.campaign_type) AS campaign_type,
       coalesce(l.matched_key, n.matched_key) AS matched_key,
       CASE WHEN l.matched_key = k.key THEN 'exact' WHEN l.matched_key IS NOT NULL THEN 'prefix'
            WHEN n.matched_key IS NOT NULL THEN 'token' ELSE 'none' END AS method
FROM keys k LEFT JOIN lead0 l ON l.text = k.text AND l.rk = 1 LEFT JOIN near n ON n.text = k.text AND n.rk = 1""")
def campaign_type_resolution(d: Driver):
    """Store-side spellings of the campaign names, resolved to the campaign type of the platform side."""
    pt = d.table("part").select("p_name", "p_brand", "p_type")
    spelled = F.array(F.upper("p_name"), F.concat_ws(" - ", "p_name", "p_brand"), F.concat_ws(": ", "p_brand", "p_name"),
                      F.concat_ws(" ", "p_brand", F.split_part("p_name", F.lit(" "), F.lit(2))), F.col("p_brand"))
    known = pt.select(F.col("p_name").alias("name"), F.col("p_type").alias("campaign_type"))
    return resolve.resolve_types(pt.select(F.explode(spelled).alias("text")), known)


STORE_CHANNEL = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'google'
  WHEN o_orderpriority = '3-MEDIUM' THEN 'meta' ELSE 'direct' END"""


def _store_channel():
    p = F.col("o_orderpriority")
    return F.when(p.isin("1-URGENT", "2-HIGH"), "google").when(p == "3-MEDIUM", "meta").otherwise("direct")


@query("cost_per_new_customer_by_channel", S.BASE + f"""
, sp AS (SELECT month_start, channel, {S.resum("spend")} AS paid_spend FROM fact
         WHERE attribution_layer = 'platform' GROUP BY 1, 2),
fd AS (SELECT o_custkey, min(o_orderdate) AS first_day FROM orders GROUP BY 1),
cd AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day, {STORE_CHANNEL} AS channel, o.o_custkey
       FROM orders o JOIN fd ON fd.o_custkey = o.o_custkey AND fd.first_day = o.o_orderdate),
cu AS (SELECT left(day, 7) AS month_start, channel, count(*) AS new_customers FROM cd GROUP BY 1, 2)
SELECT sp.month_start, sp.channel, paid_spend, new_customers, paid_spend / NULLIF(new_customers, 0) AS cost_per_new_customer
FROM sp LEFT JOIN cu ON cu.month_start = sp.month_start AND cu.channel = sp.channel""")
def cost_per_new_customer_by_channel(d: Driver):
    """Platform spend per new store customer, by month and channel: a customer is new on the first order day,
    through each channel of that day's orders."""
    sp = d.fact(layers=PLATFORM).groupBy("month_start", "channel").agg(resum("spend").alias("paid_spend"))
    od = d.table("orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    first = od.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_day"))
    cu = (od.join(first, "o_custkey").where(F.col("o_orderdate") == F.col("first_day"))
          .select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), _store_channel().alias("channel"), "o_custkey").distinct()
          .groupBy(F.substring("day", 1, 7).alias("month_start"), "channel").agg(F.count(F.lit(1)).alias("new_customers")))
    return (sp.join(cu, ["month_start", "channel"], "left")
            .select("month_start", "channel", "paid_spend", "new_customers",
                    safe_div(F.col("paid_spend"), F.col("new_customers").cast("double")).alias("cost_per_new_customer")))


@query("conversion_rate_by_channel", f"""
WITH ch AS (SELECT o_custkey, {STORE_CHANNEL} AS channel,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rk FROM orders)
SELECT strftime(ts, '%Y-%m-%d') AS day, coalesce(channel, 'unknown') AS channel, count_if(event_type = 'view') AS visits,
       count_if(event_type = 'purchase') AS purchases,
       count_if(event_type = 'purchase') / NULLIF(count_if(event_type = 'view'), 0) AS conversion_rate
FROM events LEFT JOIN ch ON ch.o_custkey = user_id AND rk = 1 GROUP BY 1, 2""")
def conversion_rate_by_channel(d: Driver):
    """Purchases per page visit by day and acquisition channel (that of the visitor's first order)."""
    own = d.table("orders").groupBy("o_custkey").agg(
        F.min_by(_store_channel(), F.struct("o_orderdate", "o_orderkey")).alias("channel"))
    ev = d.table("events").select("ts", "event_type", "user_id").join(own, F.col("user_id") == F.col("o_custkey"), "left")
    t = ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.coalesce("channel", F.lit("unknown")).alias("channel")).agg(
        F.count_if(F.col("event_type") == "view").alias("visits"), F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    return t.withColumn("conversion_rate", safe_div(F.col("purchases").cast("double"), F.col("visits").cast("double")))


@query("search_vs_spend", S.BASE + f"""
, wk AS (SELECT strftime(date_trunc('week', ts), '%Y-%m') AS search_month, count(*) AS n FROM events
         WHERE lower(event_type) LIKE '%r%' GROUP BY 1),
se AS (SELECT search_month, {S.dsum("n")} AS branded_search, row_number() OVER (ORDER BY search_month) AS ordinal FROM wk GROUP BY 1),
sp AS (SELECT month_start AS spend_month, {S.resum("spend")} AS paid_spend FROM fact WHERE attribution_layer = 'platform' GROUP BY 1),
so AS (SELECT *, row_number() OVER (ORDER BY spend_month) AS ordinal FROM sp)
SELECT ordinal, search_month, branded_search, spend_month, paid_spend, branded_search / NULLIF(paid_spend, 0) AS searches_per_spend
FROM se FULL OUTER JOIN so USING (ordinal)""")
def search_vs_spend(d: Driver):
    """Branded search next to paid spend. The two series cover different years, so they are aligned by the
    ordinal of their months (one row a month, numbered in one small window)."""
    weeks = tables.event_weeks(d.spark, d.sf_dir)
    se = marts.branded_search_metrics(tables.search_matrix(d.spark, d.sf_dir, weeks), "label", "r", {w: w[:7] for w in weeks},
                                      d.p.brand_label)
    se = se.select(F.col("month_start").alias("search_month"), F.col("metric_value").alias("branded_search"))
    sp = d.fact(layers=PLATFORM).groupBy(F.col("month_start").alias("spend_month")).agg(resum("spend").alias("paid_spend"))
    numbered = lambda df, by: df.withColumn("ordinal", F.row_number().over(Window.partitionBy().orderBy(by)).cast("long"))
    j = numbered(se, "search_month").join(numbered(sp, "spend_month"), "ordinal", "full")
    return j.select("ordinal", "search_month", "branded_search", "spend_month", "paid_spend",
                    safe_div("branded_search", "paid_spend").alias("searches_per_spend"))


VALIDATE = "meta_d2c_adset_Mar_"


@query("manifest_full", COV_SQL + f"""
, f AS (
  SELECT 'drop/' || source_group || '/' || source_group || '_' || strftime(CAST(month || '-01' AS DATE), '%b_%Y') || '.'
           || CASE WHEN source_group = 'meta_blinkit' THEN 'xlsx' ELSE 'csv' END AS relative_path,
         source_group, CASE WHEN source_group = 'meta_blinkit' THEN 'xlsx' ELSE 'csv' END AS extension, month AS parsed_month
  FROM found WHERE source_group IS NOT NULL),
m AS (
  SELECT relative_path, source_group, extension, CAST(length(relative_path) AS BIGINT) AS size_bytes,
         parsed_month || '-28' AS modified_at, parsed_month, CASE WHEN extension = 'csv' THEN 'yes' ELSE 'no' END AS parseable_by_etl,
         CASE WHEN extension = 'xlsx' THEN 'yes' ELSE 'no' END AS needs_manual_xlsx_etl, '' AS header_preview,
         CASE WHEN extension = 'csv' THEN '' ELSE 'xlsx requires an explicit conversion step' END AS notes,
         CASE WHEN contains(relative_path, '{VALIDATE}') THEN 'received_needs_validation'
              WHEN extension = 'csv' THEN 'received_ready_csv' ELSE 'received_xlsx_manual_etl' END AS status,
         CASE WHEN contains(relative_path, '{VALIDATE}') THEN 'Confirm the period; re-export if mislabeled.' ELSE '' END AS action_required
  FROM f)
SELECT * FROM m
UNION ALL
SELECT 'PENDING::' || source_group || '::' || month, source_group, NULL, NULL, NULL, month, NULL, NULL, NULL,
       '{quality.PENDING_NOTE}', 'awaited', '{quality.PENDING_ACTION}' FROM cov WHERE status = 'missing'""")
def manifest_full(d: Driver):
    """The file manifest with status: one file per source and month found, blinkit as xlsx, and the pending
    rows of the coverage gaps; sorted by status, source, month and path."""
    ext = F.when(F.col("source_group") == "meta_blinkit", "xlsx").otherwise("csv")
    day = F.to_date(F.concat("month", F.lit("-01")))
    path = F.concat(F.lit("drop/"), "source_group", F.lit("/"), "source_group", F.lit("_"), F.date_format(day, "MMM_yyyy"),
                    F.lit("."), ext)
    ok, note = parseability(ext)
    files = _found(d).distinct().select(
        path.alias("relative_path"), "source_group", ext.alias("extension"), F.length(path).cast("long").alias("size_bytes"),
        F.concat("month", F.lit("-28")).alias("modified_at"), F.col("month").alias("parsed_month"), ok.alias("parseable_by_etl"),
        F.when(ext == "xlsx", "yes").otherwise("no").alias("needs_manual_xlsx_etl"), F.lit("").alias("header_preview"),
        note.alias("notes"))
    return quality.manifest_status(files, quality.pending_rows(_coverage(d)), EXPORT_STATUS_ORDER, validate_token=VALIDATE)


@query("new_customers_long", S.BASE + f"""
, fd AS (SELECT o_custkey, min(o_orderdate) AS first_day FROM orders GROUP BY 1)
SELECT month_start, '{S.LABEL}' AS brand, 'meta' AS channel, 'new_customers' AS metric_name,
       {S.dsum("CASE WHEN day = first_day THEN 1 ELSE 0 END")} AS metric_value, 'shopify' AS attribution_layer,
       'meta_shopify_sales_monthly' AS source_table
FROM store JOIN fd USING (o_custkey) WHERE channel = 'meta' AND brand_meta_campaign = '{S.FOCUS}' GROUP BY 1""")
def new_customers_long(d: Driver):
    """New customers of the focus brand in the meta store rows, as monthly metric rows."""
    first = d.table("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_day"))
    rows = (d.store_rows(True).where(F.col("channel") == "meta").join(first, "o_custkey")
            .withColumn("New customers", (F.col("day") == F.col("first_day")).cast("int").cast("string")))
    return marts.new_customer_metrics(rows, d.p.brand_label, d.p.months)


@query("audit_high_confidence", AUDIT_SQL + " SELECT * FROM cand WHERE confidence = 'high'")
def audit_high_confidence(d: Driver):
    """Audit candidates of high confidence."""
    return audit.split_by_confidence(_audit(d))[0]


@query("audit_to_review", AUDIT_SQL + " SELECT * FROM cand WHERE confidence <> 'high'")
def audit_to_review(d: Driver):
    """Audit candidates of medium or low confidence."""
    return audit.split_by_confidence(_audit(d))[1]


def _assigned_sql(rules) -> str:
    values = ", ".join(f"({S._q(b)}, {S._q(p)}, {S._q(x)}, {r}, {k})" for k, (b, p, x, r) in enumerate(rules))
    return f"""(SELECT platform, n AS name, brand FROM (
      SELECT n, r.platform, r.brand, row_number() OVER (PARTITION BY n, r.platform
             ORDER BY r.priority DESC, length(r.pattern) DESC, r.ord) AS rk
      FROM (SELECT DISTINCT lower(p_name) AS n FROM part)
      JOIN (VALUES {values}) r(brand, platform, pattern, priority, ord) ON n LIKE r.pattern) WHERE rk = 1)"""


@query("brand_assignment_diff", f"""
SELECT coalesce(b.platform, a.platform) AS platform, coalesce(b.name, a.name) AS name, b.brand AS brand_before,
       a.brand AS brand_after, CASE WHEN b.brand IS NULL THEN 'added' WHEN a.brand IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM {_assigned_sql(S.P.brand_rules)} b FULL OUTER JOIN {_assigned_sql(PROPOSED)} a ON a.platform = b.platform AND a.name = b.name
WHERE b.brand IS DISTINCT FROM a.brand""")
def brand_assignment_diff(d: Driver):
    """Names whose brand a proposed rule table would change, by platform."""
    names = d.table("part").select(F.col("p_name").alias("name"))

    def assigned(bmap: BrandMap):
        best = bmap.wide(names, ("google", "meta"))
        return best.select("name", F.explode(F.create_map(F.lit("google"), "google", F.lit("meta"), "meta")).alias("platform", "hit")) \
            .where("hit is not null").select("platform", "name", F.col("hit.brand").alias("brand"))
    return audit.assignment_diff(assigned(d.bmap), assigned(BrandMap.from_rows(d.spark, PROPOSED)))
