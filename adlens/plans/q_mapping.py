"""Brand-mapping, keyword-inference and text/numeric function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlens.functions.numeric import column_coercion_report, to_num
from adlens.functions.text import campaign_key
from adlens.operators import audit, marts
from adlens.operators.mapping import infer_rules
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import Driver

MATCH = """
, names AS (SELECT DISTINCT platform, campaign_name FROM plat),
tagged AS (
  SELECT n.platform, n.campaign_name, b.brand AS mapped_brand, b.pattern AS matched_pattern,
         b.priority AS matched_priority
  FROM names n LEFT JOIN map_best b ON b.n = lower(n.campaign_name) AND b.platform = n.platform)"""


def _names(d: Driver):
    return d.raw_platform_rows().select("platform", "campaign_name").distinct()


@query("brand_mapping", S.BASE + MATCH + " SELECT platform, campaign_name, mapped_brand FROM tagged")
def brand_mapping(d: Driver):
    """Mapped brand per distinct (platform, campaign name)."""
    return d.platform_rows().select("platform", "campaign_name", "mapped_brand").distinct()


@query("brand_mapping_with_pattern", S.BASE + MATCH + """
SELECT platform, campaign_name, mapped_brand, matched_pattern, matched_priority,
       mapped_brand IS NOT NULL AS brand_specific FROM tagged""")
def brand_mapping_with_pattern(d: Driver):
    """Winning rule (brand, pattern, priority) per name and the brand-specific flag."""
    t = audit.brand_tagging(d.platform_rows().select("platform", "campaign_name", "rule").distinct())
    return t.select("platform", "campaign_name", F.col("brand").alias("mapped_brand"),
                    "matched_pattern", "matched_priority", "brand_specific")


@query("brand_mapping_join", S.BASE + MATCH + """
SELECT platform, campaign_name, mapped_brand, matched_pattern, matched_priority FROM tagged""")
def brand_mapping_join(d: Driver):
    """The same mapping attached to the distinct names of the ad rows."""
    return d.bmap.attach(_names(d), "campaign_name", F.col("platform"), details=True)


@query("brand_spend", S.BASE + """
, msb AS (SELECT mapped_brand AS brand, CAST(SUM(CAST(spend AS DECIMAL(18,4))) AS DOUBLE) AS meta_spend_inr
          FROM plat WHERE channel = 'meta' AND spend > 0 AND mapped_brand IS NOT NULL GROUP BY 1),
gsb AS (SELECT mapped_brand AS brand, CAST(SUM(CAST(spend AS DECIMAL(18,4))) AS DOUBLE) AS google_spend_inr
        FROM plat WHERE channel = 'google' AND spend > 0 AND mapped_brand IS NOT NULL GROUP BY 1)
SELECT coalesce(msb.brand, gsb.brand) AS brand, coalesce(meta_spend_inr, 0) AS meta_spend_inr,
       coalesce(google_spend_inr, 0) AS google_spend_inr,
       coalesce(meta_spend_inr, 0) + coalesce(google_spend_inr, 0) AS total_spend_inr
FROM msb FULL OUTER JOIN gsb ON msb.brand = gsb.brand""")
def brand_spend(d: Driver):
    """Spend by mapped brand on each platform and combined (all brands)."""
    return marts.spend_by_brand_combined(d.campaigns("meta", "google"))


def _kw_sql() -> str:
    parts = []
    for brand, keys in S.P.keywords.items():
        arms = " ".join(f"WHEN n LIKE '%{k}%' THEN '{k}'" for k in keys)
        parts.append(f"SELECT {S._q(brand)} AS brand, platform, CASE {arms} END AS kw FROM kn")
    return (S.BASE + """
, kn AS (SELECT DISTINCT channel AS platform, lower(campaign_name) AS n FROM plat
         WHERE channel IN ('meta', 'google') AND campaign_name IS NOT NULL)
SELECT DISTINCT brand, platform, '%' || kw || '%' AS pattern FROM (""" + " UNION ALL ".join(parts)
            + ") WHERE kw IS NOT NULL")


@query("keyword_inference", _kw_sql())
def keyword_inference(d: Driver):
    """Rules inferred from keywords: first keyword of each brand found in a name."""
    names = (d.raw_platform_rows().where(F.col("channel").isin("meta", "google"))
             .select("campaign_name", "channel").distinct())
    return infer_rules(names, "campaign_name", F.col("channel"), d.p.keywords)


@query("brand_tagging", S.BASE + """
, t AS (SELECT p.source_table, b.brand, b.pattern AS matched_pattern, p.spend, p.revenue
        FROM plat p LEFT JOIN map_best b ON b.n = lower(p.campaign_name) AND b.platform = p.platform)
SELECT source_table, brand, matched_pattern, brand IS NOT NULL AS brand_specific,
       CAST(SUM(CAST(spend AS DECIMAL(18,4))) AS DOUBLE) AS spend,
       CAST(SUM(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) AS revenue, count(*) AS "rows"
FROM t GROUP BY 1, 2, 3, 4""")
def brand_tagging(d: Driver):
    """Rows tagged with the winning pattern, totals per source x brand x pattern."""
    t = audit.brand_tagging(d.platform_rows())
    return audit.brand_totals(t, ["source_table", "brand", "matched_pattern", "brand_specific"],
                              ["spend", "revenue"])


def _messy(d: Driver):
    li = d.table("lineitem")
    raw = (F.when(F.col("l_linenumber") == 7, F.lit("--"))
           .when(F.col("l_linenumber") == 6,
                 F.concat(F.format_number(F.col("l_discount") * 100, 2), F.lit("%")))
           .otherwise(F.format_number("l_extendedprice", 2)))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw_text"),
                     F.format_number("l_extendedprice", 2).alias("price_text"),
                     F.concat(F.format_number(F.col("l_discount") * 100, 2), F.lit("%")).alias("pct_text"),
                     F.col("l_returnflag").alias("flag_text"),
                     F.when(F.col("l_linenumber") == 7, F.lit("--"))
                     .otherwise(F.col("l_quantity").cast("string")).alias("qty_text"))


MESSY_SQL = """
, messy AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 7 THEN '--'
         WHEN l_linenumber = 6 THEN format('{:,.2f}', l_discount * 100) || '%'
         ELSE format('{:,.2f}', l_extendedprice) END AS raw_text,
    format('{:,.2f}', l_extendedprice) AS price_text,
    format('{:,.2f}', l_discount * 100) || '%' AS pct_text,
    l_returnflag AS flag_text,
    CASE WHEN l_linenumber = 7 THEN '--' ELSE CAST(l_quantity AS VARCHAR) END AS qty_text
  FROM lineitem)"""


@query("numeric_coercion", S.with_ctes(MESSY_SQL.lstrip().lstrip(",")) + """
SELECT l_orderkey, l_linenumber, raw_text,
       TRY_CAST(replace(replace(raw_text, ',', ''), '%', '') AS DOUBLE) AS value FROM messy""")
def numeric_coercion(d: Driver):
    """Tolerant measure parsing of thousands-separated, percent and ``--`` text."""
    m = _messy(d)
    return m.select("l_orderkey", "l_linenumber", "raw_text", to_num("raw_text").alias("value"))


def _clean(c: str) -> str:
    return (f"regexp_replace(nullif(replace(replace(CASE WHEN {c} IN ('--', 'nan', 'None') THEN NULL "
            f"ELSE {c} END, ',', ''), '%', ''), ''), '[^0-9.\\-]', '', 'g')")


COERCE_COLS = ["price_text", "pct_text", "flag_text", "qty_text"]


@query("strict_column_coercion", S.with_ctes(MESSY_SQL.lstrip().lstrip(",")) + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({_clean(c)}) AS n_values,
        count_if({_clean(c)} IS NOT NULL AND NOT regexp_full_match({_clean(c)}, '-?([0-9]+\\.?[0-9]*|\\.[0-9]+)')) AS n_bad,
        count_if({_clean(c)} IS NOT NULL AND NOT regexp_full_match({_clean(c)}, '-?([0-9]+\\.?[0-9]*|\\.[0-9]+)')) = 0 AS is_numeric
        FROM messy""" for c in COERCE_COLS))
def strict_column_coercion(d: Driver):
    """All-or-nothing numeric decision per text column (one bad cell keeps text)."""
    return column_coercion_report(_messy(d), COERCE_COLS)


@query("campaign_key", """
SELECT p_partkey, upper(p_name) || ' - ' || p_brand AS campaign_text,
       trim(regexp_replace(lower(trim(upper(p_name) || ' - ' || p_brand)), '[^a-z0-9]+', '_', 'g'), '_') AS campaign_key
FROM part""")
def campaign_key_q(d: Driver):
    """Normalised join key of store-side campaign text."""
    text = F.concat(F.upper("p_name"), F.lit(" - "), F.col("p_brand"))
    return d.table("part").select("p_partkey", text.alias("campaign_text"),
                                  campaign_key(text).alias("campaign_key"))
