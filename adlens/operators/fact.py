"""The conversion fact: month x channel x sub-channel x objective x layer.

A source becomes *staged rows* with canonical columns; one staged frame can
carry several sources (one scan, one aggregate) whose channel, sub-channel or
objective differ per row. ``conversion_fact`` keeps the focus brand, groups, sums
null-preservingly and adds the guarded ratios.

``EXPORT_SOURCES`` describes the six original exports (column names as in
the files) so real exports stage with ``stage_export``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.metrics import roas, cpa
from adlens.functions.numeric import sum_money, to_num
from adlens.functions.text import contains_any, lower_or_unknown

FACT_KEYS = ["month_start", "channel", "sub_channel", "objective_class",
             "attribution_layer", "source_table"]
FACT_COLUMNS = ["month_start", "brand", "channel", "sub_channel", "objective_class",
                "attribution_layer", "spend", "revenue", "orders", "roas", "cpa",
                "data_confidence", "source_table"]
STAGED_COLUMNS = FACT_KEYS + ["mapped_brand", "spend", "revenue", "orders"]


def _col(c) -> Column:
    if c is None:
        return F.lit(None)
    return F.col(c) if isinstance(c, str) else c


def objective_from_type(type_col, tokens) -> Column:
    """Campaign-type text containing any generation token -> demand_generation,
    anything else (missing included) -> demand_capture."""
    return F.when(contains_any(_col(type_col), tokens), F.lit("demand_generation")) \
        .otherwise(F.lit("demand_capture"))


def conversion_fact(staged: list[DataFrame], focus_brand: str, brand_label: str,
                    months: list | None = None, sort: bool = False) -> DataFrame:
    """Null-preserving monthly fact over staged frames.

    Rows are kept when their mapped brand equals the focus brand and (when
    given) their month is in ``months``; groups with only null values keep a
    null sum. ROAS and CPA are guarded; rows without any signal are dropped.
    Each staged frame is aggregated on its own (partial aggregation before the
    shuffle) and the small results are unioned.
    """
    parts = []
    for s in staged:
        s = s.where(F.col("mapped_brand") == focus_brand)
        if months:
            s = s.where(F.col("month_start").isin(list(months)))
        parts.append(s.groupBy(*FACT_KEYS).agg(
            sum_money("spend").alias("spend"),
            sum_money("revenue").alias("revenue"),
            sum_money("orders").alias("orders")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    out = finished(u, brand_label)
    return out.orderBy("month_start", "channel", "attribution_layer", "sub_channel") if sort else out


def finished(sums: DataFrame, brand_label: str) -> DataFrame:
    """The fact from its sums by FACT_KEYS: guarded ratios and labels, rows without any signal dropped."""
    no_signal = ((F.coalesce("spend", F.lit(0.0)) == 0) & (F.coalesce("revenue", F.lit(0.0)) == 0)
                 & (F.coalesce("orders", F.lit(0.0)) == 0))
    extra = {
        "brand": F.lit(brand_label),
        "roas": roas("revenue", "spend"),
        "cpa": cpa("spend", "orders"),
        "data_confidence": F.when(F.col("attribution_layer") == "shopify", "high")
        .otherwise("medium"),
    }
    return sums.where(~no_signal).select(*[extra[c].alias(c) if c in extra else F.col(c) for c in FACT_COLUMNS])


def demand_capture(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("objective_class") == "demand_capture")


# ---------------------------------------------------------------------------
# Original export sources.
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class ExportSource:
    source_table: str
    channel: str
    layer: str
    platform: str
    name_cols: tuple          # mapped to brand; a row is kept if any maps to the focus
    spend: str | None
    revenue: str | None
    orders: tuple             # first non-null of these columns
    sub_channel: str          # literal value, or "col:<name>" for lower(column) / unknown
    objective: str            # literal value, or "type:<name>" for the token rule


EXPORT_SOURCES = [
    ExportSource("google_ads_campaigns_monthly", "google", "platform", "google", ("Campaign",),
                 "Cost", "Revenue", ("Orders",), "col:Campaign type", "type:Campaign type"),
    ExportSource("google_shopify_monthly", "google", "shopify", "google", ("Order UTM campaign",),
                 None, "Total sales", ("Orders",), "col:Order UTM medium", "demand_capture"),
    ExportSource("meta_d2c_adset_monthly", "meta", "platform", "meta", ("Ad set name",),
                 "Amount spent (INR)", "Results value", ("Purchases", "Results"), "d2c",
                 "demand_generation"),
    ExportSource("meta_shopify_sales_monthly", "meta", "shopify", "meta",
                 ("Order UTM content", "Order UTM campaign", "Order UTM medium"),
                 None, "Total sales", ("Orders",), "d2c", "demand_generation"),
    ExportSource("meta_blinkit_monthly", "blinkit", "platform", "meta", ("Ad set name",),
                 "Amount spent (INR)", "Results value", ("Results",), "cpa", "demand_capture"),
    ExportSource("meta_instamart_monthly", "instamart", "platform", "meta", ("Ad set name",),
                 "Amount spent (INR)", "Results value", ("Results",), "cpa", "demand_capture"),
]


def stage_export(df: DataFrame, src: ExportSource, bmap, focus_brand: str,
                 generation_tokens, title_col: str = "Product title at time of sale",
                 title_regex: str | None = None, keep: tuple = ()) -> DataFrame:
    """Stage one original export (columns may be missing: they read as null). Columns in ``keep`` are carried along.

    ``Total:`` rows are dropped first. Names are mapped once per distinct text.
    For store sources with several name columns the row counts as the focus
    brand when any of them maps to it. A product-title filter (legacy store
    files) applies only to rows that have a title.
    """
    names = [c for c in src.name_cols if c in df.columns]
    df = drop_totals(df, names)
    cols = set(df.columns)
    get = lambda c: F.col(f"`{c}`") if c in cols else F.lit(None).cast("string")
    hit = F.lit(False) if names else F.lit(True)
    for k, c in enumerate(names):
        df = bmap.attach(df.withColumn(f"_name{k}", F.col(f"`{c}`")), f"_name{k}", src.platform, f"_brand{k}")
        hit = hit | F.coalesce(F.col(f"_brand{k}") == focus_brand, F.lit(False))
    brand = F.when(hit, F.lit(focus_brand))
    if title_regex and title_col in cols:
        t = F.lower(F.col(title_col))
        brand = F.when(F.col(title_col).isNull() | t.rlike(title_regex), brand)
    sub = (lower_or_unknown(get(src.sub_channel[4:])) if src.sub_channel.startswith("col:")
           else F.lit(src.sub_channel))
    obj = (objective_from_type(get(src.objective[5:]), generation_tokens)
           if src.objective.startswith("type:") else F.lit(src.objective))
    orders = F.coalesce(*[to_num(get(c)) for c in src.orders]) if src.orders else None
    return df.select(
        F.col("month_start").cast("string").alias("month_start"),
        F.lit(src.channel).alias("channel"), sub.alias("sub_channel"),
        obj.alias("objective_class"), F.lit(src.layer).alias("attribution_layer"),
        F.lit(src.source_table).alias("source_table"), brand.alias("mapped_brand"),
        (to_num(get(src.spend)) if src.spend else F.lit(None).cast("double")).alias("spend"),
        (to_num(get(src.revenue)) if src.revenue else F.lit(None).cast("double")).alias("revenue"),
        (orders if orders is not None else F.lit(None).cast("double")).alias("orders"), *keep,
    )


def drop_totals(df: DataFrame, columns) -> DataFrame:
    """Rows of an export without its summary rows: those with a first or name column that starts
    with ``Total:``. A null is no summary."""
    summary = F.lit(False)
    for c in dict.fromkeys([*df.columns[:1], *columns]):
        if dict(df.dtypes)[c] == "string":
            summary = summary | F.coalesce(F.trim(F.col(f"`{c}`")).startswith("Total:"), F.lit(False))
    return df.where(~summary)
