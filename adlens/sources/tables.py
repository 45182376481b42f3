"""The driver's TPC-H-like tables seen as marketing exports.

Shapes (one function each, DataFrame out, columns already snake_case):

* ``platform_rows``  ad-platform rows (campaign / ad-set level): lineitem
  joined to part. channel from the return flag (A google, R meta,
  N blinkit), campaign = part name, campaign type = part type,
  spend = price x discount, revenue = price x (1 - discount), orders = quantity.
* ``store_rows``     store-attributed order lines: lineitem joined to part and
  orders. channel from order priority (1, 2 google; 3 meta; else direct),
  UTM campaign = upper(part name), UTM content = part brand,
  UTM medium = lower(part type), revenue = price, one order per line.
* ``customer_days``  daily new-vs-returning customers from orders.
* ``search_matrix``  a wide matrix (label x week) of event counts.

Joins are written dimension-last with the dimension filtered first, so at
scale Catalyst prunes columns at the scan and AQE can turn a join into a
broadcast when the filtered side is measured small at runtime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions.dates import month_of

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped_part(spark: SparkSession, sf_dir: str, bmap, texts=("p_name",), hits_only: bool = False) -> DataFrame:
    """part with the winning rule of each of ``texts`` on both platforms: columns
    ``<text>_google`` and ``<text>_meta``, struct(brand, pattern, priority) or null.
    Rules are tested on this dimension, all texts in one pass; the result travels
    through the joins with the big tables. ``hits_only`` leaves out parts without a hit."""
    pt = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    best = bmap.by_key(pt, "p_partkey", texts, ("google", "meta"))
    return pt.join(best, "p_partkey", "inner" if hits_only else "left")


def _channel_from_flag():
    f = F.col("l_returnflag")
    return (F.when(f == "A", "google").when(f == "R", "meta").when(f == "N", "blinkit"))


def _source_from_flag():
    f = F.col("l_returnflag")
    return (F.when(f == "A", "google_ads_campaigns_monthly")
            .when(f == "R", "meta_d2c_adset_monthly")
            .when(f == "N", "meta_blinkit_monthly"))


def platform_rows(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    """Ad rows. With a mapped ``part`` they carry the winning rule of the campaign
    name on the row's platform (``rule``, ``mapped_brand``); ``part`` may be filtered."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    pt = part if part is not None else read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    j = li.join(pt, li["l_partkey"] == pt["p_partkey"], "inner")
    channel = _channel_from_flag()
    if part is not None:
        rule = F.when(channel == "google", F.col("p_name_google")).otherwise(F.col("p_name_meta"))
        j = j.withColumn("_rule", rule)
    mapped = [F.col("_rule").alias("rule"), F.col("_rule.brand").alias("mapped_brand")] if part is not None else []
    return j.select(
        month_of("l_shipdate").alias("month_start"),
        F.col("l_shipdate").alias("day"),
        channel.alias("channel"),
        F.when(channel == "google", "google").otherwise("meta").alias("platform"),
        _source_from_flag().alias("source_table"),
        F.col("p_name").alias("campaign_name"),
        F.col("p_type").alias("campaign_type"),
        F.when(F.col("l_linestatus") == "F", "7-day click or 1-day view")
         .otherwise("1-day click").alias("attribution_setting"),
        F.col("l_orderkey"), F.col("l_linenumber"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("spend"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        F.col("l_quantity").alias("orders"),
        (F.col("l_quantity") * 100).alias("impressions"),
        (F.col("l_quantity") * 60).alias("reach"),
        (F.col("l_quantity") * F.col("l_linenumber")).alias("clicks"), *mapped,
    )


def store_rows(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    """Store order lines. With a mapped ``part`` they carry the brand of the UTM
    campaign on the row's own channel (``campaign_brand``, null for direct)."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    pt = part if part is not None else read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    od = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    j = (li.join(pt, li["l_partkey"] == pt["p_partkey"], "inner")
         .join(od, F.col("l_orderkey") == F.col("o_orderkey"), "inner"))
    pr = F.col("o_orderpriority")
    mapped = [F.when(pr.isin("1-URGENT", "2-HIGH"), F.col("p_name_google.brand")).when(pr == "3-MEDIUM", F.col("p_name_meta.brand"))
              .alias("campaign_brand")] if part is not None else []
    return j.select(
        month_of("o_orderdate").alias("month_start"),
        F.col("o_orderdate").alias("day"),
        F.when(pr.isin("1-URGENT", "2-HIGH"), "google").when(pr == "3-MEDIUM", "meta")
         .otherwise("direct").alias("channel"),
        F.upper(F.col("p_name")).alias("utm_campaign"),
        F.col("p_brand").alias("utm_content"),
        F.lower(F.col("p_type")).alias("utm_medium"),
        F.col("o_orderkey"), F.col("o_custkey"), F.col("l_linenumber"),
        F.col("l_extendedprice").alias("revenue"),
        F.lit(1.0).alias("orders"), *mapped,
    )


def customer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily (day, bucket, customers, orders, total_sales); an order placed on
    the customer's first order day is ``New``, any later one ``Returning``.

    First order days come from a grouped min (partial aggregation, so a hot
    customer costs no more than a cold one) joined back on the customer key;
    AQE splits a skewed join partition if one customer dominates.
    """
    od = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    first = od.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_day"))
    j = od.join(first, "o_custkey")
    bucket = F.when(F.col("o_orderdate") == F.col("first_day"), "New").otherwise("Returning")
    return (j.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), bucket.alias("bucket"))
            .agg(F.countDistinct("o_custkey").alias("customers"),
                 F.count(F.lit(1)).alias("orders"),
                 F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_sales")))


def event_weeks(spark: SparkSession, sf_dir: str) -> list[str]:
    """The weeks present in the events, in order: one entry per week of the table's span."""
    wk = F.date_format(F.date_trunc("week", F.col("ts")), "yyyy-MM-dd")
    rows = read(spark, sf_dir, "events").select(wk.alias("w")).where("w is not null").distinct().collect()
    return sorted(r.w for r in rows)


def search_matrix(spark: SparkSession, sf_dir: str, weeks: list[str]) -> DataFrame:
    """Wide matrix: one row per label (event type), one column per week
    (``yyyy-MM-dd`` of the week start) holding the event count. The week list
    gives the columns (``event_weeks``)."""
    ev = read(spark, sf_dir, "events").select("event_type", "ts")
    wk = F.date_format(F.date_trunc("week", F.col("ts")), "yyyy-MM-dd")
    return (ev.select(F.col("event_type").alias("label"), wk.alias("week"))
            .groupBy("label").pivot("week", weeks).agg(F.count(F.lit(1))))
