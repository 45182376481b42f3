"""Staged frames over the driver tables, shared by the named queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions.text import lower_or_unknown
from adlens.operators.fact import conversion_fact, objective_from_type
from adlens.operators.mapping import BrandMap
from adlens.params import DRIVER_PARAMS, Params
from adlens.sources import tables

BOTH = ("platform", "shopify")
PLATFORM = ("platform",)


def _in_months(day: str, months: list | None) -> Column:
    """Days of the given ``yyyy-MM`` months as plain date ranges, which reach the scan."""
    hit = F.lit(True) if not months else F.lit(False)
    for m in months or []:
        start = F.to_date(F.lit(m + "-01"))
        hit = hit | ((F.col(day) >= start) & (F.col(day) < F.add_months(start, 1)))
    return hit


class Driver:
    """Builds the marketing shapes over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = DRIVER_PARAMS):
        self.spark = spark
        self.sf_dir = sf_dir
        self.p = params

    @cached_property
    def bmap(self) -> BrandMap:
        return BrandMap.from_rows(self.spark, self.p.brand_rules)

    def table(self, name: str) -> DataFrame:
        return tables.read(self.spark, self.sf_dir, name)

    @cached_property
    def part(self) -> DataFrame:
        """part with the winning rules of its name."""
        return tables.mapped_part(self.spark, self.sf_dir, self.bmap)

    def _is_focus(self, rule: str) -> Column:
        return F.coalesce(F.col(rule)["brand"] == self.p.focus_brand, F.lit(False))

    def focus_part(self, layers=BOTH) -> DataFrame:
        """Parts of the focus brand, before any join: by name for the platform layer; for the store layer
        also by the other UTM texts of meta."""
        if "shopify" not in layers:
            named = tables.mapped_part(self.spark, self.sf_dir, self.bmap, hits_only=True)
            return named.where(self._is_focus("p_name_google") | self._is_focus("p_name_meta"))
        pt = tables.mapped_part(self.spark, self.sf_dir, self.bmap, ("p_name", "p_brand", "p_type"), hits_only=True)
        hit = self._is_focus("p_name_meta") | self._is_focus("p_brand_meta") | self._is_focus("p_type_meta")
        return pt.withColumn("meta_hit", hit).where(hit | self._is_focus("p_name_google"))

    # -- raw export shapes ---------------------------------------------------
    def raw_platform_rows(self) -> DataFrame:
        """Ad rows without a brand."""
        return tables.platform_rows(self.spark, self.sf_dir)

    def platform_rows(self, focus_only: bool = False) -> DataFrame:
        rows = tables.platform_rows(self.spark, self.sf_dir, self.focus_part(PLATFORM) if focus_only else self.part)
        return rows.where(F.col("mapped_brand") == self.p.focus_brand) if focus_only else rows

    def store_rows(self, focus_only: bool = False) -> DataFrame:
        """Store lines; focus_only keeps those whose UTM campaign maps to the focus brand."""
        rows = tables.store_rows(self.spark, self.sf_dir, self.focus_part(PLATFORM) if focus_only else self.part)
        return rows.where(F.col("campaign_brand") == self.p.focus_brand) if focus_only else rows

    def campaigns(self, *channels: str) -> DataFrame:
        """Raw campaign report of the given ad channels, all brands, spend > 0."""
        return self.platform_rows().where(F.col("channel").isin(*channels) & (F.col("spend") > 0))

    def measures(self) -> DataFrame:
        """Channel, month and measures of all ad rows. No campaign text is needed, so part isn't read."""
        flag = F.col("l_returnflag")
        channel = F.when(flag == "A", "google").when(flag == "R", "meta").when(flag == "N", "blinkit")
        return self.table("lineitem").select(
            channel.alias("channel"), F.date_format("l_shipdate", "yyyy-MM").alias("month_start"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("spend"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
            F.col("l_quantity").alias("orders"), (F.col("l_quantity") * 100).alias("impressions"),
            (F.col("l_quantity") * 60).alias("reach"), (F.col("l_quantity") * F.col("l_linenumber")).alias("clicks"))

    def spend_rows(self, *channels: str) -> DataFrame:
        """Spend of the campaign reports of the given channels."""
        return (self.measures().select("channel", "month_start", "spend")
                .where(F.col("channel").isin(*channels) & (F.col("spend") > 0)))

    def months(self) -> DataFrame:
        """Every month from the first to the last of the ad and store data."""
        days = (self.table("lineitem").select(F.col("l_shipdate").alias("day"))
                .unionAll(self.table("orders").select("o_orderdate")))
        span = days.agg(F.trunc(F.min("day"), "month").alias("lo"), F.max("day").alias("hi"))
        return (span.where("lo is not null")
                .select(F.explode(F.sequence("lo", F.to_date("hi"), F.expr("interval 1 month"))).alias("m"))
                .select(F.date_format("m", "yyyy-MM").alias("month_start")))

    # -- staged frames ---------------------------------------------------------
    def _platform_row(self, period: str, max_day: int | None) -> Column:
        flag, ptype = F.col("l_returnflag"), F.col("p_type")
        channel = F.when(flag == "A", "google").when(flag == "R", "meta").when(flag == "N", "blinkit")
        if max_day is not None:
            channel = F.when(F.dayofmonth("l_shipdate") <= max_day, channel)
        return F.struct(
            self._period("l_shipdate", period).alias("month_start"), channel.alias("channel"),
            F.when(channel == "google", lower_or_unknown(ptype)).when(channel == "meta", F.lit("d2c"))
            .otherwise(F.lit("cpa")).alias("sub_channel"),
            F.when(channel == "google", objective_from_type(ptype, self.p.generation_tokens))
            .when(channel == "meta", F.lit("demand_generation")).otherwise(F.lit("demand_capture"))
            .alias("objective_class"),
            F.lit("platform").alias("attribution_layer"),
            F.when(flag == "A", "google_ads_campaigns_monthly").when(flag == "R", "meta_d2c_adset_monthly")
            .when(flag == "N", "meta_blinkit_monthly").alias("source_table"),
            F.when(flag == "A", F.col("p_name_google.brand")).otherwise(F.col("p_name_meta.brand")).alias("mapped_brand"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("spend"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
            F.col("l_quantity").cast("double").alias("orders"))

    def _store_row(self, period: str, max_day: int | None) -> Column:
        prio, ptype = F.col("o_orderpriority"), F.col("p_type")
        channel = F.when(prio.isin("1-URGENT", "2-HIGH"), "google").when(prio == "3-MEDIUM", "meta").otherwise("direct")
        if max_day is not None:
            channel = F.when(F.dayofmonth("o_orderdate") <= max_day, channel)
        return F.struct(
            self._period("o_orderdate", period).alias("month_start"), channel.alias("channel"),
            F.when(channel == "google", lower_or_unknown(F.lower(ptype))).otherwise(F.lit("d2c")).alias("sub_channel"),
            F.when(channel == "google", F.lit("demand_capture")).otherwise(F.lit("demand_generation")).alias("objective_class"),
            F.lit("shopify").alias("attribution_layer"),
            F.when(channel == "google", F.lit("google_shopify_monthly"))
            .otherwise(F.lit("meta_shopify_sales_monthly")).alias("source_table"),
            # a meta row counts for the focus brand when any UTM text maps to it
            F.when(channel == "google", F.col("p_name_google.brand"))
            .when((channel == "meta") & F.col("meta_hit"), F.lit(self.p.focus_brand)).alias("mapped_brand"),
            F.lit(None).cast("double").alias("spend"),
            F.col("l_extendedprice").alias("revenue"), F.lit(1.0).alias("orders"))

    @staticmethod
    def _period(day: str, period: str) -> Column:
        if period == "week":
            return F.date_format(F.date_trunc("week", F.col(day)), "yyyy-MM-dd")
        return F.date_format(day, "yyyy-MM")

    def staged(self, layers=BOTH, period: str = "month", max_day: int | None = None,
               months: list | None = None) -> list[DataFrame]:
        """Staged rows of the focus brand for the layers asked for, and nothing else: the platform layer
        never touches orders. Both layers without a month filter come from one pass: lineitem joined once
        to part and to orders, and every row turned into a platform and a store row, which the fact
        aggregates map-side. ``max_day`` cuts both sources to the same days of the month; ``months``
        reach the scans as date ranges, so then each layer reads its own."""
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
                                           "l_returnflag", "l_shipdate")
        od = self.table("orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
        on_part, on_order = F.col("l_partkey") == F.col("p_partkey"), F.col("l_orderkey") == F.col("o_orderkey")
        rows = {"platform": self._platform_row, "shopify": self._store_row}
        if set(layers) == set(BOTH) and not months:
            joined = li.join(self.focus_part(layers), on_part).join(od, on_order, "left")
            return [self.both_layers(joined, period, max_day)]
        else:
            frames = []
            if "platform" in layers:
                frames.append(li.where(_in_months("l_shipdate", months)).join(self.focus_part(PLATFORM), on_part)
                              .select(rows["platform"](period, max_day).alias("r")))
            if "shopify" in layers:
                frames.append(li.join(self.focus_part(), on_part).join(od.where(_in_months("o_orderdate", months)), on_order)
                              .select(rows["shopify"](period, max_day).alias("r")))
        return [f.select("r.*").where(F.col("channel").isNotNull()) for f in frames]

    def both_layers(self, joined: DataFrame, period: str = "month", max_day: int | None = None) -> DataFrame:
        """Staged rows of both layers from lines that carry the columns of their part and order."""
        rows = F.array(self._platform_row(period, max_day), self._store_row(period, max_day))
        return joined.select(F.explode(rows).alias("r")).select("r.*").where(F.col("channel").isNotNull())

    def fact(self, sort: bool = False, period: str = "month", max_day: int | None = None, layers=BOTH,
             months: list | None = None) -> DataFrame:
        months = months or self.p.months
        return conversion_fact(self.staged(layers, period, max_day, months), self.p.focus_brand,
                               self.p.brand_label, months, sort=sort)
