"""Mapping audit: which entities carry a focus-brand signal but do not map to
the focus brand, how confident that signal is, and per-brand tagging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.numeric import sum_money


def confidence(name: Column, high_tokens, low_tokens) -> Column:
    """Ordered token rules: any high token -> high, else any low token -> low,
    else medium."""
    t = F.lower(F.coalesce(name.cast("string"), F.lit("")))
    hi = F.lit(False)
    for k in high_tokens:
        hi = hi | t.contains(k)
    lo = F.lit(False)
    for k in low_tokens:
        lo = lo | t.contains(k)
    return F.when(hi, "high").when(lo, "low").otherwise("medium")


def audit_entities(sources: list[DataFrame], high_tokens, low_tokens,
                   signal_regex: str) -> DataFrame:
    """Distinct (source, platform, month, entity) from every source with its
    mapped brand, confidence and signal flag. Sources carry columns source,
    platform, month_start, entity_name, mapped_brand; null names are dropped."""
    columns = ["source", "platform", "month_start", "entity_name", "mapped_brand"]
    u = sources[0].select(columns)
    for s in sources[1:]:
        u = u.unionByName(s.select(columns))
    u = u.where(F.col("entity_name").isNotNull()).distinct()
    return u.select(
        "source", "platform", F.col("month_start").cast("string").alias("month_start"),
        "entity_name", "mapped_brand",
        confidence(F.col("entity_name"), high_tokens, low_tokens).alias("confidence"),
        F.coalesce(F.col("entity_name").rlike(signal_regex), F.lit(False)).alias("signal"))


def audit_candidates(entities: DataFrame, focus: str) -> DataFrame:
    """Entities with the signal whose mapped brand is not the focus (null counts as not)."""
    return entities.where(F.col("signal") & ~F.col("mapped_brand").eqNullSafe(F.lit(focus)))


def audit_summary(candidates: DataFrame) -> DataFrame:
    """Candidate counts per (source, mapped brand, confidence); null brands kept."""
    return (candidates.groupBy("source", "mapped_brand", "confidence")
            .agg(F.count(F.lit(1)).alias("entities")))


def brand_tagging(rows: DataFrame) -> DataFrame:
    """Each row tagged with its winning rule (brand, pattern, priority), given as column
    ``rule``, and a brand-specific flag (some rule matched)."""
    return (rows.withColumn("brand", F.col("rule.brand"))
            .withColumn("matched_pattern", F.col("rule.pattern"))
            .withColumn("matched_priority", F.col("rule.priority"))
            .withColumn("brand_specific", F.col("rule").isNotNull())
            .drop("rule"))


def assignment_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Names whose brand differs between two assignments (platform, name, brand): added, removed or
    changed."""
    b = before.select("platform", "name", F.col("brand").alias("brand_before")).distinct()
    a = after.select("platform", "name", F.col("brand").alias("brand_after")).distinct()
    change = (F.when(F.col("brand_before").isNull(), "added").when(F.col("brand_after").isNull(), "removed")
              .otherwise("changed"))
    return (b.join(a, ["platform", "name"], "full").where(~F.col("brand_before").eqNullSafe(F.col("brand_after")))
            .withColumn("change", change))


def split_by_confidence(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates of high confidence, and those of medium or low confidence to be looked at."""
    high = F.col("confidence") == "high"
    return candidates.where(high), candidates.where(~high)


def brand_totals(tagged: DataFrame, by: list, measures: list) -> DataFrame:
    """Sums of measures per group of tagged rows (e.g. source x brand)."""
    return tagged.groupBy(*by).agg(
        *[sum_money(m).alias(m) for m in measures], F.count(F.lit(1)).alias("rows"))
