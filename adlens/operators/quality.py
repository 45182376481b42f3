"""Data-quality operators: coverage grid, issues, manifest status, guardrails
and the key/bounds/layer checks.

Grids (sources x months, channels x layers) are built by exploding literal
arrays, never by joining data to data; "found" sets are distinct projections
(partially aggregated) so their size is the number of (source, month) pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Texts of the issue and guardrail reports.
MISSING_DETAIL = "Expected month-wise extract not received."
PENDING_NOTE = "Expected month-wise extract not received yet."
PENDING_ACTION = "Please share month-wise extract for this source and month."
GUARDRAIL_OK = "No brand-map guardrail violations found."
GUARDRAIL_EMPTY = "Brand map is empty; guardrails were skipped."


def _lits(values):
    return F.array(*[F.lit(v) for v in values])


def coverage_grid(found: DataFrame, sources: list, months: DataFrame) -> DataFrame:
    """status available/missing for every source group and month of ``months``
    (month_start). ``found`` has columns source_group, month."""
    grid = months.select(F.explode(_lits(sources)).alias("source_group"), F.col("month_start").alias("month"))
    have = found.select("source_group", "month").distinct().withColumn("status", F.lit("available"))
    return (grid.join(have, ["source_group", "month"], "left")
            .select("source_group", "month", F.coalesce("status", F.lit("missing")).alias("status")))


def pending_rows(coverage: DataFrame, fixed: list | None = None) -> DataFrame:
    """Manifest rows for coverage gaps (``PENDING::source::month``) plus fixed
    pending rows: (relative_path, source_group, parsed_month, notes, action)."""
    gaps = coverage.where(F.col("status") == "missing").select(
        F.concat_ws("::", F.lit("PENDING"), "source_group", "month").alias("relative_path"),
        "source_group", F.col("month").alias("parsed_month"),
        F.lit(PENDING_NOTE).alias("notes"), F.lit(PENDING_ACTION).alias("action_required"))
    if fixed:
        spark = coverage.sparkSession
        extra = spark.createDataFrame(fixed, gaps.schema)
        gaps = gaps.unionByName(extra)
    return gaps.select("*", F.lit("awaited").alias("status"))


def manifest_status(files: DataFrame, pending: DataFrame, status_order: list,
                    validate_token: str | None = None,
                    validate_action: str = "Confirm the period; re-export if mislabeled.") -> DataFrame:
    """Status per manifest entry: by parseability, overridden for file names
    containing ``validate_token``; pending rows appended (other columns of ``files``
    are null there); one row per path (the later entry wins); sorted by status order, group, month, path."""
    kept = [c for c in files.columns if c not in ("status", "action_required")]
    base = files.select(
        *kept,
        F.when(F.col("parseable_by_etl") == "yes", "received_ready_csv")
         .when(F.col("parseable_by_etl") == "no", "received_xlsx_manual_etl")
         .otherwise("received").alias("status"),
        F.lit("").alias("action_required"))
    if validate_token:
        hit = F.col("relative_path").contains(validate_token)
        base = base.select(*kept, F.when(hit, "received_needs_validation").otherwise(F.col("status")).alias("status"),
                           F.when(hit, validate_action).otherwise(F.col("action_required"))
                           .alias("action_required"))
    u = (base.withColumn("_seq", F.lit(0))
         .unionByName(pending.select("relative_path", "source_group", "parsed_month", "notes", "status",
                                     "action_required").withColumn("_seq", F.lit(1)), allowMissingColumns=True))
    w = Window.partitionBy("relative_path").orderBy(F.desc("_seq"))
    rank = F.create_map(*[x for i, s in enumerate(status_order) for x in (F.lit(s), F.lit(i))])
    return (u.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .withColumn("_order", F.coalesce(rank[F.col("status")], F.lit(9)))
            .orderBy("_order", "source_group", "parsed_month", "relative_path")
            .drop("_seq", "_rn", "_order"))


def dq_issues(coverage: DataFrame, manifest: DataFrame | None = None,
              suspect_token: str | None = None, suspect_month: str = "",
              suspect_detail: str = "File name suggests another period; confirm the extract."
              ) -> DataFrame:
    """Issues: missing source-months, suspicious file names, awaited files."""
    parts = [coverage.where(F.col("status") == "missing").select(
        F.lit("missing_source_month").alias("issue_type"), "source_group",
        F.col("month").alias("month_start"), F.lit("high").alias("severity"),
        F.lit(MISSING_DETAIL).alias("details"))]
    if manifest is not None:
        if suspect_token:
            parts.append(manifest.where(F.col("relative_path").contains(suspect_token)).select(
                F.lit("file_validation").alias("issue_type"), "source_group",
                F.lit(suspect_month).alias("month_start"), F.lit("high").alias("severity"),
                F.lit(suspect_detail).alias("details")))
        parts.append(manifest.where(F.col("status") == "awaited").select(
            F.lit("awaited_file").alias("issue_type"), "source_group",
            F.col("parsed_month").alias("month_start"), F.lit("high").alias("severity"),
            F.col("action_required").alias("details")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def guardrails(entities: DataFrame, focus: str, must_map: list, must_not_map: list,
               rule_names=("must_map_to_focus", "must_not_map_to_focus"), rules: DataFrame | None = None) -> DataFrame:
    """Mapping rules over distinct (source, month_start, entity_name, mapped_brand) with their number
    of rows: a name containing a must-map token that does not map to the focus brand, or a
    must-not-map token that does, is a violation. Both rules are tested in one pass. With no
    violation the result is one ``ok`` row; with an empty rule table (``rules``) it is one
    ``warning`` row, as nothing can be mapped. Both are decided lazily, without an action."""
    name = F.coalesce(F.col("entity_name").cast("string"), F.lit(""))
    e = (entities.select("source", F.col("month_start").cast("string").alias("month_start"),
                         name.alias("entity_name"), "mapped_brand")
         .groupBy("source", "month_start", "entity_name", "mapped_brand").agg(F.count(F.lit(1)).alias("n_rows")))

    def has(toks):
        cond = F.lit(False)
        for t in toks:
            cond = cond | F.lower("entity_name").contains(t.lower())
        return cond
    on_focus = F.coalesce(F.col("mapped_brand") == focus, F.lit(False))

    def broken(cond, rule: str, details: str):
        return F.when(cond, F.struct(F.lit(rule).alias("rule"), F.lit(details).alias("details")))
    both = F.array_compact(F.array(
        broken(has(must_map) & ~on_focus, rule_names[0],
               f"Entity contains {'/'.join(must_map)} but did not map to {focus}."),
        broken(has(must_not_map) & on_focus, rule_names[1], f"Entity contains {'/'.join(must_not_map)} but mapped to {focus}.")))
    v = e.withColumn("v", F.explode(both)).select("v.rule", "source", "month_start", "entity_name", "mapped_brand",
                                                  F.lit("violation").alias("status"), "v.details", "n_rows")
    one = entities.sparkSession.range(1).select(F.lit(1).alias("_k"))

    def note(status: str, details: str):
        return one.select(F.lit("all").alias("rule"), F.lit("").alias("source"), F.lit("").alias("month_start"),
                          F.lit("").alias("entity_name"), F.lit(None).cast("string").alias("mapped_brand"),
                          F.lit(status).alias("status"), F.lit(details).alias("details"),
                          F.lit(0).cast("long").alias("n_rows"), "_k")
    some = v.select(F.lit(1).alias("_k")).limit(1)
    ok = note("ok", GUARDRAIL_OK).join(some, "_k", "left_anti")
    if rules is None:
        return v.unionByName(ok.drop("_k"))
    known = rules.select(F.lit(1).alias("_k")).limit(1)
    keep = lambda df: df.withColumn("_k", F.lit(1)).join(known, "_k", "left_semi").drop("_k")
    return (keep(v).unionByName(keep(ok.drop("_k")))
            .unionByName(note("warning", GUARDRAIL_EMPTY).join(known, "_k", "left_anti").drop("_k")))


def duplicate_keys(df: DataFrame, keys: list) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def null_keys(df: DataFrame, keys: list) -> DataFrame:
    """Per key column: rows and rows where the key is null (one scan)."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(k).isNull()).alias(f"_n{i}") for i, k in enumerate(keys)])
    arr = F.array(*[F.struct(F.lit(k).alias("key_column"), F.col("_rows").alias("n_rows"),
                             F.col(f"_n{i}").alias("n_null")) for i, k in enumerate(keys)])
    return wide.select(F.explode(arr).alias("r")).select("r.*")


def sanity_bounds(df: DataFrame, bounds: dict, by: list) -> DataFrame:
    """Rows outside [low, high] per measure and group (one scan, one aggregate)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c, (lo, hi) in bounds.items():
        aggs.append(F.count_if(F.col(c) < lo).alias(f"{c}_below"))
        aggs.append(F.count_if(F.col(c) > hi).alias(f"{c}_above"))
    return df.groupBy(*by).agg(*aggs)


def layer_completeness(fact: DataFrame, expected: list) -> DataFrame:
    """(month, channel, layer) that should exist and do not: per month of the fact,
    the expected (channel, layer) pairs (a literal array) without those present."""
    pairs = F.array(*[F.struct(F.lit(c).alias("channel"), F.lit(l).alias("attribution_layer"))
                      for c, l in expected])
    have = fact.groupBy("month_start").agg(F.collect_set(F.struct("channel", "attribution_layer")).alias("_have"))
    return (have.select("month_start", F.explode(F.array_except(pairs, F.col("_have"))).alias("p"))
            .select("month_start", "p.channel", "p.attribution_layer"))


def gap_issues(coverage: DataFrame, fixed: list) -> DataFrame:
    """The issues of coverage gaps, and the awaited files they and ``fixed`` stand for, in one pass:
    the same rows as ``dq_issues(coverage, pending_rows(coverage, fixed))``."""
    def issue(kind: str, detail: str):
        return F.struct(F.lit(kind).alias("issue_type"), F.lit(detail).alias("details"))
    both = F.array(issue("missing_source_month", MISSING_DETAIL), issue("awaited_file", PENDING_ACTION))
    gaps = (coverage.where(F.col("status") == "missing").select("source_group", "month", F.explode(both).alias("i"))
            .select("i.issue_type", "source_group", F.col("month").alias("month_start"), F.lit("high").alias("severity"),
                    "i.details"))
    rows = [("awaited_file", group, month, "high", action) for _, group, month, _, action in fixed]
    return gaps.unionByName(coverage.sparkSession.createDataFrame(rows, gaps.schema)) if rows else gaps


def missing_columns(df: DataFrame, required: list) -> list:
    """Required columns absent from a source (schema check, no job)."""
    have = set(df.columns)
    return [c for c in required if c not in have]
