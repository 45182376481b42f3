r"""URL filters: a path-template tree per host, judged by smoothed labelled purity.

Rules decide the urls they fit, the longest rule first; those urls are the labelled ones. For all others:

1. Shape. Digits in a path segment become '#'. Equal (host, shape) rows are counted once, with their
   number of labelled and of blocked urls.
2. Tree. Level by level, a node with more than WIDE different segments below it has them generalised into
   one wildcard '*'. Levels beyond DEPTH are one wildcard '**'.
3. Merge. Sibling branches with MIN_LABELLED labelled urls or more are sorted by their blocked share; a run
   of neighbours whose shares a two-proportion test can't tell apart (|z| < Z) becomes one branch 'a|b'.
4. Purity. A template's blocked share is smoothed towards PRIOR with a weight of ALPHA urls. At REJECT or
   more its urls are blocked, otherwise allowed: without labelled urls there is no evidence against a
   template, so its urls stay. (The share of all labelled urls is no prior: it tells what the rules are about.)

All of it is DataFrame work on counts per (host, shape); a host with most of the urls is one row per shape.
The urls are joined with their templates at the end. A null url or one without '://' has an empty host and
path, and no rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm import common

#: (verdict, host, path): a rule fits its host and all subdomains if the path starts with its path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
DEPTH = 4
WIDE = 50
MIN_LABELLED = 5
Z = 1.96
ALPHA, PRIOR = 5.0, 0.5
REJECT = 0.6
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty without '://'."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), _UPPER, _UPPER.lower()), part(2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _level(tree: DataFrame, depth: int) -> DataFrame:
    """Extend the template of every row by its segment at ``depth``, generalised and merged."""
    segment = F.when(F.size("segments") >= depth, F.element_at("segments", depth))
    tree = tree.withColumn("segment", segment)
    node = ["host", "template"]
    children = common.stash(tree.where("segment is not null").groupBy(*node, "segment")
                            .agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))
    width = common.stash(children.groupBy(*node).agg(F.count("*").alias("width")))
    narrow = children.join(width.where(F.col("width") <= WIDE), node)
    # at most WIDE children a node, so these windows are small
    by_share = Window.partitionBy(*node).orderBy("share", "segment")
    share = lambda b, m: (b + 0.5) / (m + 1)
    known = (narrow.where(F.col("labelled") >= MIN_LABELLED)
             .withColumn("share", share(F.col("blocked"), F.col("labelled")))
             .withColumn("m", F.lag("labelled").over(by_share)).withColumn("b", F.lag("blocked").over(by_share)))
    pooled = share(F.col("b") + F.col("blocked"), F.col("m") + F.col("labelled"))
    z = ((F.col("share") - share(F.col("b"), F.col("m")))
         / F.sqrt(pooled * (1 - pooled) * (1 / F.col("m") + 1 / F.col("labelled"))))
    run = F.sum(F.when(F.col("m").isNull() | (z >= Z), 1).otherwise(0)).over(by_share)
    run = known.withColumn("run", run).groupBy(*node, "run").agg(F.sort_array(F.collect_list("segment")).alias("names"))
    merged = run.select(*node, F.explode("names").alias("segment"), F.array_join("names", "|").alias("branch"))
    names = common.stash(children.join(width, node).join(merged, [*node, "segment"], "left")
                         .select(*node, "segment", F.when(F.col("width") > WIDE, "*")
                                 .otherwise(F.coalesce("branch", "segment")).alias("branch")))
    out = tree.join(names, [*node, "segment"], "left")
    return common.stash(out.withColumn("template", F.when(F.col("branch").isNull(), F.col("template"))
                                       .otherwise(F.concat("template", F.lit("/"), "branch")))
                        .drop("segment", "branch"))


def templates(urls: DataFrame) -> DataFrame:
    """(host, shape, template, urls, labelled, purity, rejected) for every shape in urls(host, shape,
    blocked): blocked is 1 or 0 for labelled urls, else null."""
    tree = common.stash(
        urls.groupBy("host", "shape").agg(F.count("*").alias("urls"), F.count("blocked").alias("labelled"),
                                          F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked"))
        .withColumn("segments", F.filter(F.split("shape", "/"), lambda x: x != ""))
        .withColumn("template", F.lit("")))
    for depth in range(1, DEPTH + 1):
        tree = _level(tree, depth)
    tree = tree.withColumn("template", F.when(F.size("segments") > DEPTH, F.concat("template", F.lit("/**")))
                           .otherwise(F.col("template")))
    judged = common.stash(
        tree.groupBy("host", "template").agg(F.sum("urls").alias("urls"), F.sum("labelled").alias("labelled"),
                                             F.sum("blocked").alias("blocked"))
        .withColumn("purity", (F.col("blocked") + ALPHA * PRIOR) / (F.col("labelled") + ALPHA))
        .withColumn("rejected", F.col("purity") >= REJECT))
    return common.stash(tree.select("host", "shape", "template").join(judged, ["host", "template"]))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity for every row of pages(page_id, url)."""
    host, path = split_url(F.col("url"))
    urls = (pages.select("page_id", host.alias("host"), path.alias("path"))
            .withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
            .withColumn("shape", F.regexp_replace("path", "[0-9]+", "#"))
            .withColumn("blocked", F.when(F.col("fit").isNotNull(), (F.col("fit.verdict") == "block").cast("int"))))
    shapes = templates(urls.select("host", "shape", "blocked"))
    method = F.when(F.col("rejected"), "block").otherwise("allow")
    return (urls.join(shapes.select("host", "shape", "template", "purity", "rejected"), ["host", "shape"])
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.verdict", method).alias("verdict"), "template", "purity"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(common.read(spark, sf_dir, "pages").select("page_id", "url"))
