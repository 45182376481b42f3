import random
import re

from pyspark.sql import functions as F

from adlens.functions import fmt
from adlens.functions.metrics import revenue_from_roas
from adlens.operators import report
from adlens.operators.mapping import BrandMap
from adlens.operators.resolve import fuzzy_types, resolve_types
from adlens.plans.driver import Driver


def test_resolve_types_in_order(spark):
    known = spark.createDataFrame([("PMax - Sara", "PMAX"), ("PMax", "OLD"), ("Search Brand", "SEARCH"), ("Search Other", "SEARCH2"), (None, "X")],
                                  "name string, campaign_type string")
    texts = ["pmax sara", "PMax-Sara new customer", "pmax_x", "my brand words", "nothing", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: (r.campaign_type, r.matched_key, r.method) for r in resolve_types(df, known).collect()}
    assert got == {"pmax sara": ("PMAX", "pmax_sara", "exact"), "PMax-Sara new customer": ("PMAX", "pmax_sara", "prefix"),
                   "pmax_x": ("OLD", "pmax", "prefix"), "my brand words": ("SEARCH", "search_brand", "token"),
                   "nothing": (None, None, "none"), "": (None, None, "none")}


def test_formats(spark):
    df = spark.createDataFrame([(1234.6, 0.126, None)], "a double, b double, c double")
    r = df.select(fmt.currency("a").alias("a"), fmt.percent("b").alias("b"), fmt.multiple("c").alias("c"),
                  fmt.multiple("b").alias("d")).first()
    assert tuple(r) == ("Rs 1,235", "0.1%", "-", "0.13x")
    assert tuple(fmt.round_floats(df, 1).first()) == (1234.6, 0.1, None)
    r = df.select(revenue_from_roas("a", "b").alias("r"), revenue_from_roas("a", "c").alias("n")).first()
    assert r.r == 1234.6 * 0.126 and r.n is None


def orders_and_lines(spark, folder, months):
    """A tiny sf folder with one google and one meta line a month."""
    path = f"file://{folder}"
    lines = [(k, 1, 1, 2.0, 100.0, 0.1, "A" if k % 2 else "R", "F", f"{m}-05") for k, m in enumerate(months)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_returnflag string, l_linestatus string, d string") \
        .withColumn("l_shipdate", F.to_timestamp_ntz("d")).drop("d").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(k, k, "O", 100.0, "1-URGENT", f"{m}-03") for k, m in enumerate(months)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string, d string") \
        .withColumn("o_orderdate", F.to_timestamp_ntz("d")).drop("d").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(1, "hot rod", "Brand#1", "PROMO", 1, 9.0)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double") \
        .write.parquet(f"{path}/part.parquet")
    return path


def test_every_month_of_the_data_appears(spark, tmpdir_fresh):
    """The report window comes from the data: nothing is cut off at fixed months."""
    d = Driver(spark, orders_and_lines(spark, tmpdir_fresh, ["1987-11", "1988-02", "2031-07"]))
    months = sorted(r.month_start for r in d.months().collect())
    assert months[0] == "1987-11" and months[-1] == "2031-07" and len(months) == 525
    split = {r.month_start: r.total for r in report.budget_split(d.fact(layers=("platform",)), d.months()).collect()}
    assert split["2031-07"] == 10.0 and split["1987-11"] == 10.0 and split["2000-01"] == 0.0
    both = sorted((r.month_start, r.attribution_layer) for r in d.fact(months=["1988-02"]).collect())
    assert both == [("1988-02", "platform"), ("1988-02", "shopify")]


def test_platform_queries_do_not_read_orders(spark):
    from adlens.plans.catalog import QUERIES
    for name in ("spend_mix", "objective_totals", "tax_adjusted_roas", "budget_variance", "spend_response", "iroas_by_objective"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "o_orderkey" not in plan, name
    plan = QUERIES["ask_total_spend_meta_month"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "GreaterThanOrEqual(o_orderdate" in plan


def test_no_names_at_all(spark):
    empty = spark.createDataFrame([], "name string")
    assert BrandMap.from_rows(spark, []).attach(empty, "name", "meta").count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def test_fuzzy_types_equal_all_pairs(spark):
    """Also short keys, repeated grams, ties, nulls and blanks; random edits at and beyond the bound."""
    rng = random.Random(4)
    names = ["aaaaaaaaaa", "aaaaaaaaab", "abababababab", "ab", "abcd", "abcde", "abcdf", "summer sale 2026", "summer sole 2026", "x", ""]
    names += ["".join(rng.choice("abc_ ") for _ in range(rng.randint(3, 14))) for _ in range(60)]
    texts = [*names[:9], None, "", "--", "Summer-Sale 2026!", "sumer sale 202", "smmr sl"]
    for t in names:
        for _ in range(2):
            x = list(t)
            for _ in range(rng.randint(1, 3)):
                at = rng.randint(0, max(0, len(x) - 1))
                x[at:at + rng.randint(0, 1)] = rng.choice(["", "c", "zz"])
            texts.append("".join(x))
    known = [(n, f"T{k % 7}") for k, n in enumerate(names)] + [(None, "X")]
    key = lambda t: re.sub("[^a-z0-9]+", "_", t.strip(" ").lower()).strip("_")
    kinds = {}
    for n, c in known:
        if n is not None and key(n):
            kinds[key(n)] = min(kinds.get(key(n), c), c)
    want = {}
    for t in texts:
        if t is not None:
            near = sorted((edits(key(t), m), m, c) for m, c in kinds.items() if key(t)
                          and edits(key(t), m) <= min(max(len(key(t)), len(m)) // 5, 2))
            want[t] = (near[0][2], near[0][1], near[0][0]) if near else (None, None, None)
    got = fuzzy_types(spark.createDataFrame([(t,) for t in texts], "text string"), spark.createDataFrame(known, "name string, campaign_type string"))
    assert {r.text: (r.campaign_type, r.matched_key, r.distance) for r in got.collect()} == want
    assert want["sumer sale 202"][2] == 2 and sum(v[2] is None for v in want.values()) > 5


def test_fuzzy_query_compares_no_pairs(spark):
    from adlens.plans.catalog import QUERIES
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["campaign_type_fuzzy"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "ReusedExchange" in plan
