import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from adlens.operators.mapping import BrandMap, infer_rules

RULES = [("A", "meta", "%ab%", 80), ("B", "meta", "%abc%", 80), ("C", "meta", "%x_y%", 100),
         ("D", "google", "%ab%", 80), ("E", "meta", "%ab%", 80), ("F", "meta", "q%", 50)]


def plain_mapper(rules, name, platform):
    """Independent plain-Python statement of the rule: LIKE with only % as
    wildcard, best by priority, then pattern length, then rule order."""
    if name is None:
        return None
    text = name.lower()
    best = None
    for i, (b, p, pat, pr) in enumerate(rules):
        if p.lower() != platform.lower():
            continue
        parts = pat.lower().split("%")
        ok, pos = True, 0
        if not text.startswith(parts[0]):
            ok = False
        else:
            pos = len(parts[0])
            for j, seg in enumerate(parts[1:], 1):
                if j == len(parts) - 1:
                    ok = text.endswith(seg) and len(text) - len(seg) >= pos
                else:
                    k = text.find(seg, pos)
                    if k < 0:
                        ok = False
                        break
                    pos = k + len(seg)
            if len(parts) == 1:
                ok = text == parts[0]
        if ok:
            key = (pr, len(pat), -i)
            if best is None or key > best[0]:
                best = (key, b)
    return best[1] if best else None


def run(spark, names, platform="meta", rules=RULES):
    df = spark.createDataFrame([(n, platform) for n in names], "name string, platform string")
    out = BrandMap.from_rows(spark, rules).attach(df, "name", F.col("platform"))
    return {r.name: r.mapped_brand for r in out.collect()}


def test_priority_length_order(spark):
    a = run(spark, ["xxABCxx", "zab", "x_y", "xzy", "qz", None])
    assert a["xxABCxx"] == "B"          # same priority, longer pattern wins
    assert a["zab"] == "A"              # tie on priority and length: first rule wins
    assert a["x_y"] == "C"              # '_' is literal
    assert a["xzy"] is None             # ... so it does not match 'xzy'
    assert a["qz"] == "F"               # anchored pattern
    assert a[None] is None              # null name maps to null, not to text 'none'


def test_platform_separation(spark):
    assert run(spark, ["ab"], platform="google")["ab"] == "D"


def test_short_and_empty_patterns(spark):
    rules = [("All", "meta", "%", 1), ("One", "meta", "%x%", 2), ("Two", "meta", "%a%b%", 3), ("Back", "meta", "%\\\\%", 4)]
    got = run(spark, ["", "q", "xq", "a-b", "b\\c"], rules=rules)
    assert got == {n: plain_mapper(rules, n, "meta") for n in got}
    assert (got[""], got["q"], got["xq"], got["a-b"]) == ("All", "All", "One", "Two")


def test_five_thousand_rules_from_rows_frame_and_csv(spark, tmpdir_fresh):
    rules = [(f"B{k}", "meta", f"%word{k}x%", str(k % 7) if k % 5 else "n/a") for k in range(5000)]
    names = [f"camp word{k}x" for k in range(0, 6000, 37)] + [f"word{k}x word{k + 1}x" for k in range(0, 4900, 91)] + [None, ""]
    want = {n: plain_mapper([(b, p, x, int(r) if r.isdigit() else 0) for b, p, x, r in rules], n, "meta") for n in names}
    df = spark.createDataFrame([(n,) for n in names], "name string")
    with open(f"{tmpdir_fresh}/rules.csv", "w") as f:
        f.write("brand,platform,pattern,priority\n" + "".join(",".join(r) + "\n" for r in rules))
    frame = spark.createDataFrame([(*r, k) for k, r in enumerate(rules)], "brand string, platform string, pattern string, priority string, ord int")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")  # the file is read in several parts
    try:
        for bm in (BrandMap.from_rows(spark, rules), BrandMap(frame), BrandMap.from_csv(spark, f"file://{tmpdir_fresh}/rules.csv")):
            assert {r.name: r.mapped_brand for r in bm.attach(df, "name", "meta").collect()} == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rules_are_tested_on_the_dimension(spark):
    """No LIKE above the scan of the large table, and no cartesian product."""
    from adlens.plans.catalog import QUERIES
    for name in ("conversion_fact", "brand_spend", "guardrails"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Cartesian" not in plan
        for line in plan.split("\n"):
            assert not ("LIKE" in line.upper() and "l_" in line)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="abcxyq_% ", min_size=0, max_size=8), min_size=1, max_size=15))
def test_random_names_match_plain_mapper(spark, names):
    names = list(dict.fromkeys(names))
    a = run(spark, names)
    for n in names:
        assert a[n] == plain_mapper(RULES, n, "meta"), n


def test_match_details(spark):
    df = spark.createDataFrame([("abc",)], "n string")
    r = BrandMap.from_rows(spark, RULES).attach(df, "n", "meta", details=True).first()
    assert (r.mapped_brand, r.matched_pattern, r.matched_priority) == ("B", "%abc%", 80)


def test_infer_rules_first_keyword(spark):
    names = spark.createDataFrame([("Sara Treats pack",), ("plain",)], "n string")
    out = infer_rules(names, "n", "meta", {"S": ["sara", "sara treats"], "T": ["treats", "treat"]})
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("S", "meta", "%sara%"), ("T", "meta", "%treats%")]


def rows_of(df):
    return sorted((r.name, r.platform, r.hit.brand) for r in df.collect())


def test_keys_are_the_rarest_grams_of_the_names(spark):
    rules = [("A", "meta", "%common%rare1%", 1), ("B", "meta", "%zz%", 1), ("C", "meta", "%", 1), ("D", "meta", "abcd", 1)]
    names = spark.createDataFrame([(x,) for x in ["common"] * 9 + ["rare1 of common", "abcd", "bcd", "zz", None, ""]], "name string")
    plain = BrandMap.from_rows(spark, rules)
    keyed = plain.keyed_by(names)
    keys = {r.brand: r.gram for r in keyed.rules.collect()}
    assert keys["A"] in ("com", "omm", "mmo", "mon", "rar", "are", "re1") and keys["B"] == "zz" and keys["C"] == "" and keys["D"] == "abc"
    only = spark.createDataFrame([(x,) for x in ["common"] * 9 + ["rar"] * 3 + ["are"] * 2 + ["re1"]], "name string")
    assert {r.brand: r.gram for r in plain.keyed_by(only).rules.collect()}["A"] == "re1"
    assert rows_of(keyed.hits(names)) == rows_of(plain.hits(names))


def test_a_rule_frame_and_rows_give_the_same_hits(spark):
    frame = spark.createDataFrame([(*r, k) for k, r in enumerate(RULES)], "brand string, platform string, pattern string, priority int, ord int")
    names = spark.createDataFrame([(x,) for x in ["xxABCxx", "zab", "x_y", "qz", None, "", "ab"]], "name string")
    want = rows_of(BrandMap.from_rows(spark, RULES).hits(names))
    assert want and rows_of(BrandMap(frame).hits(names)) == want == rows_of(BrandMap(frame).keyed_by(names).hits(names))


def test_only_grams_of_candidate_rules_leave_the_names(spark):
    """Rows that go into the join, for 5,000 rules: near the number of rules that a name can match."""
    from adlens.operators.mapping import _cut
    rules = [(f"B{k}", "meta", f"%word{k}x%", 1) for k in range(5000)]
    names = spark.createDataFrame([(f"camp word{k}x and a long tail of other text {k}",) for k in range(2000)], "name string")
    bm = BrandMap.from_rows(spark, rules).keyed_by(names)
    sent = _cut(names, bm.cells).count()
    per_name = names.select((3 * F.length("name")).alias("n")).agg(F.avg("n")).first()[0]
    assert sent / 2000 < per_name / 4
    assert bm.hits(names).count() == 2000


def test_by_key_maps_all_texts_in_one_pass(spark):
    df = spark.createDataFrame([(1, "xABCx", "zab"), (2, None, "q"), (3, "none", "none"), (4, "ab", "ab")], "id int, a string, b string")
    out = BrandMap.from_rows(spark, RULES).by_key(df, "id", ("a", "b"), ("meta", "google"))
    got = {r.id: tuple(x and x.brand for x in (r.a_meta, r.a_google, r.b_meta, r.b_google)) for r in out.collect()}
    assert got == {1: ("B", "D", "A", "D"), 2: (None, None, "F", None), 4: ("A", "D", "A", "D")}


def test_the_fact_scans_part_twice_and_explodes_it_once(spark):
    """Whatever the number of texts: one pass maps them, one scan carries the other columns."""
    from adlens.plans.catalog import QUERIES
    for conf in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
        try:
            plan = QUERIES["conversion_fact"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.count("p_partkey") and sum("Relation" in x and "p_partkey" in x for x in plan.split("\n")) == 2
        assert sum("Relation" in x and "l_orderkey" in x for x in plan.split("\n")) == 1
