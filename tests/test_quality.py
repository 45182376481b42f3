from pyspark.sql import functions as F

from adlens.operators import audit, quality
from adlens.operators.mapping import BrandMap
from adlens.params import EXPORT_BRAND_RULES


def ents(spark, names):
    df = spark.createDataFrame([("src", "meta", "2025-12", n) for n in names],
                               "source string, platform string, month_start string, entity_name string")
    return BrandMap.from_rows(spark, EXPORT_BRAND_RULES).attach(df, "entity_name", F.col("platform"))


def test_guardrails_ok_row_and_violations(spark):
    ok = quality.guardrails(ents(spark, ["sara prospecting"]), "Sara's", ["wholesome"],
                            ["treat", "treats"]).collect()
    assert len(ok) == 1 and ok[0].status == "ok"
    bad = quality.guardrails(ents(spark, ["sara treats", "wholesome treat", "wholesome treat"]), "Sara's",
                             ["wholesome"], ["treat", "treats"]).collect()
    # 'sara treats' maps to Treats Portfolio (priority 200): no violation of rule 2.
    # 'wholesome treat' -> Treats Portfolio as well: violates the must-map rule.
    assert [(r.rule, r.entity_name, r.n_rows) for r in bad] == [("must_map_to_focus", "wholesome treat", 2)]


def test_guardrails_of_an_empty_map_warn(spark):
    empty = BrandMap.from_rows(spark, [])
    e = empty.attach(ents(spark, ["wholesome x"]).drop("mapped_brand"), "entity_name", F.col("platform"))
    out = quality.guardrails(e, "Sara's", ["wholesome"], ["treat"], rules=empty.rules).collect()
    assert [(r.rule, r.status, r.details) for r in out] == [("all", "warning", quality.GUARDRAIL_EMPTY)]
    full = BrandMap.from_rows(spark, EXPORT_BRAND_RULES)
    ok = quality.guardrails(ents(spark, ["sara"]), "Sara's", ["wholesome"], ["treat"], rules=full.rules).collect()
    assert [r.status for r in ok] == ["ok"]


def months(spark, *names):
    return spark.createDataFrame([(m,) for m in names], "month_start string")


def test_gap_issues_are_those_of_the_pending_rows(spark):
    cov = spark.createDataFrame([("g", "2026-02", "missing"), ("g", "2026-01", "available"), ("h", "2031-07", "missing")],
                                "source_group string, month string, status string")
    fixed = [("PENDING::x::all", "x", "all", "note", "send it")]
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(quality.gap_issues(cov, fixed)) == rows(quality.dq_issues(cov, quality.pending_rows(cov, fixed)))


def test_file_validation_issue_and_missing_columns(spark):
    manifest = spark.createDataFrame([("a/x_Jan_25.csv", "g", "2025-01", "received_ready_csv", "")],
                                     "relative_path string, source_group string, parsed_month string, status string, action_required string")
    cov = spark.createDataFrame([], "source_group string, month string, status string")
    got = quality.dq_issues(cov, manifest, suspect_token="Jan_25", suspect_month="2026-01").collect()
    assert [(r.issue_type, r.month_start) for r in got] == [("file_validation", "2026-01")]
    assert quality.missing_columns(cov, ["month", "nope"]) == ["nope"]


def test_coverage_grid(spark):
    found = spark.createDataFrame([("a", "2025-12")], "source_group string, month string")
    cov = {(r.source_group, r.month): r.status
           for r in quality.coverage_grid(found, ["a", "b"], months(spark, "2025-12", "2026-01")).collect()}
    assert cov == {("a", "2025-12"): "available", ("a", "2026-01"): "missing",
                   ("b", "2025-12"): "missing", ("b", "2026-01"): "missing"}


def test_manifest_status_order_and_dedupe(spark):
    files = spark.createDataFrame(
        [("a/x_Jan_25.csv", "g", "2025-01", "", "yes"), ("a/y.xlsx", "g", "", "n", "no")],
        "relative_path string, source_group string, parsed_month string, notes string, parseable_by_etl string")
    cov = spark.createDataFrame([("g", "2026-02", "missing")], "source_group string, month string, status string")
    pend = quality.pending_rows(cov)
    out = quality.manifest_status(files, pend, ["awaited", "received_needs_validation",
                                                "received_xlsx_manual_etl", "received_ready_csv"],
                                  validate_token="Jan_25.csv").collect()
    assert [r.status for r in out] == ["awaited", "received_needs_validation", "received_xlsx_manual_etl"]


def test_layer_completeness_and_keys(spark):
    f = spark.createDataFrame([("2025-12", "google", "platform")],
                              "month_start string, channel string, attribution_layer string")
    miss = quality.layer_completeness(f, [("google", "platform"), ("google", "shopify")]).collect()
    assert [(r.channel, r.attribution_layer) for r in miss] == [("google", "shopify")]
    nk = {r.key_column: r.n_null for r in quality.null_keys(
        spark.createDataFrame([(None, "x"), ("a", None)], "k1 string, k2 string"), ["k1", "k2"]).collect()}
    assert nk == {"k1": 1, "k2": 1}


def test_audit_confidence_and_candidates(spark):
    e = audit.audit_entities([ents(spark, ["SWF_x treats", "sara dog food", "plain", None])],
                             [" swf", "swf_", "_swf", "sara's", "saras", "wholesome"], ["dog food"],
                             "(?i)(sara|swf|wholesome)")
    c = {r.entity_name: (r.mapped_brand, r.confidence) for r in audit.audit_candidates(e, "Sara's").collect()}
    assert c == {"SWF_x treats": ("Treats Portfolio", "high")}
    high, rest = audit.split_by_confidence(audit.audit_candidates(e, "nobody"))
    assert {r.entity_name for r in high.collect()} == {"SWF_x treats"}
    assert {r.entity_name for r in rest.collect()} == {"sara dog food"}


def test_assignment_diff(spark):
    was = spark.createDataFrame([("meta", "a", "X"), ("meta", "b", "X"), ("meta", "c", None)], "platform string, name string, brand string")
    now = spark.createDataFrame([("meta", "a", "X"), ("meta", "b", "Y"), ("meta", "d", "Z")], "platform string, name string, brand string")
    got = {(r.name, r.brand_before, r.brand_after, r.change) for r in audit.assignment_diff(was, now).collect()}
    assert got == {("b", "X", "Y", "changed"), ("d", None, "Z", "added")}
