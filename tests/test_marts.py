from pyspark.sql import functions as F

from adlens.operators import marts, report, tabs

FACT_SCHEMA = ("month_start string, brand string, channel string, sub_channel string, "
               "objective_class string, attribution_layer string, spend double, revenue double, "
               "orders double, roas double, cpa double, data_confidence string, source_table string")


def fact(spark):
    rows = [("2025-12", "s", "google", "search", "demand_capture", "platform", 100.0, 400.0, 4.0),
            ("2025-12", "s", "google", "pmax", "demand_capture", "shopify", None, 250.0, 2.0),
            ("2025-12", "s", "meta", "d2c", "demand_generation", "platform", 300.0, 600.0, 3.0),
            ("2026-01", "s", "google", "search", "demand_capture", "platform", 200.0, 500.0, 5.0),
            ("2026-01", "s", "blinkit", "cpa", "demand_capture", "platform", 0.0, 10.0, 1.0)]
    return spark.createDataFrame([r + (None, None, "medium", "t") for r in rows], FACT_SCHEMA)


def test_reconciliation_status_and_deltas(spark):
    out = {(r.month_start, r.channel): r for r in marts.reconciliation(fact(spark), "s").collect()}
    g = out[("2025-12", "google")]
    assert g.revenue_delta == 150.0 and g.status == "ok"
    assert g.roas_delta == g.roas_platform - g.roas_shopify
    assert out[("2025-12", "meta")].status == "missing_shopify_layer"
    assert ("2026-01", "blinkit") not in out


def test_spend_mix_shares_sum_to_100(spark):
    mix = tabs.spend_mix(fact(spark), {"blinkit": "blinkit_cpass"})
    tot = mix.groupBy("month_start").agg(F.sum("channel_spend_pct").alias("p")).collect()
    for r in tot:
        assert r.p is None or abs(r.p - 100.0) < 1e-9
    assert "blinkit_cpass" in {r.channel for r in mix.collect()}


def test_zero_spend_ratio_is_null(spark):
    ins = {(r.month_start, r.channel): r for r in tabs.conversion_insights(fact(spark), {}).collect()}
    assert ins[("2026-01", "blinkit")].roas_paid_attribution is None


def test_budget_split_fills_missing_months(spark):
    months = spark.createDataFrame([("2025-11",), ("2025-12",), ("2026-01",)], "month_start string")
    out = {r.month_start: r for r in report.budget_split(fact(spark), months).collect()}
    assert out["2025-11"].total == 0.0 and out["2025-11"].capture_share is None
    assert out["2025-12"].demand_capture == 100.0 and out["2025-12"].demand_generation == 300.0
    assert abs(out["2025-12"].capture_share - 25.0) < 1e-12


def test_iroas_floor(spark):
    out = report.iroas_by_objective(fact(spark), floor=50.0).collect()
    cap = [r for r in out if r.objective_class == "demand_capture"][0]
    assert cap.period == "Dec 2025 -> Jan 2026" and cap.delta_spend == 100.0
    assert cap.iroas_proxy == (510.0 - 400.0) / 100.0
    out2 = report.iroas_by_objective(fact(spark), floor=1000.0).collect()
    assert all(r.iroas_proxy is None for r in out2)


def test_branded_search_unpivot(spark):
    m = spark.createDataFrame([("Sara Food", "61,250.00", "10"), ("Sara Wholesome", "3", None),
                               ("Other", "5", "5")], "label string, `Dec 2025` string, `Jan 2026` string")
    out = {r.month_start: r.metric_value for r in marts.branded_search_metrics(
        m, "label", "sara", {"Dec 2025": "2025-12", "Jan 2026": "2026-01", "Feb 2026": "2026-02"},
        "s").collect()}
    assert out == {"2025-12": 61253.0, "2026-01": 10.0, "2026-02": None}
    none = marts.branded_search_metrics(m, "label", "zzz", {"Dec 2025": "2025-12"}, "s")
    assert none.count() == 0
