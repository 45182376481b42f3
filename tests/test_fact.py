from pyspark.sql import functions as F

from adlens.operators.fact import EXPORT_SOURCES, conversion_fact, stage_export
from adlens.operators.mapping import BrandMap
from adlens.params import EXPORT_BRAND_RULES, EXPORT_GENERATION_TOKENS

SRC = {s.source_table: s for s in EXPORT_SOURCES}


def bmap(spark):
    return BrandMap.from_rows(spark, EXPORT_BRAND_RULES)


def test_meta_platform_orders_fallback_and_sums(spark):
    rows = [("2025-12", "SWF adset 1", "1,000.50", "5,000", None, "7"),
            ("2025-12", "SWF adset 2", "500", "2,000", "3", "9"),
            ("2025-12", "Hearty cats", "999", "1", "1", "1"),           # other brand
            ("2026-01", "wholesome x", None, None, None, None)]         # no signal -> dropped
    df = spark.createDataFrame(rows, "month_start string, `Ad set name` string, "
                               "`Amount spent (INR)` string, `Results value` string, "
                               "Purchases string, Results string")
    st = stage_export(df, SRC["meta_d2c_adset_monthly"], bmap(spark), "Sara's", EXPORT_GENERATION_TOKENS)
    out = conversion_fact([st], "Sara's", "saras").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.channel, r.sub_channel, r.objective_class, r.attribution_layer) == \
        ("meta", "d2c", "demand_generation", "platform")
    assert r.spend == 1500.5 and r.revenue == 7000.0
    assert r.orders == 10.0                      # Purchases, else Results (7 + 3)
    assert abs(r.roas - 7000.0 / 1500.5) < 1e-12 and abs(r.cpa - 150.05) < 1e-12


def test_store_layer_null_spend_and_any_utm_match(spark):
    rows = [("2025-12", "x", "y", "SWF_prospecting", "100", "2", None),
            ("2025-12", "x", "y", "z", "50", "1", None),
            ("2025-12", "x", "y", "z", "70", "1", "Sara's granola")]   # legacy-style title row
    df = spark.createDataFrame(rows, "month_start string, `Order UTM campaign` string, "
                               "`Order UTM content` string, `Order UTM medium` string, "
                               "`Total sales` string, Orders string, "
                               "`Product title at time of sale` string")
    st = stage_export(df, SRC["meta_shopify_sales_monthly"], bmap(spark), "Sara's",
                      EXPORT_GENERATION_TOKENS, title_regex="sara|wholesome")
    r = conversion_fact([st], "Sara's", "saras").collect()
    assert len(r) == 1
    assert r[0].spend is None and r[0].roas is None and r[0].cpa is None
    assert r[0].revenue == 100.0 and r[0].data_confidence == "high"


def test_google_objective_and_subchannel(spark):
    rows = [("2026-01", "sara search", "Search", "100", "300", "3"),
            ("2026-01", "sara yt", "Video", "50", "10", "0"),
            ("2026-01", "sara none", None, "10", "0", "0")]
    df = spark.createDataFrame(rows, "month_start string, Campaign string, `Campaign type` string, "
                               "Cost string, Revenue string, Orders string")
    st = stage_export(df, SRC["google_ads_campaigns_monthly"], bmap(spark), "Sara's",
                      EXPORT_GENERATION_TOKENS)
    got = {(r.sub_channel, r.objective_class): r for r in conversion_fact([st], "Sara's", "saras").collect()}
    assert ("search", "demand_capture") in got
    assert ("video", "demand_generation") in got
    assert ("unknown", "demand_capture") in got
    assert got[("video", "demand_generation")].cpa is None   # orders 0 -> no CPA
