"""The fixed values of the original exports in use: source rules, keywords, key aliases, UTM choice, tab order."""

import pytest
from pyspark.sql import functions as F

from adlens.operators import tabs
from adlens.operators.mapping import infer_rules
from adlens.params import EXPORT_BRAND_KEYWORDS, EXPORT_CHANNEL_LABELS, EXPORT_KEY_ALIASES, EXPORT_SOURCE_RULES
from adlens.sources.files import classify_source


def test_files_of_every_source_are_classified(spark):
    paths = {"x/Google Dashboard/a.csv": "google_ads_campaign", "x/Google Shopify Dashboard/a.csv": "google_shopify",
             "x/SWFXMetaDashboard/a.csv": "meta_d2c_adset", "x/SWF-MetaXShopifyDashboard/a.csv": "meta_shopify_sales",
             "x/SWF-MetaXblinkit/a.csv": "meta_blinkit", "x/SWF-MetaXInstamart/a.csv": "meta_instamart",
             "x/New vs returning_Dec.csv": "shopify_new_vs_returning", "x/volume trend.xlsx - Google.csv": "brand_search_google",
             "x/other.csv": "other"}
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r.p: r.g for r in df.select("p", classify_source(F.col("p"), EXPORT_SOURCE_RULES).alias("g")).collect()} == paths


def test_keywords_give_rules(spark):
    names = spark.createDataFrame([("SaraTreats combo",), ("Heartyk pack",), ("nothing",), (None,)], "n string")
    got = {tuple(r) for r in infer_rules(names, "n", "meta", EXPORT_BRAND_KEYWORDS).collect()}
    assert got == {("Sara's", "meta", "%sara%"), ("Treats Portfolio", "meta", "%treats%"), ("Sara's Treats", "meta", "%saratreats%"),
                   ("Hearty", "meta", "%hearty%")}


def test_drilldown_with_alias_first_utm_and_order(spark):
    plat = spark.createDataFrame(
        [("2026-01", "PMax Sara's Wholesome - New Customer", "PMAX", 100.0, 300.0, 2.0), ("2026-01", "Sara small", None, 10.0, 5.0, 1.0),
         ("2025-12", "Sara small", None, 500.0, 5.0, 1.0)], "month_start string, c string, t string, s double, r double, o double")
    store = spark.createDataFrame([("2026-01", "pmax_sara_s_new_customer", "250")], "month_start string, `Order UTM campaign` string, v string") \
        .withColumn("v", F.col("v").cast("double"))
    key = tabs.first_present(store)
    assert key == "Order UTM campaign"
    with pytest.raises(ValueError):
        tabs.first_present(plat)
    out = tabs.in_report_order(tabs.campaign_drilldown(
        plat, store, name_col="c", type_col="t", spend_col="s", revenue_col="r", orders_col="o", store_key_col=key,
        store_revenue_col="v", aliases=EXPORT_KEY_ALIASES)).collect()
    assert [(r.month_start, r.paid_spend) for r in out] == [("2025-12", 500.0), ("2026-01", 100.0), ("2026-01", 10.0)]
    assert out[1].revenue_shopify_attribution == 250.0 and out[2].revenue_shopify_attribution is None
    assert set(EXPORT_CHANNEL_LABELS) == {"blinkit", "instamart"}
