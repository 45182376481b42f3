"""The original exports end to end: files in their own shapes are read, staged, summed to the fact and reconciled.
The rows are made up; they add up to the published figures of Dec 2025 and Jan 2026."""

import pytest

from adlens.operators import marts
from adlens.operators.fact import EXPORT_SOURCES, conversion_fact, stage_export
from adlens.operators.mapping import BrandMap
from adlens.params import EXPORT_PARAMS, EXPORT_TITLE_REGEX
from adlens.sources.files import read_group, read_utf16_tsv
from adlens.functions.dates import month_from_name
from pyspark.sql import functions as F

SRC = {s.source_table: s for s in EXPORT_SOURCES}

FILES = {
    "google_ads_campaigns_monthly": {"Google Ads_Jan 2026.csv": (
        "Campaign report\nJanuary 1, 2026 - January 31, 2026\n"
        "Campaign status\tCampaign\tCampaign type\tCost\tRevenue\tOrders\n"
        "Enabled\tsara pmax 1\tPerformance Max\t187,000.79\t775,900.79\t300.97\n"
        "Enabled\tswf pmax 2\tPerformance Max\t23.00\t28\t34\n"
        "Paused\twholesome search\tSearch\t49,273.07\t63,654.74\t36.14\n"
        "Enabled\thearty search\tSearch\t500\t900\t3\n"
        "Enabled\tsara idle\tSearch\t --\t --\t --\n"
        "Total: Account\t\t\t236,796.86\t840,483.53\t374.11\n")},
    "google_shopify_monthly": {"Google Ads_Shopify_Jan 2026.csv": (
        "Order UTM medium,Order UTM campaign,Orders,Total sales\n"
        "pmax,SARA_pmax,59,\"118,388.24\"\nSearch,swf search,40,65758.02\n,sara none,281,618286.97\npmax,yakies,9,100\n")},
    "meta_d2c_adset_monthly": {
        "SWF-MetaDashboard-AdsetLevel-Dec_25.csv": (
            "Ad set name,Results,Amount spent (INR),Purchases,Results value,Result value indicator\n"
            "SWF adset,9,\"1,409,651.57\",\"2,259\",\"5,137,099.71\",x\nTotal: 1,9,9,9,9,x\n"),
        "SWF-MetaDashboard-AdsetLevel-Jan_26.csv": (   # other columns, other order
            "Amount spent (INR),Ad set name,Purchases,Results,Results value\n"
            "\"775,000.84\",sara a,\"1,800\",7,4119000\n995.00,wholesome b,,81,368.8\n50,NutriMeow,1,1,1\n")},
    "meta_shopify_sales_monthly": {"Meta Shopify Report with adset data - Jan_26.csv": (
        "Order UTM campaign,Order UTM content,Order UTM medium,Orders,Total sales\n"
        "x,SWF content,z,200,203000.01\nx,y,swf_medium,39,397\nx,y,z,5,999\n")},
    "meta_blinkit_monthly": {"SWF-Blinkit-MetaDashboard-Jan_26.csv": (
        "Reporting starts,Ad set name,Results,Amount spent (INR),Results value\n1/1/2026,sara blink,2517,\"435,263.73\",724785\n")},
    "meta_instamart_monthly": {"SWF-Instamart-Jan_26.csv": (
        "Ad set name,Results,Amount spent (INR),Results value,Bid\nSWF insta,580,149469.72,189585,\n")},
}

# Published rows of the conversion mart, (month, channel, sub-channel, layer): (spend, revenue, orders).
GOLDEN = {
    ("2025-12", "meta", "d2c", "platform"): (1409651.57, 5137099.71, 2259.0),
    ("2026-01", "blinkit", "cpa", "platform"): (435263.73, 724785.0, 2517.0),
    ("2026-01", "google", "performance max", "platform"): (187023.79, 775928.79, 334.97),
    ("2026-01", "google", "search", "platform"): (49273.07, 63654.74, 36.14),
    ("2026-01", "google", "pmax", "shopify"): (None, 118388.24, 59.0),
    ("2026-01", "google", "search", "shopify"): (None, 65758.02, 40.0),
    ("2026-01", "google", "unknown", "shopify"): (None, 618286.97, 281.0),
    ("2026-01", "instamart", "cpa", "platform"): (149469.72, 189585.0, 580.0),
    ("2026-01", "meta", "d2c", "platform"): (775995.84, 4119368.8, 1881.0),
    ("2026-01", "meta", "d2c", "shopify"): (None, 203397.01, 239.0),
}


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("exports")
    bmap = BrandMap.from_rows(spark, EXPORT_PARAMS.brand_rules)
    out = []
    for table, files in FILES.items():
        (root / table).mkdir()
        for name, text in files.items():
            (root / table / name).write_bytes(text.encode("utf-16" if table.startswith("google_ads") else "utf-8"))
        if table.startswith("google_ads"):
            df = read_utf16_tsv(spark, f"file://{root}/{table}/{name}")
            df = df.withColumn("month_start", month_from_name(F.regexp_extract("source_file", r"([^/]*)$", 1)))
        else:
            df = read_group(spark, f"file://{root}/{table}")
        out.append(stage_export(df, SRC[table], bmap, EXPORT_PARAMS.focus_brand, EXPORT_PARAMS.generation_tokens,
                                title_regex=EXPORT_TITLE_REGEX))
    return out


def test_the_fact_has_the_published_rows(staged):
    fact = conversion_fact(staged, EXPORT_PARAMS.focus_brand, EXPORT_PARAMS.brand_label, EXPORT_PARAMS.months)
    got = {(r.month_start, r.channel, r.sub_channel, r.attribution_layer): (r.spend, r.revenue, r.orders) for r in fact.collect()}
    assert set(got) == set(GOLDEN)
    for k, values in GOLDEN.items():
        assert got[k] == pytest.approx(values, abs=1e-6) if None not in values else got[k][0] is None and got[k][1:] == pytest.approx(values[1:])


def test_reconciliation_and_month_filter(staged):
    args = EXPORT_PARAMS.focus_brand, EXPORT_PARAMS.brand_label
    fact = conversion_fact(staged, *args, ["2026-01"])
    assert {r.month_start for r in fact.collect()} == {"2026-01"}
    rec = {r.channel: r for r in marts.reconciliation(fact, "saras").collect()}
    assert rec["google"].revenue_delta == pytest.approx(37150.30) and rec["google"].roas_delta == pytest.approx(0.1572187628731081)
    assert rec["meta"].revenue_delta == pytest.approx(3915971.79) and rec["meta"].roas_platform == pytest.approx(5.308493406356405)
    # invariants: a layer's sums don't change by reconciling, and CPA is only given with orders
    spend = sum(r.spend or 0 for r in fact.collect() if r.channel in ("google", "meta") and r.attribution_layer == "platform")
    assert sum(r.spend_platform for r in rec.values()) == pytest.approx(spend)
    assert all((r.cpa is None) == (not r.orders or r.spend is None) for r in fact.collect())
