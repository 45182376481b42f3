from pyspark.sql import functions as F

from adlens.functions import (campaign_key, clean_numeric, coerce_numeric, lower_or_unknown,
                              month_from_name, month_label, parse_day, to_num, strict_num)


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"x {typ}")
    return df.select(expr(F.col("x")).alias("y")).first().y


def test_to_num_tolerant(spark):
    assert one(spark, to_num, "1,234.50") == 1234.5
    assert one(spark, to_num, "3.2%") == 3.2          # percent sign dropped, not divided
    assert one(spark, to_num, "--") is None
    assert one(spark, to_num, " 12 ") == 12.0
    assert one(spark, to_num, "1e3") == 1000.0
    assert one(spark, to_num, None) is None


def test_to_num_rejects_spark_only_forms(spark):
    for v in ["12d", "12f", "Infinity", "NaN", "nan", "abc", ""]:
        assert one(spark, to_num, v) is None, v


def test_strict_num_keeps_commas_bad(spark):
    assert one(spark, strict_num, "1,234") is None
    assert one(spark, strict_num, "1234") == 1234.0


def test_clean_numeric_strips(spark):
    assert one(spark, clean_numeric, "Rs 1,234.5") == 1234.5
    assert one(spark, clean_numeric, "--") is None
    assert one(spark, clean_numeric, "nan") is None


def test_coerce_numeric_all_or_nothing(spark):
    df = spark.createDataFrame(
        [("1,000", "5%", "a", "--"), ("2", "7%", "1", " --"), (None, "", "2", "3")],
        "good string, pct string, mixed string, dash string")
    out = coerce_numeric(df)
    types = dict(out.dtypes)
    assert types["good"] == "double" and types["pct"] == "double"
    assert types["mixed"] == "string"      # one bad cell keeps the whole column as text
    assert types["dash"] == "string"       # ' --' is not the exact blank token
    assert [r.good for r in out.collect()] == [1000.0, 2.0, None]


def test_campaign_key(spark):
    assert one(spark, campaign_key, "  PMAX - Sara's New Customer!! ") == "pmax_sara_s_new_customer"
    assert one(spark, campaign_key, "__a__") == "a"
    assert one(spark, campaign_key, None) is None


def test_lower_or_unknown(spark):
    assert one(spark, lower_or_unknown, None) == "unknown"
    assert one(spark, lower_or_unknown, "Search") == "search"


def test_month_from_name(spark):
    cases = {"Meta_Dec_25.csv": "2025-12", "Google Jan 2026.csv": "2026-01",
             "x-Sept2025.csv": "2025-09", "report.csv": "", "Dec2025-Feb2026.csv": "2025-12"}
    for name, want in cases.items():
        assert one(spark, month_from_name, name) == want, name


def test_parse_day_mixed_formats(spark):
    import datetime
    assert one(spark, parse_day, "2025-12-01") == datetime.date(2025, 12, 1)
    assert one(spark, parse_day, "1/1/2026") == datetime.date(2026, 1, 1)
    assert one(spark, parse_day, "garbage") is None


def test_month_label(spark):
    assert one(spark, month_label, "2025-12") == "Dec 2025"
