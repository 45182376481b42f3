"""Questions with arguments, catalogue views, exact distinct customers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adlens.operators.ask import INTENTS, ask, register
from adlens.operators.customers import daily_customers, distinct_customers
from adlens.plans.catalog import QUERIES
from adlens.plans.driver import Driver

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_intent_answers_with_and_without_arguments(spark):
    register(Driver(spark, SF))
    for intent in INTENTS:
        whole, month, one = ask(spark, intent), ask(spark, intent, month="1995-03"), ask(spark, intent, n=1)
        assert whole.columns == month.columns == one.columns and whole.count() >= 1, intent
        assert one.count() == 1 or "total" in intent
        assert ask(spark, intent, month="1800-01").where("spend_inr > 0" if "spend_inr" in whole.columns else "total_spend_inr > 0").count() == 0
    for intent in ("top_campaigns_meta", "brand_spend_combined", "total_spend_combined"):
        assert rows(ask(spark, intent)) == rows(QUERIES[f"ask_{intent}"](spark, SF))
    both = {r.channel: (r.spend_inr, r.campaign_count) for r in ask(spark, "total_spend_combined", month="1995-03").collect()}
    assert both["combined"][1] == both["meta"][1] + both["google"][1] > 0


def test_arguments_are_values_not_text(spark):
    register(Driver(spark, SF))
    assert ask(spark, "top_campaigns_meta", month="' or '1'='1").count() == 0
    assert "l_shipdate" in ask(spark, "top_campaigns_meta", month="1995-03")._jdf.queryExecution().optimizedPlan().toString()
    for bad in (0, -1):
        with pytest.raises(ValueError):
            ask(spark, "top_campaigns_meta", n=bad)
    with pytest.raises(ValueError):
        ask(spark, "drop table")


def test_views_do_not_read_orders(spark):
    register(Driver(spark, SF))
    for view in ("campaign_report", "meta_spend_by_brand", "google_spend_by_brand", "spend_by_brand", "monthly_channel_spend",
                 "monthly_paid_spend_meta_google"):
        assert spark.table(view).count() > 0
        assert "o_orderkey" not in spark.table(view)._jdf.queryExecution().optimizedPlan().toString()


def test_customers_count_once_and_days_merge(spark):
    rng = random.Random(1)
    orders = [(rng.choice([1, 2, 5, 32767, 32768, 32769, 70_000, 10**12]), dt.datetime(2026, rng.randint(1, 3), rng.randint(1, 9), 5),
               rng.choice(["a", "b"])) for _ in range(200)] + [(None, dt.datetime(2026, 1, 1), "a"), (7, None, "a"), (8, dt.datetime(2026, 1, 2), None)]
    df = spark.createDataFrame(orders, "c long, d timestamp, ch string")
    daily = daily_customers(df, "c", "d", F.col("ch"))
    got = {(r.month, r.channel): (r.new_customers, r.repeat_customers)
           for r in distinct_customers(daily, F.date_format("day", "yyyy-MM").alias("month"), "channel").collect()}
    first = {}
    for c, d, _ in orders:
        if c is not None and d is not None:
            first[c] = min(first.get(c, d.date()), d.date())
    want = {}
    for c, d, ch in orders:
        if c is not None and d is not None:
            new, again = want.setdefault((f"{d:%Y-%m}", ch), (set(), set()))
            (new if d.date() == first[c] else again).add(c)
    assert got == {k: (len(a), len(b)) for k, (a, b) in want.items()}
    total = distinct_customers(daily, F.date_format("day", "yyyy").alias("year")).collect()
    assert [(r.new_customers, r.repeat_customers) for r in total] == [
        (len({c for (a, _) in want.values() for c in a}), len({c for (_, b) in want.values() for c in b}))]
    assert distinct_customers(daily_customers(df.where("false"), "c", "d", F.col("ch")), "channel").count() == 0


def test_a_day_holds_no_more_bits_than_its_orders_need(spark):
    far = [(k * 10**6, dt.datetime(2026, 1, 1 + k % 3), "a") for k in range(-50, 50)]
    daily = daily_customers(spark.createDataFrame(far, "c long, d timestamp, ch string"), "c", "d", F.col("ch"))
    assert daily.count() == 100 and dict(daily.dtypes)["customers"] == "bigint"
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    found = distinct_customers(daily, "channel").collect()
    assert [(r.new_customers, r.repeat_customers) for r in found] == [(100, 0)]
    near = [(c, dt.datetime(2026, 1, d), "a") for c in (-65, -64, -1, 0, 63, 64, 2**62) for d in (1, 2)]
    daily = daily_customers(spark.createDataFrame(near, "c long, d timestamp, ch string"), "c", "d", F.col("ch"))
    assert [(r.new_customers, r.repeat_customers) for r in distinct_customers(daily, "channel").collect()] == [(7, 7)]
