"""Questions with arguments, and exact customers by channel and month."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlens.functions.metrics import safe_div
from adlens.functions.numeric import resum
from adlens.operators import customers
from adlens.operators.ask import ask, register
from adlens.plans import sql as S
from adlens.plans.catalog import query
from adlens.plans.driver import PLATFORM, Driver
from adlens.plans.q_more import STORE_CHANNEL, _store_channel
from adlens.plans.q_questions import BRANDS, CAMPAIGNS, MONTH, NAMED

MANY = 100


def _asked(d: Driver, intent: str, **args):
    register(d)
    return ask(d.spark, intent, **args)


def _top_sql(table: str, n: int = 10) -> str:
    return S.BASE + CAMPAIGNS + f"""
SELECT campaign, {S.dsum("spend")} AS spend_inr FROM {table} {NAMED} AND month_start = '{MONTH}' GROUP BY 1 ORDER BY 2 DESC LIMIT {n}"""


@query("ask_top_campaigns_meta_of_month", _top_sql("mc"))
def ask_top_campaigns_meta_of_month(d: Driver):
    return _asked(d, "top_campaigns_meta", month=MONTH)


@query("ask_top_campaigns_google_of_month", _top_sql("gc"))
def ask_top_campaigns_google_of_month(d: Driver):
    return _asked(d, "top_campaigns_google", month=MONTH)


@query("ask_top_100_campaigns_combined", S.BASE + CAMPAIGNS + f"""
, u AS (SELECT 'meta' AS channel, campaign, {S.dsum("spend")} AS spend_inr FROM mc {NAMED} GROUP BY 1, 2
        UNION ALL
        SELECT 'google', campaign, {S.dsum("spend")} FROM gc {NAMED} GROUP BY 1, 2)
SELECT channel, campaign, spend_inr FROM u ORDER BY spend_inr DESC LIMIT {MANY}""")
def ask_top_100_campaigns_combined(d: Driver):
    return _asked(d, "top_campaigns_combined", n=MANY)


@query("ask_brand_spend_combined_of_month", S.BASE + BRANDS.replace("WHERE channel = 'meta' AND", f"WHERE month_start = '{MONTH}' AND channel = 'meta' AND")
       .replace("WHERE channel = 'google' AND", f"WHERE month_start = '{MONTH}' AND channel = 'google' AND") + " SELECT * FROM sb")
def ask_brand_spend_combined_of_month(d: Driver):
    return _asked(d, "brand_spend_combined", month=MONTH, n=MANY)


@query("ask_total_spend_combined_any_month", S.BASE + f"""
SELECT month_start, {", ".join(f"coalesce(CAST(SUM(CAST(spend AS DECIMAL(38,4))) FILTER (WHERE channel IN ({c})) AS DOUBLE), 0) AS {n}" for n, c in
                               (("meta_spend_inr", "'meta'"), ("google_spend_inr", "'google'"), ("total_spend_inr", "'meta', 'google'")))}
FROM fact WHERE attribution_layer = 'platform' GROUP BY 1""")
def ask_total_spend_combined_any_month(d: Driver):
    return _asked(d, "total_spend_combined_month")


@query("customers_by_channel_month", S.BASE + f"""
, sp AS (SELECT month_start, channel, {S.resum("spend")} AS paid_spend FROM fact
         WHERE attribution_layer = 'platform' GROUP BY 1, 2),
fd AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_day FROM orders GROUP BY 1),
cu AS (SELECT strftime(o_orderdate, '%Y-%m') AS month_start, {STORE_CHANNEL} AS channel,
              count(DISTINCT o.o_custkey) FILTER (WHERE CAST(o_orderdate AS DATE) = first_day) AS new_customers,
              count(DISTINCT o.o_custkey) FILTER (WHERE CAST(o_orderdate AS DATE) <> first_day) AS repeat_customers
       FROM orders o JOIN fd USING (o_custkey) GROUP BY 1, 2)
SELECT cu.month_start, cu.channel, new_customers, repeat_customers, paid_spend,
       paid_spend / NULLIF(new_customers, 0) AS cost_per_new_customer, paid_spend / NULLIF(repeat_customers, 0) AS cost_per_repeat_customer
FROM cu LEFT JOIN sp ON cu.month_start = sp.month_start AND cu.channel = sp.channel""")
def customers_by_channel_month(d: Driver):
    """Exact new and repeat customers by store channel and month, each customer once, and what each cost."""
    daily = customers.daily_customers(d.table("orders"), "o_custkey", "o_orderdate", _store_channel())
    cu = customers.distinct_customers(daily, F.date_format("day", "yyyy-MM").alias("month_start"), "channel")
    sp = d.fact(layers=PLATFORM).groupBy("month_start", "channel").agg(resum("spend").alias("paid_spend"))
    return cu.join(sp, ["month_start", "channel"], "left").select(
        "month_start", "channel", "new_customers", "repeat_customers", "paid_spend",
        safe_div(F.col("paid_spend"), F.col("new_customers").cast("double")).alias("cost_per_new_customer"),
        safe_div(F.col("paid_spend"), F.col("repeat_customers").cast("double")).alias("cost_per_repeat_customer"))
