"""The canned questions with arguments: one entry, parameter markers over registered views.

``register(driver)`` creates the catalogue's views (campaign report, spend by brand, monthly spend) and
``ask(spark, intent, month, n)`` runs a question's SQL on them. Arguments go in as values of named parameter markers, never
as SQL text. All views are of the ad-platform layer, so no question reads orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.operators import marts
from adlens.plans.driver import Driver

_SUM = "cast(sum(cast(spend as decimal(18, 4))) as double)"
_MONTH = "(:month is null or month_start = :month)"
_NAMED = "campaign is not null and trim(campaign) not in ('', '--')"


def _brand(channel: str) -> str:
    return (f"select mapped_brand as brand, {_SUM} as spend_inr from campaign_report where channel = '{channel}' and {_MONTH} "
            "and mapped_brand is not null group by 1 order by 2 desc limit :n")


def _top(channel: str) -> str:
    return (f"select campaign, {_SUM} as spend_inr from campaign_report where channel = '{channel}' and {_MONTH} and {_NAMED} "
            "group by 1 order by 2 desc limit :n")


def _side(channel: str) -> str:
    return f"coalesce(cast(sum(cast(spend as decimal(18, 4))) filter (where channel = '{channel}') as double), 0)"


def _total(scope: str) -> str:
    return (f"select '{scope}' as channel, {_SUM} as spend_inr, count(*) as campaign_count from campaign_report "
            f"where channel = '{scope}' and {_MONTH}")


INTENTS = {
    "brand_spend_meta": _brand("meta"),
    "brand_spend_google": _brand("google"),
    "brand_spend_combined": (f"select *, meta_spend_inr + google_spend_inr as total_spend_inr from (select mapped_brand as brand, "
                             f"{_side('meta')} as meta_spend_inr, {_side('google')} as google_spend_inr from campaign_report "
                             f"where channel in ('meta', 'google') and {_MONTH} and mapped_brand is not null group by 1) "
                             "order by total_spend_inr desc limit :n"),
    "top_campaigns_meta": _top("meta"),
    "top_campaigns_google": _top("google"),
    "top_campaigns_combined": (f"select channel, campaign, {_SUM} as spend_inr from campaign_report where channel in ('meta', 'google') "
                               f"and {_MONTH} and {_NAMED} group by 1, 2 order by 3 desc limit :n"),
    "total_spend_meta_month": f"select month_start, meta_spend_inr as spend_inr from monthly_paid_spend_meta_google where {_MONTH}",
    "total_spend_google_month": f"select month_start, google_spend_inr as spend_inr from monthly_paid_spend_meta_google where {_MONTH}",
    "total_spend_combined_month": f"select * from monthly_paid_spend_meta_google where {_MONTH}",
    "total_spend_meta": _total("meta"),
    "total_spend_google": _total("google"),
    "total_spend_combined": (f"select coalesce(channel, 'combined') as channel, {_SUM} as spend_inr, count(*) as campaign_count "
                             f"from campaign_report where channel in ('meta', 'google') and {_MONTH} group by rollup(channel)"),
}


def register(d: Driver) -> None:
    """The views ``campaign_report``, ``meta_spend_by_brand``, ``google_spend_by_brand``, ``spend_by_brand``,
    ``monthly_channel_spend`` and ``monthly_paid_spend_meta_google``."""
    report = d.campaigns("meta", "google", "blinkit").select("channel", F.col("campaign_name").alias("campaign"), "spend",
                                                            "month_start", "mapped_brand")
    fact = d.fact(layers=("platform",))
    views = {"campaign_report": report,
             "meta_spend_by_brand": marts.spend_by_brand(report.where("channel = 'meta'"), "spend_inr"),
             "google_spend_by_brand": marts.spend_by_brand(report.where("channel = 'google'"), "spend_inr"),
             "spend_by_brand": marts.spend_by_brand_combined(report.where("channel in ('meta', 'google')")),
             "monthly_channel_spend": marts.monthly_channel_spend(fact),
             "monthly_paid_spend_meta_google": marts.monthly_paid_spend(fact)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def ask(spark: SparkSession, intent: str, month: str | None = None, n: int = 10) -> DataFrame:
    """The answer to one of INTENTS, of one month (``yyyy-MM``) or of all, and of the top ``n`` where it is a top list."""
    if intent not in INTENTS:
        raise ValueError(f"no such question: {intent}; there are {', '.join(INTENTS)}")
    if n < 1:
        raise ValueError("n must be 1 or more")
    text = INTENTS[intent]
    return spark.sql(text, args={"month": month} | ({"n": n} if ":n" in text else {}))
