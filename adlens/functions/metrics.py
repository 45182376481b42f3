"""Business ratios. One guarded divide for every ratio: a zero or missing
denominator gives null (never inf, never an ANSI error)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tax factor on ad spend and the iROAS floor of the period report.
TAX_FACTOR = 1.18
IROAS_MIN_ABS_DELTA_SPEND = 50000.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    return F.try_divide(_col(num), _col(den))


def roas(revenue, spend) -> Column:
    """revenue / spend when spend > 0, else null."""
    return F.when(_col(spend) > 0, safe_div(revenue, spend))


def cpa(spend, orders) -> Column:
    """spend / orders when orders > 0 and spend is present, else null."""
    return F.when((_col(orders) > 0) & _col(spend).isNotNull(), safe_div(spend, orders))


def pct(part, total) -> Column:
    """part / total * 100."""
    return safe_div(part, total) * 100


def iroas_with_floor(d_revenue, d_spend, floor: float = IROAS_MIN_ABS_DELTA_SPEND) -> Column:
    """Incremental ROAS, null when the spend change is smaller than the floor."""
    return F.when(F.abs(_col(d_spend)) >= floor, safe_div(d_revenue, d_spend))


def revenue_from_roas(spend, reported_roas) -> Column:
    """Revenue rebuilt for a report that has spend and ROAS only; null if either is null."""
    return _col(spend) * _col(reported_roas)
