"""Presentation formats (report text). Applied last, never before sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def currency(c, symbol: str = "Rs") -> Column:
    """``Rs 1,234`` (no decimals); null gives ``-``."""
    return F.coalesce(F.concat(F.lit(symbol + " "), F.format_number(_col(c), 0)), F.lit("-"))


def percent(c) -> Column:
    """``12.3%``; null gives ``-``."""
    return F.when(_col(c).isNotNull(), F.concat(F.format_string("%.1f", _col(c)), F.lit("%"))).otherwise("-")


def multiple(c) -> Column:
    """``3.45x``; null gives ``-``."""
    return F.when(_col(c).isNotNull(), F.concat(F.format_string("%.2f", _col(c)), F.lit("x"))).otherwise("-")


def round_floats(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round every float/double column (display only)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])
