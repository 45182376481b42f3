"""Month/date expressions. Months are ``yyyy-MM`` strings throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month-name tokens recognised in export file names.
MONTH_TOKENS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7,
    "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
}
# A token, at most one separator, and a year of exactly four or two digits.
MONTH_NAME_RE = "(" + "|".join(sorted(MONTH_TOKENS, key=len, reverse=True)) + r")[_ \-]?(\d{4}|\d{2})(?!\d)"

# Day formats seen in exports: ISO and US-style.
DAY_FORMATS = ("yyyy-MM-dd", "M/d/yyyy")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(c) -> Column:
    """``yyyy-MM`` of a date/timestamp column."""
    return F.date_format(_col(c), "yyyy-MM")


def parse_day(c) -> Column:
    """Date from text in any of the export formats; bad text gives null."""
    s = F.trim(_col(c).cast("string"))
    return F.coalesce(*[F.try_to_date(s, f) for f in DAY_FORMATS])


def day_to_month(day, fallback=None) -> Column:
    """Month of a day string; when the day does not parse, the fallback month."""
    m = F.date_format(parse_day(day), "yyyy-MM")
    return m if fallback is None else F.coalesce(m, _col(fallback))


def month_start_date(month) -> Column:
    return F.to_date(F.concat(_col(month), F.lit("-01")))


def month_label(month) -> Column:
    """``2025-12`` -> ``Dec 2025``."""
    return F.date_format(month_start_date(month), "MMM yyyy")


def month_from_name(name) -> Column:
    """Month from a file name such as ``Dec_25`` or ``Feb 2026``; first hit
    wins, a two-digit year is 20yy, no hit gives the empty string."""
    s = F.lower(_col(name))
    mon = F.regexp_extract(s, MONTH_NAME_RE, 1)
    yr = F.regexp_extract(s, MONTH_NAME_RE, 2)
    m = F.create_map(*[F.lit(x) for kv in MONTH_TOKENS.items() for x in kv])
    year = F.when(F.length(yr) == 4, yr).otherwise(F.concat(F.lit("20"), yr))
    return F.when(mon == "", F.lit("")).otherwise(
        F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(m[mon].cast("string"), 2, "0")))


def add_months_str(month, n: int) -> Column:
    return F.date_format(F.add_months(month_start_date(month), n), "yyyy-MM")
