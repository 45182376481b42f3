"""Text expressions: join keys, defaults, token tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def campaign_key(c) -> Column:
    """Join key for campaign names written differently by two systems:
    lower, trim, each run of non ``[a-z0-9]`` becomes ``_``, outer ``_`` removed."""
    s = F.regexp_replace(F.lower(F.trim(_col(c))), "[^a-z0-9]+", "_")
    return F.regexp_replace(s, "^_+|_+$", "")


def lower_or_unknown(c) -> Column:
    """Missing text becomes ``unknown``; everything is lower-cased."""
    return F.lower(F.coalesce(_col(c).cast("string"), F.lit("unknown")))


def contains_any(c, tokens) -> Column:
    """True when the lower-cased text contains any token; null text gives false."""
    s = F.lower(_col(c))
    cond = F.lit(False)
    for t in tokens:
        cond = cond | F.coalesce(s.contains(t.lower()), F.lit(False))
    return cond


def relabel(c, mapping: dict) -> Column:
    """Exact value rewrite; values not in the mapping pass through."""
    c = _col(c)
    if not mapping:
        return c
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[c], c)
