"""Numeric cleaning and null-aware sums (all JVM-side column expressions).

Spark's own ``try_cast`` is more lenient than the exports' numeric text
rules: it accepts ``12d``, ``Infinity`` and ``NaN``. Every parse below is
therefore guarded by a plain decimal/exponent pattern first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A plain decimal number with optional sign, fraction and exponent.
NUMBER_RE = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"

MONEY_PRECISION = 18
MONEY_SCALE = 4


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(text: Column) -> Column:
    """Strict parse of text to double; anything that is not a plain number is null."""
    return F.when(text.rlike(NUMBER_RE), text.try_cast("double"))


def to_num(c) -> Column:
    """Tolerant measure parse: drop ``,`` and ``%``, parse, bad -> null.

    ``3.2%`` becomes 3.2 (not 0.032), ``1,234.5`` becomes 1234.5, ``--`` is null.
    """
    text = F.regexp_replace(_col(c).cast("string"), "[,%]", "")
    return parse_number(text)


def strict_num(c) -> Column:
    """Parse without any cleaning: ``1,234`` is null."""
    return parse_number(_col(c).cast("string"))


def clean_numeric_text(c) -> Column:
    """Cleaning step of the all-or-nothing column rule, as text.

    Exact ``--`` / ``nan`` / ``None`` and blanks become null; ``,`` and ``%``
    are dropped; then every character except digits, ``.`` and ``-`` goes.
    """
    s = _col(c).cast("string")
    s = F.when(s.isin("--", "nan", "None"), F.lit(None)).otherwise(s)
    s = F.regexp_replace(s, "[,%]", "")
    s = F.when(s == "", F.lit(None)).otherwise(s)
    return F.regexp_replace(s, r"[^0-9.\-]", "")


def clean_numeric(c) -> Column:
    """Cleaned value parsed to double (null when the cleaned text is no number)."""
    t = clean_numeric_text(c)
    return F.when(t.rlike(r"^-?(\d+\.?\d*|\.\d+)$"), t.try_cast("double"))


def coerce_numeric(df: DataFrame, exclude=()) -> DataFrame:
    """Convert every string column (not excluded) to double only when *all* of
    its non-null cleaned cells parse; otherwise the column keeps its text.

    Two passes by nature: one aggregate job counts bad cells per column, one
    projection applies the decision. The aggregate is a single scan with
    partial aggregation, so its cost is one read of the data.
    """
    cands = [f.name for f in df.schema.fields
             if isinstance(f.dataType, T.StringType) and f.name not in set(exclude)]
    if not cands:
        return df
    bad = df.agg(*[
        F.count_if(clean_numeric_text(F.col(c)).isNotNull() & clean_numeric(F.col(c)).isNull())
        .alias(c) for c in cands
    ]).first().asDict()
    ok = {c for c in cands if bad[c] == 0}
    return df.select(*[
        clean_numeric(F.col(f.name)).alias(f.name) if f.name in ok else F.col(f.name)
        for f in df.schema.fields
    ])


def column_coercion_report(df: DataFrame, columns) -> DataFrame:
    """Long form of the all-or-nothing decision: one row per column with the
    number of non-null cells, the number of bad cells and the verdict.
    One scan with one global (partially aggregated) count per column."""
    aggs = []
    for c in columns:
        t = clean_numeric_text(F.col(c))
        aggs += [F.count_if(t.isNotNull()).alias(f"{c}__n"),
                 F.count_if(t.isNotNull() & clean_numeric(F.col(c)).isNull()).alias(f"{c}__bad")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("n_values"),
                              F.col(f"{c}__bad").alias("n_bad")) for c in columns])
    return (wide.select(F.explode(rows).alias("r")).select("r.*")
            .withColumn("is_numeric", F.col("n_bad") == 0))


def money(c, scale: int = MONEY_SCALE, precision: int = MONEY_PRECISION) -> Column:
    """Money as a fixed-point decimal so sums do not depend on row order.
    Row values use 18 digits (compact long arithmetic); re-summing already
    summed values uses ``precision=38``."""
    return _col(c).cast(T.DecimalType(precision, scale))


def sum_money(c, scale: int = MONEY_SCALE, precision: int = MONEY_PRECISION) -> Column:
    """Null-preserving sum (a group whose values are all null gives null)."""
    return F.sum(money(c, scale, precision)).cast("double")


def sum_money_or_zero(c, scale: int = MONEY_SCALE, precision: int = MONEY_PRECISION) -> Column:
    """Zero-filling sum (a group whose values are all null gives 0)."""
    return F.coalesce(F.sum(money(c, scale, precision)).cast("double"), F.lit(0.0))


def resum(c) -> Column:
    """Null-preserving re-sum of values that are already sums."""
    return sum_money(c, MONEY_SCALE, 38)
