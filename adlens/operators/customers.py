"""Exact distinct customers that can be merged: a bitmap for each day, not a count.

Daily distinct counts can't be added up: a customer with three order days in a month would count three times. Here a day
holds, for each channel and kind (new, repeat), the set of its customers as bitmaps of 64 customer numbers; days merge
into months, and channels into totals, by OR, and the count of bits is the exact number. A bitmap is one long, so a day has
no more of them than orders, whatever the range of customer numbers, and a group's state is 8 bytes of a hash aggregate.
Daily rows can be kept, and a late or corrected day replaces its own rows only.

A customer is new on the first order day, through each channel of that day's orders, and repeat on every later order day.
Orders without a customer or day count for nobody.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: A bitmap holds 2**WORD_BITS customer numbers.
WORD_BITS = 6


def daily_customers(orders: DataFrame, customer: str, day: str, channel: Column) -> DataFrame:
    """(day, channel, kind, bucket, customers): the customers of a day as bitmaps (long). ``customer`` is a whole number."""
    rows = orders.where(F.col(customer).isNotNull() & F.col(day).isNotNull()).select(
        F.to_date(day).alias("day"), channel.alias("channel"), F.col(customer).cast("long").alias("customer"))
    first = F.min("day").over(Window.partitionBy("customer"))
    kind = F.when(F.col("day") == F.col("first_day"), "new").otherwise("repeat")
    bit = F.expr(f"shiftleft(1L, cast(customer & {(1 << WORD_BITS) - 1} as int))")
    return (rows.withColumn("first_day", first)
            .groupBy("day", "channel", kind.alias("kind"), F.shiftright("customer", WORD_BITS).alias("bucket"))
            .agg(F.bit_or(bit).alias("customers")))


def distinct_customers(daily: DataFrame, *keys: Column | str) -> DataFrame:
    """(keys ..., new_customers, repeat_customers) from daily bitmaps; a customer counts once for a key and kind."""
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    merged = daily.groupBy(*keys, "kind", "bucket").agg(F.bit_or("customers").alias("customers"))
    names = [c for c in merged.columns if c not in ("kind", "bucket", "customers")]
    count = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bit_count("customers"))), F.lit(0))
    return merged.groupBy(*names).agg(count("new").alias("new_customers"), count("repeat").alias("repeat_customers"))
