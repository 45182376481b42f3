"""Sharding: k-d tree over document metadata, split at distributed weighted medians.

A node is a range of shards. Each level splits every node of more than one shard along its widest metadata
dimension (extent over the corpus' extent), at the key where its bytes part in proportion to the shards on
either side. With 16 shards that is the weighted median, four levels deep, and a leaf holds a sixteenth of
the bytes. The median is found by histograms: bytes per bin and node are added up on the executors, and
only the bin in which it lies is refined, until that bin holds one key or next to nothing. Rows with the
same metadata are told apart by a hash of the id, so a source with a third of all rows is split like any other.

The driver sees one row per node and round, never rows of the data. Numbers are scaled by their extent;
strings are ordered by their first bytes. Null metadata counts as 0 or empty, null text as empty. Rows that
share id and text stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm import common

SHARDS = 16
DIMENSIONS = ("n_chars", "source", "lang")
BINS = 4096
#: A bin with less than this share of its node's bytes isn't refined.
TOLERANCE = 2e-5
#: Rows of a shard are numbered in blocks of about this many.
BLOCK_ROWS = 50_000
_SCALE = 1 << 30


def _number(df: DataFrame, name: str) -> Column:
    """A metadata column as a number that keeps its order (strings: by their first 6 bytes)."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        value = F.col(name).cast("double")
        return F.when(F.isnan(value), 0.0).otherwise(F.coalesce(value, F.lit(0.0)))
    head = F.rpad(F.hex(F.substring(F.encode(F.coalesce(F.col(name).cast("string"), F.lit("")), "UTF-8"), 1, 6)), 12, "0")
    return F.conv(head, 16, 10).cast("double")


def _keys(df: DataFrame, dims: list[str]) -> DataFrame:
    """Each dimension as key_i: its scaled value in the upper bits, a hash of the row below."""
    for k, name in enumerate(dims):
        df = df.withColumn(f"_v{k}", _number(df, name))
    df = common.stash(df.select("doc_id", "size", "text_crc32", *[f"_v{k}" for k in range(len(dims))]))
    bounds = df.agg(*[f(f"_v{k}").alias(f"{n}{k}") for k in range(len(dims)) for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()
    tie = F.xxhash64("doc_id", "text_crc32", "size").bitwiseAND((1 << 32) - 1)
    keys = []
    for k in range(len(dims)):
        lo, hi = bounds[f"lo{k}"] or 0.0, bounds[f"hi{k}"] or 0.0
        scaled = ((F.col(f"_v{k}") - lo) / (hi - lo) * _SCALE).cast("long") if hi > lo else F.lit(0).cast("long")
        keys.append((scaled * (1 << 32) + tie).alias(f"key_{k}"))
    return df.select("doc_id", "size", "text_crc32", F.lit(0).alias("node"), *keys)


def _at(values: list, kind: str = "long") -> Column:
    """values[node] as an expression."""
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("node") + 1)


def _splits(df: DataFrame, dims: int, shards: int, parts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """For each node that splits, its dimension and the first key of its right side."""
    stats = (df.where(F.col("node").isin(*[n for n, k in parts.items() if k > 1])).groupBy("node")
             .agg(F.sum("size").alias("total"), *[f(f"key_{k}").alias(f"{n}{k}") for k in range(dims)
                                                  for f, n in ((F.min, "lo"), (F.max, "hi"))]).collect())
    state = {}
    for r in stats:
        k = max(range(dims), key=lambda k: ((r[f"hi{k}"] >> 32) - (r[f"lo{k}"] >> 32), -k))
        state[r.node] = {"dim": k, "lo": r[f"lo{k}"], "hi": r[f"hi{k}"], "base": 0, "total": r.total,
                         "target": r.total * (parts[r.node] // 2) / parts[r.node]}
    found: dict[int, tuple[int, int]] = {}
    while todo := {n: s for n, s in state.items() if n not in found}:
        column = lambda f, kind="long": _at([f(todo[n]) if n in todo else None for n in range(shards)], kind)
        dim = column(lambda s: s["dim"], "int")
        key = F.coalesce(*[F.when(dim == k, F.col(f"key_{k}")) for k in range(dims)])
        lo, hi = column(lambda s: s["lo"]), column(lambda s: s["hi"])
        width = column(lambda s: max(1, -(-(s["hi"] - s["lo"] + 1) // BINS)))
        bins = (df.withColumn("key", key).where(F.col("key").between(lo, hi))
                .groupBy("node", F.floor((F.col("key") - lo) / width).alias("bin"))
                .agg(F.sum("size").alias("bytes"), F.min("key").alias("first"), F.max("key").alias("last")))
        until = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        short = column(lambda s: s["target"] - s["base"], "double")
        at = (bins.withColumn("upto", F.sum("bytes").over(until)).where(F.col("upto") >= short)
              .groupBy("node").agg(F.min(F.struct("bin", "bytes", "upto", "first", "last")).alias("b")).collect())
        for node, b in at:
            s = todo[node]
            before = s["base"] + b.upto - b.bytes
            if b.first == b.last or b.bytes <= TOLERANCE * s["total"]:
                left = s["target"] - before <= s["base"] + b.upto - s["target"]
                found[node] = (s["dim"], b.first if left else b.last + 1)
            else:
                s.update(lo=b.first, hi=b.last, base=before)
    return found


def kd_shards(docs: DataFrame, shards: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for every row of ``docs`` (doc_id, text, metadata).
    ``shards`` is the number of leaves: total bytes over the target bytes of one."""
    dims = [d for d in dimensions if d in docs.columns] or ["doc_id"]
    sized = docs.withColumn("size", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long"))
    sized = sized.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    df = common.stash(_keys(sized, dims))
    parts = {0: shards}  # first shard of a node -> number of its shards
    while any(k > 1 for k in parts.values()):
        found = _splits(df, len(dims), shards, parts)
        dim = _at([found[n][0] if n in found else None for n in range(shards)], "int")
        cut = _at([found[n][1] if n in found else None for n in range(shards)])
        half = _at([parts.get(n, 0) // 2 for n in range(shards)], "int")
        key = F.coalesce(*[F.when(dim == k, F.col(f"key_{k}")) for k in range(len(dims))])
        node = F.col("node") + F.when(key >= cut, half).otherwise(0)
        df = common.stash(df.withColumn("node", node))
        parts = {n: max(1, k // 2) for n, k in parts.items()} | {n + k // 2: k - k // 2 for n, k in parts.items() if k > 1}
    return _numbered(df.select("doc_id", "size", "text_crc32", F.col("node").alias("shard")), shards)


def _numbered(df: DataFrame, shards: int) -> DataFrame:
    """slot: gapless from 0 in each shard. Rows are numbered in blocks; a block starts where the ones
    before it end."""
    blocks = max(1, -(-df.count() // (shards * BLOCK_ROWS)))
    df = df.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = common.stash(df.groupBy("shard", "block").agg(F.count("*").alias("n"))
                          .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    rank = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")) - 1
    return (df.join(starts, ["shard", "block"]).withColumn("slot", (F.col("start") + rank).cast("long"))
            .drop("start", "block"))


def op5_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards(common.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
