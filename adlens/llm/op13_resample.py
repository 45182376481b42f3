"""Target-distribution importance resampling with hashed n-gram features, hashed by a position-table CRC.

A feature is a run of 1 to ``runs`` consecutive words joined by one space; its bucket is the CRC-32 of its bytes modulo
BUCKETS. Buckets are counted over the raw documents and over the target texts, each bucket has a gain (a scaled log
ratio of the smoothed shares), a document's weight is the mean gain of its features, and the documents with the highest
weight plus a Gumbel noise that its id alone decides are drawn: sampling without replacement in proportion to exp(weight).

Position-table CRC: CRC-32 is linear over XOR. A byte contributes a number that depends on the byte and on its distance
from the end of the span, the length contributes a constant, and the CRC is the XOR of all of them. With the
contributions precomputed for SPAN distances, all features of a megabyte of text are hashed by one table look-up a byte
and one ``bitwise_xor.reduceat`` over the feature spans. Longer spans are cut into blocks of SPAN bytes from their end;
the blocks are folded from left to right, each fold advancing the value by SPAN zero bytes (four more tables).

1. Count: every task counts its buckets; vectors of BUCKETS numbers are added up.
2. Weigh: gains go to all tasks (BUCKETS numbers); every document gets n_words, n_features, weight and score.
3. Draw: scores are whole numbers. Counts by score give the score at which the draw ends (as many rows as there are
   scores, which doesn't grow with the documents), and the number of documents before each score. Within a score,
   documents are ranked in blocks of doc_id ranges, so that no task gets a score of a whole corpus.

Null text has no words. A null doc_id counts as an empty one in the noise and comes first in ties. Rows that share a
doc_id are drawn one by one, ties by text hash. An empty target leaves all gains to the smoothing. Empty documents give
an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm import common, kernel

BUCKETS = 10_000
RUNS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Distances from the end that the contribution table holds.
SPAN = 64
#: The reflected CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320
#: Documents of one score that are ranked in one task, about.
BLOCK_ROWS = 50_000


# --- position-table CRC -------------------------------------------------------------------------------------------

@functools.cache
def _zero_byte() -> np.ndarray:
    """What one byte of the register becomes when it is shifted out."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _advance(value: np.ndarray, steps: int) -> np.ndarray:
    """Registers after ``steps`` zero bytes."""
    table = _zero_byte()
    for _ in range(steps):
        value = (value >> np.uint32(8)) ^ table[value & np.uint32(255)]
    return value


@functools.cache
def tables(span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """contributions[distance from the end, byte], and fold[k, byte]: the value of byte k of a register after ``span``
    zero bytes."""
    contributions = np.empty((span, 256), np.uint32)
    contributions[0] = _zero_byte()
    for d in range(1, span):
        contributions[d] = _advance(contributions[d - 1], 1)
    fold = np.stack([_advance(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), span) for k in range(4)])
    return contributions, fold


def _folded(value: np.ndarray, fold: np.ndarray) -> np.ndarray:
    out = fold[0][value & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ fold[k][(value >> np.uint32(8 * k)) & np.uint32(255)]
    return out


@functools.cache
def _length_constants(span: int = SPAN) -> np.ndarray:
    """What the initial and the final inversion contribute to a span of 0 to ``span`` bytes."""
    out = np.empty(span + 1, np.uint32)
    register = np.array([0xFFFFFFFF], np.uint32)
    for n in range(span + 1):
        out[n] = register[0] ^ np.uint32(0xFFFFFFFF)
        register = _advance(register, 1)
    return out


def crc32_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, span: int = SPAN) -> np.ndarray:
    """CRC-32 of each data[start:start + length] (lengths of 1 or more; spans may overlap)."""
    if not len(starts):
        return np.empty(0, np.uint32)
    contributions, fold = tables(span)
    blocks = -(-lengths // span)
    if int(blocks.max()) == 1:
        begin, size = starts, lengths
    else:  # the first block of a span is the short one
        of = np.repeat(np.arange(len(starts)), blocks)
        place = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        head = lengths - (blocks - 1) * span
        begin = starts[of] + np.where(place > 0, head[of] + (place - 1) * span, 0)
        size = np.where(place > 0, span, head[of])
    edge = np.cumsum(size) - size
    distance = np.repeat(edge + size - 1, size) - np.arange(int(size.sum()))
    bytes_ = data[np.repeat(begin - edge, size) + np.arange(len(distance))]
    value = np.bitwise_xor.reduceat(contributions[distance, bytes_], edge)
    if len(value) == len(starts):
        return value ^ _length_constants(span)[lengths]
    first = np.cumsum(blocks) - blocks
    # the inverted initial register joins the first block, and is folded on with it
    out = value[first] ^ _length_constants(span)[lengths - (blocks - 1) * span] ^ np.uint32(0xFFFFFFFF)
    left = np.flatnonzero(blocks > 1)
    at = 1
    while len(left):
        out[left] = _folded(out[left], fold) ^ value[first[left] + at]
        at += 1
        left = left[blocks[left] > at]
    return out ^ np.uint32(0xFFFFFFFF)


# --- features -----------------------------------------------------------------------------------------------------

def features(batch: pa.RecordBatch, runs: int = RUNS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every feature of a batch with a text column, and the rows' word counts."""
    data, offsets = kernel.utf8(batch.column("text"))
    starts, ends, first = kernel.words(data, offsets, kernel.ALNUM)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(n_words)), n_words)
    size = ends - starts
    # the words one after the other, a space behind each
    begin = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    at = np.repeat(begin, size) + (np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size))
    joined[at] = kernel.LOWER[data[kernel.ALNUM[data]]] if len(data) else data
    bucket, of = [], []
    for run in range(1, runs + 1):
        head = np.arange(max(0, len(starts) - run + 1))
        head = head[row[head] == row[head + run - 1]] if len(head) else head
        tail = head + run - 1
        hashes = crc32_spans(joined, begin[head], begin[tail] + size[tail] - begin[head])
        bucket.append(hashes.astype(np.int64) % buckets)
        of.append(row[head])
    return np.concatenate(bucket), np.concatenate(of), n_words


def _count(runs: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets)
        for batch in batches:
            for part in kernel.pieces(batch, "text"):
                total += np.bincount(features(part, runs, buckets)[0], minlength=buckets)
        yield common.vector_batch(list(common.vector_rows("bucket", total)))
    return run


def bucket_counts(texts: DataFrame, runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of ``texts`` (text) fall into each bucket."""
    return common.sum_vectors(common.arrow(texts.select("text"), _count(runs, buckets), common.VECTOR_SCHEMA),
                              {"bucket": buckets})["bucket"]


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain, in thousandths of a nat."""
    n, s, t = float(len(raw)), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n))))
                     for a, b in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: str) -> int:
    """Gumbel noise in thousandths, by the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


WEIGHED = "doc_id long, content long, n_words long, n_features long, weight long, score long"


def _weigh(gain: np.ndarray, runs: int, seed: str):
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        bucket, row, n_words = features(part, runs, len(gain))
        n = np.bincount(row, minlength=part.num_rows)
        total = np.zeros(part.num_rows, np.int64)
        edges = np.flatnonzero(np.diff(row, prepend=-1)) if runs == 1 else None
        if runs == 1 and len(row):
            total[row[edges]] = np.add.reduceat(gain[bucket], edges)
        elif len(row):
            np.add.at(total, row, gain[bucket])
        weight = total // np.maximum(n, 1)
        ids = part.column("doc_id")
        score = weight + np.array([noise(x, seed) for x in ids.to_pylist()], np.int64)
        return pa.RecordBatch.from_arrays(
            [ids, part.column("content"), *[pa.array(x, pa.int64()) for x in (n_words, n, weight, score)]],
            [x.split()[0] for x in WEIGHED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.pieces(batch, "text"):
                yield rows(part)
    return run


def weigh(docs: DataFrame, target: DataFrame, runs: int = RUNS, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """doc_id, content, n_words, n_features, weight and score of every row of ``docs`` (doc_id, text), written to the
    shared folder."""
    gain = gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", common.content().alias("content"))
    return common.stash(common.arrow(docs, _weigh(gain, runs, seed), WEIGHED))


def draw(weighed: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT,
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``weighed`` with the ``rank`` of the drawn rows, null for the others."""
    can = weighed.where(F.col("n_words") >= least_words)
    scores = sorted(can.groupBy("score").count().collect(), reverse=True)  # a row for each whole number that occurs
    wanted = sum(r["count"] for r in scores) * percent // 100
    before, starts, cut = 0, [], None
    for score, count in scores:
        if before >= wanted:
            break
        starts.append((score, before, max(1, -(-count // block_rows))))
        before, cut = before + count, score
    if cut is None:
        return weighed.withColumn("rank", F.lit(None).cast("long"))
    spark = weighed.sparkSession
    at = F.broadcast(spark.createDataFrame(starts, "score long, before long, blocks int"))
    top = can.where(F.col("score") >= cut).join(at, "score")
    if any(blocks > 1 for _, _, blocks in starts):
        top = _blocked(top, block_rows)
    else:
        top = top.withColumn("base", F.lit(0).cast("long")).withColumn("block", F.lit(0))
    place = F.row_number().over(Window.partitionBy("score", "block").orderBy(F.asc_nulls_first("doc_id"), "content"))
    top = top.withColumn("rank", F.col("before") + F.col("base") + place)
    drawn = top.where(F.col("rank") <= wanted).select(*weighed.columns, "rank")
    no = F.lit(None).cast("long")
    rest = weighed.where((F.col("n_words") < least_words) | (F.col("score") < cut)).withColumn("rank", no)
    missed = top.where(F.col("rank") > wanted).select(*weighed.columns).withColumn("rank", no)
    return drawn.unionByName(rest).unionByName(missed)


def _blocked(top: DataFrame, block_rows: int) -> DataFrame:
    """``base`` and ``block``: rows of a crowded score in doc_id order are dealt to blocks of equal parts of the score's
    doc_id range, and a block starts where the ones before it end."""
    span = top.where("blocks > 1").groupBy("score").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    top = top.join(F.broadcast(span), "score", "left")
    width = (F.col("hi").cast("double") - F.col("lo") + 1) / F.col("blocks")
    block = F.floor((F.col("doc_id").cast("double") - F.col("lo")) / width).cast("int")
    top = top.withColumn("block", F.when(F.col("blocks") > 1, F.coalesce(F.least(block, F.col("blocks") - 1), F.lit(-1)))
                         .otherwise(0)).drop("lo", "hi")
    until = Window.partitionBy("score").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = (top.groupBy("score", "block").count()
            .withColumn("base", F.coalesce(F.sum("count").over(until), F.lit(0))).drop("count"))
    return top.join(base, ["score", "block"])


def resample(docs: DataFrame, target: DataFrame, runs: int = RUNS, buckets: int = BUCKETS, seed: str = SEED,
             least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """The drawn rows of ``docs`` (doc_id, text, ...) with their rank. Only the drawn names meet the texts; of rows with
    equal doc_id and text as many stay as were drawn."""
    drawn = draw(weigh(docs, target, runs, buckets, seed), least_words, percent).where("rank is not null")
    names = [c for c in docs.columns if c != "rank"]
    again = Window.partitionBy("_id", "_of").orderBy("rank")
    drawn = drawn.select(F.col("doc_id").alias("_id"), F.col("content").alias("_of"), "rank")
    drawn = common.stash(drawn.withColumn("_at", F.row_number().over(again)))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_content") == F.col("_of"))
    texts = docs.select(names).withColumn("_content", common.content()).join(drawn.where("_at = 1"), same, "left_semi")
    texts = texts.withColumn("_nth", F.row_number().over(Window.partitionBy("doc_id", "_content").orderBy(F.lit(0))))
    return texts.join(drawn, same & (F.col("_nth") == F.col("_at"))).select(*names, "rank")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = draw(weigh(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark")))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT r, unnest(w) AS x FROM d),
bw AS (SELECT unnest({_WORDS}) AS x FROM benchmark),
tab AS (SELECT list(list_reduce([k] || range(8), lambda c, i: CASE WHEN c % 2 = 1
  THEN xor(c // 2, {POLYNOMIAL}) ELSE c // 2 END) ORDER BY k) AS t FROM (SELECT unnest(range(256)) AS k)),
vocab AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM dw UNION SELECT x FROM bw)),
bucket AS (SELECT x, xor(list_reduce([4294967295::BIGINT] || list_transform(range(len(h) // 2),
  lambda i: (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1),
  lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % {BUCKETS} AS b FROM vocab, tab),
s AS (SELECT b, count(*) AS s FROM dw JOIN bucket USING (x) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM bw JOIN bucket USING (x) GROUP BY b),
g AS (SELECT b, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + {BUCKETS})
  / ((coalesce(s, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + {BUCKETS})))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT b FROM bucket) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
f AS (SELECT r, count(*) AS n, sum(gain) AS total FROM dw JOIN bucket USING (x) JOIN g USING (b) GROUP BY r),
q AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features,
  CAST(coalesce(total, 0) // coalesce(n, 1) - CASE WHEN coalesce(total, 0) % coalesce(n, 1) < 0 THEN 1 ELSE 0 END AS BIGINT) AS weight,
  CAST('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8] AS BIGINT) AS h FROM d LEFT JOIN f USING (r)),
sc AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM q),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM sc WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CAST(CASE WHEN k <= {PERCENT} * n // 100 THEN k END AS BIGINT) AS rank
FROM sc LEFT JOIN o USING (r)
"""
