"""Benchmark decontamination: prefix-filtered set join of item-sized windows with whole documents.

1. Rarity: every word of the corpus is counted into hashed cells.
2. Each benchmark window keeps its rarest word as its prefix token, with its position. A document that
   contains the window contains that word, so for exact containment one prefix token is enough.
3. Documents look up their words among the prefix tokens. A hit at word p and a prefix position o give
   one start p - o (positional bound); the window must end inside the document (length bound).
4. Candidates that pass a fixed-size bitmap of window hashes carry their words, and an equi-join with the
   windows on those words verifies them exactly.

The two bitmaps are the only data sent to all tasks. Their size is fixed; a larger benchmark only makes
them denser, which costs candidates but loses nothing. The benchmark itself is joined by shuffle.

Null texts have no words. Rows that share a doc_id are judged one by one; items that share an item_id
count once, and a null item_id counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm import common, kernel

WINDOW = 10
RARITY_BITS = 16
TOKEN_BITS = 22
WINDOW_BITS = 24


def _words(part: pa.RecordBatch):
    data, offsets = kernel.utf8(part.column("text"))
    starts, ends, first = kernel.words(data, offsets, kernel.ALNUM)
    return data, starts, ends, first, kernel.hash_words(data, starts, ends)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << RARITY_BITS)
    for batch in batches:
        for part in kernel.pieces(batch, "text"):
            cell = _words(part)[4] >> np.uint64(64 - RARITY_BITS)
            total += np.bincount(cell.astype(np.int64), minlength=len(total))
    yield common.vector_batch(list(common.vector_rows("words", total)))


def _spell(data, starts, ends, at: int, size: int) -> str:
    chars = kernel.LOWER[data[starts[at]:ends[at + size - 1]]]
    return b" ".join(chars[a:b].tobytes() for a, b in zip(
        starts[at:at + size] - starts[at], ends[at:at + size] - starts[at], strict=True)).decode("utf-8", "replace")


WINDOWS = "item string, words string, size int, hash long, token long, place int"


def _windows(counts: np.ndarray, window: int):
    """Item windows with their rarest word (ties: the first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends, first, hashes = _words(batch)
            rows = []
            for k, item in enumerate(batch.column("item").to_pylist()):
                n = int(first[k + 1] - first[k])
                size = min(window, n)
                for at in range(first[k], first[k + 1] - size + 1) if n else ():
                    own = hashes[at:at + size]
                    place = int(np.argmin(counts[(own >> np.uint64(64 - RARITY_BITS)).astype(np.int64)]))
                    rows.append((item, _spell(data, starts, ends, at, size), size,
                                 int(kernel.grams(own, size)[0].astype(np.int64)), int(own[place].astype(np.int64)), place))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 6, [
                    pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32()], strict=True)],
                ["item", "words", "size", "hash", "token", "place"])
    return run


FOUND = "row long, doc_id long, content long, n_words long, start long, size int, words string"


def _search(tokens: np.ndarray, hashes: np.ndarray, shapes: list[tuple[int, int]]):
    """One row per document, and one per place where a window may stand. ``tokens`` and ``hashes``
    are packed bitmaps; ``shapes`` the (size, place of the prefix token) that occur."""
    places: dict[int, list[int]] = {}
    for size, place in shapes:
        places.setdefault(size, []).append(place)

    def marked(bits: np.ndarray, x: np.ndarray, width: int) -> np.ndarray:
        x = (x & np.uint64((1 << width) - 1)).astype(np.int64)
        return (bits[x >> 3] >> (x & 7).astype(np.uint8)) & 1 > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in kernel.pieces(batch, "text"):
                data, starts, ends, first, words = _words(part)
                n = part.num_rows
                ids, contents = part.column("doc_id").to_pylist(), part.column("content").to_pylist()
                found = [(row + k, ids[k], contents[k], int(first[k + 1] - first[k]), None, None, None) for k in range(n)]
                prefix = np.flatnonzero(marked(tokens, words, TOKEN_BITS)) if places else ()
                for size, at in places.items() if len(prefix) else ():
                    start = np.unique(prefix[:, None] - np.array(at)[None, :])
                    start = start[(start >= 0) & (start + size <= len(words))]
                    doc = np.searchsorted(first, start, "right") - 1
                    inside = start + size <= first[doc + 1]
                    start, doc = start[inside], doc[inside]
                    total = np.full(len(start), np.uint64(size))
                    for k in range(size):
                        total *= np.uint64(0xD6E8FEB86659FD93)
                        total += words[start + k]
                    hit = marked(hashes, kernel.mix(total), WINDOW_BITS)
                    found += [(row + d, None, None, None, s - int(first[d]), size, _spell(data, starts, ends, s, size))
                              for s, d in zip(start[hit].tolist(), doc[hit].tolist(), strict=True)]
                row += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found, strict=True), [
                        pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()], strict=True)],
                    [x.split()[0] for x in FOUND.split(", ")])
    return run


def contained(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The documents (row, doc_id, content, n_words) and every window of an item found in one
    (row, start, size, item)."""
    docs = docs.select("doc_id", "text", common.content().alias("content"))
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    counts = common.sum_vectors(common.arrow(docs.select("text"), _count, common.VECTOR_SCHEMA),
                                {"words": 1 << RARITY_BITS})["words"]
    windows = common.stash(common.arrow(items, _windows(counts, window), WINDOWS).distinct())
    shapes = [tuple(r) for r in windows.select("size", "place").distinct().collect()]  # window**2 / 2 at most
    bits = [np.packbits(common.bitmap(windows, c, b), bitorder="little")
            for c, b in (("token", TOKEN_BITS), ("hash", WINDOW_BITS))]
    found = common.stash(common.arrow(docs, _search(*bits, shapes), FOUND))
    hits = (found.where("start is not null").select("row", "start", "size", "words")
            .join(windows.select("size", "words", "item").distinct(), ["size", "words"]))
    return found.where("start is null").select("row", "doc_id", "content", "n_words"), hits


def covered(hits: DataFrame) -> DataFrame:
    """Words of each document that lie in any hit: the union of the spans, by running maximum."""
    spans = hits.select("row", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    return (spans.withColumn("fresh", F.greatest(fresh, F.lit(0)))
            .groupBy("row").agg(F.sum("fresh").alias("n_hit")))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items (sorted as strings) and contaminated."""
    rows, hits = contained(docs, items, window)
    hits = common.stash(hits)
    found = hits.select("row", "item").distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return (rows.join(covered(hits), "row", "left").join(found, "row", "left")
            .select("row", "doc_id", "content", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t FROM (
  SELECT item_id, w, least({WINDOW}, len(w)) AS k, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i
  FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS t FROM (
  SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT r, i, dw.k, item_id FROM dw JOIN bw ON dw.t = bw.t AND dw.k = bw.k),
n AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""
