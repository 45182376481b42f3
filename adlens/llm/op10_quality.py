"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Two multinomials over hashed word 1- and 2-grams are estimated: the raw one from every document,
the target one from documents labelled good. A document's score is its mean log ratio per n-gram; a document that
the target was estimated from is scored without its own counts, so labelled scores are like those of any other.
The threshold is fixed before any document is judged: the score that best parts the labelled rows,
where rejecting a good one costs ``clean_cost`` times what keeping a bad one gains.

Null text has no words. Without labels, or without both kinds, no model can reject: only the plain
rules decide. Rows that share a doc_id are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import common, kernel

BUCKET_BITS = 16
#: The target multinomial is fitted on at most so many trusted rows (smallest id hashes first).
TRUSTED_ROWS = 20_000
SMOOTHING = 0.5
CLEAN_COST = 20.0
BIN = 0.01
SYMBOLS = b"#*$%&|<>"


def _ngrams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all 1- and 2-grams, the row of each, and the rows' n-gram counts."""
    data, offsets = kernel.utf8(batch.column("text"))
    starts, ends, first = kernel.words(data, offsets, kernel.NOT_SPACE)
    hashes = kernel.hash_words(data, starts, ends)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs = kernel.grams(hashes, 2)
    same = row[1:] == row[:-1]
    bucket = np.concatenate([hashes, pairs[same]]) >> np.uint64(64 - BUCKET_BITS)
    row = np.concatenate([row, row[1:][same]])
    return bucket.astype(np.int64), row, np.bincount(row, minlength=batch.num_rows)


def _count(trusted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
        for batch in batches:
            for part in kernel.pieces(batch, "text"):
                bucket, row, _ = _ngrams(part)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                good = np.isin(ids, trusted)[row]
                raw += np.bincount(bucket, minlength=len(raw))
                target += np.bincount(bucket[good], minlength=len(raw))
        yield common.vector_batch([*common.vector_rows("raw", raw), *common.vector_rows("target", target)])
    return run


METRICS = ("doc_id long, content long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "score double")


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def repeated(windows: np.ndarray, size: int) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows) + size, np.int64)
    hit = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    twice[hit] += 1
    np.subtract.at(twice, hit + size, 1)
    return int((np.cumsum(twice) > 0).sum())


class Model:
    """Hashed n-gram counts of the target and the raw corpus, and the ids the target was counted from."""

    def __init__(self, target: np.ndarray, raw: np.ndarray, trusted: np.ndarray):
        cells = SMOOTHING * len(raw)
        self.target, self.trusted = target.astype(np.float32), trusted
        self.total = float(target.sum()) + cells
        self.raw = (np.log(raw + SMOOTHING) - np.log(raw.sum() + cells)).astype(np.float32)

    def score(self, batch: pa.RecordBatch) -> np.ndarray:
        """Mean log ratio per n-gram of each row."""
        bucket, row, n = _ngrams(batch)
        count, total = self.target[bucket].astype(np.float64), np.full(batch.num_rows, self.total)
        own = np.isin(batch.column("doc_id").to_numpy(zero_copy_only=False), self.trusted)
        if own.any():  # leave the document itself out
            at = np.flatnonzero(own[row])
            _, place, times = np.unique(row[at] * len(self.raw) + bucket[at], return_inverse=True, return_counts=True)
            count[at] = np.maximum(count[at] - times[place], 0)
            total[own] = np.maximum(total[own] - n[own], SMOOTHING * len(self.raw))
        ratio = np.log(count + SMOOTHING) - np.log(total)[row] - self.raw[bucket]
        return np.bincount(row, ratio, batch.num_rows) / np.maximum(n, 1)


def _measure(model: Model | None):
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True

    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = kernel.utf8(part.column("text"))
        starts, ends, first = kernel.words(data, offsets, kernel.NOT_SPACE)
        windows = kernel.grams(kernel.hash_words(data, starts, ends, lower=False), 3)
        total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
        chars = total(kernel.NOT_SPACE[data] & ((data & 0xC0) != 0x80))
        raw = data.tobytes()
        dup, again = [], []
        for i in range(part.num_rows):
            text = raw[offsets[i]:offsets[i + 1]]
            dup.append(_dup_lines(text) if b"\n" in text else 0)
            again.append(repeated(windows[first[i]:max(first[i], first[i + 1] - 2)], 3))
        score = model.score(part) if model else np.zeros(part.num_rows)
        columns = [part.column("doc_id"), part.column("content"), np.diff(first), chars, total(symbol[data]), dup, again, score]
        kinds = [pa.int64()] * 7 + [pa.float64()]
        return pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            [x.split()[0] for x in METRICS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernel.pieces(batch, "text"):
                yield rows(part)
    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The two multinomials; None without a trusted row."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    trusted = np.array([r[0] for r in common.lowest(good, TRUSTED_ROWS, "doc_id").collect()], np.int64)
    size = {"raw": 1 << BUCKET_BITS, "target": 1 << BUCKET_BITS}
    got = common.sum_vectors(common.arrow(docs.select("doc_id", "text"), _count(trusted), common.VECTOR_SCHEMA), size)
    return Model(got["target"], got["raw"], trusted) if got["target"].any() else None


def threshold(scored: DataFrame, labels: DataFrame) -> float:
    """Score below which a document goes, from a histogram of the labelled rows' scores (BIN wide;
    as many bins as the scores span, whatever the number of rows)."""
    known = (scored.join(labels.select("doc_id", "quality").where("quality in (0, 1)").distinct(), "doc_id")
             .where("n_words > 0")
             .groupBy(F.floor(F.col("score") / BIN).alias("bin"))
             .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
             .orderBy("bin").collect())
    good, bad = sum(r.good for r in known), sum(r.bad for r in known)
    if not good or not bad:
        return float("-inf")
    best, at, g, b = 0.0, float("-inf"), 0, 0
    for r in known:
        g, b = g + r.good, b + r.bad
        if b / bad - CLEAN_COST * g / good > best:
            best, at = b / bad - CLEAN_COST * g / good, (r.bin + 1) * BIN
    return at


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, base_failed, score, threshold and the verdict ``kept`` for every row of ``docs``
    (doc_id, text)."""
    docs = docs.select("doc_id", "text", common.content().alias("content"))
    scored = common.stash(common.arrow(docs, _measure(fit(docs, labels)), METRICS))
    at = threshold(scored, labels)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (scored.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("score") >= F.lit(at)))
            .withColumn("threshold", F.lit(at)))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")).drop("content")
