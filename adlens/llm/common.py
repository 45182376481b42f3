"""Shared plumbing of the llm operators: reading, cutting lineage, summing task vectors, bounded bitmaps."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE = 4096
#: Rows of an Arrow batch. Spark's default of 10,000 whole texts would be tens of megabytes, several times a task.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Shuffle files of a query go when it ends, not when the driver's JVM happens to collect its plan.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scratch: list[str] = []
_shipped: set[str] = set()
#: Paths stashed within the innermost ``released``, and those of the one around it.
_stashed: ContextVar[tuple[list[str], list[str] | None] | None] = ContextVar("stashed", default=None)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of every executor, once per application, and see to batches
    that hold whole texts in little memory (unless the session sets its own size)."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="adlens-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "adlens_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _lean(task: Task) -> Task:
    """``task``, which gives its memory back to the system when it ends: a Python worker lives on between
    tasks and stages, and what its allocators keep counts against the executor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)
    return run


def arrow(df: DataFrame, task: Task, schema: str) -> DataFrame:
    """mapInArrow with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(_lean(task), schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a scratch folder only in local mode (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _scratch:
        _scratch.append(tempfile.mkdtemp(prefix="adlens-"))
        atexit.register(shutil.rmtree, _scratch[0], ignore_errors=True)
    return "file://" + _scratch[0]


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Tables stashed within are deleted at the end, but for those stashed with ``hold``, which belong to what is
    around it. What is read afterwards must come from held tables only."""
    outer = _stashed.get()
    token = _stashed.set((own := [], outer[0] if outer else None))
    try:
        yield
    finally:
        _stashed.reset(token)
        for path in own:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stash(df: DataFrame, hold: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages don't recompute it, and
    losing an executor loses nothing. Its shuffle files are deleted at once; within ``released`` it is deleted
    itself at the end unless held."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stash-{uuid.uuid4().hex}"
    own, around = _stashed.get() or (None, None)
    owner = around if hold else own
    if owner is not None:
        owner.append(path)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def vector_rows(kind: str, vector: np.ndarray) -> Iterator[tuple[str, int, bytes]]:
    """A task's count vector as rows of at most SLICE numbers, in the narrowest type that holds them (its
    name comes first); slices that are all zero are left out."""
    for k in range(0, len(vector), SLICE):
        part = vector[k:k + SLICE]
        if part.any():
            yield kind, k // SLICE, _narrow(part)


def _narrow(part: np.ndarray) -> bytes:
    top = part.max()
    narrow = next((w for w, most in ((b"u1", 255), (b"u2", 65535)) if top <= most), b"f8")
    narrow = narrow if part.min() >= 0 and (part == np.floor(part)).all() else b"f8"
    return narrow + part.astype("<" + narrow.decode()).tobytes()


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<" + bytes(packed[:2]).decode(), offset=2).astype(np.float64)


VECTOR_SCHEMA = "kind string, slice int, numbers binary"


def vector_batch(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    kind, part, numbers = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.string()), pa.array(part, pa.int32()), pa.array(numbers, pa.binary())],
        ["kind", "slice", "numbers"])


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        for kind, part, numbers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            values = _numbers(numbers)
            old = total.get((kind, part))
            total[kind, part] = values if old is None else old + values
    yield vector_batch([(k, s, _narrow(v)) for (k, s), v in sorted(total.items())])


def sum_vectors(df: DataFrame, lengths: dict[str, int], kept_as: type = np.float64) -> dict[str, np.ndarray]:
    """Add up the task vectors of ``df`` (VECTOR_SCHEMA). Slices are added on the executors, each
    slice in one task; the driver gets one vector of fixed length per kind, sent in the narrowest types and
    ``kept_as`` numbers of that type. Counts stay exact below 2**53, in as far as the type holds them."""
    wanted = sum(-(-n // SLICE) for n in lengths.values())
    parts = max(1, min(wanted, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    summed = arrow(df.repartition(parts, "kind", "slice"), _add_slices, VECTOR_SCHEMA)
    out = {kind: np.zeros(-(-n // SLICE) * SLICE, kept_as) for kind, n in lengths.items()}
    for kind, part, numbers in summed.collect():  # fixed size: sum(lengths) numbers
        values = _numbers(numbers)  # all of the slice
        out[kind][part * SLICE:part * SLICE + len(values)] = values
    return {kind: out[kind][:n] for kind, n in lengths.items()}


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which of 2**bits cells the hashes in ``column`` (long) fall into, as a boolean array of that
    fixed size, whatever the number of rows."""
    cell = F.col(column).bitwiseAND((1 << bits) - 1)
    rows = (df.groupBy(F.shiftright(cell, 15).alias("slot"))
            .agg(F.bitmap_construct_agg(cell.bitwiseAND(32767)).alias("bits")).collect())
    out = np.zeros(max(1 << bits, 1 << 15), bool)
    for slot, packed in rows:  # at most 2**bits / 32768 rows of 4 KB
        on = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").astype(bool)
        out[slot * 32768:slot * 32768 + len(on)] |= on
    return out[:1 << bits]


def _as_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots of 32768 bits as 512 numbers, of which a join's rows read one in place; a binary is copied for each row."""
    for batch in batches:
        words = [np.frombuffer(x, "<i8") for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.int64()))], ["_slot", "_words"])


def _probe(df: DataFrame, column: str, keys: DataFrame, key: str, bits: int) -> DataFrame:
    cell = F.col(key).bitwiseAND((1 << bits) - 1)
    table = arrow(keys.groupBy(F.shiftright(cell, 15).alias("_slot"))
                  .agg(F.bitmap_construct_agg(cell.bitwiseAND(32767)).alias("_bits")), _as_words, "_slot long, _words array<long>")
    own = F.col(column).bitwiseAND((1 << bits) - 1)
    return (df.withColumn("_cell", own).withColumn("_slot", F.shiftright("_cell", 15))
            .join(F.broadcast(table), "_slot", "left")
            .withColumn("_on", F.expr("coalesce(shiftright(_words[cast(shiftright(_cell, 6) & 511 as int)], cast(_cell & 63 as int)) & 1, 0) = 1"))
            .drop("_slot", "_words", "_cell"))


def marked(df: DataFrame, column: str, keys: DataFrame, key: str, bits: int = 24) -> DataFrame:
    """Rows of ``df`` whose hash ``column`` falls into a cell that a hash of ``keys`` falls into: a
    superset of the semi-join that needs no shuffle of ``df``. Broadcasts 2**bits / 8 bytes at most."""
    return _probe(df, column, keys, key, bits).where("_on").drop("_on")


def unmarked(df: DataFrame, column: str, keys: DataFrame, key: str, bits: int = 24) -> DataFrame:
    """The other rows: none of them matches a hash of ``keys``."""
    return _probe(df, column, keys, key, bits).where("not _on").drop("_on")


def content(text: str = "text"):
    """64-bit hash of a text; with the doc_id it names a document (rows with both equal are the same)."""
    return F.xxhash64(text)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the rows named in gone(doc_id, content). Only rows that may
    be named are shuffled."""
    names = docs.columns
    docs = docs.withColumn("_content", content()).withColumn("_key", F.xxhash64("doc_id", "_content"))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("content").alias("_of"))
    keys = gone.select(F.xxhash64("_id", "_of").alias("_k"))
    left = marked(docs, "_key", keys, "_k").join(
        gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_content") == F.col("_of")), "left_anti")
    return left.select(names).union(unmarked(docs, "_key", keys, "_k").select(names))


def lowest(df: DataFrame, n: int, *key: str) -> DataFrame:
    """The ``n`` rows with the smallest hash of ``key`` (ties: by the key), as a bounded sample. Rows above a cut
    that some 4 n rows pass are dropped first, so that a task doesn't send n rows of its own to the driver."""
    total = df.count()
    mark = F.xxhash64(*key)
    if total > 8 * n:
        df = df.where(mark <= F.lit(-(1 << 63) + int((1 << 64) * 4 * n / total)))
    return df.orderBy(mark, *key).limit(n)
