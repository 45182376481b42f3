"""N-gram Jaccard join: parity sketches, pigeonhole join per size band, exact verification.

A document is its set of distinct word shingles. Two sets with Jaccard similarity 3/4 or more differ in at
most d = (|A| + |B|) / 7 shingles.

* Parity sketch. Every shingle is XORed into one of m cells, m a power of two fixed by the size band. A
  shingle that is in both sets cancels out, so the number of cells that differ (the Hamming distance, by
  cell) is at most the symmetric difference.
* Pigeonhole. If A has more than d cells that are not empty, one of them is untouched by any difference and
  equal in B. Cells are ordered by the rarity of their rarest shingle, the same order for all sets, so the
  first d + 1 cells of either set are enough: they have an equal cell. A set with d filled cells or fewer
  also emits its single shingles, of which there are always more than d. Sets near the lower edge of a band
  also emit their cells as the band below has them. No pair above the threshold is lost.
* Groups. Sets with an equal cell are compared with one pivot of the group (smallest hash), not pairwise.
  After linking, only pairs of the same group that are still in different components are compared, in
  blocks and in rounds, the nearest few of each set first. A bit sketch of fixed width (one parity bit per
  cell) gives that order and rejects most pairs before the exact check.
* Verification. The shingles of the sets still in question are intersected.

Equal sets are joined by their 64-bit hash before, so copies never become pairs. A group whose shingles are
very common is split by a salt and its pivots are grouped again. Null or empty text has no shingles and
is linked with nothing; rows that share a doc_id are joined through their sets like any others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import common, groups, kernel
from adlens.llm.components import components

SHINGLE = 5
#: Shingles are counted in 2**RARITY_BITS hashed cells; the finer, the better common ones stand out.
RARITY_BITS = 20
#: Words (64 bits each) of the bit sketch that filters pairs.
SKETCH = 16
#: Below this size every shingle is its own cell.
SMALL = 8
#: A group whose rarest shingle may occur more often than this is salted into parts of about this size.
SALT_ROWS = 8192
WANTED_BITS = 24
U64 = np.uint64


def _sets_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = kernel.utf8(part.column("text"))
    starts, ends, first = kernel.words(data, offsets, kernel.NOT_SPACE)
    return kernel.shingle_sets(kernel.hash_words(data, starts, ends), first, SHINGLE)


def _set_hash(own: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = kernel.mix(own ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64) + U64(len(own))
    return int(kernel.mix(np.array([total], U64))[0].astype(np.int64))


def _sketch(own: np.ndarray) -> np.ndarray:
    bit = (kernel.mix(own ^ U64(0x2545F4914F6CDD1D)) & U64(64 * SKETCH - 1)).astype(np.int64)
    odd = np.bincount(bit, minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


SETS = f"doc_id long, content long, n long, set long, sketch array<long>, {common.VECTOR_SCHEMA}"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, and the task's shingle counts by hashed cell."""
    names = [x.split()[0] for x in SETS.split(", ")]
    counts = np.zeros(1 << RARITY_BITS)
    for batch in batches:
        for part in kernel.pieces(batch, "text"):
            shingles, at = _sets_of(part)
            counts += np.bincount((shingles >> U64(64 - RARITY_BITS)).astype(np.int64), minlength=len(counts))
            sets = [shingles[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            rows = len(sets)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("content"), pa.array(np.diff(at)), pa.array([_set_hash(s) for s in sets], pa.int64()),
                pa.array([_sketch(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                pa.nulls(rows, pa.string()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names)
    vector = common.vector_batch(list(common.vector_rows("shingles", counts)))
    rows = vector.num_rows
    yield pa.RecordBatch.from_arrays([
        *[pa.nulls(rows, pa.int64())] * 4, pa.nulls(rows, pa.list_(pa.int64())), *vector.columns], names)


def _cells(own: np.ndarray, count: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """XOR and rarity of every filled cell of the parity sketch with 2**level cells, rarest first;
    level 63: one cell for each shingle."""
    value = kernel.mix(own ^ U64(0x9FB21C651E98DF25))
    if level < 63:
        cell = own & U64((1 << level) - 1)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        head = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        value = np.bitwise_xor.reduceat(value[order], head) ^ kernel.mix(cell[head])
        count = np.minimum.reduceat(count[order], head)
    order = np.lexsort((value, count))
    return value[order], count[order]


def signatures(own: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The keys under which a set must be found, and the rarity of each. own: sorted distinct
    shingles; count: how often each one's rarity cell was hit."""
    n = len(own)
    band = n.bit_length() - 1
    roles = [(band, n // 3)]  # the partner has at most 4/3 n shingles
    if 4 * ((1 << band) - 1) >= 3 * n:  # the band below has partners
        roles.append((band - 1, ((1 << band) - 1 + n) // 7))
    for level, differ in roles:
        value, rare = _cells(own, count, level if 1 << level >= SMALL else 63)
        filled = len(value)
        salt = U64(2 * level + 1)
        yield kernel.mix(value[:differ + 1] + salt), rare[:differ + 1]
        if filled <= differ and 1 << level >= SMALL:
            value, rare = _cells(own, count, 63)
            yield kernel.mix(value[:differ + 1] + salt + U64(1 << 32)), rare[:differ + 1]


def _emit(counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in kernel.pieces(batch, "text"):
                shingles, at = _sets_of(part)
                often = counts[(shingles >> U64(64 - RARITY_BITS)).astype(np.int64)]
                keys, rare, sets, sizes = [], [], [], []
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = shingles[a:b]
                    if a == b or (name := _set_hash(own)) in seen:
                        continue
                    seen.add(name)
                    for key, few in signatures(own, often[a:b]):
                        keys.append(key)
                        rare.append(few)
                        sets.append(name)
                        sizes.append(len(key))
                if keys:
                    sets = np.repeat(np.array(sets, np.int64), sizes)
                    parts = np.clip(np.concatenate(rare) // SALT_ROWS, 1, (1 << groups.PART_BITS) - 1).astype(U64)
                    part = np.where(parts > 1, 1 + kernel.mix(sets.view(U64)) % parts, 0).astype(np.int64)
                    key = (np.concatenate(keys).view(np.int64) >> groups.PART_BITS << groups.PART_BITS) | part
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(sets)], ["key", "set"])
    return run


WANTED = "set long, shingles array<long>"


def _fetch(bits: np.ndarray):
    """Shingles of the rows whose id is marked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("mark").to_numpy(zero_copy_only=False) & ((1 << WANTED_BITS) - 1)
            on = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            if not on.any():
                continue
            for part in kernel.pieces(batch.filter(pa.array(on)), "text"):
                shingles, at = _sets_of(part)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(shingles.view(np.int64)))
                names = [_set_hash(shingles[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), lists], ["set", "shingles"])
    return run


def _near(sets: DataFrame, pairs: DataFrame, threshold: int) -> DataFrame:
    """Those of pairs(a, b) whose sizes and bit sketches allow a link."""
    side = lambda x: sets.select(F.col("set").alias(x), F.col("n").alias(f"n_{x}"), F.col("rep").alias(f"rep_{x}"))
    bits = lambda x: sets.select(F.col("set").alias(x), F.col("sketch").alias(f"sketch_{x}"))
    apart = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")),
                        F.lit(0), lambda x, y: x + y)
    most = (100 - threshold) * (F.col("n_a") + F.col("n_b")) / (100 + threshold)
    like = common.stash(pairs.join(side("a"), "a").join(side("b"), "b")
                        .where(100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")))
    return common.stash(like.join(bits("a"), "a").join(bits("b"), "b").where(apart <= most)
                        .select("a", "b", "n_a", "n_b", "rep_a", "rep_b"))


def _shingles(docs: DataFrame, near: DataFrame) -> DataFrame:
    """(set, shingles) of every set in near, read from the documents again."""
    reps = near.select(F.xxhash64("rep_a").alias("mark")).union(near.select(F.xxhash64("rep_b"))).distinct()
    bits = np.packbits(common.bitmap(reps, "mark", WANTED_BITS), bitorder="little")
    marked = docs.select(F.xxhash64("doc_id").alias("mark"), "text")
    return common.stash(common.arrow(marked, _fetch(bits), WANTED).dropDuplicates(["set"]))


def _verified(near: DataFrame, shingles: DataFrame, threshold: int) -> DataFrame:
    """Those of near(a, b, n_a, n_b) that are links, by intersecting their shingles."""
    lists = lambda x: shingles.select(F.col("set").alias(x), F.col("shingles").alias(f"list_{x}"))
    both = F.size(F.array_intersect("list_a", "list_b"))
    pairs = near.select("a", "b", "n_a", "n_b")
    return common.stash(pairs.join(lists("b"), "b").join(lists("a"), "a").withColumn("both", both)
                        .where(100 * F.col("both") >= threshold * (F.col("n_a") + F.col("n_b") - F.col("both")))
                        .select("a", "b"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs that are not yet in one component."""
    root = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    joined = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left")
    same = F.coalesce("root_a", "a") == F.coalesce("root_b", "b")
    return joined.where(~same).drop("root_a", "root_b")


def jaccard_components(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """doc_id, content hash, n_shingles, component_id (smallest doc_id reachable by links) and component (its
    smallest set hash; null without shingles) for every row of ``docs``.
    Two documents link at a similarity of ``threshold`` percent or more. The size bands are laid out for
    75, so a lower threshold is refused."""
    if threshold < 75:
        raise ValueError("threshold must be 75 or more")
    with common.released(docs.sparkSession):
        return common.stash(_classes(docs.select("doc_id", "text", common.content().alias("content")), threshold), hold=True)


def _classes(docs: DataFrame, threshold: int) -> DataFrame:
    described = common.stash(common.arrow(docs, _describe, SETS))
    counts = common.sum_vectors(described.where("kind is not null").select("kind", "slice", "numbers"),
                                {"shingles": 1 << RARITY_BITS}, np.float32)["shingles"]
    rows = described.where("kind is null").select("doc_id", "content", "n", "set", "sketch")
    sets = common.stash(rows.where("n > 0").groupBy("set").agg(
        F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.first("sketch").alias("sketch")))
    grouped = groups.pivots(common.arrow(docs.select("text"), groups.packing(_emit(counts)), groups.PACKED))
    pairs = grouped.select(F.col("pivot").alias("a"), F.col("set").alias("b")).where("a <> b").distinct()
    near = _near(sets, pairs, threshold)
    shingles = _shingles(docs, near)
    # each set with its smallest pivot first; then only pairs that this leaves apart
    first = near.groupBy("b").agg(F.min_by(F.struct("a", "n_a", "n_b"), "a").alias("p")).select("p.*", "b")
    links = _verified(first, shingles, threshold)
    rest = _apart(near, components(links)).join(first, ["a", "b"], "left_anti")
    links = links.union(_verified(rest, shingles, threshold))
    may = lambda n, m, apart: ((100 * np.minimum(n, m) >= threshold * np.maximum(n, m))
                               & (apart * (100 + threshold) <= (100 - threshold) * (n + m)))

    def verify(pairs):
        near = _near(sets, pairs, threshold)
        return _verified(near, _shingles(docs, near), threshold)

    _, roots = groups.settled(grouped, sets, links, pairs, may, SKETCH, verify, compared=True)
    placed = common.stash(sets.join(roots.withColumnRenamed("node", "set"), "set", "left")
                          .select("set", "rep", F.coalesce("root", "set").alias("root")))
    least = common.stash(placed.groupBy("root").agg(F.min("rep").alias("component_id")))
    classes = common.stash(placed.join(least, "root").select("set", "component_id", F.col("root").alias("component")))
    alone = rows.where("n = 0").select("doc_id", "content", "n", "doc_id", F.lit(None).cast("long"))
    return (rows.where("n > 0").join(classes, "set")
            .select("doc_id", "content", F.col("n").alias("n_shingles"), "component_id", "component").union(alone))


def duplicates(found: DataFrame) -> DataFrame:
    """(doc_id, content) of all but the first document of each component, from ``jaccard_components``."""
    found = common.stash(found.where("component is not null").select("component", "doc_id", "content"))
    first = common.stash(found.groupBy("component").agg(F.min(F.struct("doc_id", "content")).alias("first")))
    return (found.join(first, "component").where(~F.struct("doc_id", "content").eqNullSafe(F.col("first")))
            .select("doc_id", "content").distinct())


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(common.read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
