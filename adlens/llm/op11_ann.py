"""Approximate nearest neighbours by inner product: robust-pruned directed graphs, one a shard, searched by beam.

1. Clean: vectors become bytes. Vectors that are null or empty, all zero, or hold a null or non-finite component
   take no part, nor do rows without a vec_id.
2. Distinct vectors: equal vectors are one point, which carries the smallest ``k + 1`` ids of its rows. No list of
   ``k`` nearest needs more of them, since ties go to the smaller id, so a vector that a third of all rows share
   costs one point and nothing is lost.
3. Shards: points are dealt out by their hash, so that a shard holds about SHARD_ROWS of them (fewer if vectors are
   long) whatever the data. Every task builds the graph of one shard:
   - largest inner product becomes nearest point: each point gets one more component that makes all norms equal;
   - points are inserted in growing batches. A greedy search from the entry points over the graph so far proposes
     BUILD_BEAM neighbours; relaxed distance pruning goes through them from near to far and drops a proposal that
     is ``ALPHA`` times nearer to a kept neighbour than to the point, which keeps up to DEGREE diverse edges;
   - each edge is offered to its other end, which is pruned in the same way once it has too many.
4. Search: every query searches every shard by a beam of SEARCH_BEAM points, QUERY_ROWS queries a task at most. The
   best points of a shard are scored again in double precision on the original vectors, their ids are listed, and
   the shards' lists of ``k + 1`` are merged. Queries with equal vectors are searched once.

No step has a cap on what is indexed: every row is in one graph or named by a point of it. The beam makes the answer
approximate; the recall is measured against brute force in the tests and the README.

Rows that have both vec_id and vector equal are one row. An id that comes with several vectors is judged row by row.
Vectors of another length than the query are no candidates. Fewer candidates than ``k`` are all listed, as far as the
beam finds them. An empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm import common

NEAREST = 20
QUERY_MODULUS = 20
SHARD_ROWS = 8192
SHARD_BYTES = 1 << 23
QUERY_ROWS = 4096
DEGREE = 40
ALPHA = 1.1
BUILD_BEAM = 80
SEARCH_BEAM = 128
#: Points that are expanded at once, and queries that are searched at once.
WIDTH = 4
BATCH = 256
#: Points that every search starts from.
ENTRIES = 8


# --- graph of one shard -------------------------------------------------------------------------------------------

def level(points: np.ndarray) -> np.ndarray:
    """Points with one more component, which makes all norms equal to the largest: of two points the one with the
    larger inner product with a query is then the nearer one."""
    norms = np.einsum("nd,nd->n", points, points)
    most = norms.max(initial=0.0)
    return np.concatenate([points, np.sqrt(np.maximum(most - norms, 0))[:, None]], 1).astype(np.float32)


def beam_search(points: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int,
                found: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``beam`` best points met, nearest first (-1: none), and their negated inner products.
    Only the first ``found`` points are in the graph. Unused edges are -1."""
    n = len(points) if found is None else found
    rows = len(queries)
    ids = np.full((rows, beam), -1, np.int64)
    near = np.full((rows, beam), np.inf, np.float32)
    closed = np.ones((rows, beam), bool)
    met = np.zeros((rows, n + 1), np.int16)  # column n stands for "none"
    line = np.arange(rows)[:, None]
    step = np.broadcast_to(entries, (rows, len(entries)))
    active = np.arange(rows)
    while len(active):
        own = line[:len(active)]
        fresh = np.where(step < 0, n, step)
        seen = met[active[:, None], fresh] > 0
        place = np.arange(1, fresh.shape[1] + 1, dtype=np.int16)[None, :]
        met[active[:, None], fresh] = place
        good = (met[active[:, None], fresh] == place) & ~seen & (fresh < n)  # once each, though several offer it
        fresh = np.where(good, fresh, -1)
        far = -np.matmul(points[fresh], queries[active][:, :, None])[:, :, 0]
        far[~good] = np.inf
        all_far = np.concatenate([near[active], far], 1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        near[active] = all_far[own, order]
        ids[active] = np.concatenate([ids[active], fresh], 1)[own, order]
        closed[active] = np.concatenate([closed[active], ~good], 1)[own, order]
        open_ = ~closed[active]
        going = open_.any(1)
        active, open_ = active[going], open_[going]
        if len(active):
            pick = np.argsort(~open_, axis=1, kind="stable")[:, :WIDTH]
            use = np.take_along_axis(open_, pick, 1)
            chosen = ids[active[:, None], pick]
            closed[active[:, None], pick] = True
            step = np.where(use[:, :, None], edges[chosen], -1).reshape(len(active), -1)
    return ids, near


def prune(points: np.ndarray, own: np.ndarray, proposals: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each point in ``own`` among its proposals (a row each, -1: none)."""
    vectors = points[proposals]
    to = points[own]
    square = np.einsum("bcd,bcd->bc", vectors, vectors)
    far = np.maximum(square + np.einsum("bd,bd->b", to, to)[:, None] - 2 * np.matmul(vectors, to[:, :, None])[:, :, 0], 0)
    alive = (proposals >= 0) & (proposals != own[:, None])
    far[~alive] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    proposals, far = np.take_along_axis(proposals, order, 1), np.take_along_axis(far, order, 1)
    alive, square = np.take_along_axis(alive, order, 1), np.take_along_axis(square, order, 1)
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    alive[:, 1:] &= ~((proposals[:, 1:] == proposals[:, :-1]) & alive[:, :-1])  # equal ones stand together
    between = np.maximum(square[:, :, None] + square[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1)), 0)
    out = np.full((len(own), degree), -1, np.int64)
    kept = np.zeros(len(own), np.int64)
    relaxed = alpha * alpha
    for k in range(proposals.shape[1]):
        take = np.flatnonzero(alive[:, k] & (kept < degree))
        if not len(take):
            continue
        out[take, kept[take]] = proposals[take, k]
        kept[take] += 1
        alive[take] &= ~(relaxed * between[take, k] <= far[take])
    return out


def build(points: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM) -> np.ndarray:
    """Edges (a row of ``degree`` each, -1: none) of the graph over levelled points, entered at the first ENTRIES."""
    n = len(points)
    edges = np.full((n, degree), -1, np.int64)
    begin = min(n, degree + 1)
    everyone = np.broadcast_to(np.arange(begin), (begin, begin))
    edges[:begin] = prune(points, np.arange(begin), everyone.copy(), degree, alpha) if n else edges
    done = begin
    while done < n:
        own = np.arange(done, min(n, done + min(BATCH, max(16, done // 4))))
        proposals, _ = beam_search(points, edges, np.arange(min(ENTRIES, done)), points[own], beam, done)
        edges[own] = prune(points, own, proposals, degree, alpha)
        done = own[-1] + 1
        _offer_back(points, edges, own, degree, alpha)
    return edges


def _offer_back(points: np.ndarray, edges: np.ndarray, own: np.ndarray, degree: int, alpha: float) -> None:
    source = np.repeat(own, degree)
    target = edges[own].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    node, first, count = np.unique(target, return_index=True, return_counts=True)
    used = (edges[node] >= 0).sum(1)
    free = used + count <= degree
    fit = np.repeat(free, count)
    place = np.arange(len(target)) - np.repeat(first, count)
    edges[target[fit], np.repeat(used, count)[fit] + place[fit]] = source[fit]
    full = np.flatnonzero(~free)
    for k in range(0, len(full), BATCH):
        some = full[k:k + BATCH]
        offers = np.full((len(some), int(count[some].max())), -1, np.int64)
        for i, j in enumerate(some.tolist()):
            offers[i, :count[j]] = source[first[j]:first[j] + count[j]]
        edges[node[some]] = prune(points, node[some], np.concatenate([edges[node[some]], offers], 1), degree, alpha)


# --- Spark --------------------------------------------------------------------------------------------------------

def _clean(width: int):
    """(vec_id, vec) of the rows that take part; ``width`` is the bytes of a component."""
    kind = np.dtype(f"<f{width}")

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("vector")
        length = np.where(column.is_null().to_numpy(zero_copy_only=False), 0,
                          np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
        flat = column.flatten()
        hole = flat.is_null().to_numpy(zero_copy_only=False)
        values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(kind) + kind.type(0)  # no negative zero
        at = np.concatenate([[0], np.cumsum(length)])
        wrong = np.concatenate([[0], np.cumsum(hole | ~np.isfinite(values))])
        some = np.concatenate([[0], np.cumsum(values != 0)])
        good = (np.diff(wrong[at]) == 0) & (np.diff(some[at]) > 0) & batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
        raw = values.tobytes()
        keep = np.flatnonzero(good)
        return pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(pa.array(keep)),
             pa.array([raw[at[i] * width:at[i + 1] * width] for i in keep], pa.binary())], ["vec_id", "vec"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield rows(batch)
    return run


GRAPH = "shard int, size int, points binary, edges binary, ids binary, counts binary"


def _build(kind: np.dtype):
    """The graph of each vector length that a shard holds, as one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, ids = [], []
        for batch in batches:
            vectors += batch.column("vec").to_pylist()
            ids += batch.column("ids").to_pylist()
        for size in sorted({len(v) for v in vectors}):
            own = sorted((v, i) for v, i in zip(vectors, ids, strict=True) if len(v) == size)
            order = np.random.default_rng(0).permutation(len(own))
            points = np.frombuffer(b"".join(own[i][0] for i in order), kind).reshape(len(own), -1)
            edges = build(level(points.astype(np.float64)))
            of = [own[i][1] for i in order]
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([size], pa.int32()),
                 pa.array([points.tobytes()], pa.binary()), pa.array([edges.astype("<i4").tobytes()], pa.binary()),
                 pa.array([np.concatenate([np.array(x, "<i8") for x in of]).tobytes()], pa.binary()),
                 pa.array([np.array([len(x) for x in of], "<i4").tobytes()], pa.binary())],
                [x.split()[0] for x in GRAPH.split(", ")])
    return run


FOUND = "q long, top array<struct<far:double,vec_id:long>>"
_FOUND = pa.schema([("q", pa.int64()), ("top", pa.list_(pa.struct([("far", pa.float64()), ("vec_id", pa.int64())])))])


def _search(kind: np.dtype, k: int, beam: int):
    """The ``k`` best ids of one shard for some queries."""
    def run(graph: pa.Table, queries: pa.Table) -> pa.Table:
        if not graph.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        row = graph.slice(0, 1).to_pylist()[0]
        points = np.frombuffer(row["points"], kind).reshape(-1, row["size"] // kind.itemsize)
        edges = np.frombuffer(row["edges"], "<i4").reshape(len(points), -1).astype(np.int64)
        counts, ids = np.frombuffer(row["counts"], "<i4"), np.frombuffer(row["ids"], "<i8")
        at = np.cumsum(counts) - counts
        exact, levelled = points.astype(np.float64), level(points.astype(np.float64))
        numbers, vectors = queries.column("q").to_numpy(), queries.column("vec").to_pylist()
        out = []
        for a in range(0, len(vectors), BATCH):
            wanted = np.frombuffer(b"".join(vectors[a:a + BATCH]), kind).reshape(-1, points.shape[1]).astype(np.float64)
            probe = np.concatenate([wanted, np.zeros((len(wanted), 1))], 1).astype(np.float32)
            got, _ = beam_search(levelled, edges, np.arange(min(ENTRIES, len(points))), probe, beam)
            for i, own in enumerate(got):
                own = own[own >= 0]
                scores = (exact[own] * wanted[i]).sum(1)
                many = counts[own]
                place = np.repeat(at[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                score, name = np.repeat(scores, many), ids[place]
                best = np.lexsort((name, -score))[:k]
                out.append([{"far": -s, "vec_id": v} for s, v in zip(score[best].tolist(), name[best].tolist(), strict=True)])
        return pa.Table.from_arrays([pa.array(numbers, pa.int64()), pa.array(out, _FOUND.field("top").type)], schema=_FOUND)
    return run


def cleaned(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vec) of the rows that take part, each once, written to the shared folder."""
    kind = embeddings.schema["embedding"].dataType.elementType.typeName()
    vector = F.col("embedding").cast("array<float>" if kind == "float" else "array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    return common.stash(common.arrow(rows, _clean(4 if kind == "float" else 8), "vec_id long, vec binary").distinct())


def graphs(rows: DataFrame, kind: np.dtype, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graphs of all shards of ``rows`` (vec_id, vec), a row for each shard and vector length."""
    least = Window.partitionBy("vec").orderBy("vec_id")
    points = (rows.withColumn("place", F.row_number().over(least)).where(F.col("place") <= k + 1)
              .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    points = common.stash(points)
    n, total = points.agg(F.count("*"), F.sum(F.octet_length("vec"))).first()
    shards = max(1, -(-n // shard_rows), -(-(total or 0) // SHARD_BYTES))
    common.ship(rows.sparkSession)
    return common.stash(common.arrow(points.repartition(shards, "vec"), _build(kind), GRAPH))


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = NEAREST, beam: int = SEARCH_BEAM,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``embeddings`` (vec_id, embedding) found for each
    row of ``queries`` (same columns), without the row of the query's own vec_id. Both must have the same kind of
    components."""
    kind = np.dtype("<f4" if embeddings.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8")
    index = graphs(cleaned(embeddings), kind, k, shard_rows)
    asked = cleaned(queries)
    distinct = common.stash(asked.select("vec").distinct().withColumn("q", F.monotonically_increasing_id()))
    parts = max(1, -(-distinct.count() // QUERY_ROWS))
    part = F.pmod(F.xxhash64("q"), F.lit(parts)).cast("int").alias("part")
    spread = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    last = index.agg(F.max("shard")).first()[0] or 0
    wanted = distinct.select(F.explode(F.sequence(F.lit(0), F.lit(last))).alias("at"),
                             F.octet_length("vec").alias("length"), part, "q", "vec")
    found = (spread.groupBy("shard", "size", "part").cogroup(wanted.groupBy("at", "length", "part"))
             .applyInArrow(_search(kind, k + 1, beam), FOUND))
    best = common.stash(found.groupBy("q").agg(F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k + 1).alias("top")))
    own = asked.join(distinct, "vec").select(F.col("vec_id").alias("query_id"), "q").join(best, "q")
    others = F.slice(F.filter("top", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (own.select("query_id", F.posexplode(others).alias("place", "hit"))
            .select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    (-F.col("hit.far")).alias("score")))


def op11_ann_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.read(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % QUERY_MODULUS == 0))
