"""Candidate pairs from groups of rows with an equal key, without emitting all pairs of a group.

``pivots`` compares every member of a group with its first one. After those pairs are linked, ``settled``
compares, in blocks, only members that are still in different components, the nearest ones first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm import common, kernel
from adlens.llm.components import components, extended

#: Members of a group are compared in blocks of so many.
BLOCK = 1024
#: Pairs taken of each member in the first round, and how many times as many in each later one.
KEEP = 2
KEEP_GROWTH = 16
#: Sides of a block: outsiders, all outsiders again, members of the group's largest component; outsiders of a group of
#: one block, which are sent once.
LEFT, RIGHT, MAIN, BOTH = 0, 1, 2, 3
#: Groups of up to so many rows are compared all at once, row distance by row distance.
SMALL_GROUP = 64
#: Sorted rows handled at once.
GATHER = 1 << 16
GROUPED = "key long, pivot long, set long"
#: Keys are dealt out in 2**BUCKET_BITS buckets, a task's rows of a bucket as one row, after each PACK rows. Millions of
#: rows of two numbers cost more in shuffle and sort than all that is done with them.
BUCKET_BITS = 12
PACK = 1 << 19
PACKED = "bucket int, packed binary"
#: The low bits of a key hold the number of its part, 0 where a group isn't split.
PART_BITS = 16
_PART = (1 << PART_BITS) - 1


def _packed(key: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
    """Rows (key, set) as one row a bucket, all of a key's in the same one."""
    bucket = (kernel.mix(key.view(np.uint64)) >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket, both = bucket[order], np.stack([key[order], own[order]], axis=1)
    head = np.flatnonzero(np.diff(bucket.astype(np.int32), prepend=-1))
    ends = (np.append(head, len(key)) * both.itemsize * 2).astype(np.int32)
    data = pa.BinaryArray.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(ends), pa.py_buffer(both)])
    return pa.RecordBatch.from_arrays([pa.array(bucket[head].astype(np.int32)), data], ["bucket", "packed"])


def packing(task: common.Task) -> common.Task:
    """``task``, which gives (key, set), with its rows packed by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in task(batches):
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            rows += batch.num_rows
            if rows >= PACK:
                yield _packed(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held, rows = [], 0
        if rows:
            yield _packed(*(np.concatenate(c) for c in zip(*held, strict=True)))
    return run


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, set) arrays sorted by both, of whole buckets of rows(bucket, packed) sorted by bucket, some GATHER rows each."""
    held: list[bytes] = []
    size, last = 0, None

    def sort():
        key, own = np.frombuffer(b"".join(held), np.int64).reshape(-1, 2).T
        order = np.argsort(key)
        key, own = key[order], own[order]
        same = np.concatenate([[False], key[1:] == key[:-1]])
        many = np.flatnonzero(same | np.append(same[1:], False))  # most groups have one row
        own[many] = own[many[np.lexsort((own[many], key[many]))]]
        return key, own

    for batch in batches:
        for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if bucket != last and size >= 16 * GATHER:
                yield sort()
                held, size = [], 0
            held.append(packed)
            size += len(packed)
            last = bucket
    if size:
        yield sort()


def dealt(keys: DataFrame) -> DataFrame:
    """The rows of a bucket next to each other (one sort column: a radix sort)."""
    return keys.repartition("bucket").sortWithinPartitions("bucket")


def _pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set with the smallest one of its group, once. The pivot of a part of a split group comes
    without a pivot, to be grouped again by its key alone."""
    for key, own in whole_groups(batches):
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(head, len(key)))
        new = np.zeros(len(key), bool)
        new[head] = True
        again = np.concatenate([[False], (own[1:] == own[:-1]) & ~new[1:]])
        pivot = np.repeat(own[head], size)
        keep = ~again & (~new | ((key & _PART) > 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[keep] & ~np.int64(_PART)), pa.array(pivot[keep], mask=new[keep]), pa.array(own[keep])],
            ["key", "pivot", "set"])


def _group(keys: DataFrame) -> DataFrame:
    return common.stash(common.arrow(dealt(keys), _pivots, GROUPED))


def pivots(keys: DataFrame) -> DataFrame:
    """(key, pivot, set) for every member but the first of each group in keys(key, set), or the same ``packing``. A
    group whose keys have part numbers in their low bits is grouped by part first, then the pivots of its parts by
    the key alone."""
    pack = lambda rows: common.arrow(rows.select("key", "set"), packing(iter), PACKED)
    grouped = _group(keys if "packed" in keys.columns else pack(keys))
    again = _group(pack(grouped.where("pivot is null")))
    return grouped.where("pivot is not null").union(again.where("pivot is not null"))


def _best(i: np.ndarray, j: np.ndarray, far: np.ndarray, own: np.ndarray, keep: int) -> np.ndarray:
    """Which pairs are among the ``keep`` nearest of either of their rows (ties: the smaller partner)."""
    kept = np.zeros(len(i), bool)
    for row, partner in ((i, j), (j, i)):
        order = np.lexsort((own[partner], far, row))
        row = row[order]
        start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        rank = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
        kept[order[rank < keep]] = True
    return kept


class _Keys:
    """The keys of each row, up to the one it is in here at least, for asking in which of their common groups two rows are compared: the one of the smallest key."""

    def __init__(self, flat: np.ndarray, size: np.ndarray, key: np.ndarray):
        known, rank = np.unique(np.append(flat, key), return_inverse=True)
        self.many, self.rank = len(known), rank[:len(flat)]
        row = np.repeat(np.arange(len(size)), size)
        own = rank[len(flat):]
        self.all = np.sort(row * self.many + self.rank)
        less = self.rank < own[row]  # of groups that come before the one that the row is in here
        self.less = self.rank[less]
        self.size = np.bincount(row[less], minlength=len(size))
        self.head = np.cumsum(self.size) - self.size

    def elsewhere(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs have a smaller key in common."""
        i, j = np.where(self.size[i] <= self.size[j], i, j), np.where(self.size[i] <= self.size[j], j, i)
        many = self.size[i]
        pair = np.repeat(np.arange(len(i)), many)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many) + self.head[i][pair]
        want = j[pair] * self.many + self.less[at]
        place = np.minimum(np.searchsorted(self.all, want), len(self.all) - 1)
        out = np.zeros(len(i), bool)
        out[pair[self.all[place] == want]] = True
        return out


def _cross(near: Callable, width: int, keep: int):
    """Pairs in one block of a group that are in different components, weren't compared as pivot and member, have no
    smaller key in common, and pass ``near``: of each row the ``keep`` nearest ones. ``more`` says that some of the
    block were left out."""
    def pairs(block, half, own, root, n, key, pivot, count, sketch, keys) -> pa.RecordBatch:
        keys = _Keys(keys, count, key)
        head = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        size = np.diff(np.append(head, len(block)))
        lefts = (half == LEFT) | (half == BOTH)
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]

        def test(i, j):
            for k in range(0, len(i), 1 << 16):
                a, b = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                apart = np.bitwise_count(sketch[a] ^ sketch[b]).sum(1, dtype=np.int64)
                ok = near(n[a], n[b], apart)
                a, b, apart = a[ok], b[ok], apart[ok]
                ok = ~keys.elsewhere(a, b)
                a, b = a[ok], b[ok]
                out.append((a, b, apart[ok] / (n[a] + n[b])))

        def paired(i, j):  # a row of the left half with one of the right half, two outsiders once
            return (lefts[i] & (half[j] != LEFT) & ((half[j] == MAIN) | (own[i] < own[j])) & (root[i] != root[j])
                    & (pivot[i] != own[j]) & (pivot[j] != own[i]))

        rows = np.flatnonzero(np.repeat(size <= SMALL_GROUP, size))
        for step in range(1, SMALL_GROUP):  # all small groups at once
            rows = rows[rows + step < len(block)]
            rows = rows[block[rows] == block[rows + step]]
            if not len(rows):
                break
            for i, j in ((rows, rows + step), (rows + step, rows)):
                on = paired(i, j)
                test(i[on], j[on])
        for k in np.flatnonzero(size > SMALL_GROUP).tolist():
            here = np.arange(head[k], head[k] + size[k])
            left, right = here[lefts[here]], here[half[here] != LEFT]
            for at in range(0, len(left), 256):
                i, j = np.nonzero(root[left[at:at + 256], None] != root[right][None, :])
                i, j = left[at + i], right[j]
                on = paired(i, j)
                test(i[on], j[on])
        i, j, far = (np.concatenate(c) for c in zip(*out, strict=True))
        kept = _best(i, j, far, own, keep) if len(i) else np.zeros(0, bool)
        of = np.searchsorted(head, i, "right") - 1
        more = np.bincount(of[~kept], minlength=len(head)) > 0
        a, b = own[i[kept]], own[j[kept]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)),
                                           pa.array(more[of[kept]]), pa.array(key[i[kept]])], ["a", "b", "more", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
            lists = batch.column(8)
            cols.append(np.diff(lists.offsets.to_numpy()))
            cols.append(np.concatenate(batch.column(7).to_numpy(zero_copy_only=False)).view(np.uint64).reshape(-1, width))
            flat = lists.flatten().to_numpy()  # bits of signed numbers are counted wrongly, hence the view above
            if rest:
                cols = [np.concatenate(c) for c in zip(rest[0], cols, strict=True)]
                flat = np.concatenate([rest[1], flat])
            last = int(np.searchsorted(cols[0], cols[0][-1]))  # the last group may go on
            cut = int(cols[7][:last].sum())
            if last:
                yield pairs(*(c[:last] for c in cols), flat[:cut])
            rest = [c[last:] for c in cols], flat[cut:]
        if rest:
            yield pairs(*rest[0], rest[1])
    return run


def _members(grouped: DataFrame, compared: bool = False) -> DataFrame:
    """(key, set, pivot) of all members of groups of three or more. ``compared`` says that every member was compared
    with its pivot; else, and of a group's first member, pivot is the member itself. Of two members the one is
    the pivot, so that smaller groups have no other pair."""
    large = grouped.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    pair = F.explode(F.array(F.struct("set", "pivot"), F.struct(F.col("pivot").alias("set"), F.col("pivot"))))
    members = grouped.join(large, "key", "left_semi").select("key", pair.alias("m"))
    least = F.min("m.pivot") if compared else F.first("m.set")
    return members.groupBy("key", F.col("m.set").alias("set")).agg(least.alias("pivot"))


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of members(key, set, pivot) whose group isn't in one component yet; of groups of the same members, which
    near copies have by hundreds, one."""
    placed = common.stash(members.join(roots.withColumnRenamed("node", "set"), "set", "left")
                          .select("key", "set", "pivot", F.coalesce("root", "set").alias("root")))
    names = [F.bit_xor(F.xxhash64("set", F.lit(k))).alias(f"name_{k}") for k in range(2)]
    keys = (placed.groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("least"), F.max("root").alias("most"), *names)
            .where("least < most").groupBy("size", "name_0", "name_1").agg(F.min("key").alias("key")))
    return common.stash(placed.drop("root").join(keys.select("key"), "key", "left_semi"))


def keyed(sets: DataFrame, members: DataFrame) -> DataFrame:
    """Those of sets(set, n, sketch) that are among members(key, set, pivot), with all their keys, ascending."""
    return common.stash(sets.join(members.groupBy("set").agg(F.sort_array(F.collect_list("key")).alias("keys")), "set"))


def cross_pairs(members: DataFrame, sets: DataFrame, roots: DataFrame, near: Callable, width: int, keep: int) -> DataFrame:
    """Pairs (a, b) of members(key, set, pivot) with an equal key that are in different components, weren't compared as
    pivot and member, and pass ``near(n of a, n of b, differing sketch bits)``: for each member of a block the ``keep``
    nearest ones, and in ``more`` whether pairs of its block were left out. sets: (set, n, sketch of ``width`` longs) and, from
    ``keyed``, their keys: a pair is compared under the smallest of its common keys only; roots: (node, root).

    Members outside the largest component of their group (outsiders) are compared with all others; blocks are dealt
    by hash, so that no group is sorted or held in one task."""
    placed = common.stash(members.join(roots.withColumnRenamed("node", "set"), "set", "left")
                          .select("key", "set", "pivot", F.coalesce("root", "set").alias("root")))
    parts = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    open_keys = common.stash(parts.groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("main"))
                             .where("size > 2 and size > main.n")
                             .select("key", F.col("main.root").alias("main"),
                                     F.ceil(F.col("size") / BLOCK).alias("rights"),
                                     F.ceil((F.col("size") - F.col("main.n")) / BLOCK).alias("lefts")))
    dealt_to = lambda salt, n: F.pmod(F.xxhash64("set", F.lit(salt)), F.col(n))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    joined = placed.join(open_keys, "key")
    outside = F.col("root") != F.col("main")
    alone = F.col("rights") == 1
    lefts = (joined.where(outside & ~alone).withColumn("x", dealt_to(1, "lefts")).withColumn("y", all_of("rights"))
             .withColumn("half", F.lit(LEFT)))
    rights = (joined.withColumn("x", all_of("lefts")).withColumn("y", dealt_to(2, "rights"))
              .withColumn("half", F.when(outside & alone, BOTH).when(outside, RIGHT).otherwise(MAIN)))
    blocks = lefts.unionByName(rights).select(F.xxhash64("key", "x", "y").alias("block"), "half", "set", "root", "key", "pivot")
    if "keys" not in sets.columns:
        sets = keyed(sets, members)
    less = F.expr("slice(keys, 1, greatest(array_position(keys, key) - 1, 0))")  # no others are asked for
    rows = (blocks.join(sets.select("set", "n", "sketch", "keys"), "set")
            .select("block", "half", "set", "root", "n", "key", "pivot", "sketch", less.alias("keys"))
            .repartition("block").sortWithinPartitions("block"))
    return common.arrow(rows, _cross(near, width, keep), "a long, b long, more boolean, key long")


def settled(grouped: DataFrame, sets: DataFrame, links: DataFrame, tested: DataFrame, near: Callable, width: int,
            verify: Callable[[DataFrame], DataFrame], compared: bool = False) -> tuple[DataFrame, DataFrame]:
    """All components, as (links, roots), after every pair of a group that may link has been verified or has come
    into one component. Pairs are taken in rounds: the nearest few of every member first, whose links mostly join
    the rest; each round takes KEEP_GROWTH times as many of those that are still apart, until none is left out. A
    group of which no pair was left out is done.
    tested(a, b): pairs that were verified before, ``compared``: all of pivots and members among them;
    verify(pairs): those of them that are links."""
    roots, keep = components(links), KEEP
    members = _open(_members(grouped, compared), roots)
    sets = keyed(sets, members)  # of all rounds: a key that is done leaves no pair to others
    while True:
        with common.released(grouped.sparkSession):
            found = common.stash(cross_pairs(members, sets, roots, near, width, keep)
                                 .select("a", "b", F.when(F.col("more"), F.col("key")).alias("key")))
            new = common.stash(found.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), hold=True)
            linked = None if new.isEmpty() else common.stash(verify(new), hold=True)
            left = found.where("key is not null").select("key").distinct()
            members = common.stash(members.join(left, "key", "left_semi"), hold=True)
        if linked is not None:
            tested = tested.union(new)
            if not linked.isEmpty():
                links = links.union(linked)
                roots = extended(roots, linked)
        if members.isEmpty():
            return links, roots
        keep *= KEEP_GROWTH
