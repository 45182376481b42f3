"""Line dedup: exact repeats by name, pigeonhole join of SimHash blocks, edit similarity, one occurrence per group.

A line is normalised to its words (letters, digits and all beyond ASCII, A-Z lower-cased). Lines without a
word are never removed.

* Equal normalised lines are one node, whatever their length and the number of their occurrences.
* Two lines are near if their word-level edit similarity is SIMILARITY or more. A line's segments are its runs of
  SEGMENT words, wherever they stand, and a segment's block is the SimHash of its words. E is what the line and the
  longest line it may be near to allow. A line's keys are the rarest of its distinct blocks, in one order for all
  lines, just so many that E edits can't change a word of each of their segments (least greedy cover of their
  places), SEGMENT * E + 1 at most. So, of two near lines, the keys of the one whose keys end first in that order
  hold a block that the other line has, too, and it is among the other's keys (pigeonhole). Where all of a line's
  blocks are not enough, all are its keys; the longest run of words that E edits leave has SEGMENT words or
  more. No near pair is lost, whatever the lengths. Lines too short to allow an edit have no keys.
* The lines of a key are compared with one of them (groups.pivots); after linking, only those that are still
  in different components are compared in blocks (groups.settled). A changed word changes at most two bits of a line's
  parity sketch, one more or less at most one, which with the length rejects most pairs before the edit distance is taken.
* Of all occurrences of a connected group, the first by (doc_id, content hash, line number) stays.

Null text has no lines and stays null. A document that loses all its lines keeps an empty text. Rows that
share both doc_id and text count as the same document: a line that stays does so in each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import common, groups, kernel

MIN_WORDS = 1
SIMILARITY = 0.9
#: Words of a segment. Runs of two or three common words recur by chance in any large table, so that groups grow with the
#: square of the rows. Of near lines of any length an untouched run of five words is left, not always one of six.
SEGMENT = 5
#: Blocks are counted in 2**RARITY_BITS hashed cells.
RARITY_BITS = 22
#: A key that may occur more often than this is salted into parts of about this size.
SALT_ROWS = 8192
WANTED_BITS = 24
U64 = np.uint64

#: 64-bit numbers of a line's parity sketch. Of one number alone, most pairs of near copies that are too far apart pass.
SKETCH = 4
SKETCHES = [f"sketch_{k}" for k in range(SKETCH)]

LINES = "doc_id long, content long, line int, n int, name long, " + ", ".join(f"{x} long" for x in SKETCHES)
OCCURRENCES = f"{LINES}, {common.VECTOR_SCHEMA}"
CODES = "name long, codes string"


def _edits(n):
    """Word edits by which a line may differ from one of n words, n being the longer one's."""
    return np.floor((1 - SIMILARITY) * n + 1e-9).astype(np.int64)


def _most_edits(n: np.ndarray) -> np.ndarray:
    """The same for a line of n words and the longest line it may be near to."""
    return _edits(np.floor(n / SIMILARITY + 1e-6))


def _lines(part: pa.RecordBatch):
    """Lines of the part with MIN_WORDS words or more: row, number in the row, first word, words; and
    all word hashes."""
    data, offsets = kernel.utf8(part.column("text"))
    breaks = np.flatnonzero(data == 10)
    edges = np.union1d(offsets[:-1], np.append(breaks + 1, 0))
    edges = np.unique(np.append(edges[edges < len(data)], len(data)))
    starts, ends, first = kernel.words(data, edges, kernel.ALNUM)
    hashes = kernel.hash_words(data, starts, ends)
    row = np.searchsorted(offsets, edges[:-1], "right") - 1
    before = np.searchsorted(breaks, edges[:-1]) - np.searchsorted(breaks, offsets[row])
    n = np.diff(first)
    keep = np.flatnonzero(n >= MIN_WORDS)
    return row[keep], before[keep], first[:-1][keep], n[keep], hashes


def _words_of(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all words of the lines, and where each line begins among them."""
    head = np.cumsum(n) - n
    return np.repeat(first - head, n) + np.arange(int(n.sum())), head


def names(words: np.ndarray, head: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hash of each line's word sequence."""
    powers = np.cumprod(np.concatenate([[U64(1)], np.full(int(n.max()), U64(0x9E3779B97F4A7C15))]), dtype=U64)
    place = np.arange(len(words)) - np.repeat(head, n)
    return kernel.mix(np.add.reduceat(words * powers[place], head) + n.astype(U64))


#: The bits of a byte, one in each byte of a 64-bit number.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def simhash(words: np.ndarray, head: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each line or segment, the majority of every bit over the hashes of its words (ties: 0)."""
    own = kernel.mix(words + U64(0x632BE59BD9B4E019))
    if n.min() == n.max() == 2:
        return own[head] & own[head + 1]
    if n.min() == n.max() == 5:
        a, b, c, d, e = (own[head + k] for k in range(5))
        odd, two = a ^ b ^ c, (a & b) | (c & (a | b))  # of three of them
        return (two & (odd | d | e)) | (odd & d & e)
    parts = -(-n // 255)  # a byte counts 255 words at most
    edge = np.cumsum(parts) - parts
    start = np.repeat(head, parts) + 255 * (np.arange(int(parts.sum())) - np.repeat(edge, parts))
    own = own.view(np.uint8).reshape(-1, 8)
    votes = np.concatenate([np.add.reduceat(_LANES[own[:, k]], start).view(np.uint8).reshape(-1, 8) for k in range(8)], 1)
    votes = np.add.reduceat(votes, edge, axis=0, dtype=np.int32)
    return np.packbits(2 * votes > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


def parity(words: np.ndarray, head: np.ndarray) -> list[np.ndarray]:
    """For each line, which of SKETCH times 64 hashed cells hold an odd number of its words."""
    cell = kernel.mix(words ^ U64(0x2545F4914F6CDD1D)) % U64(64 * SKETCH)
    bit, at = U64(1) << (cell & U64(63)), cell >> U64(6)
    return [np.bitwise_xor.reduceat(np.where(at == U64(k), bit, U64(0)), head) for k in range(SKETCH)]


def _blocks(words: np.ndarray, head: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block of every segment, mixed, the line of each and its first word. Every line has SEGMENT words or more."""
    many = n - SEGMENT + 1
    at, _ = _words_of(head, many)
    return kernel.mix(simhash(words, at, np.full(len(at), SEGMENT))), np.repeat(np.arange(len(n)), many), at


def _cell(block: np.ndarray) -> np.ndarray:
    return (block >> U64(64 - RARITY_BITS)).astype(np.int64)


def _edits_to_hit(start: np.ndarray, line: np.ndarray, lines: int) -> np.ndarray:
    """For each line, how many words must change until each of its segments has a changed one. start: first words of the
    segments, ascending. The last word of the first segment is the best to change; then of the first one left, and so on."""
    m = len(start)
    ahead = np.arange(1, m + 1)
    for k in range(1, SEGMENT):
        ahead[:-k] += start[k:] < start[:-k] + SEGMENT
    head = np.flatnonzero(np.diff(line, prepend=-1))
    end = np.append(head[1:], m)
    ahead = np.append(np.where(ahead < np.repeat(end, end - head), ahead, m), m)
    steps = np.append(np.ones(m, np.int32), 0)
    while (ahead < m).any():  # twice as far each time
        steps += steps[ahead]
        ahead = ahead[ahead]
    out = np.zeros(lines, np.int64)
    out[line[head]] = steps[head]
    return out


def _enough(start: np.ndarray, line: np.ndarray, rank: np.ndarray, edits: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many of each line's segments, by rank, must be taken so that ``edits`` edits can't change them all: the least
    number, or at most a sixteenth more; ``most`` if fewer aren't enough."""
    low, high = np.minimum(edits + 1, most), most.copy()
    while (wide := high - low > high >> 4).any():
        middle = (low + high) >> 1
        on = np.flatnonzero(rank < np.where(wide, middle, 0)[line])
        ok = _edits_to_hit(start[on], line[on], len(most)) > edits
        high = np.where(wide & ok, middle, high)
        low = np.where(wide & ~ok, middle + 1, low)
    return high


def _ordered_keys(words: np.ndarray, head: np.ndarray, n: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The keys under which a line must be found, the line of each, and how often its block may occur. Every line may
    differ by an edit from another one. counts: how often the blocks of each cell occur."""
    block, line, start = _blocks(words, head, n)
    often = np.minimum(counts[_cell(block)].astype(U64), U64(0xFFFFFF))
    key = (often << U64(40)) | (block >> U64(24))  # a block's name and its place in the order
    order = np.argsort(key)  # this and a radix sort of small numbers take a fraction of a lexsort
    of = line[order].astype(np.uint16 if len(n) <= 1 << 16 else np.uint32)
    by_line = np.argsort(of, kind="stable")
    order, of = order[by_line], of[by_line]
    by = key[order]
    new = np.flatnonzero(np.concatenate([[True], (by[1:] != by[:-1]) | (of[1:] != of[:-1])]))
    order, of = np.minimum.reduceat(order, new), of[new].astype(np.int64)
    edge = np.searchsorted(of, np.arange(len(n) + 1))
    edits = _most_edits(n)
    most = np.minimum(SEGMENT * edits + 1, np.diff(edge))
    rank = np.full(len(key), len(key))
    rank[order] = np.arange(len(order)) - edge[of]
    on = np.flatnonzero(rank < most[line])
    start, line, rank = start[on], line[on], rank[on]
    on = on[rank < _enough(start, line, rank, edits, most)[line]]
    return kernel.mix(key[on]), np.repeat(np.arange(len(n)), n - SEGMENT + 1)[on], (key[on] >> U64(40)).astype(np.int64)


def line_keys(words: np.ndarray, head: np.ndarray, n: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys and lines as above; without counts all blocks are as rare."""
    return _ordered_keys(words, head, n, np.zeros(1 << RARITY_BITS, np.int32) if counts is None else counts)[:2]


def _fresh(found, seen: set[int]) -> tuple[np.ndarray, ...]:
    """Name, first word and words of the lines that are not in ``seen`` and may differ by an edit from another one."""
    _, _, first, n, hashes = found
    long = np.flatnonzero(_most_edits(n) > 0)
    first, n = first[long], n[long]
    if not len(long):
        return np.empty(0, np.int64), first, n
    at, head = _words_of(first, n)
    name = names(hashes[at], head, n).view(np.int64)
    fresh = np.flatnonzero([x not in seen and not seen.add(x) for x in name.tolist()])
    return name[fresh], first[fresh], n[fresh]


def _occur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per line with a word, and the task's counts of blocks by hashed cell."""
    columns = [x.split()[0] for x in OCCURRENCES.split(", ")]
    counts = np.zeros(1 << RARITY_BITS, np.int32)
    seen: set[int] = set()
    for batch in batches:
        for part in kernel.pieces(batch, "text"):
            found = row, line, first, n, hashes = _lines(part)
            if not len(row):
                continue
            at, head = _words_of(first, n)
            words = hashes[at]
            _, start, size = _fresh(found, seen)
            if len(start):
                cell = np.sort(_cell(_blocks(hashes, start, size)[0]).astype(np.int32))
                edge = np.flatnonzero(np.diff(cell, prepend=-1))
                counts[cell[edge]] += np.diff(np.append(edge, len(cell))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").take(pa.array(row)), part.column("content").take(pa.array(row)),
                pa.array(line.astype(np.int32)), pa.array(n.astype(np.int32)),
                pa.array(names(words, head, n).view(np.int64)), *(pa.array(x.view(np.int64)) for x in parity(words, head)),
                pa.nulls(len(row), pa.string()), pa.nulls(len(row), pa.int32()), pa.nulls(len(row), pa.binary())], columns)
    vector = common.vector_batch(list(common.vector_rows("blocks", counts)))
    rows = vector.num_rows
    yield pa.RecordBatch.from_arrays([pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int32()),
                                      pa.nulls(rows, pa.int32()), *(pa.nulls(rows, pa.int64()) for _ in range(1 + SKETCH)),
                                      *vector.columns], columns)


def _emit(counts: np.ndarray):
    """Keys of the lines that may differ by an edit from another, of each line once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in kernel.pieces(batch, "text"):
                found = _lines(part)
                name, first, n = _fresh(found, seen)
                if not len(name):
                    continue
                key, line, often = _ordered_keys(found[4], first, n, counts)
                name = name[line]
                parts = np.clip(often // SALT_ROWS, 1, (1 << groups.PART_BITS) - 1).astype(U64)
                salt = np.where(parts > 1, 1 + kernel.mix(name.view(U64)) % parts, 0).astype(np.int64)
                key = (key.view(np.int64) >> groups.PART_BITS << groups.PART_BITS) | salt
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(name)], ["key", "set"])
    return run


def _code(wanted: np.ndarray):
    """Lines whose names are marked in a packed bitmap, with one character per word (of 2**20, by hash), so
    that character edit distance is word edit distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for part in kernel.pieces(batch, "text"):
                row, _, first, n, hashes = _lines(part)
                if not len(row):
                    continue
                at, head = _words_of(first, n)
                name = names(hashes[at], head, n).view(np.int64)
                cell = name & ((1 << WANTED_BITS) - 1)
                on = np.flatnonzero((wanted[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1)
                on = on[[x not in sent and not sent.add(x) for x in name[on].tolist()]] if len(on) else on
                code = ((hashes[at] >> U64(44)) + U64(0x10000)).astype("<u4")  # beyond the surrogates
                text = [code[head[k]:head[k] + n[k]].tobytes().decode("utf-32-le") for k in on.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(name[on]), pa.array(text, pa.string())], ["name", "codes"])
    return run


def _near(n, m, apart):
    most = _edits(np.maximum(n, m))
    return (np.abs(n - m) <= most) & (apart <= 2 * most - np.abs(n - m))


def _verified(docs: DataFrame, lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of pairs(a, b) of line names that are links, by edit similarity."""
    side = lambda x: lines.select(F.col("name").alias(x), F.col("n").alias(f"n_{x}"), F.col("content").alias(f"content_{x}"),
                                  *(F.col(k).alias(f"{k}_{x}") for k in SKETCHES))
    apart = " + ".join(f"bit_count({k}_a ^ {k}_b)" for k in SKETCHES)
    most = F.expr(f"cast(floor({1 - SIMILARITY:.6f} * greatest(n_a, n_b) + 1e-9) as int)")
    near = common.stash(pairs.join(side("a"), "a").join(side("b"), "b").withColumn("most", most)
                        .where(f"abs(n_a - n_b) <= most and {apart} <= 2 * most - abs(n_a - n_b)")
                        .select("a", "b", "most", "content_a", "content_b"))
    wanted = common.stash(near.select(F.col("a").alias("name"), F.col("content_a").alias("mark")).union(
        near.select("b", "content_b")).distinct())
    hold = common.marked(docs.select("text", "content"), "content", wanted, "mark").select("text")
    bits = np.packbits(common.bitmap(wanted, "name", WANTED_BITS), bitorder="little")
    codes = common.stash(common.arrow(hold, _code(bits), CODES).dropDuplicates(["name"]))
    text = lambda x: codes.select(F.col("name").alias(x), F.col("codes").alias(f"codes_{x}"))
    return common.stash(near.select("a", "b", "most").join(text("a"), "a").join(text("b"), "b")
                        .where(F.expr("levenshtein(codes_a, codes_b, most) >= 0")).select("a", "b"))


def _roots(docs: DataFrame, lines: DataFrame, counts: np.ndarray) -> DataFrame:
    """(node, root) of all line names that are near to another. lines: name, n, sketches, content."""
    grouped = groups.pivots(common.arrow(docs.select("text"), groups.packing(_emit(counts)), groups.PACKED))
    pairs = common.stash(grouped.select(F.col("pivot").alias("a"), F.col("set").alias("b")).where("a <> b").distinct())
    own = grouped.select("set").union(grouped.select("pivot"))
    lines = common.stash(common.marked(lines, "name", own, "set"))
    links = _verified(docs, lines, pairs)
    sets = lines.select(F.col("name").alias("set"), "n", F.array(*SKETCHES).alias("sketch"))
    return groups.settled(grouped, sets, links, pairs, _near, SKETCH, lambda p: _verified(docs, lines, p),
                          compared=True)[1]


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, content, removed_lines): the line numbers, from 0, that go from each document that loses any.
    docs: doc_id, text, content."""
    with common.released(docs.sparkSession):
        return common.stash(_removed(docs), hold=True)


def _removed(docs: DataFrame) -> DataFrame:
    described = common.stash(common.arrow(docs.select("doc_id", "text", "content"), _occur, OCCURRENCES))
    counts = common.sum_vectors(described.where("kind is not null").select("kind", "slice", "numbers"),
                                {"blocks": 1 << RARITY_BITS}, np.uint32)["blocks"]
    counts = counts.astype(np.min_scalar_type(counts.max()))  # goes to every worker
    occurrences = described.where("kind is null").select("doc_id", "content", "line", "n", "name", *SKETCHES)
    lines = common.stash(occurrences.groupBy("name").agg(F.count("*").alias("size"), F.min("n").alias("n"),
                                                         F.min("content").alias("content"),
                                                         *(F.min(k).alias(k) for k in SKETCHES)))
    roots = _roots(docs, lines.drop("size"), counts).withColumnRenamed("node", "name")
    groups_of = common.stash(lines.where("size > 1").select("name").join(roots, "name", "full")
                             .select("name", F.coalesce("root", "name").alias("root")))
    found = common.stash(common.marked(occurrences, "name", groups_of, "name").select("name", "doc_id", "content", "line")
                         .join(groups_of, "name").select("root", "doc_id", "content", "line"))
    mark = F.struct("doc_id", "content", "line")
    stays = common.stash(found.groupBy("root").agg(F.min(mark).alias("stays")))
    return (found.join(stays, "root").where(~mark.eqNullSafe(F.col("stays")))
            .groupBy("doc_id", "content").agg(F.sort_array(F.collect_set("line")).alias("removed_lines")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its columns, its text without the removed lines, and the numbers of the
    removed lines (``removed_lines``, from 0)."""
    docs = docs.withColumn("_content", F.xxhash64("text"))
    gone = removed_lines(docs.select("doc_id", "text", F.col("_content").alias("content")))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("content").alias("_of"), "removed_lines")
    docs = docs.withColumn("_key", F.xxhash64("doc_id", "_content"))
    hit = common.marked(docs, "_key", gone.select(F.xxhash64("_id", "_of").alias("key")), "key")
    rest = common.unmarked(docs, "_key", gone.select(F.xxhash64("_id", "_of").alias("key")), "key")
    none = F.array().cast("array<int>")
    text = F.array_join(F.filter(F.split("text", "\n"), lambda _, k: ~F.array_contains("removed_lines", k)), "\n")
    out = (hit.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_content") == F.col("_of")), "left")
           .withColumn("text", F.when(F.col("removed_lines").isNotNull(), text).otherwise(F.col("text")))
           .withColumn("removed_lines", F.coalesce("removed_lines", none))
           .drop("_id", "_of"))
    return out.unionByName(rest.withColumn("removed_lines", none)).drop("_content", "_key")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", F.size("removed_lines").cast("long").alias("n_removed"),
                                    "removed_lines")
