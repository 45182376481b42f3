"""Source divergence audit: how far the word distributions of a language's sources are apart, and by which terms.

Late string materialisation: no shuffle that is sized by the corpus carries a term's text.

1. Count: every term of a document becomes a 64-bit digest of (lang, term). Tasks send (digest, documents); digests in
   fewer than ``least`` documents are out. Where terms share a digest their documents only add up, so no term that is to
   be kept can be lost here.
2. Gather: texts are read again, and only digests that passed are looked at (a bitmap whose size follows their number up
   to a bound rules out most others, a join on the digest rules out the rest). Tasks send (group, digest, count), and
   one row for each digest with the smallest and the largest string they met under it.
3. Split: a digest whose smallest and largest strings differ is a collision. Only the terms of such digests are counted
   again, by their text. Within a task all strings of a digest are compared byte by byte, so no collision is missed.
4. Shares: kept terms get a number; shares are whole numbers, computed in decimals.
5. Pairs: shares are dealt out to (lang, slice of some SLICE terms, tile pair of some TILE sources each). A task fills a
   dense table for its slice and tiles, adds up the absolute differences of each pair, and the sums are added by pair.
   Work and result follow the number of pairs of sources, which is what is asked for; no task holds more than a slice.
6. Terms: the largest differences of each group are ranked with all ties by number, and only those are joined to text.

Null text, lang and source read as ''. A group without kept terms has a count of 0 for each. Rows that share a doc_id are
judged one by one. A lang without kept terms has value 0 for each pair. Empty documents give an empty result; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm import common, kernel

LEAST = 30
SMOOTHING = 5
SCALE = 1_000_000_000
LISTED = 50
SLICE = 1024
TILE = 128
#: Counters a task holds before it sends them.
HELD = 1 << 20
#: The bitmap of digests has 8 bits a digest, up to 2**MOST_BITS (8 MB).
MOST_BITS = 26

LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Terms:
    """The terms of a piece of documents: their place in the lower-cased bytes, row and digest."""

    def __init__(self, part: pa.RecordBatch, bits: int):
        self.data, offsets = kernel.utf8(part.column("text"))
        self.starts, self.ends, first = kernel.words(self.data, offsets, LETTERS)
        self.row = np.repeat(np.arange(part.num_rows), np.diff(first))
        self.langs = part.column("lang").to_pylist()
        marks = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(self.langs)}
        mark = np.array([marks[x] for x in self.langs], np.uint64)
        digest = kernel.mix(kernel.hash_words(self.data, self.starts, self.ends) ^ mark[self.row])
        self.digest = digest >> np.uint64(64 - bits)

    def only(self, keep: np.ndarray) -> None:
        self.starts, self.ends, self.row, self.digest = (x[keep] for x in (self.starts, self.ends, self.row, self.digest))

    def spelled(self, places: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """Digest, row, and lang and term with a zero byte between them (no term holds one)."""
        low, head = kernel.LOWER[self.data].tobytes(), [x.encode() + b"\0" for x in self.langs]
        for digest, row, a, b in zip(*(x[places].tolist() for x in (self.digest, self.row, self.starts, self.ends)), strict=True):
            yield digest, row, head[row] + low[a:b]

    def differing(self, order: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Of the terms in ``order`` (sorted by digest), those whose text or lang isn't that of the first term of
        their digest, ``head``."""
        size = self.ends - self.starts
        code = np.unique(np.array(self.langs, object).astype(str), return_inverse=True)[1] if self.langs else np.empty(0, int)
        same = (size[order] == size[head]) & (code[self.row[order]] == code[self.row[head]])
        at, to = order[same], head[same]
        length = size[at]
        inner = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        equal = kernel.LOWER[self.data[np.repeat(self.starts[at], length) + inner]] == \
            kernel.LOWER[self.data[np.repeat(self.starts[to], length) + inner]]
        wrong = np.add.reduceat(~equal, np.cumsum(length) - length) > 0 if len(length) else np.empty(0, bool)
        return np.concatenate([order[~same], at[wrong]])


def _runs(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new combination of keys begins."""
    n = len(sorted_keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return np.flatnonzero(new)


def _summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    order = np.lexsort(keys)
    keys = [k[order] for k in keys]
    at = _runs(*keys)
    return [k[at] for k in keys], np.add.reduceat(n[order], at) if len(at) else n[:0]


class Counter:
    """Sums by key over the pieces of a task, in bounded memory."""

    def __init__(self, keys: int):
        self.keys, self.parts, self.size = keys, [], 0

    def add(self, keys: list[np.ndarray], n: np.ndarray) -> bool:
        """True if the counter should be emptied."""
        self.parts.append((keys, n))
        self.size += len(n)
        if self.size > HELD:
            keys, n = self.sums()
            self.parts, self.size = [(keys, n)], len(n)
        return self.size > HELD // 2 and len(self.parts) == 1

    def sums(self) -> tuple[list[np.ndarray], np.ndarray]:
        if not self.parts:
            return [np.empty(0, np.int64)] * self.keys, np.empty(0, np.int64)
        return _summed([np.concatenate(x) for x in zip(*[k for k, _ in self.parts], strict=True)],
                       np.concatenate([n for _, n in self.parts]))

    def take(self) -> tuple[list[np.ndarray], np.ndarray]:
        out = self.sums()
        self.parts, self.size = [], 0
        return out


def _documents(bits: int):
    """(digest, documents that hold it)."""
    def batch(held: Counter) -> pa.RecordBatch:
        (digest,), n = held.take()
        return pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), pa.array(n.astype(np.int64))], ["digest", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter(1)
        for whole in batches:
            for part in kernel.pieces(whole, "text"):
                terms = Terms(part, bits)
                order = np.argsort(terms.digest, kind="stable")  # rows stay in order within a digest
                digest, row = terms.digest[order], terms.row[order]
                at = _runs(digest, row)
                mine = _runs(digest[at])
                if held.add([digest[at][mine]], np.diff(np.append(mine, len(at)))):
                    yield batch(held)
        yield batch(held)
    return run


GATHERED = "group long, digest long, n long, low binary, high binary"
_GATHERED = pa.schema([("group", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("low", pa.binary()), ("high", pa.binary())])


def _gather(bitmap: np.ndarray, bits: int):
    """Counts by group and digest, and the smallest and largest string of each digest, of digests in the bitmap."""
    mask = np.uint64(len(bitmap) * 8 - 1)

    def counts(held: Counter) -> pa.RecordBatch:
        (digest, group), n = held.take()
        none = pa.nulls(len(n), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(group), pa.array(digest.view(np.int64)), pa.array(n.astype(np.int64)),
                                           none, none], schema=_GATHERED)

    def strings(table: dict[int, tuple[bytes, bytes]]) -> pa.RecordBatch:
        rows = len(table)
        low, high = zip(*table.values(), strict=True) if table else ((), ())
        digest = np.fromiter(table, np.uint64, rows).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(rows, pa.int64()), pa.array(digest), pa.nulls(rows, pa.int64()), pa.array(low, pa.binary()),
             pa.array(high, pa.binary())], schema=_GATHERED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, table, size = Counter(2), {}, 0
        for whole in batches:
            for part in kernel.pieces(whole, "text"):
                terms = Terms(part, bits)
                cell = (terms.digest & mask).astype(np.int64)
                terms.only((bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0)
                group = part.column("group").to_numpy()[terms.row]
                order = np.argsort(terms.digest, kind="stable")
                at = _runs(terms.digest[order])
                heads = order[at]
                others = terms.differing(order, np.repeat(heads, np.diff(np.append(at, len(order)))))
                for digest, _, text in terms.spelled(np.concatenate([heads, others])):
                    old = table.get(digest)
                    if old is None:
                        table[digest] = (text, text)
                        size += len(text)
                    elif text < old[0] or text > old[1]:
                        table[digest] = (min(text, old[0]), max(text, old[1]))
                if len(table) > HELD or size > 1 << 26:
                    yield strings(table)
                    table, size = {}, 0
                if held.add(*_summed([terms.digest, group], np.ones(len(group), np.int64))):
                    yield counts(held)
        yield counts(held)
        yield strings(table)
    return run


SPLIT = "group long, text binary, n long, documents long"


def _split(bitmap: np.ndarray, bits: int):
    """Counts by group and text of the terms whose digest is in the bitmap."""
    mask = np.uint64(len(bitmap) * 8 - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in kernel.pieces(whole, "text"):
                terms = Terms(part, bits)
                cell = (terms.digest & mask).astype(np.int64)
                terms.only((bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0)
                groups = part.column("group").to_pylist()
                found: dict[tuple[int, bytes], list[int]] = {}
                for _, row, text in terms.spelled(np.arange(len(terms.row))):
                    own = found.setdefault((groups[row], text), [0, 0, -1])
                    own[0] += 1
                    own[1] += own[2] != row
                    own[2] = row
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g for g, _ in found], pa.int64()), pa.array([t for _, t in found], pa.binary()),
                     pa.array([x[0] for x in found.values()], pa.int64()), pa.array([x[1] for x in found.values()], pa.int64())],
                    ["group", "text", "n", "documents"])
    return run


def _bitmap(digests: DataFrame, bits: int) -> np.ndarray:
    """A packed bitmap of the digests, 8 bits or more for each up to 2**MOST_BITS."""
    width = max(15, min(MOST_BITS, bits, max(1, digests.count()).bit_length() + 3))
    return np.packbits(common.bitmap(digests, "digest", width), bitorder="little")


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents (group, lang, text) and the groups (group, lang, source); a group's number is a hash that no other
    group has."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(text("lang"), text("source"), text("text"))
    found = common.stash(docs.groupBy("lang", "source").agg(F.count("*").alias("documents")))
    tries = 0
    while True:
        number = F.xxhash64(F.lit(tries), "lang", "source").alias("group")
        groups = found.select(number, "lang", "source", "documents")
        if found.count() == groups.select("group").distinct().count():
            return docs.select(number, "lang", "text"), groups
        tries += 1


def kept_terms(docs: DataFrame, least: int = LEAST, bits: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups (group, lang, source, documents), kept terms (term, lang, item) and counts above 0 (term, group, n)."""
    texts, groups = _grouped(docs)
    passed = common.stash(common.arrow(texts.select("lang", "text"), _documents(bits), "digest long, n long")
                          .groupBy("digest").agg(F.sum("n").alias("documents")).where(F.col("documents") >= least))
    gathered = common.stash(common.arrow(texts, _gather(_bitmap(passed, bits), bits), GATHERED))
    strings = common.stash(gathered.where("low is not null").groupBy("digest")
                           .agg(F.min("low").alias("low"), F.max("high").alias("high")).join(passed.select("digest"), "digest"))
    counts = gathered.where("low is null").groupBy("group", "digest").agg(F.sum("n").alias("n"))
    alone = strings.where("low = high").select("digest", F.col("low").alias("text"))
    shared = common.stash(strings.where("low != high").select("digest"))
    number = F.monotonically_increasing_id()
    names = common.stash(alone.withColumn("term", number))
    rows = counts.join(names.select("digest", "term"), "digest").select("term", "group", "n")
    names = names.select("term", "text")
    if not shared.isEmpty():
        apart = common.stash(common.arrow(texts, _split(_bitmap(shared, bits), bits), SPLIT)
                             .groupBy("group", "text").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents")))
        kept = apart.groupBy("text").agg(F.sum("documents").alias("documents")).where(F.col("documents") >= least)
        kept = kept.join(alone, "text", "left_anti")  # the bitmap lets some others pass
        more = common.stash(kept.select((-number - 1).alias("term"), "text"))
        rows = rows.unionByName(apart.join(more, "text").select("term", "group", "n"))
        names = names.unionByName(more)
    item = F.substring_index(F.col("text").cast("string"), "\0", -1)
    lang = F.substring(F.col("text").cast("string"), F.lit(1), F.char_length(F.col("text").cast("string")) - F.char_length("item") - 1)
    terms = names.withColumn("item", item).withColumn("lang", lang).select("term", "lang", "item")
    return groups, common.stash(terms), common.stash(rows)


def _share(n: str, total: str, kept: str, smoothing: int) -> F.Column:
    return F.expr(f"1 + (cast({SCALE} as decimal(11,0)) * cast({n} + {smoothing} as decimal(19,0))) div "
                  f"cast({total} + {smoothing} * {kept} as decimal(19,0))").cast("long")


def shares(groups: DataFrame, terms: DataFrame, counts: DataFrame, smoothing: int = SMOOTHING) -> tuple[DataFrame, DataFrame]:
    """The groups with their lang's number of sources and kept terms and their share ``p0`` of a term they lack (null
    without kept terms), and (term, group, lang, p, q) for each count above 0: the group's and the lang's share."""
    of = groups.select("group", "lang")
    own = counts.groupBy("group").agg(F.sum("n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"))
    stats = (groups.join(own, "group", "left").join(kept, "lang", "left")
             .withColumns({"total": F.coalesce("total", F.lit(0)), "kept": F.coalesce("kept", F.lit(0))}))
    langs = stats.groupBy("lang").agg(F.sum("total").alias("all"), F.count("*").alias("sources"))
    stats = stats.join(langs, "lang")
    stats = common.stash(stats.withColumn("p0", F.when(F.col("kept") > 0, _share("0", "total", "kept", smoothing))))
    whole = counts.groupBy("term").agg(F.sum("n").alias("everywhere"))
    rows = (counts.join(whole, "term").join(stats.select("group", "lang", "total", "all", "kept"), "group")
            .select("term", "group", "lang", _share("n", "total", "kept", smoothing).alias("p"),
                    _share("everywhere", "all", "kept", smoothing).alias("q")))
    return stats, common.stash(rows)


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64()), ("met", pa.int64())])


def _distances(part: pa.Table) -> pa.Table:
    """Sums of absolute differences of each pair of sources of one slice and two tiles, over the terms that any of these
    sources has, and the number of those terms."""
    group, term = part.column("group").to_numpy(), part.column("term")
    numbers, row = np.unique(group, return_inverse=True)
    base, left = np.empty(len(numbers), np.int64), np.empty(len(numbers), bool)
    base[row] = part.column("p0").fill_null(0).to_numpy()
    left[row] = (part.column("own").to_numpy() == part.column("ta").to_numpy())
    real = term.is_valid().to_numpy()
    terms, column = np.unique(term.fill_null(0).to_numpy()[real], return_inverse=True)
    table = np.repeat(base[:, None], len(terms), 1)
    table[row[real], column] = part.column("p").fill_null(0).to_numpy()[real]
    one = part.column("ta")[0].as_py() == part.column("tb")[0].as_py()
    a, b, value = [], [], []
    for i in range(len(numbers)):
        others = np.arange(i + 1, len(numbers)) if one else np.flatnonzero(~left) if left[i] else ()
        if len(others):
            a.append(np.full(len(others), numbers[i]))
            b.append(numbers[others])
            value.append(np.abs(table[others] - table[i]).sum(1))
    if not a:
        return _PAIRS.empty_table()
    a, b, value = (np.concatenate(x) for x in (a, b, value))
    return pa.Table.from_arrays([pa.array(x) for x in (a, b, value, np.full(len(a), len(terms)))], schema=_PAIRS)


def pairs(stats: DataFrame, rows: DataFrame, slice_terms: int = SLICE, tile: int = TILE) -> DataFrame:
    """(a, b, value) for each ordered pair of groups of a lang."""
    cut = stats.select("group", F.greatest(F.lit(1), F.ceil(F.col("kept") / slice_terms)).cast("int").alias("slices"),
                       F.ceil(F.col("sources") / tile).cast("int").alias("tiles"), "p0")
    at = F.pmod(F.xxhash64("term"), F.col("slices")).cast("int")
    full = (rows.join(cut, "group").select("lang", "group", "term", "p", "p0", "tiles", at.alias("slice")))
    bare = (stats.select("lang", "group").join(cut, "group")
            .select("lang", "group", F.lit(None).cast("long").alias("term"), F.lit(None).cast("long").alias("p"), "p0", "tiles",
                    F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")))
    own = F.pmod(F.xxhash64("group"), F.col("tiles")).cast("int")
    dealt = (full.unionByName(bare).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("ta", F.least("own", "other")).withColumn("tb", F.greatest("own", "other")))
    common.ship(rows.sparkSession)
    parts = (dealt.groupBy("lang", "slice", "ta", "tb")
             .applyInArrow(_distances, "a long, b long, value long, met long")
             .groupBy("a", "b").agg(F.sum("value").alias("value"), F.sum("met").alias("met")))
    # a term that neither has differs by what they give to a term they lack
    for x in ("a", "b"):
        parts = parts.join(stats.select(F.col("group").alias(x), F.coalesce("p0", F.lit(0)).alias(f"p0_{x}"),
                                        F.col("kept").alias(f"kept_{x}")), x)
    lacked = (F.col("kept_a") - F.col("met")) * F.abs(F.col("p0_a") - F.col("p0_b"))
    parts = parts.withColumn("value", F.col("value") + lacked)
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return parts.select(both.alias("pair"), "value").select("pair.a", "pair.b", "value")


def divergence(docs: DataFrame, least: int = LEAST, listed: int = LISTED, smoothing: int = SMOOTHING, bits: int = 64,
               slice_terms: int = SLICE, tile: int = TILE) -> DataFrame:
    """lang, source, part ('pair': against each other source of the lang; 'term': the terms that the source uses more than
    its lang), item, value and rank. ``bits`` is the width of a digest."""
    groups, terms, counts = kept_terms(docs, least, bits)
    stats, rows = shares(groups, terms, counts, smoothing)
    a, b = (groups.select(F.col("group").alias(x), F.col("source").alias(f"source_{x}"), F.col("lang").alias(f"lang_{x}"))
            for x in ("a", "b"))
    pair = (pairs(stats, rows, slice_terms, tile).join(a, "a").join(b, "b")
            .select(F.col("lang_a").alias("lang"), F.col("source_a").alias("source"), F.col("source_b").alias("item"), "value"))
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.withColumn("rank", F.row_number().over(place))
    more = rows.where("p > q").select("group", "term", (F.col("p") - F.col("q")).alias("value"))
    tied = more.withColumn("place", F.rank().over(Window.partitionBy("group").orderBy(F.desc("value")))).where(F.col("place") <= listed)
    term = (tied.join(terms.select("term", "item"), "term").join(groups.select("group", "lang", "source"), "group")
            .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= listed))
    shape = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item",
                                       F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
    return shape(pair, "pair").unionByName(shape(term, "term"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(common.read(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS item FROM d),
grp AS (SELECT DISTINCT lang, source FROM d),
kept AS (SELECT lang, item FROM t GROUP BY lang, item HAVING count(DISTINCT r) >= {LEAST}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, item, count(*) AS n FROM t JOIN kept USING (lang, item) GROUP BY ALL),
gn AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM grp LEFT JOIN c USING (lang, source) GROUP BY lang, source),
ln AS (SELECT lang, sum(n) AS n FROM gn GROUP BY lang),
p AS (SELECT lang, source, item, coalesce(c.n, 0) AS n, 1 + CAST({SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTHING}) // (gn.n + {SMOOTHING} * v) AS BIGINT) AS p
  FROM gn JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, item)),
q AS (SELECT lang, item, 1 + CAST({SCALE}::HUGEINT * (coalesce(sum(c.n), 0) + {SMOOTHING}) // (any_value(ln.n) + {SMOOTHING} * any_value(v)) AS BIGINT) AS q
  FROM kept JOIN ln USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, item) GROUP BY lang, item),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b
  ON a.lang = b.lang AND a.item = b.item AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, 'term' AS part, item, CAST(p - q AS BIGINT) AS value FROM p JOIN q USING (lang, item) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= {LISTED}
"""
