"""Priority LIKE-pattern entity mapping (campaign / ad-set name -> brand).

Rule table columns: ``brand, platform, pattern, priority`` plus an ``ord``
column (file order). For one name on one platform every rule whose pattern
matches the lower-cased name is a hit; the best hit wins by
``priority desc, length(pattern) desc, ord asc``. No hit gives null, a null
name gives null. Only ``%`` is a wildcard: ``_`` and ``\\`` in a pattern are
literal.

There is one way to map, whatever the number of rules: names meet the rules in an
equi-join on a literal gram, and LIKE is tested on those pairs only.

* The grams of a pattern are all runs of ``GRAM`` characters in its literal text (its
  longest literal run if that is shorter, the empty text if there is none). A name that
  the pattern matches contains each of them, so any one of them finds every hit.
* Every pattern gets one of its grams as key. ``keyed_by(names)`` counts the rules' grams
  in the names and takes each pattern's rarest; without counts it is the gram that the
  fewest other rules have.
* Names are cut into grams, and a gram goes on only if it is in a bitmap of the keys. The
  bitmap has a fixed size (BITS) and is a scalar subquery, so what is shuffled is near
  the number of rules that a name can match, not three times the name's length. A full
  bitmap (very many rules) costs rows, never hits.

The best hit per name is one aggregate. No broadcast is forced: the optimizer sees the
sizes.
"""

from __future__ import annotations

from copy import copy
from functools import cached_property
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
#: Cells of the key bitmap (8 KB), 64 to a word.
BITS = 1 << 16
#: Rule tables given as rows, by session: keys are chosen once an application.
_settled: WeakKeyDictionary = WeakKeyDictionary()


def _priority(c: Column) -> Column:
    """Numeric priority; bad or missing text counts as 0."""
    return F.coalesce(c.cast("string").try_cast("double").cast("int"), F.lit(0))


def _grams(text: Column, n: int) -> Column:
    """All runs of ``n`` characters of a text, as an array."""
    last = F.length(text) - (n - 1)
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(n)))) \
        .otherwise(F.array().cast("array<string>"))


_CELL = f"(xxhash64(gram) & {BITS - 1})"


def _cells(keys: DataFrame) -> DataFrame:
    """The cells of ``keys(gram)`` as one row: an array of BITS / 64 words."""
    words = (keys.selectExpr(f"{_CELL} as cell").groupBy(F.expr("shiftright(cell, 6)").alias("id"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(cell & 63 as int)))").alias("bits")))
    every = keys.sparkSession.range(0, BITS // 64, 1, 1).join(words, "id", "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "bits"))), lambda x: x["bits"]).alias("words"))


def _cut(texts: DataFrame, cells: DataFrame) -> DataFrame:
    """``texts(name, ...)`` with each distinct gram of the name (of up to GRAM characters) whose cell is set."""
    runs = ", ".join(f"if(length(name) >= {n}, transform(sequence(1, length(name) - {n - 1}), i -> substring(name, i, {n})), "
                     "cast(array() as array<string>))" for n in range(1, GRAM + 1))
    cut = texts.where("name is not null").selectExpr("*", f"explode(array_distinct(concat(array(''), {runs}))) as gram")
    return cut.where(F.getbit(F.element_at(cells.scalar(), F.expr(f"cast(shiftright({_CELL}, 6) as int) + 1")),
                              F.expr(f"cast({_CELL} & 63 as int)")) == 1)


class BrandMap:
    """A rule table and the mapping of names by it."""

    def __init__(self, rules: DataFrame):
        ordc = F.col("ord") if "ord" in rules.columns else F.monotonically_increasing_id()
        runs = F.filter(F.split("pattern", "%"), lambda x: F.length(x) > 0)
        longest = F.array_max(F.transform(runs, lambda x: F.struct(F.length(x).alias("n"), x.alias("s"))))["s"]
        grams = F.array_distinct(F.flatten(F.transform(runs, lambda x: _grams(x, GRAM))))
        self.candidates = (rules.select(
            F.col("brand").cast("string").alias("brand"),
            F.lower(F.col("platform").cast("string")).alias("platform"),
            F.lower(F.col("pattern").cast("string")).alias("pattern"),
            _priority(F.col("priority")).alias("priority"), ordc.cast("long").alias("ord"))
            .where(F.col("pattern").isNotNull() & F.col("platform").isNotNull())
            .withColumn("grams", F.when(F.size(grams) > 0, grams).otherwise(F.array(F.coalesce(longest, F.lit(""))))))
        self._count = None  # (gram, n) of the names, where keyed_by counted them
        self._given = False

    @cached_property
    def rules(self) -> DataFrame:
        """(brand, platform, pattern, priority, ord, gram): every rule with its key."""
        spread = self.candidates.select("*", F.explode("grams").alias("gram")).drop("grams")
        count = self._count
        if count is None:
            count = spread.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        key = F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("gram")))
        whole = ["brand", "platform", "pattern", "priority", "ord"]
        # equal rules may share an ord, and a null brand is a value like any other
        return spread.join(count, "gram", "left").groupBy(*whole).agg(key.alias("gram"))

    @cached_property
    def cells(self) -> DataFrame:
        """The bitmap of the keys."""
        return _cells(self.rules)

    def keyed_by(self, names: DataFrame) -> "BrandMap":
        """The same rules, each keyed by the one of its grams that the fewest of ``names(name)`` hold."""
        mine = self.candidates.select(F.explode("grams").alias("gram")).distinct()
        texts = names.select(F.lower(F.col("name").cast("string")).alias("name"))
        out = copy(self)
        out.__dict__.pop("rules", None)
        out.__dict__.pop("cells", None)
        out._count = _cut(texts, _cells(mine)).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        return out._settle() if self._given else out

    def _settle(self) -> "BrandMap":
        """Keys and bitmap of rules that were given as rows are computed once, not in every plan."""
        spark = self.candidates.sparkSession
        self._given = True
        self.rules = spark.createDataFrame(self.rules.toArrow())
        self.cells = spark.createDataFrame(self.cells.toArrow())
        return self

    # -- construction -----------------------------------------------------
    @classmethod
    def from_rows(cls, spark: SparkSession, rows) -> "BrandMap":
        """rows: (brand, platform, pattern, priority) tuples in file order."""
        import pyarrow as pa
        text = lambda v: None if v is None else str(v)
        rows = [tuple(r) for r in rows]
        known = _settled.setdefault(spark, {})
        if tuple(rows) in known:
            return known[tuple(rows)]
        cols = [pa.array([text(r[k]) for r in rows], pa.string()) for k in range(4)]
        table = pa.table([*cols, pa.array(range(len(rows)), pa.int64())],
                         ["brand", "platform", "pattern", "priority", "ord"])
        known[tuple(rows)] = cls(spark.createDataFrame(table))._settle()
        return known[tuple(rows)]

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str) -> "BrandMap":
        """One rule file with a header. Row order is that of the file, also where the file is split:
        a row is placed by its split's first byte plus its number in the split."""
        df = (spark.read.option("header", True).schema(
            "brand string, platform string, pattern string, priority string").csv(path))
        row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        return cls(df.select("*", (F.col("_metadata.file_block_start") + row).alias("ord")))

    # -- mapping ------------------------------------------------------------
    def pairs(self, texts: DataFrame) -> DataFrame:
        """``texts(name, ...)``, lower-cased names, joined to every rule that matches: with platform, hit and rank."""
        matched = (_cut(texts, self.cells).join(self.rules, "gram")
                   .where(r"name like regexp_replace(regexp_replace(pattern, '\\\\', '\\\\\\\\'), '_', '\\\\_')"))
        return matched.selectExpr(*texts.columns, "platform", "struct(brand, pattern, priority) as hit",
                                  "struct(priority, length(pattern) as n, -ord as o) as rank")

    def hits(self, names: DataFrame) -> DataFrame:
        """(name, platform, hit, rank) for every rule that matches a distinct lower-cased text of
        ``names(name)``."""
        return self.pairs(names.select(F.lower(F.col("name").cast("string")).alias("name")).where("name is not null").distinct())

    def wide(self, names: DataFrame, platforms) -> DataFrame:
        """(name, <platform> ...): the winning struct(brand, pattern, priority) on each platform, for
        every distinct lower-cased name with a hit on any of them."""
        on = lambda p, c: F.when(F.col("platform") == p, F.col(c))
        return self.hits(names).groupBy("name").agg(*[F.max_by(on(p, "hit"), on(p, "rank")).alias(p) for p in platforms])

    def by_key(self, df: DataFrame, key: str, texts, platforms) -> DataFrame:
        """(key, <text>_<platform> ...): for every row of ``df`` that has a hit, the winning struct(brand, pattern,
        priority) of each of its ``texts`` on each platform. ``key`` names a row. All texts are mapped in one pass, and
        one aggregate by key is the only shuffle that grows with ``df``."""
        each = ", ".join(f"struct({k} as k, lower(cast({c} as string)) as name)" for k, c in enumerate(texts))
        found = self.pairs(df.selectExpr(f"{key} as _key", f"inline(array({each}))"))
        best = [F.expr(f"max_by(hit, rank) filter (where k = {k} and platform = '{p}') as {c}_{p}")
                for k, c in enumerate(texts) for p in platforms]
        return found.groupBy("_key").agg(*best).withColumnRenamed("_key", key)

    def attach(self, df: DataFrame, name_col: str, platform: str | Column, out_col: str = "mapped_brand",
               details: bool = False) -> DataFrame:
        """``df`` with the mapped brand of ``name_col`` on ``platform`` (a literal platform name or a
        column). With ``details`` also ``matched_pattern`` and ``matched_priority``."""
        best = (self.hits(df.select(F.col(name_col).alias("name"))).groupBy("name", "platform")
                .agg(F.max_by("hit", "rank").alias("_hit"))
                .select(F.col("name").alias("_name"), F.col("platform").alias("_on"), "_hit"))
        own = F.lower(F.lit(platform) if isinstance(platform, str) else platform)
        out = df.join(best, (F.lower(F.col(name_col).cast("string")) == F.col("_name")) & (own == F.col("_on")), "left")
        out = out.withColumn(out_col, F.col("_hit.brand"))
        if details:
            out = (out.withColumn("matched_pattern", F.col("_hit.pattern"))
                   .withColumn("matched_priority", F.col("_hit.priority")))
        return out.drop("_name", "_on", "_hit")


def infer_rules(names: DataFrame, name_col: str, platform: str | Column, keywords: dict) -> DataFrame:
    """Keyword-based rule inference: for each brand, the first of its keywords
    (in list order) contained in a lower-cased name gives the rule
    (brand, platform, %keyword%). Output is the distinct rule set. ``platform`` is a
    literal or a column of ``names``.

    ``keywords`` is a small dict parameter; the work is one projection and
    one distinct over the names, so it scales with the names table.
    """
    lname = F.lower(F.col(name_col))
    per_brand = []
    for brand, keys in keywords.items():
        first = None
        for k in keys:
            cond = lname.contains(k)
            first = F.when(cond, F.lit(k)) if first is None else first.when(cond, F.lit(k))
        per_brand.append(F.struct(F.lit(brand).alias("brand"), first.alias("kw")))
    return (names.where(F.col(name_col).isNotNull())
            .select((F.lit(platform) if isinstance(platform, str) else platform).alias("platform"),
                    F.explode(F.array(*per_brand)).alias("h"))
            .where(F.col("h.kw").isNotNull())
            .select(F.col("h.brand").alias("brand"), "platform",
                    F.concat(F.lit("%"), F.col("h.kw"), F.lit("%")).alias("pattern"))
            .distinct())
