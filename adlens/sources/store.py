"""Derived tables kept on shared storage, one set for each state of the sources.

* ``part_rules``   part keys with the winning rule of each text, mapped once
* ``focus_lines``  lineitem rows of parts that can count for the focus brand, with the part's columns, bucketed
                   and sorted by order key
* ``orders``       orders, bucketed and sorted by order key into as many buckets
* ``fact``         the conversion fact, partitioned by month

A state is a fingerprint of the source files (path, length, modification time) and of the parameters; its tables live in
a folder of that name, so a changed source never meets old tables, and old states can be deleted as folders. A table is
complete when its marker is written, which is after its files; a build that lost its driver is done again.

``focus_lines`` and ``orders`` join without an exchange: the shuffle by order key, the largest of every two-layer
query, is paid once when the tables are written. A query by month reads that month's folder of ``fact`` only, also if the
months come from a table (dynamic partition pruning).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators.fact import FACT_COLUMNS, conversion_fact
from adlens.plans.driver import Driver
from adlens.session import shared_dir

#: Bytes of source files that go into one bucket, about; the number of buckets is a power of two.
BUCKET_BYTES = 128 << 20
LEAST_BUCKETS = 8
SOURCES = ("part", "lineitem", "orders")
FACT_TYPES = {"spend": "double", "revenue": "double", "orders": "double", "roas": "double", "cpa": "double"}


class Store:
    """Derived tables over one driver folder. ``root`` defaults to the session's shared folder."""

    def __init__(self, driver: Driver, root: str | None = None, buckets: int | None = None):
        self.d, self.spark = driver, driver.spark
        files = self._files()
        size = sum(length for _, length, _ in files)
        need = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
        self.buckets = buckets or 1 << (need - 1).bit_length()
        mark = repr((files, driver.p, self.buckets))
        self.state = hashlib.sha256(mark.encode()).hexdigest()[:20]
        self.root = f"{(root or shared_dir(self.spark)).rstrip('/')}/store/{self.state}"

    def _files(self) -> list[tuple]:
        """Name, length and time of every source file; contents aren't read."""
        rows = (self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .load([f"{self.d.sf_dir}/{t}.parquet" for t in SOURCES]).select("path", "length", "modificationTime").collect())
        return sorted((r.path, r.length, str(r.modificationTime)) for r in rows)

    # -- building ------------------------------------------------------------
    def _complete(self, table: str) -> bool:
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_complete/{table}")
        return marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(marker)

    def _completed(self, table: str) -> None:
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.root}/_complete/{table}")

    def _bucketed(self, df: DataFrame, table: str, key: str) -> DataFrame:
        """``df`` as a bucketed table. An application that finds the files declares the table on them."""
        name, path = f"adlens_{self.state}_{table}", f"{self.root}/{table}"
        if not self._complete(table):
            # one file a bucket: rows are dealt out by the same hash as the buckets
            (df.repartition(self.buckets, key).write.mode("overwrite").format("parquet").option("path", path)
             .bucketBy(self.buckets, key).sortBy(key).saveAsTable(name))
            self._completed(table)
        elif not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def focus_lines(self) -> DataFrame:
        part = self.part_rules()
        lines = (self.d.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
                                                 "l_returnflag", "l_shipdate")
                 .join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey"))
        return self._bucketed(lines, "focus_lines", "l_orderkey")

    def orders(self) -> DataFrame:
        return self._bucketed(self.d.table("orders").select("o_orderkey", "o_orderdate", "o_orderpriority"), "orders", "o_orderkey")

    def part_rules(self) -> DataFrame:
        """Parts that can count for the focus brand, with their rules."""
        path, part = f"{self.root}/part_rules", self.d.focus_part()
        if not self._complete("part_rules"):
            part.write.mode("overwrite").parquet(path)
            self._completed("part_rules")
        return self.spark.read.schema(part.schema).parquet(path)

    def build_fact(self) -> DataFrame:
        """The conversion fact of both layers from the bucketed tables: no exchange below its aggregate."""
        lines, orders = self.focus_lines(), self.orders()
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        return conversion_fact([self.d.both_layers(joined)], self.d.p.focus_brand, self.d.p.brand_label)

    # -- reading --------------------------------------------------------------
    def fact(self, months: list[str] | DataFrame | None = None) -> DataFrame:
        """The fact from its table. ``months`` is a list, or a frame with a column ``month_start``: either way only the
        folders of those months are read."""
        path = f"{self.root}/fact"
        if not self._complete("fact"):
            made = self.build_fact()
            made.repartition("month_start").write.mode("overwrite").partitionBy("month_start").parquet(path)
            self._completed("fact")
        types = ", ".join(f"`{c}` {FACT_TYPES.get(c, 'string')}" for c in [*[c for c in FACT_COLUMNS if c != "month_start"], "month_start"])
        fact = self.spark.read.schema(types).parquet(path).select(*FACT_COLUMNS)  # a month stays text
        if isinstance(months, DataFrame):
            return fact.join(F.broadcast(months.select("month_start").distinct()), "month_start", "left_semi")
        return fact.where(F.col("month_start").isin(list(months))) if months else fact
