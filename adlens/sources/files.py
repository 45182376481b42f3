"""File sources and sinks for the original exports.

* ``read_csv_strings``   header CSVs bound by column name, every column read as text
                          (no inference: types must not depend on the file)
* ``read_utf16_tsv``     UTF-16 tab-separated export with preamble rows
* ``read_group``         many files of one source group, with lineage
                          (``source_file``) and month from the file name
* ``prefer_revised``     per month, rows of revised files replace the others
* ``manifest``           file listing (binaryFile metadata only) with source
                          group, month, parseability and header preview (first lines only)
* ``write_partitioned``  parquet sink partitioned by month (dynamic overwrite)

Column names are normalised to snake_case at this boundary when asked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions.dates import month_from_name


def snake(name: str) -> str:
    """``Amount spent (INR)`` -> ``amount_spent_inr``; a trailing space (the
    exports' percent-change twin of a column) becomes ``_pct_change``."""
    suffix = "_pct_change" if name.endswith(" ") and name.strip() else ""
    s = re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).strip("_").lower()
    return (s or "col") + suffix


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake(c) for c in df.columns])


def existing(spark: SparkSession, paths) -> list[str]:
    """The files under ``paths`` (files, folders or globs); a path that doesn't exist has none."""
    out: list[str] = []
    for p in [paths] if isinstance(paths, str) else paths:
        try:
            out += [r.path for r in spark.read.format("binaryFile").load(p).select("path").collect()]
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    return sorted(set(out))


def _reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE")
            .option("multiLine", multi_line))


def read_csv_strings(spark: SparkSession, paths, columns: list | None = None, multi_line: bool = False) -> DataFrame:
    """Header CSVs as all-string columns, bound by name. Files may differ in their headers: those with
    the same header are read together, and the reads are united by column name (a column that a
    file lacks is null). ``columns`` picks columns in that order. A file is split among tasks unless
    quoted line breaks are declared by ``multi_line``. Paths that don't exist count as empty. Every
    row has its decoded path in ``source_file``."""
    files = existing(spark, paths)
    out = None
    for group in by_head(spark, files):  # a header is read once, not once a file
        own = [_escaped(p) for p in group.paths]
        header = _reader(spark, multi_line).csv(own[0]).columns
        if not header:
            continue
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        df = _reader(spark, multi_line).schema(schema).csv(own).select(
            "*", F.url_decode(F.col("_metadata.file_path")).alias("source_file"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        out = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*(columns or []), "source_file"]))
    if columns:
        have = set(out.columns)
        out = out.select(*[F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c) for c in columns], "source_file")
    return out


#: Raw lines looked at for a file's first lines: in UTF-16 some letters hold the byte of a line break.
HEAD_PARTS = 64
SMALL = 1 << 20
HEADS = "path string, encoding string, lines array<string>"


def _decoded(raw: bytes) -> tuple[str, str]:
    """(encoding, text) by byte-order mark, as UTF-8 or else as Latin-1."""
    for mark, encoding in ((b"\xff\xfe", "UTF-16LE"), (b"\xfe\xff", "UTF-16BE")):
        if raw.startswith(mark):
            return encoding, raw[2:len(raw) // 2 * 2].decode(encoding, "replace")
    try:
        return "UTF-8", raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return "ISO-8859-1", raw.decode("latin-1")


def _first_lines(n: int, alone: bool):
    """The first ``n`` lines of each file that a task reads. With ``alone`` a task has one file, and ends with its
    first batches: the rest of the file is never read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[bytes]] = {}
        for batch in batches:
            for path, line in zip(batch.column("path").to_pylist(), batch.column("line").to_pylist(), strict=True):
                own = parts.setdefault(path, [])
                if len(own) < HEAD_PARTS:
                    own.append(line)
            if alone and any(len(own) >= HEAD_PARTS for own in parts.values()):
                break
        texts = [_decoded(b"\n".join(own)) for own in parts.values()]
        lines = [[x.rstrip("\r") for x in text.split("\n")][:n] for _, text in texts]
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.string()), pa.array([e for e, _ in texts], pa.string()),
                                          pa.array(lines, pa.list_(pa.string()))], ["path", "encoding", "lines"])
    return run


def heads(spark: SparkSession, paths: list[str], n: int = 3) -> DataFrame:
    """(path, encoding, lines): encoding and first ``n`` lines of every file that isn't empty, in as many jobs for a
    thousand files as for ten. A file of over SMALL bytes is one task, which stops after its head; smaller ones share
    tasks."""
    def read(some: list[str], alone: bool) -> DataFrame:
        own = spark.newSession()  # for its settings
        own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50 if alone else 16 * SMALL))
        own.conf.set("spark.sql.files.openCostInBytes", str(1 << 50 if alone else SMALL // 16))
        own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(HEAD_PARTS if alone else 10_000))
        if alone:
            own.conf.set("spark.sql.files.minPartitionNum", "1")
        if not some:
            return own.createDataFrame([], HEADS)
        lines = (own.read.option("lineSep", "\n").text(some)
                 .select(F.url_decode(F.col("_metadata.file_path")).alias("path"), F.col("value").cast("binary").alias("line")))
        return lines.mapInArrow(_first_lines(n, alone), HEADS)

    listed = spark.read.format("binaryFile").load(paths).select("path", "length").collect() if paths else []
    large = [_escaped(r.path) for r in listed if r.length > SMALL]
    small = [_escaped(r.path) for r in listed if r.length <= SMALL]
    found = read(small, False)
    return found.unionAll(read(large, True)) if large else found


def head_lines(spark: SparkSession, path: str, n: int = 3) -> list[str]:
    """The first ``n`` lines of a text file."""
    found = heads(spark, [path], n).collect()
    return found[0].lines if found else []


def by_head(spark: SparkSession, files: list[str], line: int = 0) -> list:
    """The files grouped on the executors by encoding and first lines (up to and with number ``line``): rows of
    (encoding, lines, paths). Empty files are in no group."""
    return (heads(spark, [_escaped(f) for f in files], line + 1).where(F.size("lines") > line).groupBy("encoding", "lines")
            .agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("paths").collect())  # names of files, and their headers


def _escaped(path: str) -> str:
    """A decoded path as Spark's readers take it: literally, not as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_utf16_tsv(spark: SparkSession, paths, preamble_rows: int = 2) -> DataFrame:
    """TSV exports in UTF-16 of either byte order, or in UTF-8: preamble lines, then the header, then rows, as text columns
    by the names of the header. ``paths`` is one path or many; files with the same encoding and head are read together, and
    the reads are united by column name. The preamble and the header are dropped by their content (a preamble line has one
    field, whose text is known; a row with blank fields stays). Lines are found by their bytes, so a file is split among
    tasks; in UTF-16 a letter that ends in the byte 00 right before one that begins with 0A would end a line. Paths that don't exist and files that end before their header count as empty."""
    out = None
    for group in by_head(spark, existing(spark, paths), preamble_rows):
        df = _tsv(spark, [_escaped(p) for p in group.paths], group.encoding, group.lines, preamble_rows)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return spark.createDataFrame([], "source_file string") if out is None else \
        out.select(*[c for c in out.columns if c != "source_file"], "source_file")


def _tsv(spark: SparkSession, paths: list[str], encoding: str, top: list[str], preamble_rows: int) -> DataFrame:
    header = [c.strip("\ufeff") for c in top[preamble_rows].split("\t")]
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))])
    df = (spark.read.option("encoding", encoding).option("sep", "\t").option("lineSep", "\n")
          .option("header", False).option("mode", "PERMISSIVE").option("maxCharsPerColumn", -1)
          .option("maxColumns", max(20480, len(header) + 1)).schema(schema).csv(paths)
          .withColumn("source_file", F.url_decode(F.col("_metadata.file_path"))))
    clean = [F.regexp_replace(F.col(f"_c{i}"), "^\ufeff|\r$", "").alias(c) for i, c in enumerate(header)]
    df = df.select(*[F.when(c != "", c).alias(n) for c, n in zip(clean, header, strict=True)], "source_file")
    fields = F.array(*[F.col(f"`{c}`") for c in header])
    same = fields.eqNullSafe(F.array(*[F.lit(c if c else None).cast("string") for c in header]))
    rest_null = F.size(F.array_compact(F.slice(fields, 2, len(header)))) == 0
    intro = [x.strip("\ufeff") for x in top[:preamble_rows]]
    first = F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))
    preamble = rest_null & (first.isin(intro) if intro else F.lit(False))
    return df.where(~same & ~preamble)


def read_group(spark: SparkSession, paths, columns: list | None = None,
               months: list | None = None, multi_line: bool = False) -> DataFrame:
    """All files of a source group by column name, with ``source_file`` (decoded path) and
    ``month_start`` from the file name; optional month filter."""
    df = read_csv_strings(spark, paths, columns, multi_line)
    out = df.withColumn("month_start", month_from_name(F.regexp_extract("source_file", r"([^/]*)$", 1)))
    return out.where(F.col("month_start").isin(list(months))) if months else out


def prefer_revised(df: DataFrame, month_col: str, is_revised: Column) -> DataFrame:
    """Keep, per month, only the revised rows when the month has any; other
    months keep all rows. A null flag is no revision. Whether a month has any
    is one grouped maximum (a row per month), joined back, so no window spans
    a whole month of raw rows."""
    flagged = df.withColumn("_rev", F.coalesce(is_revised, F.lit(False)))
    has = flagged.groupBy(F.col(month_col).alias("_month")).agg(F.max("_rev").alias("_any"))
    return (flagged.join(has, F.col(month_col).eqNullSafe(F.col("_month")))
            .where(F.col("_rev") == F.col("_any")).drop("_rev", "_month", "_any"))


def classify_source(path: Column, rules: list) -> Column:
    """Ordered substring rules on the lower-cased path; first hit wins, else ``other``."""
    p = F.lower(path)
    out = None
    for token, group in rules:
        out = F.when(p.contains(token), group) if out is None else out.when(p.contains(token), group)
    return (out.otherwise("other") if out is not None else F.lit("other"))


def parseability(ext: Column):
    """(parseable_by_etl, note) by extension."""
    ok = F.when(ext == "csv", "yes").otherwise("no")
    note = (F.when(ext == "csv", "")
            .when(ext == "xlsx", "xlsx requires an explicit conversion step")
            .otherwise("unsupported extension"))
    return ok, note


def header_preview(lines: list[str], limit: int = 500) -> str:
    """First non-blank of the first three lines (the third when the first
    names a campaign report); cut to ``limit`` characters."""
    l0, l1, l2 = ([x.strip() for x in lines] + ["", "", ""])[:3]
    if "campaign report" in l0.lower() and len(lines) >= 3:
        return l2[:limit]
    return (l0 or l1 or l2)[:limit]


def manifest(spark: SparkSession, root: str, rules: list, with_preview: bool = True) -> DataFrame:
    """One row per file under ``root``: path, group, extension, size, mtime,
    month from the name, parseability and (optionally) header preview, for
    which only the first lines of the CSV files are read. Files of no bytes are
    not listed (the file source skips them)."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
          .select("path", "length", "modificationTime"))
    path = F.url_decode(F.col("path"))
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    ext = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    ok, note = parseability(ext)
    cols = [path.alias("relative_path"), classify_source(path, rules).alias("source_group"),
            ext.alias("extension"), F.col("length").alias("size_bytes"),
            F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss").alias("modified_at"),
            month_from_name(name).alias("parsed_month"), ok.alias("parseable_by_etl"),
            F.when(ext == "xlsx", "yes").otherwise("no").alias("needs_manual_xlsx_etl")]
    if with_preview:
        files = [_escaped(r.path) for r in df.where(ext == "csv").select(path.alias("path")).collect()]  # file names, not data
        previews = [(r.path, header_preview(r.lines)) for r in heads(spark, files).collect()]  # 500 characters a file
        previews = spark.createDataFrame(previews, "_path string, _preview string")
        df = df.join(previews, path == F.col("_path"), "left")
        cols.append(F.coalesce("_preview", F.lit("")).alias("header_preview"))
    cols.append(note.alias("notes"))
    return df.select(*cols)


def write_partitioned(df: DataFrame, path: str, partition_col: str = "month_start",
                      fmt: str = "parquet") -> None:
    """Sink partitioned by month; only the months present in ``df`` are
    replaced (dynamic partition overwrite), so a re-run of one month does
    not touch the others. CSV files get a header."""
    out = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col)
    (out.option("header", True) if fmt == "csv" else out).format(fmt).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A mart or tab as CSV with a header in every file; a null is an empty field, an empty text is quoted."""
    df.write.mode("overwrite").option("header", True).csv(path)


def load_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalogue table (drop + create as select)."""
    w = df.write.mode("overwrite")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
