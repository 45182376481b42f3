import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from adlens.functions.dates import month_from_name
from adlens.operators.fact import drop_totals
from adlens.session import checkpoint_dir
from adlens.sources import files
from adlens.streaming.incremental import quarantine_issues, quarantine_path, refresh, store_files

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_read_group_month_from_encoded_name(spark, tmpdir_fresh):
    write(f"{tmpdir_fresh}/g/Google_Jan 2026.csv", "Campaign,Cost\n\"a, b\",\"1,000\"\n")
    write(f"{tmpdir_fresh}/g/Google_Dec_25.csv", "Campaign,Cost\nc,5\n")
    df = files.read_group(spark, f"{tmpdir_fresh}/g/*.csv")
    got = sorted((r.Campaign, r.month_start) for r in df.collect())
    assert got == [("a, b", "2026-01"), ("c", "2025-12")]


def test_prefer_revised(spark):
    df = spark.createDataFrame([("2025-12", True, 1), ("2025-12", False, 2), ("2026-01", False, 3)],
                               "m string, rev boolean, v int")
    kept = sorted(r.v for r in files.prefer_revised(df, "m", F.col("rev")).collect())
    assert kept == [1, 3]


def test_a_null_flag_is_no_revision(spark):
    df = spark.createDataFrame([("2026-01", None, 1), ("2026-01", None, 2), ("2026-02", True, 3), ("2026-02", None, 4), (None, None, 5)],
                               "m string, rev boolean, v int")
    assert sorted(r.v for r in files.prefer_revised(df, "m", F.col("rev")).collect()) == [1, 2, 3, 5]


def test_files_are_bound_by_column_name(spark, tmpdir_fresh):
    write(f"{tmpdir_fresh}/g/a_Jan_26.csv", "Campaign,Cost\nalpha,10\n")
    write(f"{tmpdir_fresh}/g/b_Feb_26.csv", "Cost,Campaign\n20,beta\n")
    write(f"{tmpdir_fresh}/g/c_Mar_26.csv", "Extra,Campaign,Reach,Cost\nx,gamma,5,30\n")
    rows = files.read_group(spark, f"{tmpdir_fresh}/g")
    assert {(r.Campaign, r.Cost, r.Extra, r.month_start) for r in rows.collect()} == {
        ("alpha", "10", None, "2026-01"), ("beta", "20", None, "2026-02"), ("gamma", "30", "x", "2026-03")}
    picked = files.read_csv_strings(spark, f"{tmpdir_fresh}/g/*.csv", ["Cost", "Campaign", "Nope"])
    assert picked.columns == ["Cost", "Campaign", "Nope", "source_file"]
    assert {(r.Cost, r.Campaign, r.Nope) for r in picked.collect()} == {("10", "alpha", None), ("20", "beta", None), ("30", "gamma", None)}
    only = files.read_group(spark, f"{tmpdir_fresh}/g", months=["2026-02"])
    assert [r.Campaign for r in only.collect()] == ["beta"]


def test_missing_paths_and_quoted_line_breaks(spark, tmpdir_fresh):
    write(f"{tmpdir_fresh}/a.csv", "name,note\n\"x\",\"two\nlines\"\n")
    got = files.read_csv_strings(spark, [f"{tmpdir_fresh}/a.csv", f"{tmpdir_fresh}/none.csv"], multi_line=True)
    assert [(r.name, r.note) for r in got.collect()] == [("x", "two\nlines")]
    none = files.read_csv_strings(spark, f"{tmpdir_fresh}/none.csv", ["a", "b"])
    assert none.columns == ["a", "b", "source_file"] and none.count() == 0
    assert files.read_group(spark, f"{tmpdir_fresh}/nothing/*.csv", ["a"]).count() == 0


def test_utf16_tsv_with_preamble(spark, tmpdir_fresh):
    text = ("Campaign report\nJanuary 1, 2026 - January 31, 2026\n"
            "Campaign status\tCampaign\tCost\nEnabled\tsara, search\t1,234.50\nEnabled\t\t7\nTotal: x\t\t10\n")
    for name, end in (("t", "\n"), ("u", "\r\n")):
        write(f"{tmpdir_fresh}/{name}.csv", text.replace("\n", end), encoding="utf-16")
        df = files.read_utf16_tsv(spark, f"{tmpdir_fresh}/{name}.csv")
        rows = [tuple(r)[:3] for r in drop_totals(df, ["Campaign"]).collect()]
        assert rows == [("Enabled", "sara, search", "1,234.50"), ("Enabled", None, "7")]  # a blank field loses no row


def test_header_heads(spark, tmpdir_fresh):
    long = "ü" * 3000 + ",b"
    cases = {"bom": ("\ufeffa,b\n1,2\n", "utf-8", "a,b"), "latin": ("Größe,b\n", "latin-1", "Größe,b"),
             "long": (long + "\n1\n", "utf-8", long[:500]), "wide": ("Campaign report\nx\nA\tB\n", "utf-16", "A\tB"),
             "third": ("x" * 5000 + " campaign report\nline\nName,Cost\n", "utf-8", "Name,Cost"), "blank": ("\n\nz\n", "utf-8", "z")}
    for name, (text, encoding, _) in cases.items():
        write(f"{tmpdir_fresh}/in/{name}.csv", text, encoding=encoding)
    got = {os.path.basename(r.relative_path)[:-4]: r.header_preview for r in files.manifest(spark, f"{tmpdir_fresh}/in", []).collect()}
    assert got == {k: v for k, (_, _, v) in cases.items()}


def test_months_of_file_names(spark):
    names = {"Jan 202.csv": "", "Jan_25.csv": "2025-01", "x-Sept-2026 v1.csv": "2026-09", "Feb2026.csv": "2026-02", "Mar_20256.csv": "",
             "May 7.csv": "", "dec 99": "2099-12"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n: r.m for r in df.select("n", month_from_name("n").alias("m")).collect()} == names


def test_manifest_and_partitioned_sink(spark, tmpdir_fresh):
    write(f"{tmpdir_fresh}/in/SWF-MetaXBlinkit/SWF-Blinkit-Jan_26.csv", "a,b\n1,2\n")
    write(f"{tmpdir_fresh}/in/x.xlsx", "zz")
    m = {os.path.basename(r.relative_path): r for r in files.manifest(
        spark, f"{tmpdir_fresh}/in", [("swf-metaxblinkit", "meta_blinkit")]).collect()}
    b = m["SWF-Blinkit-Jan_26.csv"]
    assert (b.source_group, b.parsed_month, b.parseable_by_etl, b.header_preview) == \
        ("meta_blinkit", "2026-01", "yes", "a,b")
    assert m["x.xlsx"].parseable_by_etl == "no"
    out = f"{tmpdir_fresh}/out"
    d1 = spark.createDataFrame([("2025-12", 1), ("2026-01", 2)], "month_start string, v int")
    files.write_partitioned(d1, out)
    files.write_partitioned(spark.createDataFrame([("2026-01", 9)], "month_start string, v int"), out)
    got = sorted((r.month_start, r.v) for r in spark.read.parquet(out).collect())
    assert got == [("2025-12", 1), ("2026-01", 9)]


def test_stream_keeps_all_files_of_a_month(spark, tmpdir_fresh):
    drop, target = f"{tmpdir_fresh}/drop", f"{tmpdir_fresh}/staging"
    name = os.path.basename(tmpdir_fresh)
    write(f"{drop}/meta_w1_Dec_25.csv", "name,spend\na,1\n")
    write(f"{drop}/meta_Jan_26.csv", "spend,name\n2,b\n")
    refresh(spark, drop, target, ["name", "spend"], name=name)
    write(f"{drop}/meta_w2_Dec_25.csv", "name,spend\nc,3\n")   # a second week of the same month
    write(f"{drop}/nomonth.csv", "name,spend\nq,9\n")
    refresh(spark, drop, target, ["name", "spend"], name=name)
    rows = sorted((r.month_start, r.name, r.spend) for r in spark.read.parquet(target).collect())
    assert rows == [("2025-12", "a", "1"), ("2025-12", "c", "3"), ("2026-01", "b", "2")]
    lost = spark.read.parquet(quarantine_path(target)).collect()
    assert [(r.name, r.spend) for r in lost] == [("q", "9")]
    assert [r.issue_type for r in quarantine_issues(spark, target).collect()] == ["file_without_month"]
    # the same file delivered again replaces its own rows only
    store_files(spark, [f"file://{drop}/meta_w2_Dec_25.csv"], target, ["name", "spend"])
    assert spark.read.parquet(target).count() == 3
    assert quarantine_issues(spark, f"{tmpdir_fresh}/other").count() == 0


def test_stream_resumes_in_a_second_application(tmpdir_fresh):
    """Another process with the same checkpoint folder reads nothing that was read before."""
    write(f"{tmpdir_fresh}/drop/meta_Dec_25.csv", "name,spend\na,1\n")
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from adlens.session import build_session\nfrom adlens.streaming.incremental import refresh\n"
            f"s = build_session('local[2]', 2, extra={{'spark.checkpoint.dir': 'file://{tmpdir_fresh}/ckpt'}})\n"
            f"q = refresh(s, '{tmpdir_fresh}/drop', '{tmpdir_fresh}/out', ['name', 'spend'])\n"
            "print('ROWS', sum(p['numInputRows'] for p in q.recentProgress))\n")
    read = []
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        read.append(int(done.stdout.rpartition("ROWS")[2]))
    assert read[0] >= 1 and read[1] == 0


def test_checkpoint_folder_must_be_set(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == folder

    class Bare:
        class conf:  # noqa: N801
            @staticmethod
            def get(_, default):
                return default
    with pytest.raises(RuntimeError):
        checkpoint_dir(Bare)


def test_load_table(spark, tmpdir_fresh):
    files.load_table(spark.createDataFrame([(1,)], "v int"), "adlens_load_test", f"{tmpdir_fresh}/t")
    files.load_table(spark.createDataFrame([(2,)], "v int"), "adlens_load_test", f"{tmpdir_fresh}/t")
    assert [r.v for r in spark.table("adlens_load_test").collect()] == [2]
    spark.sql("DROP TABLE adlens_load_test")
