"""Header discovery in one job, exports of any byte order, CSV sinks."""

import os

import pytest

from adlens.sources import files
from tests.test_files_streaming import write


def jobs_of(spark, work) -> int:
    """Spark jobs that ``work`` starts."""
    context, group = spark.sparkContext, f"count-{os.urandom(4).hex()}"
    context.setJobGroup(group, group)
    try:
        work()
        return len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setJobGroup("", "")


def test_jobs_do_not_grow_with_the_files(spark, tmpdir_fresh):
    for n in (70, 140):
        for k in range(n):
            header = "name,cost" if k % 2 else "cost,name"
            write(f"{tmpdir_fresh}/{n}/f{k}_Jan_26.csv", header + "\n" + (f"a{k},{k}\n" if k % 2 else f"{k},a{k}\n"))
    few = jobs_of(spark, lambda: files.read_csv_strings(spark, f"{tmpdir_fresh}/70"))
    many = jobs_of(spark, lambda: files.read_csv_strings(spark, f"{tmpdir_fresh}/140"))
    assert many == few
    got = files.read_csv_strings(spark, f"{tmpdir_fresh}/140").collect()
    assert sorted((r.name, r.cost) for r in got) == sorted((f"a{k}", str(k)) for k in range(140))
    few = jobs_of(spark, lambda: files.manifest(spark, f"{tmpdir_fresh}/70", []).collect())
    many = jobs_of(spark, lambda: files.manifest(spark, f"{tmpdir_fresh}/140", []).collect())
    assert many == few


def test_only_the_head_of_a_file_is_read(spark, tmpdir_fresh):
    """A file that would be split, and is longer than what a task looks at."""
    write(f"{tmpdir_fresh}/long.csv", "a,b\n" + "1,2\n" * 4_000_000)
    write(f"{tmpdir_fresh}/empty.csv", "")
    write(f"{tmpdir_fresh}/one.csv", "a,b")
    found = files.heads(spark, [f"file://{tmpdir_fresh}/{n}.csv" for n in ("long", "empty", "one")], 2)
    assert os.path.getsize(f"{tmpdir_fresh}/long.csv") > files.SMALL
    assert found.rdd.getNumPartitions() == 2  # small files share tasks, a large one is a task and isn't split
    assert {os.path.basename(r.path): r.lines for r in found.collect()} == {"long.csv": ["a,b", "1,2"], "one.csv": ["a,b"]}


def test_names_that_look_like_patterns(spark, tmpdir_fresh):
    for name in ("a [1] Jan_26.csv", "b{x} 50% Feb_26.csv", "c*Mar_26.csv"):
        write(f"{tmpdir_fresh}/odd/{name}", f"n\n{name[0]}\n")
    got = files.read_group(spark, f"{tmpdir_fresh}/odd")
    assert {(r.n, r.month_start) for r in got.collect()} == {("a", "2026-01"), ("b", "2026-02"), ("c", "2026-03")}


REPORT = "Campaign report\nJanuary 2026\n{header}\n{rows}Total: x\t\t\t\n"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_exports_of_any_byte_order_at_once(spark, tmpdir_fresh, end):
    codes = {"le": ("utf-16-le", b"\xff\xfe"), "be": ("utf-16-be", b"\xfe\xff"), "utf8": ("utf-8", b"\xef\xbb\xbf"), "plain": ("utf-8", b"")}
    for k, (name, (code, mark)) in enumerate(codes.items()):
        header = "Status\tCampaign\tCost" if k % 2 else "Campaign\tCost\tExtra"
        rows = f"on\tCafé Ċ {name}\t{k}\n" if k % 2 else f"Café Ċ {name}\t{k}\tx\n"  # letters that hold the byte of a line break
        os.makedirs(f"{tmpdir_fresh}/in", exist_ok=True)
        with open(f"{tmpdir_fresh}/in/{name}.csv", "wb") as f:
            f.write(mark + REPORT.format(header=header, rows=rows).replace("\n", end).encode(code))
    write(f"{tmpdir_fresh}/in/short.csv", "Campaign report\n")
    df = files.read_utf16_tsv(spark, [f"{tmpdir_fresh}/in/*.csv", f"{tmpdir_fresh}/none.csv"])
    assert set(df.columns) == {"Status", "Campaign", "Cost", "Extra", "source_file"} and df.columns[-1] == "source_file"
    got = {(r.Campaign, r.Cost, r.Status, r.Extra) for r in df.where("coalesce(Campaign, '') not like 'Total%' and Cost is not null").collect()}
    assert got == {("Café Ċ le", "0", None, "x"), ("Café Ċ be", "1", "on", None), ("Café Ċ utf8", "2", None, "x"),
                   ("Café Ċ plain", "3", "on", None)}


def test_a_very_long_header_is_whole(spark, tmpdir_fresh):
    names = [f"column number {k} of a wide export" for k in range(3000)]  # 100 KB
    write(f"{tmpdir_fresh}/wide.csv", "Campaign report\nx\n" + "\t".join(names) + "\n" + "\t".join(map(str, range(3000))) + "\n", "utf-16")
    df = files.read_utf16_tsv(spark, f"{tmpdir_fresh}/wide.csv")
    assert df.columns == [*names, "source_file"]
    assert df.select(f"`{names[-1]}`").collect()[0][0] == "2999"


def test_csv_sinks_have_a_header(spark, tmpdir_fresh):
    df = spark.createDataFrame([("2026-01", "a,b", 1.5), ("2026-01", None, None), ("2026-02", "", 2.0)], "month_start string, n string, v double")
    files.write_csv(df.repartition(2), f"{tmpdir_fresh}/flat")
    lines = [r.value for r in spark.read.text(f"{tmpdir_fresh}/flat").collect()]
    assert sorted(set(lines)) == ['2026-01,"a,b",1.5', "2026-01,,", '2026-02,"",2.0', "month_start,n,v"]
    assert lines.count("month_start,n,v") == len([f for f in os.listdir(f"{tmpdir_fresh}/flat") if f.endswith(".csv")])
    files.write_partitioned(df, f"{tmpdir_fresh}/months", fmt="csv")
    files.write_partitioned(df.where("month_start = '2026-02'").withColumn("v", df["v"] * 2), f"{tmpdir_fresh}/months", fmt="csv")
    back = files.read_csv_strings(spark, f"{tmpdir_fresh}/months/*/*.csv", ["n", "v"])
    assert sorted((r.v or "") for r in back.collect()) == ["", "1.5", "4.0"]
