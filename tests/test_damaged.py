"""Damaged export rows are set aside; all others load."""

import os

from adlens.sources import damaged


def put(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def base(path):
    return os.path.basename(path)


def test_one_damaged_file_among_ten(spark, tmpdir_fresh):
    for k in range(9):
        put(f"{tmpdir_fresh}/in/f{k}_Jan_26.csv", f'name,cost,note\na{k},{k},\n"b,{k}",,"x ""y"""\n'.encode())
    put(f"{tmpdir_fresh}/in/bad_Jan_26.csv", b"cost,name,note\n1,whole,ok\n2,short\n3,long,x,y\n4,caf\xe9,z\n5,,\n")
    rows, gone = damaged.read_checked(spark, f"{tmpdir_fresh}/in", ["name", "cost"])
    got = [(base(r.source_file), r.name, r.cost) for r in rows.collect()]
    want = [(f"f{k}_Jan_26.csv", n, c) for k in range(9) for n, c in ((f"a{k}", str(k)), (f"b,{k}", None))]
    # the odd byte makes the whole file Latin-1 when it is in the head that is looked at
    bad = [("bad_Jan_26.csv", n, c) for n, c in (("whole", "1"), ("café", "4"), (None, "5"))]
    assert sorted(got, key=str) == sorted(want + bad, key=str)
    assert sorted((base(r.source_file), r.reason, r.record) for r in gone.collect()) == [
        ("bad_Jan_26.csv", "fields", "2,short"), ("bad_Jan_26.csv", "fields", "3,long,x,y")]
    issues = damaged.damage_issues(gone)
    assert issues.schema.simpleString() == spark.createDataFrame([], damaged.ISSUES).schema.simpleString()
    assert [(r.issue_type, base(r.source_group), r.details) for r in issues.collect()] == [
        ("damaged_rows_fields", "bad_Jan_26.csv", "2 rows set aside.")]
    assert gone.count() == 2 and rows.count() == 21  # no column is read, and the fields are counted all the same
    damaged.store_damaged(gone, f"{tmpdir_fresh}/aside")
    assert spark.read.parquet(f"{tmpdir_fresh}/aside").count() == 2


def test_bytes_that_the_encoding_does_not_know(spark, tmpdir_fresh):
    body = b"".join(b"r%d,%d\n" % (k, k) for k in range(200))  # beyond the head, which is sound UTF-8
    put(f"{tmpdir_fresh}/in/a.csv", "name,cost\ncafé,1\n".encode() + body + b"b\xff\xfeb,7\nend,8\n")
    rows, gone = damaged.read_checked(spark, f"{tmpdir_fresh}/in/a.csv")
    assert rows.columns == ["name", "cost", "source_file"] and rows.count() == 202
    assert [(r.reason, damaged.UNKNOWN in r.record, r.record.endswith(",7")) for r in gone.collect()] == [("bytes", True, True)]


def test_headers_without_a_wanted_column_and_nothing_to_read(spark, tmpdir_fresh):
    put(f"{tmpdir_fresh}/in/html.csv", b"<html>\n<p>Sign in\n")
    put(f"{tmpdir_fresh}/in/good.csv", b"name\nx\n")
    put(f"{tmpdir_fresh}/in/empty.csv", b"")
    rows, gone = damaged.read_checked(spark, [f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/none"], ["name", "cost"])
    assert [(r.name, r.cost) for r in rows.collect()] == [("x", None)]
    assert [(base(r.source_file), r.reason, r.record) for r in gone.collect()] == [("html.csv", "header", "<p>Sign in")]
    rows, gone = damaged.read_checked(spark, f"{tmpdir_fresh}/none", ["name"])
    assert rows.columns == ["name", "source_file"] and rows.count() == gone.count() == 0
