"""The kept tables: same rows as the direct queries, plans without the large exchange, one month read."""

import os
import re
import shutil

import pytest

from adlens.operators import marts
from adlens.plans.driver import Driver
from adlens.sources.store import Store

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture()
def store(spark, tmpdir_fresh):
    return Store(Driver(spark, SF), f"file://{tmpdir_fresh}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_bucketed_inputs_join_without_an_exchange(spark, store, no_broadcast):
    lines, orders = store.focus_lines(), store.orders()
    plan = plan_of(lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "left"))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    whole = plan_of(store.build_fact())
    below = whole[whole.index("SortMergeJoin"):]
    assert "Exchange" not in below and whole.count("SortMergeJoin") == 1
    assert len(re.findall(r"SelectedBucketsCount: (\d+) out of \1", below)) == 2


def test_stored_fact_equals_the_direct_one(spark, store):
    assert rows(store.fact()) == rows(Driver(spark, SF).fact())
    assert rows(store.build_fact()) == rows(Driver(spark, SF).fact())


def test_one_scan_and_one_month(spark, store):
    store.fact()
    plan = plan_of(marts.reconciliation(store.fact(), "x"))
    assert plan.count("FileScan") == 1 and "Join" not in plan
    month = sorted({r.month_start for r in store.fact().select("month_start").collect()})[5]
    one = store.fact([month])
    assert re.search(rf"PartitionFilters: \[[^\]]*month_start#\d+ (= {month}|IN \({month}\))", plan_of(one))
    assert rows(one) == [r for r in rows(store.fact()) if r[0] == month] != []
    wanted = spark.createDataFrame([(month, 1), ("1900-01", 0)], "month_start string, use int").where("use = 1")
    some = store.fact(wanted)
    assert "dynamicpruning" in plan_of(some) and rows(some) == rows(one)


def test_a_changed_source_gets_its_own_tables(spark, tmpdir_fresh):
    folder = f"{tmpdir_fresh}/sf"
    os.makedirs(folder)
    for t in ("part", "lineitem", "orders"):
        shutil.copy(f"{SF}/{t}.parquet", folder)
    first = Store(Driver(spark, folder), f"file://{tmpdir_fresh}/kept")
    before = rows(first.fact())
    again = Store(Driver(spark, folder), f"file://{tmpdir_fresh}/kept")
    assert again.state == first.state and rows(again.fact()) == before
    shutil.copy("/root/testdata/sf0.01/lineitem.parquet", f"{folder}/lineitem.parquet")
    changed = Store(Driver(spark, folder), f"file://{tmpdir_fresh}/kept")
    assert changed.state != first.state and rows(changed.fact()) == rows(Driver(spark, folder).fact()) != before


def test_another_application_finds_the_tables(spark, store, no_broadcast):
    want = rows(store.build_fact())
    for t in ("focus_lines", "orders"):  # a catalogue that doesn't know them, files that are there
        spark.sql(f"DROP TABLE adlens_{store.state}_{t}")
    stamp = {f: os.stat(f).st_mtime_ns for d, _, fs in os.walk(store.root[7:]) for f in (os.path.join(d, x) for x in fs)}
    found = Store(store.d, store.root[:store.root.index("/store/")])
    assert rows(found.build_fact()) == want
    below = plan_of(found.build_fact())
    assert "Exchange" not in below[below.index("SortMergeJoin"):]
    assert all(os.stat(f).st_mtime_ns == t for f, t in stamp.items())


def test_a_build_that_was_cut_off_is_done_again(spark, store):
    want = rows(store.fact())
    shutil.rmtree(f"{store.root[7:]}/_complete/fact")
    shutil.rmtree(f"{store.root[7:]}/fact")
    assert rows(store.fact()) == want


def test_buckets_follow_the_size_of_the_sources(spark, tmpdir_fresh, monkeypatch):
    monkeypatch.setattr("adlens.sources.store.BUCKET_BYTES", 10_000)
    many = Store(Driver(spark, SF), f"file://{tmpdir_fresh}")
    assert many.buckets > 8 and many.buckets & (many.buckets - 1) == 0
    assert rows(many.build_fact()) == rows(Driver(spark, SF).fact())
