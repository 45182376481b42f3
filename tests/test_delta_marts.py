"""Marts kept by deltas equal a full rebuild, and untouched months aren't written."""

import os
import random

from adlens.operators import marts
from adlens.operators.fact import EXPORT_SOURCES, conversion_fact, stage_export
from adlens.operators.mapping import BrandMap
from adlens.params import Params
from adlens.sources.files import read_group
from adlens.streaming.marts import DeltaMarts, refresh_marts
from tests.test_files_streaming import write

PARAMS = Params(focus_brand="Sara", brand_label="Sara", brand_rules=[("Sara", "google", "%sara%", 1), ("Sara", "meta", "%sara%", 1)],
                generation_tokens=["video"])
GOOGLE, STORE = EXPORT_SOURCES[0], EXPORT_SOURCES[1]


def google(path, seed, rows=30):
    rng = random.Random(seed)
    lines = [f"{rng.choice(['sara a', 'other', 'SARA b'])},{rng.choice(['Search', 'Video', ''])},"
             f"\"{rng.randint(1, 5000):,}.{rng.randint(0, 9999):04d}\",{rng.random() * 900:.4f},{rng.choice(['', '3', '--'])}" for _ in range(rows)]
    write(path, "Campaign,Campaign type,Cost,Revenue,Orders\n" + "".join(x + "\n" for x in lines))


def store(path, seed):
    rng = random.Random(seed)
    write(path, "Order UTM campaign,Order UTM medium,Total sales,Orders\n" + "".join(
        f"{rng.choice(['Sara x', 'no'])},cpc,{rng.random() * 700:.4f},{rng.randint(1, 4)}\n" for _ in range(25)))


def rebuilt(spark, folder):
    bmap = BrandMap.from_rows(spark, PARAMS.brand_rules)
    staged = [stage_export(read_group(spark, f"{folder}/{d}"), s, bmap, "Sara", ["video"]) for d, s in (("google", GOOGLE), ("store", STORE))]
    return conversion_fact(staged, "Sara", "Sara")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def check(spark, kept, folder):
    fact = rebuilt(spark, folder)
    for name, want in (("fact", fact), ("reconciliation", marts.reconciliation(fact, "Sara")), ("exec_summary", marts.exec_summary(fact, "Sara"))):
        assert kept.mart(name).columns == want.columns
        assert rows(kept.mart(name)) == rows(want), name


def stamps(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_deltas_equal_a_full_rebuild(spark, tmpdir_fresh):
    folder = f"{tmpdir_fresh}/in"
    kept = DeltaMarts(spark, f"file://{tmpdir_fresh}/marts", PARAMS)
    for k, name in enumerate(("w1 Dec_25", "w2 Dec_25", "Jan_26")):
        google(f"{folder}/google/{name}.csv", k)
    write(f"{folder}/google/no month.csv", "Campaign,Cost\nsara,5\n")
    store(f"{folder}/store/s Jan_26.csv", 9)
    paths = sorted(f"file://{folder}/google/{f}" for f in os.listdir(f"{folder}/google") if "month" not in f)
    assert kept.deliver([*paths, f"file://{folder}/google/no month.csv"], GOOGLE) == ["2025-12", "2026-01"]
    assert kept.deliver([f"file://{folder}/store/s Jan_26.csv"], STORE) == ["2026-01"]
    os.remove(f"{folder}/google/no month.csv")
    check(spark, kept, folder)

    before = stamps(f"{tmpdir_fresh}/marts")  # a new month, and a corrected week
    google(f"{folder}/google/Feb_26.csv", 7)
    google(f"{folder}/google/w2 Dec_25.csv", 8, rows=11)
    assert kept.deliver([f"file://{folder}/google/{f}.csv" for f in ("Feb_26", "w2 Dec_25")], GOOGLE) == ["2025-12", "2026-02"]
    check(spark, kept, folder)
    after = stamps(f"{tmpdir_fresh}/marts")
    january = {f for f in before if "month_start=2026-01" in f}
    assert len(january) >= 5 and all(after.get(f) == before[f] for f in january)
    weeks = {f for f in before if "/partials/" in f and "w1_Dec" in f}
    assert weeks and all(after.get(f) == before[f] for f in weeks)

    write(f"{folder}/google/Feb_26.csv", "Campaign,Campaign type,Cost,Revenue,Orders\nother,Search,5,5,1\n")  # nothing of the brand is left
    assert kept.deliver([f"file://{folder}/google/Feb_26.csv"], GOOGLE) == ["2026-02"]
    assert kept.mart("fact").where("month_start = '2026-02'").count() == 0
    check(spark, kept, folder)
    same = rows(kept.mart("fact"))
    kept.deliver(paths, GOOGLE)  # twice the same
    assert rows(kept.mart("fact")) == same


def test_the_stream_delivers_new_files_only(spark, tmpdir_fresh):
    folder, name = f"{tmpdir_fresh}/in", os.path.basename(tmpdir_fresh)
    kept = DeltaMarts(spark, f"file://{tmpdir_fresh}/marts", PARAMS)
    os.makedirs(f"{folder}/store")
    google(f"{folder}/google/a Jan_26.csv", 1)
    refresh_marts(spark, f"{folder}/google", kept, GOOGLE, name)
    first = stamps(f"{tmpdir_fresh}/marts")
    google(f"{folder}/google/b Feb_26.csv", 2)
    refresh_marts(spark, f"{folder}/google", kept, GOOGLE, name)
    fact = conversion_fact([stage_export(read_group(spark, f"{folder}/google"), GOOGLE, BrandMap.from_rows(spark, PARAMS.brand_rules),
                                         "Sara", ["video"])], "Sara", "Sara")
    assert rows(kept.mart("fact")) == rows(fact)
    now = stamps(f"{tmpdir_fresh}/marts")
    assert all(now.get(f) == t for f, t in first.items())
