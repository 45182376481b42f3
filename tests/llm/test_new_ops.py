"""Operators 11 to 13 against brute force, on awkward tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adlens.llm import op11_ann as op11
from adlens.llm import op12_divergence as op12
from adlens.llm import op13_resample as op13
from tests.llm.helpers import ALNUM, CLASHES, SF, awkward, frame, low, words

# --- operator 11 --------------------------------------------------------------------------------------------------


def vectors(spark, rows, kind="float"):
    clash = "".join(f", {c} string" for c in ("vec", "q", "top", "shard", "rank", "score", "ids", "label"))
    return spark.createDataFrame([(*r, *["clash"] * 8) for r in rows], f"vec_id long, embedding array<{kind}>{clash}").repartition(3)


def brute(rows, queries, k, kind=np.float32):
    """{(query id, vector): [(vec_id, score)]}: exact answer, ties to the smaller id, rows of equal id and vector once."""
    def good(r):
        return r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])
    use = sorted({(r[0], tuple(kind(x) for x in r[1])) for r in rows if good(r)})
    out = {}
    for i, q in sorted({(r[0], tuple(kind(x) for x in r[1])) for r in queries if good(r)}):
        found = [(-float(np.dot(np.float64(v), np.float64(q))), j) for j, v in use if j != i and len(v) == len(q)]
        out[i, q] = [(j, -s) for s, j in sorted(found)[:k]]
    return out


def test_awkward_vectors_give_the_exact_answer(spark):
    rows = [(0, [1.0, 0.0, 2.0]), (20, [1.0, 0.0, 2.0]), (1, [1.0, 0.0, 2.0]), (1, [1.0, 0.0, 2.0]), (2, None), (3, []),
            (4, [0.0, -0.0, 0.0]), (5, [1.0, None, 2.0]), (6, [float("nan"), 1.0, 1.0]), (7, [float("inf"), 1.0, 1.0]),
            (None, [1.0, 1.0, 1.0]), (8, [3.0, 0.0, 0.0]), (9, [0.0, 1.0, 0.0]), (10, [-0.0, 1.0, 0.0]), (11, [100.0, 1.0, -7.0]),
            (12, [1.0, 2.0]), (40, [0.0, 1.0, 0.0]), (60, None), (80, [5.0, 5.0])]
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    df = vectors(spark, rows)
    got = defaultdict(list)
    for r in op11.nearest(df, df.where("vec_id % 20 = 0"), k=3).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, round(r.score, 9)))
    want = {i: [(n, j, round(s, 9)) for n, (j, s) in enumerate(found, 1)] for (i, _), found in brute(rows, queries, 3).items()}
    assert got == {i: w for i, w in want.items() if w}
    assert [v for _, v, _ in got[0]] == [11, 1, 20]  # 86, then its two copies


def test_ties_and_copies_go_to_the_smaller_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(300)] + [(1000 + i, [0.1 * i, 1.0, 0.0, 0.0]) for i in range(30)]
    df = vectors(spark, rows)
    got = op11.nearest(df, df.where("vec_id in (0, 10, 299)"), k=20).collect()
    for q in (0, 10, 299):
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == \
            [i for i in range(21) if i != q][:20]


def test_recall_of_many_shards_and_both_widths(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(3000, 24)) * rng.uniform(0.5, 2, (3000, 1))  # norms differ
    for kind, cast in (("float", np.float32), ("double", np.float64)):
        rows = [(i, [float(x) for x in cast(p)]) for i, p in enumerate(points)]
        df = vectors(spark, rows, kind)
        got = defaultdict(set)
        for r in op11.nearest(df, df.where("vec_id % 50 = 0"), shard_rows=700).collect():
            got[r.query_id].add((r.vec_id, r.score))
        want = brute(rows, rows[::50], 20, cast)
        shared = sum(len({v for v, _ in got[i]} & {v for v, _ in w}) for (i, _), w in want.items())
        assert shared >= 0.95 * 20 * len(want)
        for (i, q), _ in want.items():
            assert all(abs(s - float(np.dot(cast(points[v]).astype(float), np.float64(q)))) < 1e-12 for v, s in got[i])


def test_no_vectors(spark):
    for rows in ([], [(0, None), (20, [0.0])]):
        df = vectors(spark, rows)
        assert op11.nearest(df, df).collect() == []


def test_pruning_keeps_diverse_edges():
    points = op11.level(np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 3], [5, 0]]))
    kept = op11.prune(points, np.array([0]), np.array([[1, 2, 3, 4, -1, 1]]), 3, 1.0)[0]
    flat = points.astype(float)
    far = lambda a, b: ((flat[a] - flat[b]) ** 2).sum()
    want = []
    for c in sorted((1, 2, 3, 4), key=lambda c: far(0, c)):
        if len(want) < 3 and all(far(k, c) > far(0, c) for k in want):
            want.append(c)
    assert [k for k in kept.tolist() if k >= 0] == want


# --- operator 12 --------------------------------------------------------------------------------------------------

LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def audit(docs, least, listed=50, smoothing=5):
    """{(lang, source, part, item, value, rank)} of [(lang, source, text)]."""
    docs = [(lang or "", source or "", words(text, LETTERS)) for lang, source, text in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        often = Counter(w for _, _, t in mine for w in set(t))
        kept = [w for w, n in often.items() if n >= least]
        count = {s: Counter(w for _, x, t in mine if x == s for w in t if often[w] >= least) for _, s, _ in mine}
        share = lambda c, w: 1 + 10**9 * (c[w] + smoothing) // (sum(c.values()) + smoothing * len(kept))
        whole = sum(count.values(), Counter())
        for s, c in count.items():
            pair = sorted((-sum(abs(share(c, w) - share(o, w)) for w in kept), x.encode(), x) for x, o in count.items() if x != s)
            out |= {(lang, s, "pair", x, -v, n) for n, (v, _, x) in enumerate(pair, 1)}
            term = sorted((share(whole, w) - share(c, w), w.encode(), w) for w in kept if c[w] and share(c, w) > share(whole, w))
            out |= {(lang, s, "term", w, -v, n) for n, (v, _, w) in enumerate(term[:listed], 1)}
    return out


def sourced(spark, docs):
    schema = "doc_id long, text string, lang string, source string" + "".join(f", {c} string" for c in [*CLASHES, "term", "p", "digest", "part"])
    return spark.createDataFrame([(1, t, lang, s, *["clash"] * (len(CLASHES) + 4)) for lang, s, t in docs], schema).repartition(3)


def mixed():
    rng = np.random.default_rng(3)
    names = ["the", "Of", "été", "ÉTÉ", "x", "longer", "Zebra", "naïve", "日本", "and", "is", "won't", "a1b"]
    docs = [(["en", "de", None][k % 3], ["a", "b", "é", None, ""][k % 5],
             " ".join(rng.choice(names, rng.integers(1, 12)))) for k in range(120)]
    return docs + [("fr", "lone", "rare"), ("fr", "none", None), ("fr", "odd", "12 34 !"), ("en", "big", "the " * 20_000 + "tail"),
                   ("en", "a", "the"), ("en", "a", "the"), ("", "", "the of"), ("e\0n", "s\0", "zero zero"), ("en", "w", "y" * 70_000)]


@pytest.mark.parametrize("bits,slices,tile", [(64, 1024, 128), (3, 2, 2), (2, 1, 1)])
def test_audit_equals_brute_force_also_with_collisions(spark, bits, slices, tile):
    docs = mixed()
    got = op12.divergence(sourced(spark, docs), least=4, listed=3, bits=bits, slice_terms=slices, tile=tile).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == audit(docs, 4, 3)


def test_audit_without_documents_or_terms(spark):
    assert op12.divergence(sourced(spark, [])).collect() == []
    docs = [("en", "a", None), ("en", "b", "word"), ("de", "c", "")]
    assert {tuple(r) for r in op12.divergence(sourced(spark, docs)).collect()} == \
        {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)} == audit(docs, 30)


def test_counters_send_all_they_got(monkeypatch):
    monkeypatch.setattr(op12, "HELD", 8)
    rng = np.random.default_rng(0)
    held, sent, want = op12.Counter(1), Counter(), Counter()
    for _ in range(50):
        keys = rng.integers(0, 30, 5).astype(np.uint64)
        want.update(keys.tolist())
        if held.add(*op12._summed([keys], np.ones(5, np.int64))):
            (k,), n = held.take()
            sent.update(dict(zip(k.tolist(), n.tolist(), strict=True)))
    (k,), n = held.take()
    sent.update(dict(zip(k.tolist(), n.tolist(), strict=True)))
    assert sent == want


# --- operator 13 --------------------------------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=400), st.data())
def test_position_table_crc(data, draw):
    spans = draw.draw(st.lists(st.tuples(st.integers(0, len(data) - 1), st.integers(1, len(data))), min_size=1, max_size=8))
    spans = [(a, min(n, len(data) - a)) for a, n in spans]
    span = draw.draw(st.sampled_from([1, 3, 16, 64]))
    starts, lengths = (np.array(x) for x in zip(*spans, strict=True))
    got = op13.crc32_spans(np.frombuffer(data, np.uint8), starts, lengths, span)
    assert got.tolist() == [zlib.crc32(data[a:a + n]) for a, n in spans]


def runs_of(text, runs):
    w = words(text, ALNUM)
    return [" ".join(w[k:k + n]) for n in range(1, runs + 1) for k in range(len(w) - n + 1)]


def drawn(docs, target, runs=1, buckets=10_000, least=20, percent=10):
    """[(doc_id, features, weight, score, rank)] of [(id, text)]."""
    cell = lambda x: zlib.crc32(x.encode()) % buckets
    raw = Counter(cell(x) for _, t in docs for x in runs_of(t, runs))
    want = Counter(cell(x) for t in target for x in runs_of(t, runs))
    s_all, t_all = float(sum(raw.values())), float(sum(want.values()))
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1.0) * (s_all + buckets) / ((raw[b] + 1.0) * (t_all + buckets))))
    rows = []
    for i, t in docs:
        own = [gain(cell(x)) for x in runs_of(t, runs)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(t, ALNUM))])
    can = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for n, r in enumerate(can[:percent * len(can) // 100], 1):
        r[4] = n
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("runs,buckets,least,percent,block", [(1, 10_000, 20, 10, 50_000), (2, 97, 3, 50, 50_000), (1, 50, 0, 77, 2)])
def test_drawing_equals_brute_force(spark, runs, buckets, least, percent, block):
    rng = np.random.default_rng(2)
    names = ["alpha", "beta", "Gamma", "délta", "e5", "日本語", "x" * 130]
    docs = awkward() + [(None, "null id " * 30)] + \
        [(100 + k, " ".join(rng.choice(names, int(rng.integers(1, 60))))) for k in range(150)]
    target = ["alpha beta, ALPHA!", None, "", "gamma délta x1 " + "x" * 130]
    out = op13.draw(op13.weigh(frame(spark, docs), spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string"),
                               runs, buckets), least, percent, block)
    got = sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)
    assert got == drawn(docs, target, runs, buckets, least, percent)


def test_drawn_rows_keep_their_columns(spark):
    docs = [(k % 40, "one two three four five " * 6 + str(k % 40)) for k in range(80)]  # each row twice
    target = spark.createDataFrame([("one two",)], "text string")
    out = op13.resample(frame(spark, docs), target, percent=50)
    assert out.columns == [*frame(spark, docs).columns, "rank"]
    rows = out.collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 41))
    assert {(r.doc_id, r.text) for r in rows} <= set(docs)


def test_nothing_to_draw(spark):
    target = spark.createDataFrame([], "text string")
    assert op13.resample(frame(spark, []), target).count() == 0
    ranked = op13.draw(op13.weigh(frame(spark, [(1, None), (2, "a b")]), target)).collect()
    assert {(r.doc_id, r["rank"]) for r in ranked} == {(1, None), (2, None)}


def test_features_of_one_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(["A b  c", None, "Éa-é", ""])], ["text"])
    bucket, row, n = op13.features(batch, 2, 1 << 32)
    want = [(0, "a"), (0, "b"), (0, "c"), (2, "Éa"), (2, "é"), (0, "a b"), (0, "b c"), (2, "Éa é")]
    assert sorted(zip(row.tolist(), bucket.tolist(), strict=True)) == sorted((r, zlib.crc32(x.encode())) for r, x in want)
    assert n.tolist() == [3, 0, 2, 0] and low("É") == "É"


def test_registered():
    from adlens.llm.catalog import ORACLE, QUERIES
    assert {"op11_ann_graph", "op12_source_divergence", "op13_importance_resampling"} <= set(QUERIES)
    assert {"op12_source_divergence", "op13_importance_resampling"} <= set(ORACLE) and SF
