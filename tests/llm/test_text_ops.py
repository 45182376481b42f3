"""Kernels, packing, line dedup, decontamination, Jaccard join and quality rules against plain Python."""

import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from helpers import SF, SPACE, awkward, contaminated, frame, jaccard, line_words, low, quality, removed_lines, words

from adlens.llm import catalog, common, kernel
from adlens.llm import op01_pack as op1
from adlens.llm import op03_lines as op3
from adlens.llm import op04_decontaminate as op4
from adlens.llm import op06_jaccard as op6
from adlens.llm import op10_quality as op10


def documents(spark, table="documents", columns=("doc_id", "text")):
    return [tuple(r) for r in common.read(spark, SF, table).select(*columns).collect()]


def test_words_and_hashes_are_those_of_the_pattern():
    texts = [t for _, t in awkward()] + ["a b c\x1fd", "　x y"]
    data, offsets = kernel.utf8(pa.array(texts))
    for table, pattern in ((kernel.NOT_SPACE, SPACE), (kernel.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        starts, ends, first = kernel.words(data, offsets, table)
        hashes = kernel.hash_words(data, starts, ends)
        seen = {}
        for k, text in enumerate(texts):
            own = [kernel.LOWER[data[a:b]].tobytes().decode() for a, b in zip(
                starts[first[k]:first[k + 1]], ends[first[k]:first[k + 1]], strict=True)]
            assert own == re.findall(pattern, low(text))
            for w, h in zip(own, hashes[first[k]:first[k + 1]].tolist(), strict=True):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_task_vectors_add_up(spark):
    def task(batches):
        for _ in batches:
            pass
        v = np.arange(10_000, dtype=float)
        yield common.vector_batch([*common.vector_rows("a", v), *common.vector_rows("b", v / 3), *common.vector_rows("c", -v)])
    got = common.sum_vectors(common.arrow(spark.range(0, 4, 1, 4), task, common.VECTOR_SCHEMA),
                             {"a": 10_000, "b": 10_000, "c": 10_000, "d": 5})
    assert np.array_equal(got["a"], 4 * np.arange(10_000)) and np.allclose(got["b"], 4 * np.arange(10_000) / 3)
    assert np.array_equal(got["c"], -4 * np.arange(10_000)) and not got["d"].any()


def test_summed_counts_are_sent_in_few_bytes():
    """The driver got eight bytes a count, several times in its memory."""
    rows = list(common.vector_rows("a", np.arange(2 * common.SLICE) % 100))
    sent, = common._add_slices(iter([common.vector_batch(rows), common.vector_batch(rows)]))
    assert sum(map(len, sent.column(2).to_pylist())) == 2 * (common.SLICE + 2)
    assert [common._numbers(x)[:3].tolist() for x in sent.column(2).to_pylist()] == [[0, 2, 4], [192, 194, 196]]


def test_a_probe_copies_no_bitmap_for_a_row(spark):
    """A binary of 4 KB was read, and a byte of it written as hex, for each row."""
    rows = spark.range(100).selectExpr("id", "if(id % 10 = 3, null, id * 1001) as h")
    keys = spark.createDataFrame([(k * 1001,) for k in range(0, 100, 2)] + [(None,), (-1,)], "k long")
    found = common.marked(rows, "h", keys, "k")
    assert sorted(r.id for r in found.collect()) == [k for k in range(0, 100, 2) if k % 10 != 3] and found.schema == rows.schema
    assert common.unmarked(rows, "h", keys, "k").count() == 50
    assert "hex(" not in found._jdf.queryExecution().toString()


def test_marked_is_a_superset_and_unmarked_its_rest(spark):
    rows = spark.range(5000).selectExpr("id", "xxhash64(id) as h")
    keys = spark.range(0, 5000, 7).selectExpr("xxhash64(id) as k")
    on = {r.id for r in common.marked(rows, "h", keys, "k").collect()}
    off = {r.id for r in common.unmarked(rows, "h", keys, "k").collect()}
    assert set(range(0, 5000, 7)) <= on and not on & off and len(on | off) == 5000 and len(on) < 1000


# packing

def best_cost(place, cost, capacity):
    best = [0.0] + [float("inf")] * (len(place) - 1)
    for i in range(1, len(place)):
        for j in range(i):
            n = int(place[i] - place[j])
            if n <= capacity:
                pad = 0 if n & (n - 1) == 0 else capacity - n
                best[i] = min(best[i], best[j] + pad + cost[i])
    return best[-1]


def test_plan_is_optimal():
    rng = random.Random(3)
    for _ in range(60):
        place = np.cumsum([0] + [rng.randint(1, 30) for _ in range(rng.randint(1, 40))])
        cost = np.array([0.0] + [rng.choice([0, 4, 24]) for _ in place[1:]])
        cuts = op1.plan(place, cost, 64, True)
        steps = np.diff(cuts)
        at = np.searchsorted(place, cuts)
        paid = sum(cost[at[1:]]) + sum(0 if n & (n - 1) == 0 else 64 - n for n in steps.tolist())
        assert cuts[0] == 0 and cuts[-1] == place[-1] and steps.max() <= 64
        assert paid == best_cost(place, cost, 64)


def check_packing(pieces, docs, capacity=2048):
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    want = [(i, np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for i, t in docs]
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in by_seq.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    assert set(by_doc) == {i for i, _ in docs}
    for i, ids in {i: x for i, x in want}.items():
        copies = sum(k == i for k, _ in want)
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert sum(p.length for p in own) == copies * len(ids) and {p.doc_tokens for p in own} == {len(ids)}
        for p in own:
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
    return by_seq


def test_packing_of_awkward_texts(spark):
    check_packing(op1.digest(op1.pack(frame(spark, awkward()))).collect(), awkward())
    assert op1.pack(frame(spark, [])).count() == 0


def test_packing_pads_little(spark):
    by_seq = check_packing(catalog.QUERIES["op1_packing"](spark, SF).collect(), documents(spark))
    sizes = [sum(n for _, n in own) for own in by_seq.values()]
    pad = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert pad < 0.02 * sum(sizes)


def test_a_packing_task_keeps_nothing(monkeypatch):
    """Task after task in one worker: no object of an earlier one stays."""
    import gc
    from types import SimpleNamespace
    import public_tokenizers
    monkeypatch.setattr(op1, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    path = public_tokenizers.path
    task = op1._pack(str(path("byte_bpe_50k.json")), str(path("byte_bpe_50k.tiktoken")), 64, 1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(["One more short text. And its end."] * 500)], ["doc_id", "text"])
    left = []
    for _ in range(3):
        assert sum(b.num_rows for b in task(iter([batch]))) >= 500
        gc.collect()
        left.append(len(gc.get_objects()))
    assert left[2] - left[1] < 100


# lines

def sims_of(lines):
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(x) for x in lines])], ["text"])
    row, _, first, n, hashes = op3._lines(batch)
    assert len(row) == len(lines)
    at, head = op3._words_of(first, n)
    return dict(zip(lines, op3.simhash(hashes[at], head, n).tolist(), strict=True))


def test_simhash_is_the_majority_of_the_bits():
    lines = [tuple(f"w{k * k % 91}" for k in range(n)) for n in (5, 6, 40, 255, 256, 700)]
    got = sims_of(lines)
    for line in lines:
        data, offsets = kernel.utf8(pa.array([" ".join(line)]))
        starts, ends, _ = kernel.words(data, offsets, kernel.ALNUM)
        own = kernel.mix(kernel.hash_words(data, starts, ends) + np.uint64(0x632BE59BD9B4E019)).tolist()
        assert got[line] == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > len(own))


def near_lines():
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(n)) for n in (60, 120, 300, 8)]
    docs = []
    for k in range(30):
        lines = []
        for x in base:
            w = x.split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = f"z{rng.randint(0, 9)}"
            lines.append(" ".join(w))
        lines.append("short line")
        rng.shuffle(lines)
        docs.append((k, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("which", ["awkward", "near", "driver"])
def test_line_dedup_is_that_of_all_pairs(spark, which):
    docs = {"awkward": awkward, "near": near_lines, "driver": lambda: documents(spark)}[which]()
    docs = sorted(docs, key=lambda d: d[0])
    gone = removed_lines(docs)
    want = sorted((i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[row]), gone[row])
                  for row, (i, t) in enumerate(docs))
    got = op3.dedup_lines(frame(spark, docs))
    assert set(frame(spark, []).columns) < set(got.columns)
    assert sorted((r.doc_id, r.text, r.removed_lines) for r in got.collect()) == want


def test_a_failed_pair_does_not_hide_other_links(spark, monkeypatch):
    """Blocks of a few lines and one pair of each a round: the rest of a cluster must be compared."""
    from adlens.llm import groups
    monkeypatch.setattr(groups, "KEEP", 1)
    monkeypatch.setattr(groups, "BLOCK", 4)
    docs = near_lines()
    gone = removed_lines(docs)
    got = {r.doc_id: r.removed_lines for r in op3.dedup_lines(frame(spark, docs)).collect()}
    assert got == {docs[i][0]: x for i, x in gone.items()}


def test_near_lines_are_found_by_edit_similarity_alone(spark):
    """No SimHash in the expected result: every pair of lines with few enough edits is linked, from 9 words on."""
    rng = random.Random(11)
    docs = []
    for n in (9, 10, 11, 19, 20, 30, 50, 100):
        for _ in range(6):
            line = [f"w{rng.randint(0, 5000)}" for _ in range(n)]
            docs.append((len(docs), " ".join(line)))
            for edits in {1, n // 10, n // 10 + 1}:
                w = list(line)
                for _ in range(edits):
                    at, kind = rng.randrange(len(w)), rng.choice("sid")
                    w[at:at + (kind != "i")] = [] if kind == "d" else [f"z{rng.randint(0, 99)}"]
                docs.append((len(docs), " ".join(w)))
    gone = removed_lines(docs)
    got = {r.doc_id: r.removed_lines for r in op3.dedup_lines(frame(spark, docs)).collect()}
    assert sum(map(len, gone.values())) > 60 and got == {docs[k][0]: x for k, x in gone.items()}


def keys_of(lines):
    """Keys of each line of words."""
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(x) for x in lines])], ["text"])
    _, _, first, n, hashes = op3._lines(batch)
    at, head = op3._words_of(first, n)
    own = [set() for _ in lines]
    for key, line in zip(*(c.tolist() for c in op3.line_keys(hashes[at], head, n)), strict=True):
        own[line].add(key)
    return own


@pytest.mark.parametrize("vocabulary", [60, 5000])
@pytest.mark.parametrize("least, most", [(9, 12), (13, 19), (20, 29), (30, 39), (40, 59), (60, 99), (100, 199), (200, 600)])
def test_near_lines_share_a_block(least, most, vocabulary):
    """Recall of the candidate step by band of word counts: pairs with as many edits as edit similarity allows."""
    rng = random.Random(least)
    pairs = []
    while len(pairs) < 400:
        line = [f"w{int(vocabulary * rng.random() ** 3)}" for _ in range(rng.randint(least, most))]
        other = list(line)
        for _ in range(max(1, len(line) // 10)):  # 9 words are near to 10
            at, kind = rng.randrange(len(other)), rng.choice("sid" if len(line) > 9 else "i")
            other[at:at + (kind != "i")] = [] if kind == "d" else [f"w{int(vocabulary * rng.random() ** 3)}"]
        if line != other:
            pairs.append((line, other))
    keys = keys_of([x for pair in pairs for x in pair])
    found = sum(bool(keys[k] & keys[k + 1]) for k in range(0, len(keys), 2))
    assert found == len(pairs)  # no cap: the keys grow with the edits that a line allows
    assert all(len(own) <= op3.SEGMENT * int(op3._most_edits(np.array(len(x)))) + 1
               for own, x in zip(keys, [x for pair in pairs for x in pair], strict=True))


def test_two_words_in_common_make_no_group():
    """Pairs of words recur by chance in any large table; groups that they make grow with the square of its rows."""
    lines = []
    for k in range(60):
        for side in "ab":
            words = [f"{side}{k}x{j}" for j in range(38)]
            lines.append([*words[:k % 38], f"c{k}", f"d{k}", *words[k % 38:]])
    keys = keys_of(lines)
    assert not any(keys[k] & keys[k + 1] for k in range(0, len(keys), 2))


def test_the_sketch_rejects_copies_that_are_too_far_apart():
    """40 words allow 4 edits; of pairs with 6 changed words hardly one is left to the edit distance."""
    words = kernel.mix(np.arange(1, 1 + 400 * 46, dtype=np.uint64).reshape(400, 46))
    left, right = words[:, :40].copy(), words[:, :40].copy()
    right[:, 3:39:6] = words[:, 40:]
    head = np.arange(0, 400 * 40, 40)
    apart = sum(np.bitwise_count(a ^ b).astype(int) for a, b in zip(
        *(np.atleast_2d(op3.parity(x.ravel(), head)) for x in (left, right)), strict=True))
    n = np.full(400, 40)
    assert op3._near(n, n, apart).mean() < 0.1
    near = left.copy()
    near[:, 3:27:6] = words[:, 40:44]
    apart = sum(np.bitwise_count(a ^ b).astype(int) for a, b in zip(
        *(np.atleast_2d(op3.parity(x.ravel(), head)) for x in (left, near)), strict=True))
    assert op3._near(n, n, apart).all()


def test_lines_at_the_very_bound_are_found_at_any_length(spark):
    """Changed words at equal distances leave the fewest segments, and all but one word occur everywhere."""
    docs = []
    for n in (9, 10, 60, 100, 250, 700):
        line = [f"c{k % 7}" if k % 3 else f"w{n}x{k}" for k in range(n)]
        other = [f"z{n}x{k}" if k % 10 == 5 and k // 10 < n // 10 else w for k, w in enumerate(line)]
        docs += [(2 * n, " ".join(line)), (2 * n + 1, " ".join(other) + (" more" if n == 9 else ""))]
    got = {r.doc_id: r.removed_lines for r in op3.dedup_lines(frame(spark, docs)).collect()}
    assert got == {i: [0] if i % 2 else [] for i, _ in docs}


def test_a_segment_block_is_its_simhash():
    words = kernel.mix(np.arange(1, 42, dtype=np.uint64))
    head = np.arange(0, 40, 2)
    want = op3.simhash(words, np.append(head, 40), np.array([2] * 20 + [1]))[:20]
    assert (op3.simhash(words, head, np.full(20, 2)) == want).all()


def test_a_line_has_few_keys_and_few_by_chance():
    """Of common words only, any three in a row recur in a large table; keys must neither be many nor shared by chance."""
    rng = random.Random(3)
    lines = [[f"w{int(40 * rng.random() ** 2)}" for _ in range(100)] for _ in range(300)]
    keys = keys_of(lines)
    assert sum(map(len, keys)) < 30 * len(lines)  # a third of the words before
    assert sum(len(x) for x in keys) - len(set().union(*keys)) < 0.15 * sum(map(len, keys))


def test_as_many_keys_as_edits_cannot_all_change():
    rng = np.random.default_rng(2)
    for _ in range(200):
        start = np.sort(rng.choice(60, rng.integers(1, 40), replace=False))
        line = (start >= 30).astype(np.int64)
        start = start + op3.SEGMENT * line
        want = [0, 0]
        for k in (0, 1):
            own = start[line == k].tolist()
            while own:  # the plain greedy cover
                want[k] += 1
                own = [x for x in own if x >= own[0] + op3.SEGMENT]
        assert op3._edits_to_hit(start, line, 2).tolist() == want


def test_the_sketch_counts_inserted_words_once():
    n, m = np.array([40, 40]), np.array([36, 40])
    assert op3._near(n, m, np.array([6, 8])).tolist() == [False, True]  # four words fewer leave no other edit


def test_a_pair_is_compared_under_one_key_only(spark):
    """Near copies that share many keys made a pair in each of their groups."""
    from adlens.llm import groups
    grouped = spark.createDataFrame([(key, 0, k) for key in range(12) for k in range(1, 30)], groups.GROUPED)
    nodes = spark.createDataFrame([(k, 10, [k]) for k in range(30)], "set long, n int, sketch array<long>")
    roots = spark.createDataFrame([(k, k) for k in range(30)], "node long, root long")
    near = lambda n, m, apart: apart >= 0
    got = [(r.a, r.b) for r in groups.cross_pairs(groups._members(grouped, True), nodes, roots, near, 1, 1000).collect()]
    assert sorted(got) == [(a, b) for a in range(1, 30) for b in range(a + 1, 30)]


def test_keys_are_shuffled_as_few_rows(spark):
    """A task sent a row for each of its keys."""
    from adlens.llm import groups
    rng = np.random.default_rng(3)
    key = rng.integers(-1 << 46, 1 << 46, 60_000) << groups.PART_BITS
    key, own = np.concatenate([key, key[:9000], key[:3000], key[:70]]), rng.integers(-99, 1 << 60, 72_070)
    batch = pa.RecordBatch.from_arrays([pa.array(key), pa.array(own)], ["key", "set"])
    packed = pa.Table.from_batches(groups.packing(iter)(iter([batch, batch.slice(0, 0), batch.slice(5, 2)])))
    assert packed.num_rows <= 1 << groups.BUCKET_BITS
    got = groups.pivots(spark.createDataFrame(packed.to_pandas(), groups.PACKED)).collect()
    sets = {}
    for k, x in zip(key.tolist(), own.tolist(), strict=True):
        sets.setdefault(k, set()).add(x)
    assert sorted(map(tuple, got)) == sorted((k, min(v), x) for k, v in sets.items() for x in v - {min(v)})


def test_members_of_settled_and_of_equal_groups_go(spark, monkeypatch):
    """A near copy's row held all its keys in each of its groups: the square of its length."""
    from adlens.llm import groups
    one = [(key, 0, k) for key in range(50) for k in range(1, 6)]  # all linked
    two = [(key, 10, k) for key in range(100, 150) for k in range(11, 16)]  # not linked, 50 times the same
    three = [(200, 10, 11), (200, 10, 16), (200, 10, 17)]
    grouped = spark.createDataFrame(one + two + three, groups.GROUPED)
    nodes = spark.createDataFrame([(k, 10, [k]) for k in range(20)], "set long, n int, sketch array<long>")
    links = spark.createDataFrame([(0, k) for k in range(1, 6)], "a long, b long")
    tested = grouped.selectExpr("pivot as a", "set as b").distinct()
    held, asked, keyed = [], [], groups.keyed
    monkeypatch.setattr(groups, "keyed", lambda sets, members: held.extend(members.collect()) or keyed(sets, members))

    def verify(pairs):
        asked.extend((r.a, r.b) for r in pairs.collect())
        return pairs.where("a = 12 and b = 13")

    _, roots = groups.settled(grouped, nodes, links, tested, lambda n, m, apart: apart >= 0, 1, verify, compared=True)
    assert len(held) == 6 + 4 and {r.key for r in held} == {100, 200}
    within = lambda own: {(a, b) for a in own for b in own if a < b}
    assert set(asked) | {(12, 13)} == within(range(11, 16)) | within([11, 16, 17]) and len(asked) == len(set(asked))
    assert {(r.node, r.root) for r in roots.collect()} == {(k, 0) for k in range(6)} | {(12, 12), (13, 12)}


def test_new_links_join_what_is_there(spark):
    from adlens.llm.components import components, extended
    links = lambda rows: spark.createDataFrame(rows, "a long, b long")
    old, new = [(1, 2), (2, 3), (7, 9), (11, 12), (20, 21)], [(3, 9), (12, 30), (30, 31), (40, 41), (2, 1)]
    got = extended(components(links(old)), links(new))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, components(links(old + new)).collect()))


def test_salted_keys_lose_no_near_line(spark, monkeypatch):
    monkeypatch.setattr(op3, "SALT_ROWS", 3)
    docs = near_lines()[:12]
    gone = removed_lines(docs)
    got = {r.doc_id: r.removed_lines for r in op3.dedup_lines(frame(spark, docs)).collect()}
    assert got == {docs[k][0]: x for k, x in gone.items()}


def test_exact_repeats_of_any_length_go(spark):
    docs = [(1, "Home\n\n***\n中文没有空格的一行"), (2, "home!\nShare this\n\n***\n中文没有空格的一行"), (3, "share THIS\nAccept all cookies?"),
            (4, "Accept all cookies")]
    got = {r.doc_id: (r.text, r.removed_lines) for r in op3.dedup_lines(frame(spark, docs)).collect()}
    assert got == {1: (docs[0][1], []), 2: ("Share this\n\n***", [0, 4]), 3: ("Accept all cookies?", [0]), 4: ("", [0])}


def test_line_dedup_of_nothing(spark):
    assert op3.dedup_lines(frame(spark, [])).count() == 0


# decontamination

ITEMS = [(1, "jumps over the lazy dog while seven small cats watch from a warm"), (2, "A B, c! d"), (3, None), (4, ""),
         (5, "tok1 tok2 tok3 tok4 tok5 tok6 tok7 tok8 tok9 tok10 nothing"), (5, "one"), (None, "seven small cats"), (6, "no such words")]


@pytest.mark.parametrize("which", ["awkward", "driver"])
def test_decontamination_is_exact(spark, which):
    docs = awkward() if which == "awkward" else documents(spark)
    items = ITEMS if which == "awkward" else documents(spark, "benchmark", ("item_id", "text"))
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as words", "1 as size")
    got = op4.decontaminate(frame(spark, docs), table).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == sorted(contaminated(docs, items))
    assert all(r.contaminated == (r.n_hit > 0) for r in got)


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in op4.decontaminate(frame(spark, awkward()), none).collect()} == {0}
    assert op4.decontaminate(frame(spark, []), none).count() == 0


def test_oracles(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in catalog.ORACLE.items():
        got = catalog.QUERIES[name](spark, SF)
        want = con.execute(sql)
        order = [d[0] for d in want.description]
        assert sorted(got.columns) == sorted(order)
        assert sorted(map(repr, (tuple(r) for r in got.select(order).collect()))) == sorted(map(repr, want.fetchall()))


# Jaccard

def near_copies(n=60, size=120, seed=1):
    """Copies of a few texts with more and more words changed, around the threshold; and short ones."""
    rng = random.Random(seed)
    base = [[f"v{rng.randint(0, 5000)}" for _ in range(size)] for _ in range(3)]
    docs = []
    for k in range(n):
        w = list(base[k % 3])
        for _ in range(k % 7):
            w[rng.randrange(size)] = f"q{rng.randint(0, 99)}"
        docs.append((k, " ".join(w)))
    for k in range(n):
        m = rng.randint(1, 24)
        docs.append((n + k, " ".join(f"s{j if rng.random() > .03 else rng.randint(0, 50)}" for j in range(m))))
    return docs


@pytest.mark.parametrize("which", ["awkward", "near", "short", "driver"])
def test_jaccard_components_are_those_of_all_pairs(spark, which):
    docs = {"awkward": awkward, "near": near_copies, "short": lambda: near_copies(120, 14, 2),
            "driver": lambda: documents(spark)}[which]()
    got = op6.jaccard_components(frame(spark, docs)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(jaccard(docs))


def test_salted_groups_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(op6, "SALT_ROWS", 3)
    docs = near_copies(90)
    counts = np.full(1 << op6.RARITY_BITS, 20.0)
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in docs])], ["text"])
    rows = pa.Table.from_batches(op6._emit(counts)([batch])).to_pandas()
    from adlens.llm import groups
    assert (rows.key & ((1 << groups.PART_BITS) - 1)).max() > 1
    rows["whole"] = rows.key.to_numpy() >> groups.PART_BITS << groups.PART_BITS
    grouped = groups.pivots(spark.createDataFrame(rows[["key", "set"]])).collect()
    links = {}
    for r in rows.itertuples():
        links.setdefault(r.whole, set()).add(r.set)
    for key, sets in links.items():  # every member of a key hangs together through pivots
        from helpers import Union
        u = Union(sets)
        for g in grouped:
            if g.key == key:
                u.join(g.pivot, g.set)
        assert len({u.find(s) for s in sets}) == 1


def test_every_similar_pair_shares_a_signature():
    """The pigeonhole argument, for pairs exactly at the bound, with any rarity."""
    rng = np.random.default_rng(4)
    for _ in range(400):
        n = int(rng.integers(1, 200))
        pool = rng.integers(0, 1 << 63, 2 * n + 4, dtype=np.uint64)
        count = dict(zip(pool.tolist(), rng.integers(0, 4, len(pool)).tolist(), strict=True))
        a = np.unique(pool[:n])
        cut = int(rng.integers(0, len(a) // 4 + 1))
        b = np.unique(np.concatenate([a[cut:], pool[n:n + int(rng.integers(0, len(a) // 4 + 1))]]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        keys = [{k for key, _ in op6.signatures(s, np.array([count[x] for x in s.tolist()])) for k in key.tolist()} for s in (a, b)]
        assert keys[0] & keys[1]


def test_jaccard_refuses_what_the_bands_cannot_do(spark):
    with pytest.raises(ValueError):
        op6.jaccard_components(frame(spark, awkward()), threshold=50)
    assert op6.jaccard_components(frame(spark, [])).count() == 0


# quality

def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_base_counts(spark):
    docs = awkward() + [(30, "a b c a b c a\n\na b c a b c a\n#$%& <x> | *"), (31, "l1 x\nl1 x\n \nl1 x")]
    docs = [d for d in docs if d[0] != 11]
    got = op10.judge(frame(spark, docs), labels(spark, [])).collect()
    want = sorted((i, *quality(t)) for i, t in docs)
    assert sorted((r.doc_id, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)  # without labels only the plain rules decide


def test_quality_parts_held_out_labels(spark):
    """Fit with half of the labels; the other half must be told apart."""
    larger = SF.replace("0.001", "0.01")
    rows = [tuple(r) for r in common.read(spark, larger, "labels").select("doc_id", "quality", "toxic").collect()]
    half = [r for r in rows if r[0] % 2]
    got = {r.doc_id: r for r in op10.judge(common.read(spark, larger, "documents"), labels(spark, half)).collect()}
    rest = [(got[i], q) for i, q, _ in rows if not i % 2 and not got[i].base_failed]
    assert np.mean([r.kept for r, q in rest if q == 1]) > 0.97
    assert np.mean([r.kept for r, q in rest if q == 0] or [0]) < 0.2


def test_quality_of_nothing(spark):
    assert op10.judge(frame(spark, []), labels(spark, [(1, 1, 0), (None, None, None)])).count() == 0


def test_cross_pairs_are_those_of_all_pairs(spark, monkeypatch):
    from adlens.llm import groups
    monkeypatch.setattr(groups, "BLOCK", 40)  # groups of many blocks, block pairs above and below SMALL_GROUP
    rng = random.Random(8)
    sets = [(k, 10 + k % 5, [rng.getrandbits(3) - 4, rng.getrandbits(2)], k - k % 3 if k % 4 else k) for k in range(400)]
    key_of = {k: [0] if k < 150 else [1, 2] if k < 210 else [3 + k % 40] for k, *_ in sets}
    rows = [(key, min(j for j in key_of if key in key_of[j]), k) for k, keys in key_of.items() for key in keys]
    grouped = spark.createDataFrame([r for r in rows if r[1] != r[2]], groups.GROUPED)
    nodes = spark.createDataFrame([s[:3] for s in sets], "set long, n int, sketch array<long>")
    roots = spark.createDataFrame([(s[0], s[3]) for s in sets], "node long, root long")
    near = lambda n, m, apart: (apart <= 2) & (abs(n - m) <= 3)
    members = groups._members(grouped)
    got = {(r.a, r.b) for r in groups.cross_pairs(members, nodes, roots, near, 2, 1000).collect()}
    bits = lambda a, b: sum(((x ^ y) & 0xFFFFFFFFFFFFFFFF).bit_count() for x, y in zip(a, b, strict=True))
    size = {key: sum(key in k for k in key_of.values()) for k in key_of.values() for key in k}
    want = {(a[0], b[0]) for a in sets for b in sets if a[0] < b[0] and a[3] != b[3] and abs(a[1] - b[1]) <= 3
            and bits(a[2], b[2]) <= 2 and any(size[k] > 2 for k in set(key_of[a[0]]) & set(key_of[b[0]]))}
    assert got == want
    few = groups.cross_pairs(members, nodes, roots, near, 2, 1).collect()
    assert {(r.a, r.b) for r in few} < want and any(r.more for r in few)
    # every pair is a link or none is: in rounds, each candidate is verified or joined by others
    for link in (True, False):
        seen = []
        _, done = groups.settled(grouped, nodes, roots.selectExpr("root as a", "node as b"), spark.createDataFrame([], "a long, b long"),
                                 near, 2, lambda p: seen.append(p.collect()) or common.stash(p.where(F.lit(link))))
        at = {r.node: r.root for r in done.collect()}
        if link:
            assert all(at.get(a, a) == at.get(b, b) for a, b in want) and sum(map(len, seen)) < len(want) / 2
        else:
            assert {tuple(r) for x in seen for r in x} == want


def test_lowest_is_the_sorted_head(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    want = [r.k for r in rows.selectExpr("k", "xxhash64(k) as h").orderBy("h", "k").limit(100).collect()]
    assert [r.k for r in common.lowest(rows, 100, "k").collect()] == want
    assert common.lowest(rows.limit(5), 100, "k").count() == 5 and common.lowest(rows.limit(0), 3, "k").count() == 0


def test_tables_on_the_way_are_deleted(spark):
    import glob
    folder = common.shared_dir(spark).removeprefix("file://")
    there = lambda: set(glob.glob(f"{folder}/stash-*"))
    before = there()
    found = op6.jaccard_components(frame(spark, near_copies(20, 14, 2)))
    assert len(there() - before) == 1  # the result
    with common.released(spark):
        inner = common.stash(spark.range(3))
        with common.released(spark):
            held = common.stash(spark.range(4), hold=True)
            common.stash(spark.range(5))
        assert inner.count() + held.count() == 7 and len(there() - before) == 3
    assert len(there() - before) == 1 and found.count() == 40
    with pytest.raises(ZeroDivisionError), common.released(spark):
        common.stash(spark.range(2)), 1 // 0
    assert len(there() - before) == 1
