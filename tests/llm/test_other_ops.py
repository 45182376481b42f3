"""HTML extraction, sharding, HMM scores, license scans, URL filters and the pipeline."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from helpers import SF, SPACE, awkward, contaminated, frame, jaccard, line_words, low, quality, removed_lines

import corpus_pipeline
from adlens.llm import catalog, common
from adlens.llm import op02_html as op2
from adlens.llm import op03_lines as op3
from adlens.llm import op05_shard as op5
from adlens.llm import op07_hmm as op7
from adlens.llm import op08_license as op8
from adlens.llm import op09_urls as op9
from adlens.llm import op10_quality as op10

# HTML


def cut_cost(side, gains, ties):
    cost = sum(max(0, g) if not on else max(0, -g) for on, g in zip(side, gains, strict=True))
    return cost + sum(w for a, b, w in ties if side[a] != side[b])


def test_cut_is_minimal():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 9)
        gains = [rng.choice([-2, -1, -.5, 0, .5, 1, 3]) * rng.random() for _ in range(n)]
        ties = [(a, b, rng.random()) for a, b in itertools.combinations(range(n), 2) if rng.random() < .5]
        best = min(cut_cost(s, gains, ties) for s in itertools.product([False, True], repeat=n))
        assert math.isclose(cut_cost(op2.source_side(gains, ties), gains, ties), best, abs_tol=1e-6)


PAGES = {
    "<body><header><h1>Site</h1><a href=x>Home</a></header><nav><ul><li>Menu</ul></nav><main><h1>Title</h1><p>Real text"
    " here, long &amp; true.</p><aside>Side</aside><div class='comments'><article class=comment><p>A reader says a lot of"
    " words about the article here.</article></div><form><label>Mail</label></form></main><footer>f</footer>":
        "Title\nReal text here, long & true.",
    "<div class=content><p>One &nbsp; two<br>three</p><ul><li>item</li><li>it em<b>bold</b>x</ul></div>"
    "<div class='cookie-notice'>We use cookies on this page to make it work for all of you, really.</div><div id=sidebar>recent</div>":
        "One two three\nitem\nit emboldx",
    "<article><p>a < b and c > d</p><p>unclosed <b>bold<p>next<script>var a = '</p>';</script></article>":
        "a < b and c > d\nunclosed bold\nnext",
    "<article><p>Cut off in the middle of a ta<p": "Cut off in the middle of a ta",
    "<article><!-- no <p>text</p> --><p>x&#233;&lt;&am</p><style>p{}</style></article>": "xé<&am",
    "": "", "<html></html>": "", "   ": "",
    "<body class='comments-open has-sidebar'><div class='layout with-sidebar'><div class=page-header><a href=/>Site name</a></div>"
    "<article class='post comments-open'><div class='post-header'><h1>The title</h1></div><p class=lead>First words of the article."
    "</p><div class='share'>Share it</div><p>Last words.</p><footer>By someone</footer></article><div class=sidebar>"
    "<article><p>A teaser of another article with quite a number of words in it, which is not part of this one.</p></article>"
    "</div><section id=comments><article><p>I have read it all, and I must say that it is a good article. Thanks.</p></article>"
    "</section></div>": "The title\nFirst words of the article.\nLast words.",
    "<form id=aspnet><input><div class=content><p>The whole page is in a form, as some servers write it.</p></div></form>":
        "The whole page is in a form, as some servers write it.",
}


def test_extraction_of_odd_pages(spark):
    rows = [(k, None if k % 2 else f"u{k}", h) for k, h in enumerate(PAGES)] + [(99, "u", None)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: r for r in op2.extract(pages).collect()}
    for (k, url, _), want in zip(rows, [*PAGES.values(), ""], strict=True):
        assert (got[k].text, got[k].url, got[k].n_chars) == (want, url, len(want))
    assert op2.extract(pages.limit(0)).count() == 0


def test_driver_pages_give_their_articles(spark):
    for r in catalog.QUERIES["op2_html_main_text"](spark, SF).join(
            common.read(spark, SF, "pages").select("page_id", "html"), "page_id").collect():
        body = re.sub(r"<[^>]*$", "", r.html.partition("<article>")[2].partition("</article>")[0])
        import html
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(p for p in parts if p)


def test_formulas_and_fallback_text_are_content():
    page = ("<body><article><p>The area is <math><mi>a</mi><mo>=</mo><msup><mi>r</mi><mn>2</mn></msup></math> for a square of side r.</p>"
            "<noscript><p>This paragraph of the article is also there without any scripts.</p></noscript>"
            "<object data=x.swf><param name=a value=b><p>This paragraph stands in for the embedded object.</p></object>"
            "<p>The last words.</p></article><nav><noscript><a href=m>Menu</a></noscript></nav>")
    assert op2.main_text(page) == (
        "The area is a=r2 for a square of side r.\nThis paragraph of the article is also there without any scripts.\n"
        "This paragraph stands in for the embedded object.\nThe last words.")


def test_a_large_page_takes_linear_time():
    page = "<body>" + "<div><p>text words in a row here.</p><a href=q>l</a></div>" * 5000
    assert len(op2.blocks(page)) == 10_000 and op2.main_text(page).count("\n") >= 0


# sharding

def check_shards(got, docs, shards=16):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    size = collections.Counter()
    for r in got:
        size[r.shard] += r.size
    return [size[k] for k in range(shards)]


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_shards_have_near_equal_bytes(spark, shards):
    rng = random.Random(1)
    docs = [(k, "x" * rng.randint(0, 300)) for k in range(6000)]
    size = check_shards(op5.kd_shards(frame(spark, docs), shards).collect(), docs, shards)
    assert max(size) < 1.02 * min(size)


def test_shards_of_one_hot_source_and_equal_metadata(spark):
    docs = [(k, "same") for k in range(3200)]
    size = check_shards(op5.kd_shards(frame(spark, docs)).collect(), docs)
    assert max(size) - min(size) <= 10


def test_shards_of_awkward_rows(spark, monkeypatch):
    check_shards(op5.kd_shards(frame(spark, awkward())).collect(), awkward())
    check_shards(op5.kd_shards(spark.createDataFrame(awkward(), "doc_id long, text string")).collect(), awkward())
    monkeypatch.setattr(op5, "BLOCK_ROWS", 1)
    docs = [(k, str(k)) for k in range(100)]
    check_shards(op5.kd_shards(frame(spark, docs), 4).collect(), docs, 4)
    assert op5.kd_shards(frame(spark, [])).count() == 0


# language model

def recursion(x, start, move, emit):
    """Plain scaled forward-backward: log likelihood, expected starts, moves and emissions."""
    n, s = len(x), len(start)
    a, scale, v = np.zeros((n, s)), np.zeros(n), start
    for t in range(n):
        v = (v @ move) * emit[x[t]]
        scale[t] = v.sum()
        a[t] = v = v / scale[t]
    b = np.ones((n, s))
    for t in range(n - 2, -1, -1):
        b[t] = move @ (emit[x[t + 1]] * b[t + 1]) / scale[t + 1]
    moves, emits = np.zeros((s, s)), np.zeros(emit.shape)
    np.add.at(emits, x, a * b / (a * b).sum(1)[:, None])
    for t in range(n):
        xi = (a[t - 1] if t else start)[:, None] * move * (emit[x[t]] * b[t])
        moves += xi / xi.sum()
    first = start * (move @ (emit[x[0]] * b[0]))
    return np.log(scale).sum(), first / first.sum(), moves, emits


def test_recursion_over_pieces_is_exact():
    rng = np.random.default_rng(1)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(7), 3).T
    texts = [rng.integers(0, 7, n) for n in (1, 5, 127, 128, 129, 400, 9000, 256)]
    flat, sizes = np.concatenate(texts), np.array([len(x) for x in texts])
    want = [recursion(x, start, move, emit) for x in texts]
    assert np.allclose(op7.log_likelihood(flat, sizes, start, move, emit), [w[0] for w in want], rtol=1e-12)
    got = op7.expected(flat, sizes, start, move, emit)
    for k, name in enumerate(("start", "move", "emit"), 1):
        assert np.allclose(got[name], sum(w[k] for w in want), rtol=1e-9)


def base_scores(docs):
    tokens = [re.findall(SPACE, low(t)) + [None] for _, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs]
    count = collections.Counter(w for own, out in zip(tokens, held, strict=True) if not out for w in own)
    n, v = sum(count.values()), len(count)
    return sorted((i, out, len(own), sum(count[w] > 0 for w in own), n,
                   round(sum(math.log10((count[w] + .5) / (n + .5 * (v + 1))) for w in own), 5))
                  for (i, _), own, out in zip(docs, tokens, held, strict=True))


def test_scores_of_awkward_texts(spark):
    got = op7.score_documents(frame(spark, awkward())).collect()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) \
        == base_scores(awkward())
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert op7.score_documents(frame(spark, [])).count() == 0
    only_held = [(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    assert {(r.score, r.base_score, r.n_known) for r in op7.score_documents(frame(spark, only_held)).collect()} == {(0, 0, 0)}


def test_model_beats_the_base_on_held_out_documents(spark, monkeypatch):
    monkeypatch.setattr(op7, "BLOCK_BYTES", 1 << 16)
    docs = [tuple(r) for r in common.read(spark, SF, "documents").select("doc_id", "text").collect()]
    got = catalog.QUERIES["op7_hmm_scores"](spark, SF).collect()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) \
        == base_scores(docs)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.95 * sum(r.base_score for r in held) and sum(r.score > r.base_score for r in held) > .8 * len(held)


def test_the_model_is_a_distribution(spark):
    """Over all one-token continuations of the known words, the unknown word and the end."""
    rng = np.random.default_rng(0)
    base = rng.dirichlet(np.ones(op7.CLASSES + 2))
    start, move, emit = op7._seeded([], base, 3)
    assert np.allclose(emit.sum(0), 1) and np.allclose(move.sum(1), 1) and np.isclose(start.sum(), 1)


# licenses

def test_driver_notices_are_found(spark):
    docs = [tuple(r) for r in common.read(spark, SF, "documents").select("doc_id", "text").collect()]
    plain = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "GNU General Public License, version 3.": "GPL-3.0",
             "Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT"}
    want = sorted((i, plain[x]) for i, t in docs for x in plain if x in t)
    got = sorted({(r.doc_id, r.license) for r in catalog.QUERIES["op8_license_scan"](spark, SF).collect()})
    assert got == want and want


def test_wording_decides(spark):
    mit = dict(reversed(op8.TEMPLATES))["MIT"]
    long = next(x for _, x in op8.TEMPLATES if x.startswith("Permission"))
    docs = [(1, "Some text. Released under the MIT License. More text."), (2, long.replace("free of charge", "at no charge")),
            (3, "Licensed under the Apache License, Version 1.1."), (4, "My driving license is lost."), (5, None), (6, ""),
            (7, "Licensed under CC BY-SA 4.0.\nLicensed under CC BY 4.0."), (8, "İİ licensed under the apache license, version 2.0"),
            (9, "license " * 3000), (1, "Released under the MIT License.")]
    got = op8.license_blocks(frame(spark, docs)).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [
        (1, "MIT"), (1, "MIT"), (2, "MIT"), (7, "CC-BY-4.0"), (7, "CC-BY-SA-4.0"), (8, "Apache-2.0")]
    assert mit and {(r.missing, r.added) for r in got if r.doc_id == 2} <= {(2, 1), (1, 1), (2, 2)}
    for r in got:
        texts = [t for i, t in docs if i == r.doc_id]
        assert any(t[r.start:r.start + r.length].strip() == r.notice for t in texts)
    assert op8.license_blocks(frame(spark, [])).count() == 0


@pytest.mark.parametrize("width", [72, 80])
@pytest.mark.parametrize("prefix", ["", "# ", " * ", "// "])
def test_wrapped_notices_are_whole(width, prefix):
    import textwrap
    prose = [prefix + "Some other words of the file stand here, and none is about rights."] * 3
    for name, wording in op8.TEMPLATES:
        lines = textwrap.wrap(wording, width, initial_indent=prefix, subsequent_indent=prefix, break_on_hyphens=False, break_long_words=False)
        text = "\n".join([prefix + "Copyright (c) 2020 A. Nother", prefix.strip(), *lines, prefix.strip(), *prose])
        assert [(x[2], x[4], x[5]) for x in op8.scan(text, tuple(op8.TEMPLATES))] == [(name, 0, 0)], text


def test_every_notice_of_a_run_is_found():
    of = lambda text, templates=op8.TEMPLATES: [x[2] for x in op8.scan(text, tuple(templates))]
    gpl = next(x for _, x in op8.TEMPLATES if x.startswith("This program"))
    assert of("Code: Released under the MIT License; text: Licensed under CC BY 4.0") == ["MIT", "CC-BY-4.0"]
    assert of("Licensed under CC BY 4.0.\n" + gpl.replace("modify ", "modify\n").replace("option) ", "option)\n")) == ["CC-BY-4.0", "GPL-3.0"]
    assert of("Licensed under CC BY 4.0.\nLicensed under CC BY 4.0.") == ["CC-BY-4.0"] * 2
    close = [(f"L{k}", "Licensed under the very same long public wording for all files of the project, edition " + x)
             for k, x in enumerate(["one", "two", "three", "four", "five", "six"])]
    assert [of(text, close) for _, text in close] == [[name] for name, _ in close]


# urls

def parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    return low(host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in op9.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else None


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1", "https://example.com/en/1", "https://a.b.example.com/EN/1",
        "x://y://net/es/", "http://net/es", "http://net/es/", "http://notnet/es/", "http://a.net?q=/es/", "http://a.net/fr/#/x",
        "http://a.org/en/1/2/3/4/5/6", "http://com", "http://com/", "http://a.net/es/1\n", "http://a.org//x//", "é://ü.org/ß"]


def plain_templates(rows):
    """{(host, shape): rejected}: the tree by plain Python."""
    count = collections.defaultdict(lambda: [0, 0])
    for host, path, fit in rows:
        own = count[host, re.sub("[0-9]+", "#", path)]
        if fit:
            own[0] += 1
            own[1] += fit[1] == "block"
    name = {k: "" for k in count}
    seg = {k: [s for s in k[1].split("/") if s] for k in count}
    for depth in range(op9.DEPTH):
        nodes = collections.defaultdict(lambda: collections.defaultdict(lambda: [0, 0]))
        for k, (m, b) in count.items():
            if len(seg[k]) > depth:
                child = nodes[k[0], name[k]][seg[k][depth]]
                child[0] += m
                child[1] += b
        branch = {}
        for node, children in nodes.items():
            if len(children) > op9.WIDE:
                branch |= {(node, c): "*" for c in children}
                continue
            known = sorted(((b + .5) / (m + 1), c, m, b) for c, (m, b) in children.items() if m >= op9.MIN_LABELLED)
            runs = []
            for k, (share, c, m, b) in enumerate(known):
                if k:
                    _, _, m0, b0 = known[k - 1]
                    p = (b + b0 + .5) / (m + m0 + 1)
                    z = (share - (b0 + .5) / (m0 + 1)) / math.sqrt(p * (1 - p) * (1 / m + 1 / m0))
                if not k or z >= op9.Z:
                    runs.append([])
                runs[-1].append(c)
            for run in runs:
                branch |= {(node, c): "|".join(sorted(run)) for c in run}
        name = {k: n + ("/" + branch.get(((k[0], n), seg[k][depth]), seg[k][depth]) if len(seg[k]) > depth else "")
                for k, n in name.items()}
    name = {k: n + ("/**" if len(seg[k]) > op9.DEPTH else "") for k, n in name.items()}
    total = collections.defaultdict(lambda: [0, 0])
    for k, (m, b) in count.items():
        total[k[0], name[k]][0] += m
        total[k[0], name[k]][1] += b
    return {k: (total[k[0], name[k]][1] + op9.ALPHA * op9.PRIOR) / (total[k[0], name[k]][0] + op9.ALPHA) >= op9.REJECT for k in count}


@pytest.mark.parametrize("which", ["odd", "driver", "wide"])
def test_urls_are_judged_like_by_hand(spark, which):
    if which == "driver":
        pages = [tuple(r) for r in common.read(spark, SF, "pages").select("page_id", "url").collect()]
    elif which == "wide":  # many segments, labelled and unlabelled mixed under one host
        pages = [(k, f"http://a.net/{'es/' if k % 3 else 'es;'}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}/{k}") for k in range(900)]
    else:
        pages = list(enumerate(URLS * 2))
    rows = [(*parts(u), rule(*parts(u))) for _, u in pages]
    rejected = plain_templates(rows)
    want = sorted((i, h, p, f[0] if f else None, f[1] if f else "block" if rejected[h, re.sub("[0-9]+", "#", p)] else "allow")
                  for (i, _), (h, p, f) in zip(pages, rows, strict=True))
    table = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, host string, shape int")
    got = op9.filter_urls(table).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_no_urls(spark):
    assert op9.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


# pipeline

def test_stages_are_the_plain_ones(spark):
    """Every stage on its own input against plain Python, and the columns of documents kept."""
    docs = common.read(spark, SF, "documents")
    columns = docs.columns
    rows = lambda df: sorted(tuple(r) for r in df.select("doc_id", "text").collect())
    stage = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "packing"]

    judged = {r.doc_id: r.kept for r in op10.judge(docs, common.read(spark, SF, "labels")).collect()}
    one = common.stash(stage["quality"](spark, docs, SF))
    assert one.columns == columns and rows(one) == [d for d in rows(docs) if judged[d[0]]]
    assert all(not (quality(t)[4] < 50 or 2 * quality(t)[3] > quality(t)[4]) for _, t in rows(one))

    two = common.stash(stage["lines"](spark, one, SF))
    before = rows(one)
    gone = removed_lines(before)
    left = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[row])) for row, (i, t) in enumerate(before)]
    assert two.columns == columns and rows(two) == [(i, t) for row, (i, t) in enumerate(left) if not gone[row] or line_words(t)]
    assert all(line_words(t) for _, t in rows(two))
    assert all(r.n_chars == len(r.text) for r in two.collect() if r.text != dict(before)[r.doc_id])

    three = common.stash(stage["near_duplicates"](spark, two, SF))
    least = {i: c for i, _, c in jaccard(rows(two))}
    assert three.columns == columns and rows(three) == [d for d in rows(two) if least[d[0]] == d[0]]

    four = common.stash(stage["decontamination"](spark, three, SF))
    items = [tuple(r) for r in common.read(spark, SF, "benchmark").select("item_id", "text").collect()]
    hit = {i for i, _, n, _ in contaminated(rows(three), items) if n}
    assert four.columns == columns and rows(four) == [d for d in rows(three) if d[0] not in hit]

    from test_text_ops import check_packing
    check_packing(stage["packing"](spark, four, SF).collect(), rows(four))
    assert corpus_pipeline.run(spark, SF).count() == stage["packing"](spark, four, SF).count()


def test_stages_of_awkward_documents(spark, tmp_path):
    docs = frame(spark, awkward())
    spark.createDataFrame([(4, 1, 0), (20, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "quick brown fox"), (None, None)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    sf = f"file://{tmp_path}"
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.stash(stage(spark, docs, sf))
        assert out.columns == docs.columns
        kept[name] = sorted((r.doc_id, r.text) for r in out.collect() if r.text is not None)
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert [i for i, _ in kept["near_duplicates"]] == sorted({i for i, _, c in jaccard(awkward()) if c == i} - {1})
    assert 4 not in [i for i, _ in kept["decontamination"]]
    assert stage(spark, docs.limit(0), sf).count() == 0
