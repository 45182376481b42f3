"""Plain-Python versions of the operators' results, and an awkward documents table."""

import re
from collections import Counter

SPACE = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SF = "/root/testdata/sf0.001"
CLASHES = ["key", "set", "n", "size", "row", "start", "words", "line", "name", "sim", "node", "shard", "slot", "block",
           "kind", "content", "template", "a", "b", "root", "host", "path", "rule", "n_words", "held_out", "score"]


def low(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def words(text, pattern=SPACE):
    return re.findall(pattern, low(text))


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def jaccard(docs):
    """{row: (set size, smallest id reachable)} for [(id, text)]."""
    sets = [shingles(t) for _, t in docs]
    u = Union(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                u.join(i, j)
    out = {}
    for i in range(len(docs)):
        out.setdefault(u.find(i), []).append(i)
    least = {}
    for rows in out.values():
        for i in rows:
            least[i] = min(docs[k][0] for k in rows)
    return [(docs[i][0], len(sets[i]), least[i]) for i in range(len(docs))]


def contaminated(docs, items, size=10):
    """[(doc_id, words, hits, items)]"""
    windows = {}
    for item, text in items:
        w = words(text, ALNUM)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault((n, tuple(w[k:k + n])), set()).add("" if item is None else str(item))
    sizes = {n for n, _ in windows}
    out = []
    for doc, text in docs:
        w = words(text, ALNUM)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                own = windows.get((n, tuple(w[k:k + n])))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def line_words(line):
    return tuple(words(line, ALNUM))


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def near_line(a, b, similarity=0.9):
    """Whether word edit similarity is reached; words that only one side has rule most pairs out."""
    most = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    own, other = Counter(a), Counter(b)
    return max((own - other).total(), (other - own).total()) <= most and edit(a, b) <= most


def removed_lines(docs, similarity=0.9, least=1):
    """{row: numbers of removed lines} for [(id, text)] in order, by edit similarity of all pairs of lines."""
    found = [(i, k, line_words(x)) for i, (_, t) in enumerate(docs) if t is not None for k, x in enumerate(t.split("\n"))]
    found = [f for f in found if len(f[2]) >= least]
    distinct = sorted({f[2] for f in found})
    u = Union(distinct)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if near_line(a, b, similarity):
                u.join(a, b)
    seen, gone = {}, {i: [] for i in range(len(docs))}
    for i, k, line in found:
        mark = (docs[i], k)
        if seen.setdefault(u.find(line), mark) != mark:
            gone[i].append(k)
    return gone


def quality(text):
    """word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words."""
    w = re.findall(SPACE, text or "")
    three = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    many = {x for x in three if three.count(x) > 1}
    covered = {k + d for k, x in enumerate(three) if x in many for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(SPACE, x)]
    return (sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(w))


BASE = "the quick brown fox jumps over the lazy dog while seven small cats watch from a warm red roof near the old mill"


def awkward():
    """[(id, text)]: nulls, empty and white texts, exact and near copies, ties, a repeated row, a very long text, odd
    characters, long words and a text of one word."""
    long = " ".join(f"word{k % 977}x{k}" for k in range(30_000))
    near = " ".join(f"tok{k}" for k in range(80))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, BASE), (5, BASE), (6, BASE.upper()), (7, BASE + " today"),
        (8, near), (9, near.replace("tok5 ", "other ")), (10, near.replace("tok70", "x").replace("tok71", "y")),
        (11, long), (12, "one"), (13, "one"), (13, "one"), (14, "a b c d"), (15, "a b c d e"), (16, "a b c d e"),
        (17, "été naïve \U0001f600 café bar \x85 x \x1c y z w v u t"),
        (18, "x" * 5000 + " " + "y" * 70_000), (19, BASE + "\n" + BASE + "\n\n" + near), (20, "dup dup dup dup dup dup dup"),
        (21, "<|endoftext|> special " + BASE),
    ]


def frame(spark, docs, **extra):
    """documents table of [(id, text)] with columns whose names clash with internal ones."""
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in CLASHES)
    rows = [(i, t, "en", "src0", None if t is None else len(t), *["clash"] * len(CLASHES)) for i, t in docs]
    return spark.createDataFrame(rows, schema).repartition(3)
