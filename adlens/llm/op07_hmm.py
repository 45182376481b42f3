"""LM scoring: a hidden Markov language model over word classes.

Tokens are lower-cased words and one end per document. A word's class is a hash of its first and last bytes
and its length, so the emission table has a fixed size whatever the vocabulary. With the smoothed unigram
("base") model P0, the model is

    P(text) = P_hmm(classes of the tokens) * product over known words of P0(word) / P0(class of word)

which is a proper distribution over the known words, one unknown word and the end: the last two are classes
of their own. In every state an unknown word has the Good-Turing share, once-seen words over all tokens.

1. Encode: documents become blocks of about BLOCK_BYTES of text. Each block has a dictionary (word hash, class,
   training count) and its documents as class and word numbers. Texts are read once.
2. Count: dictionary rows are added up by word, which gives every block the corpus count of each of its words.
   Only one row per word and block is shuffled, so a frequent word has as many rows as there are blocks.
3. Train: Baum-Welch. Every task runs forward-backward over all its training documents and sends expected
   counts (a vector of fixed size); their sums give the next parameters. States are seeded by k-means on the
   class histograms of SEED_ROWS documents; the rounds that follow use all training documents.
4. Score: blocks meet their dictionaries again; base score and scaled forward recursion give the result.

The recursion works on pieces of PIECE tokens at once: the product of a piece's transition matrices carries a
state vector across it, so a long document costs no more steps than a short one and the likelihood stays exact.

Null text is empty: its only token is the end. A null doc_id counts as an empty one for the hold-out.
Without training documents every token is unknown and the score is the base score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm import common, kernel

STATES = 6
CLASS_BITS = 14
CLASSES = 1 << CLASS_BITS
UNKNOWN, END = CLASSES, CLASSES + 1
ROUNDS = 2
#: Documents whose class histograms seed the states (smallest id hashes, 20 to 2000 words).
SEED_ROWS = 512
#: Weight of the base model in a state's emissions, in tokens.
PRIOR = 200.0
BLOCK_BYTES = 1 << 24
PIECE = 128
#: Pieces handled at once.
BATCH = 4096
U64 = np.uint64

ENCODED = ("block long, kind int, doc_id long, held_out boolean, number int, word long, class int, train long, "
           "classes binary, ids binary")


def _classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size = ends - starts
    mark = np.minimum(size, 8).astype(U64)
    for k in range(3):
        head = kernel.LOWER[data[np.minimum(starts + k, ends - 1)]].astype(U64)
        tail = kernel.LOWER[data[np.maximum(ends - 1 - k, starts)]].astype(U64)
        mark = (mark << U64(16)) | (head << U64(8)) | tail
    return (kernel.mix(mark) >> U64(64 - CLASS_BITS)).astype(np.uint16)


def _table(rows: int, **columns) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "kind": pa.int32(), "doc_id": pa.int64(), "held_out": pa.bool_(), "number": pa.int32(),
             "word": pa.int64(), "class": pa.int32(), "train": pa.int64(), "classes": pa.binary(), "ids": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [columns[k] if isinstance(columns.get(k), pa.Array) else pa.array(columns[k], t) if k in columns
         else pa.nulls(rows, t) for k, t in kinds.items()], list(kinds))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: dictionary rows (kind 0) and document rows (kind 1)."""
    block = TaskContext.get().partitionId() << 20
    held: list[tuple] = []
    size = 0

    def settle():
        hashes, classes, first, ids, out = (np.concatenate(x) for x in zip(*[
            (h, c, np.diff(f), np.array(i, object), o) for h, c, f, i, o in held], strict=True))
        word, at, place = np.unique(hashes, return_index=True, return_inverse=True)
        edges = np.concatenate([[0], np.cumsum(first)])
        train = np.bincount(place[~np.repeat(out, first)], minlength=len(word))
        for k in range(0, len(word), 1 << 16):
            own = slice(k, k + (1 << 16))
            rows = len(word[own])
            yield _table(rows, block=np.full(rows, block), kind=np.zeros(rows, np.int32),
                         number=np.arange(k, k + rows, dtype=np.int32), word=word[own].view(np.int64),
                         train=train[own], **{"class": classes[at[own]].astype(np.int32)})
        place = place.astype("<u4")
        for k in range(0, len(ids), 1000):
            span = range(k, min(k + 1000, len(ids)))
            yield _table(len(span), block=np.full(len(span), block), kind=np.ones(len(span), np.int32),
                         doc_id=list(ids[k:k + 1000]), held_out=out[k:k + 1000],
                         number=first[k:k + 1000].astype(np.int32),
                         classes=[classes[edges[i]:edges[i + 1]].tobytes() for i in span],
                         ids=[place[edges[i]:edges[i + 1]].tobytes() for i in span])

    for batch in batches:
        for part in kernel.pieces(batch, "text"):
            data, offsets = kernel.utf8(part.column("text"))
            starts, ends, first = kernel.words(data, offsets, kernel.NOT_SPACE)
            held.append((kernel.hash_words(data, starts, ends), _classes(data, starts, ends), first,
                         part.column("doc_id").to_pylist(), part.column("held_out").to_numpy(zero_copy_only=False)))
            size += len(data)
            if size >= BLOCK_BYTES:
                yield from settle()
                held, size, block = [], 0, block + 1
    if held:
        yield from settle()


class Pieces:
    """Token sequences cut into pieces of at most PIECE tokens."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.flat, self.docs = flat, len(lengths)
        begin = np.cumsum(lengths) - lengths
        count = -(-lengths // PIECE)
        self.doc = np.repeat(np.arange(len(lengths)), count)
        self.place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        self.start = begin[self.doc] + self.place * PIECE
        self.size = np.minimum(PIECE, (begin + lengths)[self.doc] - self.start)
        self.rounds = [np.flatnonzero(self.place == k) for k in range(int(count.max(initial=0)))] \
            if count.max(initial=0) < 64 else self._by_place()

    def _by_place(self) -> list[np.ndarray]:
        order = np.argsort(self.place, kind="stable")
        return np.split(order, np.cumsum(np.bincount(self.place))[:-1])

    def batches(self):
        """Piece numbers (longest first), their tokens, and how many pieces have a token at each step."""
        order = np.argsort(-self.size, kind="stable")
        for k in range(0, len(order), BATCH):
            own = order[k:k + BATCH]
            at = np.minimum(self.start[own][:, None] + np.arange(self.size[own[0]]), len(self.flat) - 1)
            yield own, self.flat[at].T, [int((self.size[own] > t).sum()) for t in range(self.size[own[0]])]


def _transfer(pieces: Pieces, move: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Product of the transition-and-emission matrices of each piece, scaled, and the log of the scale."""
    states = len(move)
    product = np.empty((len(pieces.doc), states, states))
    scale = np.zeros(len(pieces.doc))
    for own, tokens, active in pieces.batches():
        m = np.broadcast_to(np.eye(states), (len(own), states, states)).copy()
        log = np.zeros(len(own))
        for t, n in enumerate(active):
            m[:n] = (m[:n].reshape(-1, states) @ move).reshape(n, states, states)
            m[:n] *= emit[tokens[t, :n]][:, None, :]
            if t % 16 == 15 or t == len(active) - 1:
                z = m.sum((1, 2))
                m /= z[:, None, None]
                log += np.log(z)
        product[own], scale[own] = m, log
    return product, scale


def _forward(pieces: Pieces, start: np.ndarray, product: np.ndarray, scale: np.ndarray):
    """State vector on entering each piece, and the log likelihood of each document."""
    entry = np.empty((len(pieces.doc), len(start)))
    now = np.broadcast_to(start, (pieces.docs, len(start))).copy()
    total = np.zeros(pieces.docs)
    for own in pieces.rounds:
        doc = pieces.doc[own]
        entry[own] = now[doc]
        after = np.einsum("ds,dst->dt", now[doc], product[own])
        z = after.sum(1)
        now[doc] = after / z[:, None]
        total[doc] += np.log(z) + scale[own]
    return entry, total


def log_likelihood(flat, lengths, start, move, emit) -> np.ndarray:
    pieces = Pieces(flat, lengths)
    return _forward(pieces, start, *_transfer(pieces, move, emit))[1]


def expected(flat, lengths, start, move, emit) -> dict[str, np.ndarray]:
    """Expected counts of starts, moves and emissions by forward-backward over whole documents."""
    pieces, states = Pieces(flat, lengths), len(start)
    product, scale = _transfer(pieces, move, emit)
    entry, _ = _forward(pieces, start, product, scale)
    leave = np.empty_like(entry)
    now = np.ones((pieces.docs, states))
    for own in reversed(pieces.rounds):
        doc = pieces.doc[own]
        leave[own] = now[doc]
        before = np.einsum("dst,dt->ds", product[own], now[doc])
        now[doc] = before / before.sum(1)[:, None]
    first = start * now
    counts = {"start": (first / first.sum(1)[:, None]).sum(0), "move": np.zeros((states, states)),
              "emit": np.zeros(emit.shape)}
    for own, tokens, active in pieces.batches():
        ahead = np.empty((len(active), len(own), states))
        a = entry[own]
        for t, n in enumerate(active):
            step = (a[:n] @ move) * emit[tokens[t, :n]]
            a[:n] = step / step.sum(1)[:, None]
            ahead[t] = a
        back = leave[own]
        for t in range(len(active) - 1, -1, -1):
            n = active[t]
            here = ahead[t, :n] * back[:n]
            here /= here.sum(1)[:, None]
            prior = ahead[t - 1, :n] if t else entry[own[:n]]
            w = emit[tokens[t, :n]] * back[:n]
            up = w @ move.T
            z = (prior * up).sum(1)
            counts["move"] += move * ((prior / z[:, None]).T @ w)
            back[:n] = up / up.sum(1)[:, None]
            ahead[t, :n] = here
        on = np.arange(len(own))[None, :] < np.array(active)[:, None]
        used, weight = tokens[on], ahead[on]
        for s in range(states):
            counts["emit"][:, s] += np.bincount(used, weight[:, s], len(emit))
    return counts


def _sequences(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Class sequences with the end of each, one after another."""
    lengths = np.array([len(b) // 2 + 1 for b in blobs], np.int64)
    flat = np.full(int(lengths.sum()), END, np.int64)
    inside = np.ones(len(flat), bool)
    inside[np.cumsum(lengths) - 1] = False
    flat[inside] = np.frombuffer(b"".join(blobs), "<u2")
    return flat, lengths


def _runs(sizes: list[int], most: int = 1 << 20):
    """Slices of rows with about ``most`` tokens each."""
    i = total = 0
    for j, n in enumerate(sizes):
        total += n
        if total >= most:
            yield i, j + 1
            i, total = j + 1, 0
    if i < len(sizes):
        yield i, len(sizes)


def _train(start, move, emit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {"start": np.zeros(start.shape), "move": np.zeros(move.shape), "emit": np.zeros(emit.shape)}
        for batch in batches:
            blobs = batch.column("classes").to_pylist()
            for i, j in _runs([len(b) // 2 for b in blobs]):
                for k, v in expected(*_sequences(blobs[i:j]), start, move, emit).items():
                    total[k] += v
        yield common.vector_batch([r for k, v in total.items() for r in common.vector_rows(k, v.ravel())])
    return run


def _seeded(blobs: list[bytes], base: np.ndarray, states: int):
    """First parameters: sticky states whose emissions are k-means centres of class histograms."""
    rng = np.random.default_rng(7)
    own = np.array([np.bincount(np.frombuffer(b, "<u2"), minlength=len(base)) for b in blobs], np.float64)
    emit = base[:, None] * np.exp(rng.normal(0, 0.1, (len(base), states)))
    if len(own) >= states:
        share = np.sqrt(own / own.sum(1)[:, None])  # cosine of these: Bhattacharyya
        centre = share[[0]]
        while len(centre) < states:
            far = np.clip(1 - (share @ centre.T).max(1), 1e-9, None)
            centre = np.vstack([centre, share[rng.choice(len(share), p=far / far.sum())]])
        for _ in range(10):
            near = (share @ centre.T).argmax(1)
            for s in range(states):
                if (near == s).any():
                    mean = share[near == s].mean(0)
                    centre[s] = mean / np.linalg.norm(mean)
        near = (share @ centre.T).argmax(1)
        for s in range(states):
            hits = own[near == s].sum(0)
            emit[:, s] = 0.5 * base + 0.5 * (hits + base) / (hits.sum() + 1)
    emit /= emit.sum(0)
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return np.full(states, 1 / states), move, emit


def fit(encoded: DataFrame, base: np.ndarray, unseen: float, states: int = STATES, rounds: int = ROUNDS):
    """Start, transition and emission probabilities after ``rounds`` of Baum-Welch over all training
    documents. base: the base model's probability of each class; unseen: that of an unknown word."""
    train = encoded.where("kind = 1 and not held_out").select("doc_id", "number", "classes")
    seeds = common.lowest(train.where("number between 20 and 2000"), SEED_ROWS, "doc_id").select("classes").collect()
    start, move, emit = _seeded([bytes(r[0]) for r in seeds], base, states)
    for _ in range(rounds):
        sent = common.arrow(train.select("classes"), _train(start, move, emit), common.VECTOR_SCHEMA)
        got = common.sum_vectors(sent, {"start": states, "move": states * states, "emit": emit.size})
        start = (got["start"] + 1) / (got["start"].sum() + states)
        moves = got["move"].reshape(states, states) + 1
        move = moves / moves.sum(1)[:, None]
        seen = got["emit"].reshape(emit.shape)
        emit = (seen + PRIOR * base[:, None]) / (seen.sum(0) + PRIOR)
        emit *= (1 - unseen) / (1 - emit[UNKNOWN])
        emit[UNKNOWN] = unseen
    return start, move, emit


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(total: float, vocabulary: int, end_count: int, base: np.ndarray, start, move, emit):
    below = np.log10(total + 0.5 * (vocabulary + 1))
    of_class = np.log10(base)

    def judge(batch: pa.RecordBatch, count: np.ndarray) -> pa.RecordBatch:
        rows = batch.num_rows
        blobs, ids = batch.column("classes").to_pylist(), batch.column("ids").to_pylist()
        flat, lengths = _sequences(blobs)
        last = np.cumsum(lengths) - 1
        inside = np.ones(len(flat), bool)
        inside[last] = False
        c = np.full(len(flat), end_count, np.int64)
        c[inside] = count[np.frombuffer(b"".join(ids), "<u4")]
        doc = np.repeat(np.arange(rows), lengths)
        single = np.log10(c + 0.5) - below
        known = c > 0
        within = np.where(known & inside, single - of_class[flat], 0.0)
        flat = np.where(known | ~inside, flat, UNKNOWN)
        chain = log_likelihood(flat, lengths, start, move, emit) / np.log(10)
        add = lambda x: np.bincount(doc, x, rows)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(lengths),
             pa.array(add(known).astype(np.int64)), pa.array(add(single)), pa.array(chain + add(within))],
            [x.split()[0] for x in SCORED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, count = None, np.zeros(0, np.int64)
        for batch in batches:
            block = batch.column("block").to_numpy()
            kind = batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])]))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                if block[a] != name:
                    name, count = block[a], np.zeros(0, np.int64)
                if kind[a] == 0:  # rows of the dictionary come sorted by number
                    count = np.concatenate([count, part.column("train").to_numpy(zero_copy_only=False)])
                    continue
                sizes = part.column("number").to_pylist()
                for i, j in _runs(sizes):
                    yield judge(part.slice(i, j - i), count)
    return run


def score_documents(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row of ``docs``."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    docs = docs.select("doc_id", "text", (F.crc32(name) % 5 == 1).alias("held_out"))
    encoded = common.stash(common.arrow(docs, _encode, ENCODED))
    everywhere = Window.partitionBy("word")
    words = common.stash(
        encoded.where("kind = 0").select("block", "number", "word", "class", "train")
        .withColumn("first", F.row_number().over(everywhere.orderBy("block")) == 1)
        .withColumn("train", F.sum("train").over(everywhere)).drop("word"))
    by_class = (words.where("first").groupBy("class").agg(F.sum("train").alias("n"), F.count_if(F.col("train") > 0).alias("v"),
                                                         F.count_if(F.col("train") == 1).alias("once"))
                .collect())  # CLASSES rows at most
    end_count = encoded.where("kind = 1 and not held_out").count()
    total = sum(r.n for r in by_class) + end_count
    vocabulary = sum(r.v for r in by_class) + (end_count > 0)
    base = np.zeros(CLASSES + 2)
    for r in by_class:
        base[r["class"]] = r.n + 0.5 * r.v
    base[UNKNOWN], base[END] = 0.5, end_count + 0.5 if end_count else 0.0
    base = np.maximum(base / (total + 0.5 * (vocabulary + 1)), 1e-300)
    if end_count:
        model = fit(encoded, base, max(base[UNKNOWN], sum(r.once for r in by_class) / (total + 1)), states, rounds)
    else:
        model = np.ones(1), np.ones((1, 1)), np.ones((CLASSES + 2, 1))
    meet = encoded.where("kind = 1").select("block", "kind", "number", "train", "doc_id", "held_out", "classes", "ids").unionByName(
        words.select("block", F.lit(0).alias("kind"), "number", "train"), allowMissingColumns=True)
    meet = meet.repartition("block").sortWithinPartitions("block", "kind", "number")
    task = _score(total, vocabulary, end_count, base, *model)
    return (common.arrow(meet, task, SCORED)
            .withColumn("train_tokens", F.lit(total).cast("long")))


def op7_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(common.read(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
