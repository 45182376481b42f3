"""Packing: order-preserving dynamic programming over document and sentence boundaries.

The token stream of a partition, in its stored order, is cut into windows of at most ``capacity`` ids.
Cuts may stand after a document (free), after a sentence (SENTENCE) or, where no boundary is near, inside
one (INSIDE). The cost of a plan is its padding plus the penalties of its cuts:

    f(i) = penalty(i) + min over j with P(i) - capacity <= P(j) of  f(j) + capacity - (P(i) - P(j))

The minimum slides over a window of positions, so a monotone queue gives every f(i) in constant time on
average. A window whose length is a power of two needs no padding; such transitions are looked up apart.
Cuts are settled about BLOCK ids at a time, with a run-out of RUNOUT windows kept back for the next block,
so a task holds one block and one document. Nothing is shuffled: each partition is packed where it is read
and only its last window can be short.

Null text counts as empty; every document ends with ``end_id``, so each row has a piece. Rows that share
a doc_id are separate documents.
"""

from __future__ import annotations

import base64
import functools
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import common

CAPACITY = 2048
END_ID = 1
SENTENCE = 4
INSIDE = 24
#: Without a boundary for GAP ids, cuts inside a sentence are offered every STEP ids.
GAP, STEP = 128, 32
BLOCK = 1 << 18
RUNOUT = 16
SPECIAL = "<|endoftext|>"

PIECES = "doc_id long, start long, doc_tokens long, sequence_id long, offset long, ids binary"


def _encoder(tokenizer: str, ranks: str):
    """Encode text to ids, and a table of the ids after which a sentence ends. The byte-level ranks
    give the tokenizer's ids; a text with its special token's string goes to the tokenizer itself. Built
    for each task, so that an idle worker holds none of it."""
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    @functools.cache
    def whole():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(tokenizer)

    def encode(text: str) -> list[int]:
        if SPECIAL in text:
            return whole().encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    ends = np.zeros(max(table.values()) + 2, bool)
    for word, number in table.items():
        ends[number] = word.endswith((b".", b"!", b"?", b"\n", "。".encode()))
    return encode, ends


def candidates(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places where a cut may stand (0 first) and their penalties."""
    sentence = np.flatnonzero(ends[ids]) + 1
    sentence = np.setdiff1d(sentence, doc_ends)
    firm = np.union1d(doc_ends, sentence)
    edges = np.concatenate([[0], firm, [len(ids)]])
    wide = np.flatnonzero(np.diff(edges) > GAP)
    loose = [np.arange(edges[k] + STEP, edges[k + 1], STEP) for k in wide]
    if last:  # a short rest may end in windows whose length is a power of two
        loose.append(np.arange(len(ids) - STEP, max(0, len(ids) - 2 * CAPACITY), -STEP))
    inside = np.setdiff1d(np.concatenate(loose) if loose else np.empty(0, np.int64), firm)
    place = np.concatenate([[0], doc_ends, sentence, inside])
    cost = np.concatenate([[0], np.zeros(len(doc_ends)), np.full(len(sentence), SENTENCE), np.full(len(inside), INSIDE)])
    order = np.argsort(place, kind="stable")
    place, cost = place[order], cost[order]
    keep = np.concatenate([[True], place[1:] != place[:-1]])
    return place[keep], cost[keep]


def plan(place: np.ndarray, cost: np.ndarray, capacity: int, last: bool) -> np.ndarray:
    """Best cuts, from place[0] to place[-1], or (not last) to the best place within one window of it."""
    exact: dict[int, list[int]] = {}
    size = 1
    while size < capacity:
        at = np.searchsorted(place, place - size)
        for i in np.flatnonzero((place[at] == place - size)).tolist():
            exact.setdefault(i, []).append(int(at[i]))
        size *= 2
    p, c = place.tolist(), cost.tolist()
    best, back = [0.0] * len(p), [0] * len(p)
    queue: deque[tuple[float, int]] = deque([(float(p[0]), 0)])  # f(j) + P(j), rising
    for i in range(1, len(p)):
        here = p[i]
        while p[queue[0][1]] < here - capacity:
            queue.popleft()
        low, j = queue[0]
        value = low + capacity - here
        for k in exact.get(i, ()):
            if best[k] < value:
                value, j = best[k], k
        value += c[i]
        best[i], back[i] = value, j
        key = value + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, i))
    i = len(p) - 1
    if not last:
        near = range(int(np.searchsorted(place, p[-1] - capacity)), len(p))
        i = min(near, key=lambda k: best[k] - p[k])
    cuts = [i]
    while i:
        i = back[i]
        cuts.append(i)
    return place[cuts[::-1]]


def _pack(tokenizer: str, ranks: str, capacity: int, end_id: int):
    def pieces(docs, stream, cuts, sequence):
        """Rows of the documents between the first and the last cut. docs: (doc_id, place of its
        first id in the stream, its ids)."""
        at = np.array([d[1] for d in docs])
        points = np.union1d(cuts, at[(at > cuts[0]) & (at < cuts[-1])])
        begin = points[:-1]
        doc = np.searchsorted(at, begin, "right") - 1
        window = np.searchsorted(cuts, begin, "right") - 1
        # points follow each other: their ids are one buffer. (pa.array of memoryviews would never let go of them)
        ids = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(((points - points[0]) * 4).astype(np.int32)),
                                                              pa.py_buffer(stream[points[0]:points[-1]].astype("<u4"))])
        columns = [
            pa.array([docs[k][0] for k in doc.tolist()], pa.int64()), pa.array(begin - at[doc]),
            pa.array([docs[k][2] for k in doc.tolist()], pa.int64()), pa.array(sequence + window),
            pa.array(begin - cuts[window]), ids]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in PIECES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ends = _encoder(tokenizer, ranks)
        sequence = TaskContext.get().partitionId() << 32
        docs: list[tuple] = []
        parts: list[np.ndarray] = []
        size = 0

        def settle(last: bool):
            nonlocal docs, parts, size, sequence
            stream = np.concatenate(parts)
            doc_ends = np.array([d[1] + d[2] for d in docs])
            place, cost = candidates(stream, doc_ends, ends, last)
            cuts = plan(place, cost, capacity, last)
            if not last:
                cuts = cuts[:max(2, len(cuts) - RUNOUT)]
            yield pieces(docs, stream, cuts, sequence)
            done = int(cuts[-1])
            sequence += len(cuts) - 1
            docs = [(d, at - done, n) for d, at, n in docs if at + n > done]
            parts, size = [stream[done:]], size - done

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                docs.append((doc_id, size, len(ids)))
                parts.append(np.array(ids, np.uint32))
                size += len(ids)
                if size >= BLOCK:
                    yield from settle(False)
        if size:
            yield from settle(True)
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document: where it starts in the document, the window it lies in, its place
    there, and its ids (little-endian unsigned 32-bit). A piece's length is that of ``ids`` over 4."""
    path = public_tokenizers.path
    task = _pack(tokenizer or str(path("byte_bpe_50k.json")), ranks or str(path("byte_bpe_50k.tiktoken")), capacity, end_id)
    return common.arrow(docs.select("doc_id", "text"), task, PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(common.read(spark, sf_dir, "documents")))
