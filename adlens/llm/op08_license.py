"""License scans by conditional compression.

A document's text is cut into sentences (a line break ends one, too). Each sentence with a cue word is a candidate
block, and for each template so is that sentence with the whole sentences around it, as many as the template may
reach to either side. A block is compressed by zstandard alone and with the template as raw dictionary; where that saves
MIN_SAVED of the block or of the template, the two are compared word by word: a template is confirmed if a part of the
block has at least MIN_WORDING of its words in their order, and the differences (words missing, words put in between)
are reported. What lies before and after a confirmed part is compared again, so one block can hold several notices.
Of confirmed parts that overlap, the one with most words of its template counts.

Null text has no blocks. Whole texts are scanned; rows that share a doc_id are scanned one by one. Nothing is
shuffled: the templates are a parameter and travel with the task.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import common

# Public notices by which texts and files are licensed, as (license, wording).
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
]
CUES = ("licen", "copyright", "permission is hereby", "redistribut", "creative commons", "public domain", "warrant", "spdx")
MIN_SAVED = 0.25
MIN_WORDING = 0.9
_LOWER = {c: c + 32 for c in range(65, 91)}
_END = re.compile(r"[.!?]+(?=\s)|\n")
_WORD = re.compile(r"\w+(?:[-.]\w+)*")

FOUND = "doc_id long, start long, length long, license string, saved double, missing long, added long, notice string"


def sentences(text: str) -> list[tuple[int, int]]:
    out, at = [], 0
    for m in _END.finditer(text):
        out.append((at, m.end()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@functools.lru_cache(maxsize=4)
def _compressors(templates: tuple):
    options = zstandard.ZstdCompressionParameters.from_level(
        9, write_content_size=False, write_checksum=False, write_dict_id=False)
    alone = zstandard.ZstdCompressor(compression_params=options)
    with_one = [zstandard.ZstdCompressor(compression_params=options, dict_data=zstandard.ZstdCompressionDict(
        text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for _, text in templates]
    return alone, with_one, [_words(text) for _, text in templates], [len(alone.compress(t.encode())) for _, t in templates]


def aligned(own: list[str], want: list[str]) -> Iterator[tuple[int, int, int]]:
    """First word, word after the last, and words in common of every part of ``own`` that has the wording ``want``."""
    todo = [(0, len(own))]
    while todo:
        a, b = todo.pop()
        if b - a < MIN_WORDING * len(want):
            continue
        same = [m for m in SequenceMatcher(None, own[a:b], want, autojunk=False).get_matching_blocks() if m.size]
        best = None
        for i in range(len(same)):  # without words that only happen to stand before or after it
            hits = 0
            for m in same[i:]:
                hits += m.size
                added = m.a + m.size - same[i].a - hits
                if added > (1 - MIN_WORDING) * len(want):
                    break
                if hits >= MIN_WORDING * len(want) and (best is None or (hits, -added) > best[0]):
                    best = (hits, -added), a + same[i].a, a + m.a + m.size
        if best:
            yield best[1], best[2], best[0][0]
            todo += [(a, best[1]), (best[2], b)]


def scan(text: str, templates: tuple) -> list[tuple[int, int, str, float, int, int]]:
    """Start, length, license, share saved, words missing and words added of every notice in a text, in its order."""
    low = text.lower()
    if not any(c in low for c in CUES):
        return []
    low = text.translate(_LOWER)  # keeps every place
    spans = sentences(text)
    cued = [k for k, (a, b) in enumerate(spans) if any(c in low[a:b] for c in CUES)]
    alone, with_one, wording, sizes = _compressors(templates)
    places = [m.span() for m in _WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in places]
    first = np.searchsorted([a for a, _ in places], [a for a, _ in spans] + [len(text)]).tolist()

    def saved(a: int, b: int, k: int) -> tuple[int, int]:
        raw = text[a:b].encode("utf-8", "replace")
        size = len(alone.compress(raw))
        return size - len(with_one[k].compress(raw)), size

    found = {}
    for k, want in enumerate(wording):
        reach = len(want) + math.ceil((1 - MIN_WORDING) * len(want))
        blocks = {(c, c + 1) for c in cued}
        for c in cued:
            lo, hi = c, c + 1
            while lo and first[c] - first[lo] < reach:
                lo -= 1
            while hi < len(spans) and first[hi] - first[c + 1] < reach:
                hi += 1
            blocks.add((lo, hi))
        for lo, hi in sorted(blocks):
            i, j = first[lo], first[hi]
            if j - i < MIN_WORDING * len(want):
                continue
            less, size = saved(spans[lo][0], spans[hi - 1][1], k)
            if less < MIN_SAVED * min(size, sizes[k]):
                continue
            for a, b, hits in aligned(words[i:j], want):
                a, b = a + i, b + i
                found[a, b, k] = hits
    kept = []
    ranked = []
    for (a, b, k), hits in found.items():
        start, end = places[a][0], places[b - 1][1]
        less, size = saved(start, end, k)
        ranked.append((-hits, len(wording[k]) - hits, b - a - hits, -less / size, a, b, k))
    for hits, missing, added, share, a, b, k in sorted(ranked):
        if -share >= MIN_SAVED and all(b <= c or d <= a for c, d, *_ in kept):
            kept.append((a, b, templates[k][0], -share, missing, added))
    return [(places[a][0], places[b - 1][1] - places[a][0], *rest) for a, b, *rest in sorted(kept)]


def _scan(templates: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                rows += [(doc_id, *found, text[found[0]:found[0] + found[1]]) for found in scan(text, templates)]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 8, kinds, strict=True)],
                [x.split()[0] for x in FOUND.split(", ")])
    return run


def license_blocks(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per confirmed notice: where it is (code points), its license, the share of its compressed size that
    the template saves, and how its wording differs."""
    return common.arrow(docs.select("doc_id", "text"), _scan(tuple(templates)), FOUND)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_blocks(common.read(spark, sf_dir, "documents")).withColumn("saved", F.round("saved", 6))
