"""License scans: MinHash bands over overlapping windows find templates, shingle containment confirms.

Templates are grouped by length into classes; a class has windows of as many five-word shingles as its
longest template may have, an eighth of that apart. A signature has one minimum per hash function and
each minimum is a band of its own. A template of n shingles whose class has windows of S < 2n meets its
best window with a similarity of at least 0.29 if 0.8 of its shingles are in the text, so at least one
of 64 bands collides with a probability above 1 - 1e-9. Only windows with a shingle of some template
can collide in any band, so only these get a signature.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.columns import chunks_of, put, text_buffer
from glyphmill.llm.word_hashes import IS_LETTER, LOWER, P2, P3, span_hashes, word_shingles, word_spans

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
BANDS = 64
# Every task holds all templates; more than this many bytes of them are refused.
MOST_TEMPLATE_BYTES = 32 << 20

# Public license notices.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0-header",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit-grant",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
)

IN_WORD = IS_LETTER.copy()
IN_WORD[ord("0") : ord("9") + 1] = True
SEEDS = np.arange(1, BANDS + 1, dtype=np.uint64) * P2


@dataclass(frozen=True)
class Templates:
    names: tuple[str, ...]
    shingles: tuple[np.ndarray, ...]
    signatures: np.ndarray
    classes: np.ndarray
    known: np.ndarray


def shingle_hashes(data: np.ndarray, bounds: np.ndarray):
    """Hash, text, start and end of each five-word shingle; words are letters and digits, A to Z as lower
    case, and a text of fewer words is one shingle."""
    lower = LOWER[data]
    starts, ends, text = word_spans(lower, bounds, IN_WORD[lower])
    words = span_hashes(lower, starts, ends)
    first, last = word_shingles(text, SHINGLE_WORDS)
    total = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for step in range(SHINGLE_WORDS):
            at = np.minimum(first + step, last)
            total = np.where(first + step <= last, (total ^ words[at]) * P3 + np.uint64(step), total)
        total ^= total >> np.uint64(32)
    return total, text[first], starts[first], ends[last]


def _signature(hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (hashes[:, None] ^ SEEDS) * P2
        return (mixed ^ mixed >> np.uint64(29)).min(axis=0)


def window_size(n: int) -> int:
    return 1 << max(0, (n - 1).bit_length())


def read_templates(texts: Sequence[tuple[str, str]]) -> Templates:
    """Signatures of templates; one without a word is left out."""
    if sum(len(t.encode()) for _, t in texts) > MOST_TEMPLATE_BYTES:
        raise ValueError(f"templates hold at most {MOST_TEMPLATE_BYTES} bytes")
    names, shingles = [], []
    for name, text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        hashes = np.unique(shingle_hashes(data, np.array([0, len(data)]))[0])
        if len(hashes):
            names.append(name)
            shingles.append(hashes)
    signatures = np.array([_signature(s) for s in shingles], np.uint64).reshape(-1, BANDS)
    classes = np.array([window_size(len(s)) for s in shingles], np.int64)
    known = np.unique(np.concatenate(shingles)) if shingles else np.zeros(0, np.uint64)
    return Templates(tuple(names), tuple(shingles), signatures, classes, known)


def _is_known(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def scan_text(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, templates: Templates, containment: float) -> list[dict]:
    """Templates in one text, given its shingles and where they start and end."""
    hits = np.flatnonzero(_is_known(hashes, templates.known))
    found: dict[tuple[int, int, int], float] = {}
    for size in np.unique(templates.classes).tolist() if len(hits) else []:
        step = max(1, size // 8)
        own = np.flatnonzero(templates.classes == size)
        # Windows that hold a hit; the last one may reach beyond the text.
        low = np.maximum(0, -(-(hits - size + 1) // step))
        windows = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(low, hits // step)])) * step
        for window in windows.tolist():
            collide = (templates.signatures[own] == _signature(hashes[window : window + size])).any(axis=1)
            for template in own[collide].tolist():
                wanted = templates.shingles[template]
                first = max(0, window - len(wanted))
                region = hashes[first : window + size + len(wanted)]
                inside = np.flatnonzero(_is_known(region, wanted))
                share = len(np.unique(region[inside])) / len(wanted)
                if share >= containment:
                    found[template, first + int(inside[0]), first + int(inside[-1])] = share
    matches: dict[int, dict] = {}
    for (template, first, last), share in sorted(found.items()):
        begin, end = int(starts[first]), int(ends[last])
        match = matches.setdefault(template, {"template_id": templates.names[template], "containment": 0.0, "spans": []})
        match["containment"] = max(match["containment"], share)
        spans = match["spans"]
        if spans and begin <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], end)
        else:
            spans.append({"start": begin, "end": end})
    return [matches[template] for template in sorted(matches)]


MATCH = "array<struct<template_id:string,containment:double,spans:array<struct<start:bigint,end:bigint>>>>"


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = NOTICES,
    text: str = "text",
    out: str = "licenses",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Add ``out``: for each template found in a text its id, the best containment and the byte spans.

    A template is found where ``containment`` of its distinct shingles lie in and around a window. NULL
    and empty texts, and texts without a match, get an empty array. Every row is looked at alone and
    whole, so repeated rows agree and no text or template is hot. Other columns stay, one named ``out``
    is replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_templates(templates))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    kind = pa.list_(pa.struct([("template_id", pa.string()), ("containment", pa.float64()), ("spans", pa.list_(span))]))

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = model.value
        for texts in batches:
            data, bounds = text_buffer(texts)
            rows: list[list] = [[] for _ in range(len(texts))]
            for i, j in chunks_of(bounds):
                hashes, text_of, starts, ends = shingle_hashes(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                for k in np.unique(text_of[_is_known(hashes, own.known)]).tolist():
                    a, b = np.searchsorted(text_of, [k, k + 1])
                    base = bounds[i + k] - bounds[i]
                    rows[i + k] = scan_text(hashes[a:b], starts[a:b] - base, ends[a:b] - base, own, containment)
            yield pa.array(rows, kind)

    return put(docs, {out: F.arrow_udf(scan, MATCH).asNondeterministic()(docs[f"`{text}`"])})
