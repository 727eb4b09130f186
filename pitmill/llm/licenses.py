"""Licence scans: a sparse word n-gram logistic regression over paragraphs, confirmed by templates.

Paragraphs end at blank lines; a notice wrapped over lines is one paragraph. A paragraph is judged in windows of
``WINDOW`` words, one every ``STEP`` words (no template is longer than ``STEP``, so each lies whole in a window), and by its
lines of up to ``WINDOW`` words. The features of a window are its words and word pairs, scaled by the
root of their number; those that the training windows do not hold have no weight. The classes are the licence families of ``TEMPLATES`` and ``none``. The model
is trained on the templates with words dropped and others put around them, and on a bounded
sample of the corpus' own windows that no template resembles (those that a first fit takes for a licence are left out of the second).

A class of its own is calibrated for what the families don't cover. A window speaks of a licence where the probability of all families
together is half way or more from the most that windows of the corpus reach that were kept from the fit to 1, and of a known family where
that of its best one is above what most families reach in models fitted without them, and nearly all keep in the model with them. A predicted family is
confirmed if one of its templates' word pairs are held to ``CONFIRM`` or more and no other family's more; a window that speaks of a licence
without that is ``unknown`` if it holds any word pair of a template. Of a paragraph's confirmed windows the best of each family counts, of its unknown ones
the surest of each stretch that overlaps no confirmed one.

Defined results: null, blank and wordless texts give no rows; repeated rows give their findings
each; a null id is kept; every word of a long text counts; ties go to the first window; with no corpus to learn from, windows
of licence words alone are learned against a few words; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.llm import wordvec
from pitmill.llm.sampling import first_by_hash
from pitmill.llm.workers import lean

#: The usual short notices of public licence families.
TEMPLATES = {
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License."],
    "Apache": ["Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "SPDX-License-Identifier: Apache-2.0"],
    "BSD": ["Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.", "SPDX-License-Identifier: MIT"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."],
    "public-domain": ["This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0)."],
    "reserved": ["All rights reserved.", "Copyright (c) 2024. All rights reserved."],
}
SLOTS = 1 << 20
WINDOW, STEP = 56, 28
#: At most so many windows of the corpus, of at most so many bytes each, of the documents first in a hash order, are learned from as ``none``.
NEGATIVE_DOCS, NEGATIVES, NEGATIVE_BYTES = 300, 4000, 4096
VARIANTS, CONFIRM, CALIBRATED = 40, 0.6, 0.98
_BLANK = re.compile(rb"\n[ \t\r\f\v]*\n")


@dataclass
class Model:
    families: list[str]  # the last is none
    features: tuple[np.ndarray, np.ndarray]
    weight: np.ndarray  # (features, K), the first row zero
    bias: np.ndarray
    least: float  # of the best family's probability
    gate: float  # of all families' probability


def words_of(line: str) -> list[str]:
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", line.lower())


def _pairs(word: np.ndarray) -> np.ndarray:
    return wordvec.mix(word[:-1] * np.uint64(3) + word[1:])


def _vocabulary(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each slot the upper half of a feature's hash, and the feature's row; of features with one slot the most frequent has it."""
    value, count = np.unique(hashes, return_counts=True)
    value = value[np.argsort(count, kind="stable")]
    upper, row = np.zeros(SLOTS, np.uint32), np.zeros(SLOTS, np.int32)
    at = (value % np.uint64(SLOTS)).astype(np.int64)
    upper[at], row[at] = (value >> np.uint64(32)).astype(np.uint32), np.arange(1, len(value) + 1)
    return upper, row


def _rows(features: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Weight rows of feature hashes; 0 for those that are none."""
    at = (hashes % np.uint64(SLOTS)).astype(np.int64)
    return np.where(features[0][at] == (hashes >> np.uint64(32)).astype(np.uint32), features[1][at], 0)


def _features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(feature hash, line) of all words and pairs."""
    word, own = wordvec.hashes(lines)
    pair = np.flatnonzero(own[1:] == own[:-1])
    both = _pairs(word)[pair] if len(word) > 1 else np.empty(0, np.uint64)
    return np.concatenate((word, both)), np.concatenate((own, own[pair]))


def _soft(y: np.ndarray) -> np.ndarray:
    y = np.exp(y - y.max(axis=1, keepdims=True, initial=-np.inf)) if len(y) else y
    return y / y.sum(axis=1, keepdims=True)


def probabilities(m: Model, lines: list[bytes]) -> np.ndarray:
    """Of each class for each line, taken as one window."""
    f, own = _features(lines)
    order = np.argsort(own, kind="stable")
    f, own = f[order], own[order]
    y = np.tile(m.bias, (len(lines), 1)).astype(np.float64)
    live, first, n = np.unique(own, return_index=True, return_counts=True)
    if len(live):
        y[live] += np.add.reduceat(m.weight[_rows(m.features, f)].astype(np.float64), first, axis=0) / np.sqrt(n)[:, None]
    return _soft(y)


def similarity(line: str, template: str) -> float:
    """Share of the template's word pairs that the line holds (single words, for a template of one)."""
    a, b = words_of(line), words_of(template)
    pairs = lambda w: set(zip(w, w[1:], strict=False)) if len(b) > 1 else set(w)
    return len(pairs(a) & pairs(b)) / max(1, len(pairs(b)))


def _fit(lines: list[bytes], y: np.ndarray, k: int, epochs: int = 12) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
    """Multinomial logistic regression, Adagrad over all lines in batches; the families weigh alike, and the last class as much as all of them."""
    f, own = _features(lines)
    features = _vocabulary(f)
    f = _rows(features, f)
    weight, bias = np.zeros((int(features[1].max()) + 1, k), np.float32), np.zeros(k, np.float32)
    square, bias_square = np.full(weight.shape, 1e-3, np.float32), np.full(k, 1e-3, np.float32)
    order = np.argsort(own, kind="stable")
    f, own = f[order], own[order]
    cut = np.searchsorted(own, np.arange(len(lines) + 1))
    scale = 1 / np.sqrt(np.maximum(1, np.diff(cut)))
    share = np.bincount(y, minlength=k) / len(y)
    each = np.where(share > 0, np.minimum(4, 1 / (2 * np.maximum(share, 1e-9) * np.append(np.full(k - 1, k - 1), 1))), 0)
    rng = np.random.default_rng(2)
    for _ in range(epochs):
        perm = rng.permutation(len(lines))
        for lo in range(0, len(perm), 64):
            rows = perm[lo : lo + 64]
            feats = np.concatenate([f[cut[r] : cut[r + 1]] for r in rows])
            at = np.repeat(np.arange(len(rows)), np.diff(cut)[rows])
            n = np.diff(cut)[rows]
            z = np.zeros((len(rows), k), np.float32)
            z[n > 0] = np.add.reduceat(weight[feats], (np.cumsum(n) - n)[n > 0], axis=0)
            z = z * scale[rows][:, None] + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= (each[y[rows]] / len(rows))[:, None]
            order = np.argsort(feats, kind="stable")
            feats = feats[order]
            first = np.flatnonzero(np.append(True, feats[1:] != feats[:-1]))
            u, g = feats[first], np.add.reduceat((p * scale[rows][:, None])[at[order]], first, axis=0).astype(np.float32)
            square[u] += g * g
            weight[u] -= 0.3 * g / np.sqrt(square[u])
            weight[0] = 0
            d = p.sum(axis=0)
            bias_square += d * d
            bias -= 0.1 * d / np.sqrt(bias_square)
    return features, weight, bias


def train(negatives: list[str], seed: int = 9) -> Model:
    """Fit on variants of the templates and the negative windows, and calibrate what is unknown."""
    rng = np.random.default_rng(seed)
    families = sorted(TEMPLATES)
    filler = [w for line in negatives[:400] for w in line.split()] or ["text"]
    lines, y = [], []
    for k, name in enumerate(families):
        for t in TEMPLATES[name]:
            for j in range(VARIANTS):
                w = t.split()
                if j:
                    w = [x for x in w if rng.random() > 0.08] or w
                    room = max(1, WINDOW - len(w))
                    before = int(rng.integers(0, room)) if rng.random() < 0.6 else 0
                    after = int(rng.integers(0, room - before)) if before < room else 0
                    w = [*rng.choice(filler, before), *w, *rng.choice(filler, after)]
                lines.append(" ".join(w).encode())
                y.append(k)
    k = len(families) + 1
    none = [n for n in negatives if words_of(n)]
    quiet, none = none[::4], [*(n for k_, n in enumerate(none) if k_ % 4), "the of and"]  # a part of them is for the gate alone
    for turn in range(2):
        every, label = lines + [n.encode() for n in none], np.array(y + [k - 1] * len(none))
        m = Model([*families, "none"], *_fit(every, label, k, epochs=3 if turn == 0 else 12), 0.0, 0.5)
        if turn == 0:
            sure = probabilities(m, every[len(lines) :])[:, -1] >= 0.5
            none = [n for n, ok in zip(none, sure, strict=True) if ok] or none
            quiet = [n for n, ok in zip(quiet, probabilities(m, [n.encode() for n in quiet])[:, -1] >= 0.5, strict=True) if ok] if quiet else []
    positive = np.flatnonzero(label < k - 1)
    left_in = probabilities(m, [every[i] for i in positive])[np.arange(len(positive)), label[positive]]
    spread = []  # the best family's probability for windows of families that a model has not seen
    for out in range(0, k - 1, 3):
        unseen = np.isin(label, np.arange(out, min(out + 3, k - 1)))
        w = Model(m.families, *_fit([every[i] for i in np.flatnonzero(~unseen)], label[~unseen], k, epochs=4), 0.0, 0.5)
        spread.append(probabilities(w, [every[i] for i in np.flatnonzero(unseen)[::7]])[:, :-1].max(axis=1))
    grid = np.linspace(0.3, 0.95, 66)
    kept = np.array([(left_in >= g).mean() for g in grid])
    taken = np.array([(np.concatenate(spread) >= g).mean() for g in grid])
    allowed = kept >= CALIBRATED
    m.least = float(grid[np.argmin(np.where(allowed, taken, 2))]) if allowed.any() else 0.3
    reached = float((1 - probabilities(m, [n.encode() for n in quiet])[:, -1]).max()) if quiet else 0.0
    m.gate = (max(0.5, reached) + 1) / 2  # half way from the most that a clean window reaches
    return m


def _text_words(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, word hashes, where each word begins, where it ends) of each text, whole, in order."""
    parts: list[tuple[np.ndarray, ...]] = []
    last, done = -1, 0

    def whole() -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    for own, pieces in wordvec.batches(texts):
        word, piece, begin, end = wordvec.hashes(pieces, places=True)
        cuts = np.searchsorted(piece, np.arange(len(pieces) + 1))
        start = 0
        for k, i in enumerate(own):
            if i != last and last >= 0:
                yield last, *whole()
            if i != last:
                parts, done = [], 0
            last, at = i, slice(cuts[k], cuts[k + 1])
            parts.append((word[at], begin[at] - start + done, end[at] - start + done))
            start += len(pieces[k]) + 1
            done += len(pieces[k])
    if last >= 0:
        yield last, *whole()


def windows(text: bytes, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last, paragraph, line) of all windows of a text, paragraphs and lines from 0."""
    breaks = np.array([b.start() for b in _BLANK.finditer(text)], np.int64)
    line = np.searchsorted(np.flatnonzero(np.frombuffer(text, np.uint8) == 10), begin)
    paragraph = np.searchsorted(breaks, begin)
    new = lambda x: np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    first = new(paragraph)
    n = np.diff(np.append(first, len(begin)))
    count = np.maximum(1, -(-(n - WINDOW) // STEP) + 1)
    a = np.repeat(first, count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * STEP
    b = np.minimum(a + WINDOW, np.repeat(first + n, count))
    line_first = new(line)
    line_end = np.append(line_first[1:], len(begin))
    own = (line_end - line_first <= WINDOW) & ~np.isin(line_first * (len(begin) + 1) + line_end, a * (len(begin) + 1) + b)
    a, b = np.concatenate((a, line_first[own])), np.concatenate((b, line_end[own]))
    return a, b, paragraph[a], line[a]


def window_logits(m: Model, word: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logits of windows ``a`` to ``b`` of a text's words, from running sums of the weights."""
    zero = np.zeros((1, m.weight.shape[1]))
    single = np.concatenate((zero, np.cumsum(m.weight[_rows(m.features, word)], axis=0, dtype=np.float64)))
    double = np.concatenate((zero, np.cumsum(m.weight[_rows(m.features, _pairs(word))], axis=0, dtype=np.float64))) if len(word) > 1 else zero
    return (single[b] - single[a] + double[b - 1] - double[a]) / np.sqrt(2 * (b - a) - 1)[:, None] + m.bias


def judge(m: Model, text: bytes, word: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int, str, float, float, str]]:
    """(paragraph, line, family, probability, similarity, status) of what speaks of a licence in a text; paragraphs and lines from 1."""
    a, b, paragraph, line = windows(text, begin)
    p = _soft(window_logits(m, word, a, b))
    best = p[:, :-1].argmax(axis=1)
    odds, all_families = p[np.arange(len(a)), best], 1 - p[:, -1]
    sure: dict[tuple[int, str], tuple] = {}
    open_: list[int] = []
    covered: list[tuple[int, int]] = []
    for i in np.flatnonzero((odds >= m.least) | (all_families >= m.gate)).tolist():
        part = text[begin[a[i]] : end[b[i] - 1]].decode("utf-8", "replace")
        name = m.families[best[i]]
        alike = {f: max(similarity(part, t) for t in ts) for f, ts in TEMPLATES.items()}
        if odds[i] >= m.least and alike[name] >= CONFIRM and alike[name] >= max(alike.values()):
            covered.append((int(a[i]), int(b[i])))
            found = (alike[name], float(odds[i]), -i)
            key = (int(paragraph[i]), name)
            if key not in sure or found > sure[key][0]:
                sure[key] = (found, int(line[i]))
        elif all_families[i] >= m.gate and max(alike.values()) > 0:
            open_.append(i)
    out = [(k[0] + 1, at + 1, k[1], found[1], found[0], "confirmed") for k, (found, at) in sure.items()]
    for i in sorted(open_, key=lambda i: (-all_families[i], i)):
        if all(b[i] <= lo or a[i] >= hi for lo, hi in covered):
            covered.append((int(a[i]), int(b[i])))
            part = text[begin[a[i]] : end[b[i] - 1]].decode("utf-8", "replace")
            alike = max(similarity(part, t) for ts in TEMPLATES.values() for t in ts)
            out.append((int(paragraph[i]) + 1, int(line[i]) + 1, "unknown", float(all_families[i]), alike, "unconfirmed"))
    return sorted(out)


def fit_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train with windows of at most ``NEGATIVE_DOCS`` documents of the corpus, at most ``NEGATIVES``."""
    rows = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("k"), F.col(text_col).cast("binary").alias("text"), F.lit(0).alias("all")).where("text is not null")
    first = first_by_hash(rows, "all", "k", NEGATIVE_DOCS)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = batch.column(0).to_pylist(), []
            for i, word, begin, end in _text_words(texts):
                if len(word):
                    a, b, *_ = windows(texts[i], begin)
                    out += [texts[i][x:y].decode("utf-8", "replace") for x, y in zip(begin[a], end[b - 1], strict=True) if y - x <= NEGATIVE_BYTES]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["part"])

    parts = first.select("text").mapInArrow(run, "part string").select(F.xxhash64("part").alias("h"), "part").distinct().orderBy("h", "part").limit(NEGATIVES)
    templates = [t for ts in TEMPLATES.values() for t in ts]
    return train([r["part"] for r in parts.collect() if max(similarity(r["part"], t) for t in templates) < 0.3])


def find_licenses(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, paragraph, line, family, probability, similarity, status)`` of every paragraph's licences."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of parameters

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, found = batch.column(0).to_pylist(), [x or b"" for x in batch.column(1).to_pylist()], []
            for i, word, begin, end in _text_words(texts):
                if len(word):
                    found += [(ids[i], *row) for row in judge(held.value, texts[i], word, begin, end)]
            cols = list(zip(*found, strict=True)) or [()] * 7
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "paragraph", "line", "family", "probability", "similarity", "status"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, paragraph long, line long, family string, probability double, similarity double, status string")
