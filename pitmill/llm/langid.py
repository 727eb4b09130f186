"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Texts are dealt into windows of ``SPAN`` bytes, the last one shorter. In each window one recurrent
layer reads forward and one backward, and a softmax labels every byte from both states. A text's
probabilities are the means over its letter bytes. The network is trained by backpropagation
through time on windows spread over a bounded sample of labelled texts.

Defined results: ``und`` with score 0 for a null text, one without a letter, or if there was
nothing to learn from; with one language to learn, that one; ties go to the smaller language name;
repeated rows are labelled alike; every byte of a long text counts; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.llm.sampling import first_by_hash
from pitmill.llm.workers import lean

SPAN, HIDDEN = 64, 8
#: At most so many texts of each language, each with so many windows, are learned from.
TRAIN_TEXTS, TRAIN_WINDOWS = 400, 4
#: Windows that a task runs at once.
ROWS = 4096
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    """For each direction: ``table`` (3H, 256) input gates of each byte with biases, ``loop`` (3H, H); ``out`` (K, 2H), ``bias``."""

    langs: list[str]
    table: list[np.ndarray]
    loop: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray


def _run(table: np.ndarray, loop: np.ndarray, data: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (steps, H, windows) of one direction over ``data`` (steps, windows)."""
    h = np.zeros((HIDDEN, data.shape[1]), np.float32)
    out = np.empty((len(data), HIDDEN, data.shape[1]), np.float32)
    gates, last = loop[: 2 * HIDDEN], loop[2 * HIDDEN :]
    for t, x in enumerate(data):
        given = np.take(table, x, axis=1)
        zr = given[: 2 * HIDDEN]
        zr += gates @ h
        np.tanh(zr, out=zr)  # the halves of a sigmoid's argument are in the weights
        zr *= 0.5
        zr += 0.5
        z, r = zr[:HIDDEN], zr[HIDDEN:]
        n = given[2 * HIDDEN :]
        rh = r * h
        n += last @ rh
        np.tanh(n, out=n)
        if keep is not None:
            keep.append((z.copy(), r.copy(), n.copy(), h, rh))
        h = n + z * (h - n)
        out[t] = h
    return out


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (windows, SPAN) with 0 beyond an end, windows of each text, and whether each byte is a letter."""
    count = np.array([-(-len(t) // SPAN) for t in texts])
    data = np.zeros(int(count.sum()) * SPAN, np.uint8)
    at = 0
    for t, n in zip(texts, count.tolist(), strict=True):
        data[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += n * SPAN
    data = _LOWER[data].reshape(-1, SPAN)
    return data, count, _LETTER[data]


def _logits(m: Model, f: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(K, steps, windows)"""
    return np.einsum("kh,thw->ktw", m.out[:, :HIDDEN], f, optimize=True) + np.einsum("kh,thw->ktw", m.out[:, HIDDEN:], b, optimize=True) + m.bias[:, None, None]


def label_bytes(m: Model, data: np.ndarray) -> np.ndarray:
    """Probability (K, SPAN, windows) of each language at each byte of ``data`` (SPAN, windows)."""
    f = _run(m.table[0], m.loop[0], data)
    b = _run(m.table[1], m.loop[1], data[::-1])[::-1]
    k = len(m.langs)
    p = np.empty((k, *data.shape), np.float32)
    for t in range(len(data)):
        p[:, t] = m.out[:, :HIDDEN] @ f[t] + m.out[:, HIDDEN:] @ b[t]
    p += m.bias[:, None, None]
    p -= p.max(axis=0)
    np.exp(p, out=p)
    p /= p.sum(axis=0)
    return p


def text_probabilities(m: Model, texts: list[bytes]) -> np.ndarray:
    """Mean over its letters (texts, K); zeros for a text without any."""
    out = np.zeros((len(texts), len(m.langs)))
    done = 0
    while done < len(texts):  # as many texts as make about 2**20 bytes; long ones in parts
        size, end = 0, done
        while end < len(texts) and (size == 0 or size + len(texts[end]) <= 1 << 20):
            size += len(texts[end])
            end += 1
        data, count, letter = _windows(texts[done:end])
        sums, letters = np.zeros((len(data), len(m.langs))), letter.sum(axis=1)
        for lo in range(0, len(data), ROWS):
            p = label_bytes(m, np.ascontiguousarray(data[lo : lo + ROWS].T))
            p *= letter[lo : lo + ROWS].T[None]
            sums[lo : lo + ROWS] = p.sum(axis=1).T
        own = np.repeat(np.arange(done, end), count)
        np.add.at(out, own, sums)
        total = np.zeros(len(texts))
        np.add.at(total, own, letters)
        out[done:end] /= np.maximum(total[done:end, None], 1)
        done = end
    return out


def train(windows: list[bytes], y: np.ndarray, langs: list[str], epochs: int = 12, seed: int = 11) -> Model:
    """Adam over backpropagation through time; the label of a byte is its text's."""
    rng = np.random.default_rng(seed)
    h3 = 3 * HIDDEN
    new = lambda *s: (rng.standard_normal(s) * (0.3 if s[-1] == 256 else 0.35)).astype(np.float32)
    m = Model(langs, [new(h3, 256), new(h3, 256)], [new(h3, HIDDEN), new(h3, HIDDEN)], new(len(langs), 2 * HIDDEN), np.zeros(len(langs), np.float32))
    if len(langs) < 2:
        return m
    params = [*m.table, *m.loop, m.out, m.bias]
    mean, square, turn = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    data = np.zeros((len(windows), SPAN), np.uint8)
    for i, w in enumerate(windows):
        data[i, : len(w)] = np.frombuffer(w[:SPAN], np.uint8)
    data = _LOWER[data]
    letter = _LETTER[data]
    batch = 128
    steps = epochs * -(-len(data) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for lo in range(0, len(data), batch):
            rows = order[lo : lo + batch]
            x, mask, label = np.ascontiguousarray(data[rows].T), letter[rows].T, y[rows]
            held: list[list] = [[], []]
            f = _run(m.table[0], m.loop[0], x, held[0])
            b = _run(m.table[1], m.loop[1], x[::-1], held[1])[::-1]
            p = _logits(m, f, b)
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            p[label, :, np.arange(len(rows))] -= 1
            p *= mask / max(1, mask.sum())
            d_out = np.concatenate((np.einsum("ktw,thw->kh", p, f, optimize=True), np.einsum("ktw,thw->kh", p, b, optimize=True)), axis=1)
            grads = [None, None, None, None, d_out, p.sum(axis=(1, 2))]
            for side, xs in ((0, x), (1, x[::-1])):
                d_h_all = np.einsum("kh,ktw->thw", m.out[:, side * HIDDEN : (side + 1) * HIDDEN], p, optimize=True)
                if side:
                    d_h_all = d_h_all[::-1]
                loop = m.loop[side]
                d_table, d_loop = np.zeros_like(m.table[side]), np.zeros_like(loop)
                d_h = np.zeros((HIDDEN, len(rows)), np.float32)
                for t in range(SPAN - 1, -1, -1):
                    z, r, n, before, rh = held[side][t]
                    d_h = d_h + d_h_all[t]
                    d_n = d_h * (1 - z) * (1 - n * n)
                    d_z = d_h * (before - n) * z * (1 - z) * 2
                    d_rh = loop[2 * HIDDEN :].T @ d_n
                    d_r = d_rh * before * r * (1 - r) * 2
                    d_given = np.concatenate((d_z, d_r, d_n))
                    d_loop[: 2 * HIDDEN] += d_given[: 2 * HIDDEN] @ before.T
                    d_loop[2 * HIDDEN :] += d_n @ rh.T
                    d_h = d_h * z + d_rh * r + loop[: 2 * HIDDEN].T @ d_given[: 2 * HIDDEN]
                    np.add.at(d_table.T, xs[t], d_given.T)
                grads[side], grads[2 + side] = d_table, d_loop
            turn += 1
            rate = 0.03 * (1 - turn / (steps + 1)) + 0.001
            for i, (par, g) in enumerate(zip(params, grads, strict=True)):
                g = np.clip(g, -1, 1)
                mean[i] = 0.9 * mean[i] + 0.1 * g
                square[i] = 0.99 * square[i] + 0.01 * g * g
                par -= rate * (mean[i] / (1 - 0.9**turn)) / (np.sqrt(square[i] / (1 - 0.99**turn)) + 1e-6)
    return m


def fit_languages(docs: DataFrame, learn: F.Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts: int = TRAIN_TEXTS, windows: int = TRAIN_WINDOWS) -> Model:
    """Learn from at most ``texts`` ids of each language and ``windows`` stretches of ``SPAN`` bytes of each, spread evenly over its text, of those that ``learn`` (a condition on ``doc_id``) allows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null and doc_id is not null and text is not null and length(text) > 0")
    if learn is not None:
        rows = rows.where(learn)
    keys = first_by_hash(rows.select("doc_id", "lang").distinct(), "lang", "doc_id", texts)
    size = F.length("text")
    places = F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), lambda j: F.substring(F.col("text"), (1 + F.greatest(size - SPAN, F.lit(0)) * j / max(1, windows - 1)).cast("int"), F.lit(SPAN)))
    # one text for an id, however often it is repeated
    one = rows.join(F.broadcast(keys), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    got = one.select("doc_id", "lang", F.explode(F.array_distinct(places)).alias("w")).select("doc_id", "lang", F.col("w").cast("binary").alias("w")).collect()
    got = sorted((r["lang"], r["doc_id"], bytes(r["w"])[:SPAN]) for r in got)
    langs = sorted({g[0] for g in got})
    return train([g[2] for g in got], np.array([langs.index(g[0]) for g in got], int), langs)


def _label(model: Model, texts: list[bytes], letters: list[bool]) -> tuple[list[str], list[float]]:
    p = text_probabilities(model, [t if ok else b"" for t, ok in zip(texts, letters, strict=True)]) if model.langs else np.zeros((len(texts), 1))
    best = p.argmax(axis=1)
    known = [bool(ok) and bool(model.langs) for ok in letters]
    return [model.langs[b] if ok else "und" for b, ok in zip(best, known, strict=True)], [float(min(1.0, p[i, b])) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, known, strict=True))]


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of parameters a language

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = _label(held.value, [x or b"" for x in batch.column(1).to_pylist()], batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    has_letter = F.coalesce(F.rlike(F.col(text_col), F.lit(r"\p{L}")), F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), has_letter.alias("letter"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = 0.4) -> DataFrame:
    """Pipeline stage: the rows whose language is identified with a score of at least ``least``, with their columns.

    Rows that are ``und`` or below it go. The label is added and filtered in one pass, without a join.
    """
    model = fit_languages(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(x or "").encode() for x in batch.column(at).to_pylist()]
            lang, score = _label(held.value, texts, batch.column(batch.num_columns - 1).to_pylist())
            keep = pa.array([x != "und" and s >= least for x, s in zip(lang, score, strict=True)], pa.bool_())
            yield batch.select(list(range(batch.num_columns - 1))).filter(keep)

    has_letter = F.coalesce(F.rlike(F.col(text_col), F.lit(r"\p{L}")), F.lit(False)).alias(max(docs.columns, key=len) + "_")  # a name that no column has
    return docs.select("*", has_letter).mapInArrow(run, docs.schema)
