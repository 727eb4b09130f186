"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of two hashed ones, of the whole word and of its first bytes (so that
inflected forms share one). Filters of several widths run over the words, each filter keeps its
largest value over the text, and a logistic layer makes a logit of them. One embedding component
starts at the log-odds of a bucket in the training texts, which shows the filters where to look.

Thresholds are calibrated by language on rows left out of the fit: the language is guessed from the
text (word-start buckets, naive Bayes), and the logit that divides the labels best in it becomes
score 0.5. The threshold of a language lies between its own and that of all rows, nearer to its own
the more rows of its rarer label there are.

What is learned from is bounded in rows and bytes: of each label the ``TRAIN_ROWS`` first ids by a hash, in that order
as many as have ``TRAIN_BYTES`` of text together (a longer text is passed over), one text for an id.

Defined results: null and blank texts are scored as texts without words; a text beyond 1 MiB is read in
pieces, each with the last words of the one before, so that filters span the cuts; without two
classes to learn from every score is the share of label 1; repeated rows are scored alike; rows with
a null id are scored and never learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.llm import wordvec
from pitmill.llm.sampling import first_by_hash
from pitmill.llm.workers import lean
from pitmill.plans.staging import stage

WORDS, STARTS, PREFIX = 1 << 15, 1 << 13, 4
#: (width, filters)
FILTERS = ((1, 24), (2, 12), (3, 12))
DIM = 12
#: At most so many labelled rows of each label are learned from, in the order of a hash of the id.
TRAIN_ROWS, TRAIN_BYTES = 3000, 32 << 20
#: So many calibration rows of its rarer label weigh a language's own threshold as much as the common one.
HALF_WEIGHT = 10


@dataclass
class Model:
    word: np.ndarray
    start: np.ndarray
    filters: list[np.ndarray]  # (width * DIM, n)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    lang: np.ndarray  # log-probability of a start bucket by language
    threshold: np.ndarray
    slope: float
    constant: float | None = None


def _buckets(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word, own, start = wordvec.hashes(pieces, PREFIX)
    return (word % np.uint64(WORDS)).astype(np.int32), (start % np.uint64(STARTS)).astype(np.int32), own


def _pooled(model: Model, w: np.ndarray, s: np.ndarray, own: np.ndarray, n: int, arg: bool = False, left: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Largest value of each filter over each of ``n`` texts (0: none), and with ``arg`` the rows of words, and where.

    ``left``: so many last words of each text start no filter.
    """
    pad = max(width for width, _ in FILTERS) - 1
    at = np.arange(len(w)) + pad * own
    rows = np.zeros((len(w) + pad * n, DIM), np.float32)
    rows[at] = model.word[w] + model.start[s]
    live = np.unique(own)
    begin = np.searchsorted(own, live)
    begin = at[begin]
    end = np.append(begin[1:], len(rows))
    pooled, where = [], []
    real = np.zeros(len(rows), bool)
    real[at] = True if left is None else np.searchsorted(own, own, "right") - np.arange(len(own)) > left[own]
    for (width, count), f, b in zip(FILTERS, model.filters, model.bias, strict=True):
        value = np.zeros((len(rows), count), np.float32)
        for o in range(width):
            value[: len(rows) - o] += rows[o:] @ f[o * DIM : (o + 1) * DIM]
        value += b
        value[~real] = 0
        np.maximum(value, 0, out=value)
        top = np.zeros((n, count), np.float32)
        if len(live):
            top[live] = np.maximum.reduceat(value, begin, axis=0)
        pooled.append(top)
        if arg:
            place = np.zeros((n, count), np.int64)
            for i, (lo, hi) in enumerate(zip(begin, end, strict=True)):
                place[live[i]] = lo + np.argmax(value[lo:hi], axis=0)
            where.append(place)
    return (np.concatenate(pooled, axis=1), rows, where, at) if arg else (np.concatenate(pooled, axis=1),)


def _log_odds(buckets: list[np.ndarray], y: np.ndarray, n: int) -> np.ndarray:
    """Of the buckets that a text has, by label; shrunk to 0 where few texts have one."""
    has = [np.zeros(n), np.zeros(n)]
    for b, label in zip(buckets, y, strict=True):
        has[label][np.unique(b)] += 1
    p = [(h + 0.5) / (max(1, (y == k).sum()) + 1) for k, h in enumerate(has)]
    seen = has[0] + has[1]
    return np.clip(np.log(p[1] / p[0]), -3, 3) * np.minimum(1, seen / 4)


def train(words: list[np.ndarray], starts: list[np.ndarray], y: np.ndarray, langs: list[str | None], calibrate: np.ndarray, epochs: int = 6, seed: int = 5) -> Model:
    """Fit on the rows outside ``calibrate``, thresholds on those inside."""
    rng = np.random.default_rng(seed)
    names = sorted({x for x in langs if x is not None}) or ["und"]
    lang = np.ones((STARTS, len(names)))
    for s, x in zip(starts, langs, strict=True):
        if x is not None:
            np.add.at(lang[:, names.index(x)], s, 1)
    lang = np.log(lang / lang.sum(axis=0)).astype(np.float32)
    fit = np.flatnonzero(~calibrate)
    small = lambda *shape: (rng.standard_normal(shape) * 0.05).astype(np.float32)
    m = Model(small(WORDS, DIM), small(STARTS, DIM), [small(w * DIM, n) for w, n in FILTERS], [np.zeros(n, np.float32) for _, n in FILTERS], small(sum(n for _, n in FILTERS)), 0.0, lang, np.zeros(len(names)), 1.0)
    if len(set(y[fit].tolist())) < 2:
        m.constant = float(y.mean()) if len(y) else 0.0
        return m
    m.word[:, 0] = _log_odds([words[i] for i in fit], y[fit], WORDS)
    m.start[:, 1] = _log_odds([starts[i] for i in fit], y[fit], STARTS)
    for f, (width, n) in zip(m.filters, FILTERS, strict=True):
        for o in range(width):
            f[o * DIM, :] += 0.4 / width
            f[o * DIM + 1, :: 2] += 0.4 / width
    m.out += 0.05
    params = {"word": m.word, "start": m.start, "out": m.out, **{f"f{i}": f for i, f in enumerate(m.filters)}, **{f"b{i}": b for i, b in enumerate(m.bias)}}
    square = {k: np.full(p.shape, 1e-2, np.float32) for k, p in params.items()}
    bias_square, weight = 1e-2, np.where(y == 1, (y[fit] == 0).mean(), (y[fit] == 1).mean()) * 2

    def step(name: str, grad: np.ndarray, rows: np.ndarray | None = None, rate: float = 0.05) -> None:
        p, s = params[name], square[name]
        if rows is None:
            s += grad * grad
            p -= rate * grad / np.sqrt(s)
        else:
            s[rows] += grad * grad
            p[rows] -= rate * grad / np.sqrt(s[rows])

    for _ in range(epochs):
        for lo in range(0, len(fit), 64):
            own_rows = rng.permutation(fit)[:64] if lo == 0 else order[lo : lo + 64]
            if lo == 0:
                order = rng.permutation(fit)
                own_rows = order[:64]
            w = np.concatenate([words[i] for i in own_rows])
            s = np.concatenate([starts[i] for i in own_rows])
            own = np.repeat(np.arange(len(own_rows)), [len(words[i]) for i in own_rows])
            pooled, rows, where, at = _pooled(m, w, s, own, len(own_rows), arg=True)
            logit = pooled @ m.out + m.out_bias
            d = ((1 / (1 + np.exp(-logit)) - y[own_rows]) * weight[own_rows] / len(own_rows)).astype(np.float32)
            d_pool = d[:, None] * m.out * (pooled > 0)
            d_rows = np.zeros_like(rows)
            k = 0
            for i, (width, n) in enumerate(FILTERS):
                g = d_pool[:, k : k + n]
                d_f = np.empty_like(m.filters[i])
                for o in range(width):
                    src = np.minimum(where[i] + o, len(rows) - 1)
                    d_f[o * DIM : (o + 1) * DIM] = np.einsum("tnd,tn->dn", rows[src], g)
                    np.add.at(d_rows, src, g[:, :, None] * m.filters[i][o * DIM : (o + 1) * DIM].T[None])
                step(f"f{i}", d_f)
                step(f"b{i}", g.sum(axis=0))
                k += n
            step("out", pooled.T @ d)
            bias_square += float(d.sum()) ** 2
            m.out_bias -= 0.05 * float(d.sum()) / bias_square**0.5
            hit = np.flatnonzero(np.abs(d_rows[at]).sum(axis=1))
            for name, bucket in (("word", w[hit]), ("start", s[hit])):
                rows_, inverse = np.unique(bucket, return_inverse=True)
                g = np.zeros((len(rows_), DIM), np.float32)
                np.add.at(g, inverse, d_rows[at[hit]])
                step(name, g, rows_)
    held = np.flatnonzero(calibrate)
    logit = np.array([_logit(m, words[i], starts[i]) for i in held])
    guess = np.array([guess_language(m, starts[i][None] if starts[i].ndim == 0 else starts[i]) for i in held], int)
    common = best_threshold(logit, y[held], 0.0)
    for k in range(len(names)):
        mine = guess == k
        rarer = min((y[held][mine] == 1).sum(), (y[held][mine] == 0).sum())
        m.threshold[k] = common + (best_threshold(logit[mine], y[held][mine], common) - common) * rarer / (rarer + HALF_WEIGHT)
    return m


def best_threshold(logit: np.ndarray, y: np.ndarray, default: float) -> float:
    """The logit with the least errors, each label weighing the same; in the middle of the widest gap that has it."""
    if len(set(y.tolist())) < 2:
        return default
    order = np.argsort(logit)
    v, label = logit[order], y[order]
    miss = np.cumsum(label) / label.sum() + 1 - np.cumsum(1 - label) / (1 - label).sum()
    gap = np.append(np.diff(v), 0)
    best = np.flatnonzero((miss <= miss[:-1].min() + 1e-12) & (gap > 0))
    if not len(best):
        return default
    k = best[np.argmax(gap[best])]
    return float((v[k] + v[k + 1]) / 2)


def _logit(m: Model, w: np.ndarray, s: np.ndarray) -> float:
    return float((_pooled(m, w, s, np.zeros(len(w), np.int64), 1)[0] @ m.out)[0] + m.out_bias)


def guess_language(m: Model, s: np.ndarray) -> int:
    return int(np.argmax(m.lang[s].sum(axis=0))) if len(s) else 0


def _overlapping(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes], np.ndarray, np.ndarray]]:
    """The pieces of ``wordvec.batches``, each after the last words of its text's piece before; how many words that is; and how many the piece leaves to the next one."""
    most = max(width for width, _ in FILTERS) - 1
    done, tail = np.zeros(len(texts), np.int64), []
    for own, pieces in wordvec.batches(texts):
        out, carried, left = [], np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        for k, (i, piece) in enumerate(zip(own, pieces, strict=True)):
            carried[k] = len(tail)
            out.append(b" ".join([*tail, piece]) if tail else piece)
            done[i] += len(piece)
            tail = (tail + wordvec.spaced(piece).split())[-most:] if done[i] < len(texts[i]) else []
            left[k] = len(tail)
        yield own, out, carried, left


def score_texts(m: Model, texts: list[bytes]) -> np.ndarray:
    if m.constant is not None:
        return np.full(len(texts), m.constant)
    pooled = np.zeros((len(texts), len(m.out)), np.float32)
    lang = np.zeros((len(texts), m.lang.shape[1]))
    for own, pieces, carried, left in _overlapping(texts):
        w, s, piece = _buckets(pieces)
        top = _pooled(m, w, s, piece, len(pieces), left=left)[0]
        np.maximum.at(pooled, own, top)
        new = np.arange(len(w)) - np.searchsorted(piece, piece) >= carried[piece]  # carried words have been counted
        s, piece = s[new], piece[new]
        if len(s):
            live = np.unique(piece)
            sums = np.add.reduceat(m.lang[s], np.searchsorted(piece, live), axis=0)
            np.add.at(lang, np.asarray(own)[live], sums)
    logit = pooled @ m.out + m.out_bias - m.threshold[np.argmax(lang, axis=1)]
    return 1 / (1 + np.exp(-np.clip(logit * m.slope, -30, 30)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", learn: F.Column | None = None, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Model:
    """Learn from at most ``rows`` ids of each label, and ``size`` bytes of their texts; ``learn`` says which ids may be learned from."""
    y = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    y = y.groupBy("doc_id").agg(F.max("y").alias("y"))
    if learn is not None:
        y = y.where(learn)
    y = first_by_hash(y, "y", "doc_id", rows)
    lang = F.col(lang_col) if lang_col in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), lang.cast("string").alias("lang"))

    @lean
    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            w: list[list] = [[] for _ in texts]
            s: list[list] = [[] for _ in texts]
            for own, pieces in wordvec.batches(texts):
                word, start, piece = _buckets(pieces)
                cut = np.searchsorted(piece, np.arange(len(pieces) + 1))
                for k, i in enumerate(own):
                    w[i].append(word[cut[k] : cut[k + 1]])
                    s[i].append(start[cut[k] : cut[k + 1]])
            join = lambda x: np.concatenate(x).astype(np.int32).tobytes() if x else b""
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([join(x) for x in w]), pa.array([join(x) for x in s]), batch.column(2), batch.column(3)], ["doc_id", "w", "s", "lang", "y"])

    # one text for an id, however often it is repeated
    sample = stage(texts.join(F.broadcast(y), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct("text", "lang")).alias("t")).select("doc_id", "t.text", "t.lang", "y"), "toxic")
    taken, left = [], dict.fromkeys((0, 1), size)
    for r in sorted(sample.select(F.xxhash64("doc_id").alias("h"), "doc_id", "y", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).collect()):
        if r["n"] <= left[r["y"]]:
            left[r["y"]] -= r["n"]
            taken.append((r["doc_id"],))
    some = sample.sparkSession.createDataFrame(taken, "doc_id long")
    got = sample.join(F.broadcast(some), "doc_id").select("doc_id", "text", "lang", "y").mapInArrow(buckets, "doc_id long, w binary, s binary, lang string, y int").collect()
    got = sorted(got, key=lambda r: (r["doc_id"], bytes(r["w"])))
    ids = np.array([r["doc_id"] for r in got], np.int64)
    calibrate = wordvec.mix(ids.view(np.uint64)) % np.uint64(4) == 0
    one = lambda r, k: np.frombuffer(bytes(r[k]), np.int32)
    return train([one(r, "w") for r in got], [one(r, "s") for r in got], np.array([r["y"] for r in got], np.int64), [r["lang"] for r in got], calibrate)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of parameters

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(held.value, [x or b"" for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores.astype(np.float64))], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "doc_id long, score double")
