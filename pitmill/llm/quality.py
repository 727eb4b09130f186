"""Quality rules: counted base rules, and lines marked content or boilerplate by a linear-chain conditional random field.

Each line of a text is described by bins of shares (symbols, shouting, separators, words said before, ...), in no
language's terms. Emission weights of the bins and transitions between neighbouring lines are trained in numpy on
labelled documents, by the gradient of the conditional log-likelihood (forward-backward). The labels are of
documents, so lines get theirs in turns: at first every line of a bad document is boilerplate and every line of a
good one content, and emissions alone are fitted; then those lines of bad documents that the field itself marks content become
content, and it is fitted whole, with its transitions, and so once more. Viterbi decoding marks the lines of a text; blank lines keep their place in the chain. A text is kept if it passes
the base rules and content lines hold at least ``MIN_CONTENT`` of its word characters.

What is learned from is bounded: of each label the ``TRAIN_ROWS`` first ids by a hash, as many as have ``TRAIN_BYTES`` of text
together (a longer text is passed over), in stretches of ``STRETCH`` lines.

Defined results: null texts have no words and fail the base rules; without two labels to learn from every line is content; repeated rows are
judged alike; rows with a null id are judged and never learned from; texts and lines of any length are read whole,
in slices; an empty table gives an empty result; other columns are ignored.
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
from pitmill.plans.staging import stage

SLICE = 1 << 20
#: At most so many labelled ids of each label, and bytes of their texts, are learned from.
TRAIN_ROWS, TRAIN_BYTES, STRETCH = 1000, 16 << 20, 64
#: A text with fewer words, or with a larger share of its words (in hundredths) in repeated windows of three, fails.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Share of the word characters that content lines must hold.
MIN_CONTENT = 0.5
CONTENT, BOILERPLATE = 0, 1

_SYMBOLS, _SPACES = b"#*$%&|<>", b" \t\n\r\x0b\x0c"


def _mark(values: bytes | range | list[int]) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[list(values)] = 1
    return out


#: Byte classes that are counted for each line: word bytes, code points in words, symbols, upper-case letters, other letters, digits, exclamation and question marks, sentence ends, braces and slashes.
_CLASSES = np.stack([
    1 - _mark(_SPACES), _mark([c for c in range(256) if c & 0xC0 != 0x80 and c not in _SPACES]), _mark(_SYMBOLS), _mark(range(65, 91)),
    _mark([*range(97, 123), *range(0xC2, 0xF5)]), _mark(range(48, 58)), _mark(b"!?"), _mark(b".,;:"), _mark(b"{}[]()=_/\\~^"),
])
#: Upper bounds of the bins of each feature of a line.
_BINS = (
    ("words", (1, 3, 6, 12, 30, 80)), ("word length", (2.5, 3.5, 5, 7, 9, 14)), ("symbols a word", (0.02, 0.1, 0.3, 0.8, 1.5)), ("upper", (0.02, 0.1, 0.3, 0.6, 0.9)),
    ("digits", (0.01, 0.1, 0.3, 0.6)), ("exclamations a word", (0.02, 0.1, 0.4, 0.9)), ("sentence marks a word", (0.02, 0.08, 0.2, 0.5)), ("braces", (0.01, 0.05, 0.2)),
    ("repeated words", (0.02, 0.1, 0.3, 0.6, 0.9)), ("different words", (0.2, 0.5, 0.8, 0.95)), ("duplicate", (0.5,)),
)
_OFFSETS = np.cumsum([0, *[len(b) + 1 for _, b in _BINS]])
N_FEATURES = int(_OFFSETS[-1])


@dataclass
class Field:
    """Weights of a bin (by label), of a pair of neighbouring labels, and of the first label."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray


@dataclass
class Text:
    """What the rules count in a text, and the bins and word characters of each line."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    bins: np.ndarray  # (lines, features)
    chars: np.ndarray  # word characters of a line

    @property
    def failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEATED * self.n_words


def _word_ids(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The number of each word (equal words have one) and the byte where it ends, read in slices cut between words."""
    known: dict[bytes, int] = {}
    out, at = [], 0
    while at < len(data):
        end = at + SLICE
        while end < len(data) and data[end] not in _SPACES:
            end += 1
        words = data[at:end].split()
        out.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
        at = end
    raw = np.frombuffer(data, np.uint8)
    word = _CLASSES[0].astype(bool)[raw]
    last = np.flatnonzero(word & ~np.append(word[1:], False))
    return (np.concatenate(out) if out else np.empty(0, np.int64)), last


def _in_repeated(ids: np.ndarray, window: int = 3) -> np.ndarray:
    """Which words are in a window of words that the text has twice or more."""
    hit = np.zeros(len(ids), bool)
    n = len(ids) - window + 1
    if n < 2:
        return hit
    key = ids[:n]
    for k in range(1, window):
        key = key * (int(ids.max()) + 1) + ids[k : n + k]
        _, key, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[key] > 1
    for k in range(window):
        hit[k : n + k] |= again
    return hit


def read_text(data: bytes) -> Text:
    """Counts and lines of a text."""
    ids, last = _word_ids(data)
    repeated = _in_repeated(ids)
    raw = np.frombuffer(data, np.uint8)
    ends = np.append(np.flatnonzero(raw == 10), len(raw))
    begins = np.append(0, ends[:-1] + 1)
    n = len(ends)
    counts = np.zeros((len(_CLASSES), n))
    for lo in range(0, len(raw), SLICE):  # lines that cross a slice get the sum of their parts
        part = raw[lo : lo + SLICE]
        first, until = np.searchsorted(ends, lo), np.searchsorted(ends, lo + len(part) - 1) + 1
        cut = np.maximum(begins[first:until] - lo, 0)
        cut = np.minimum(cut, len(part) - 1)
        for k, table in enumerate(_CLASSES):
            counts[k, first:until] += np.add.reduceat(table[part], cut)
    bytes_, chars, symbols, upper, lower, digits, loud, marks, braces = counts
    line = np.searchsorted(ends, last)
    words = np.bincount(line, minlength=n)
    again = np.bincount(line, weights=repeated, minlength=n)
    pair = np.unique(line * (len(ids) + 1) + ids)
    different = np.bincount(pair // (len(ids) + 1), minlength=n)
    seen: set[bytes] = set()
    duplicate = np.zeros(n, bool)
    for i in np.flatnonzero(words).tolist():
        key = data[begins[i] : ends[i]]
        duplicate[i] = key in seen
        seen.add(key)
    w, c, letters = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(upper + lower, 1)
    values = (words, chars / w, symbols / w, upper / letters, digits / c, loud / w, marks / w, braces / c, again / w, different / w, duplicate)
    bins = np.zeros((n, N_FEATURES), np.float32)
    for (_, bounds), off, value in zip(_BINS, _OFFSETS, values, strict=False):
        bins[np.arange(n), off + np.searchsorted(bounds, value, "right")] = 1
    bins[words == 0] = 0  # a blank line speaks for neither label
    return Text(len(ids), int(chars.sum()), int(symbols.sum()), int(duplicate.sum()), int(repeated.sum()), bins, chars)


def viterbi(field: Field, bins: np.ndarray) -> np.ndarray:
    """The likeliest labels of a text's lines; ties go to content."""
    score = bins @ field.emission
    back = np.zeros((len(score), 2), np.int8)
    (a0, a1), t = (field.start + score[0]).tolist(), field.transition.tolist()
    for i, (s0, s1) in enumerate(score[1:].tolist(), 1):
        to0, to1 = (a0 + t[0][0], a1 + t[1][0]), (a0 + t[0][1], a1 + t[1][1])
        back[i] = to0[1] > to0[0], to1[1] > to1[0]
        a0, a1 = max(to0) + s0, max(to1) + s1
    out = np.zeros(len(score), np.int8)
    at = int(a1 > a0)
    for i in range(len(score) - 1, -1, -1):
        out[i] = at
        at = int(back[i, at])
    return out


def content_share(field: Field | None, text: Text) -> float:
    """Share of the word characters in content lines; 0 without words."""
    if not text.word_chars:
        return 0.0
    return 1.0 if field is None else float(text.chars[viterbi(field, text.bins) == CONTENT].sum() / text.chars.sum())


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def gradient(field: Field, bins: np.ndarray, labels: np.ndarray, length: np.ndarray) -> tuple[float, Field]:
    """Log-likelihood of the ``(sequences, lines)`` labels, the first ``length`` lines of each, and its gradient.

    Sequences come longest first, so that a step of the recursions takes those that have its line; ``bins`` has the lines there are, in order.
    """
    n, t = labels.shape
    live = np.arange(t) < length[:, None]
    at = live.sum(axis=0)
    score = np.zeros((n, t, 2))
    score[live] = bins @ field.emission
    alpha, beta = np.zeros((n, t, 2)), np.zeros((n, t, 2))
    alpha[:, 0] = field.start + score[:, 0]
    for k in range(1, t):
        m = at[k]
        alpha[:m, k] = _log_sum(alpha[:m, k - 1, :, None] + field.transition, 1) + score[:m, k]
    for k in range(t - 2, -1, -1):
        m = at[k + 1]
        beta[:m, k] = _log_sum(field.transition + (score[:m, k + 1] + beta[:m, k + 1])[:, None], 2)
    total = _log_sum(alpha[np.arange(n), length - 1], 1)
    own, line = np.nonzero(live)
    single = np.exp(alpha[live] + beta[live] - total[own, None])
    own, line = own[line > 0], line[line > 0]
    pairs = np.exp(alpha[own, line - 1][:, :, None] + field.transition + (score + beta)[own, line][:, None] - total[own, None, None])
    mine, hot = np.eye(2)[labels[live]], np.eye(2)[labels]
    both = np.einsum("ma,mb->ab", hot[own, line - 1], hot[own, line])
    first = np.cumsum(length) - length
    likelihood = (mine * score[live]).sum() + (hot[:, 0] @ field.start).sum() + (both * field.transition).sum() - total.sum()
    return float(likelihood), Field(bins.T @ (mine - single), both - pairs.sum(axis=0), (hot[:, 0] - single[first]).sum(axis=0))


def _fitted(bins: np.ndarray, labels: np.ndarray, length: np.ndarray, chain: bool = True, rounds: int = 100, ridge: float = 1.0, rate: float = 0.3) -> Field:
    field = Field(np.zeros((bins.shape[1], 2)), np.zeros((2, 2)), np.zeros(2))
    names = ("emission", "transition", "start") if chain else ("emission",)
    square = {k: np.full(getattr(field, k).shape, 1e-3) for k in names}
    lines = max(1, int(length.sum()))
    for _ in range(rounds):
        _, grad = gradient(field, bins, labels, length)
        for k in names:
            g = (getattr(grad, k) - ridge * getattr(field, k)) / lines
            square[k] += g * g
            setattr(field, k, getattr(field, k) + rate * g / np.sqrt(square[k]))
    return field


def train(texts: list[np.ndarray], bad: list[bool], turns: int = 3) -> Field | None:
    """Fit on the bins of the lines of texts, and whether a text is bad; None without both kinds."""
    if len(set(bad)) < 2:
        return None
    parts, own = [], []
    for i, x in enumerate(texts):
        for lo in range(0, len(x), STRETCH):
            parts.append(x[lo : lo + STRETCH])
            own.append(i)
    order = sorted(range(len(parts)), key=lambda k: -len(parts[k]))  # stable: the stretches of a text stay in order
    parts, own = [parts[k] for k in order], [own[k] for k in order]
    length = np.array([len(p) for p in parts])
    bins = np.concatenate(parts).astype(np.float64)
    labels = np.repeat(np.array(bad)[own].astype(np.int64)[:, None], int(length.max()), axis=1)
    field = _fitted(bins, labels, length, chain=False)  # labels of whole texts say nothing about neighbours
    for _ in range(turns - 1):
        for i in np.flatnonzero(bad).tolist():
            found = viterbi(field, texts[i])
            if found.any():  # a bad text has some boilerplate
                for j, k in enumerate(np.flatnonzero(np.array(own) == i)):
                    part = found[j * STRETCH : (j + 1) * STRETCH]
                    labels[k, : len(part)] = part
        field = _fitted(bins, labels, length)
    return field


def fit_lines(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Field | None:
    """Learn from documents labelled good (1) or bad (0); see the module for the bounds."""
    y = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    y = stage(first_by_hash(y.groupBy("doc_id").agg(F.min("y").alias("y")), "y", "doc_id", rows), "labels")  # at most 2 * rows ids
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).where("text is not null")
    sample = stage(texts.join(F.broadcast(y), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")), "quality")
    taken, left = [], dict.fromkeys((0, 1), size)
    for r in sorted(sample.select(F.xxhash64("doc_id").alias("h"), "doc_id", "y", F.octet_length("text").alias("n")).collect()):
        if r["n"] <= left[r["y"]]:
            left[r["y"]] -= r["n"]
            taken.append((r["doc_id"],))

    @lean
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = [np.packbits(read_text(x.as_py()).bins.astype(bool), axis=1).tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bins, pa.binary())], ["doc_id", "y", "bins"])

    some = sample.sparkSession.createDataFrame(taken, "doc_id long")
    got = sorted(sample.join(F.broadcast(some), "doc_id").select("doc_id", "y", "text").mapInArrow(lines, "doc_id long, y int, bins binary").collect())
    width = -(-N_FEATURES // 8)
    bins = [np.unpackbits(np.frombuffer(bytes(r["bins"]), np.uint8).reshape(-1, width), axis=1)[:, :N_FEATURES].astype(np.float32) for r in got]
    return train(bins, [r["y"] == 0 for r in got])


def judge(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text", share: float = MIN_CONTENT) -> DataFrame:
    """The counts of every row, ``base_failed``, ``n_lines``, ``content`` (share of word characters) and ``kept``."""
    held = docs.sparkSession.sparkContext.broadcast(field)  # a fixed number of weights
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, content, lines = [], [], [], []
            for x in batch.column(1):
                text = read_text(x.as_py() or b"")
                counts.append([getattr(text, k) for k in names])
                failed.append(text.failed)
                content.append(content_share(held.value, text))
                lines.append(len(text.chars))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(names))]
            kept = [not f and c >= share for f, c in zip(failed, content, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(failed, pa.bool_()), pa.array(lines, pa.int64()), pa.array(content, pa.float64()), pa.array(kept, pa.bool_())],
                ["doc_id", *names, "base_failed", "n_lines", "content", "kept"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{k} long" for k in names) + ", base_failed boolean, n_lines long, content double, kept boolean")


def line_labels(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, line, content)`` for every line of every text, lines from 0."""
    held = docs.sparkSession.sparkContext.broadcast(field)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, x in zip(batch.column(0), batch.column(1), strict=True):
                bins = read_text(x.as_py()).bins
                found = np.zeros(len(bins), np.int8) if held.value is None else viterbi(held.value, bins)
                yield pa.RecordBatch.from_arrays([pa.array([one.as_py()] * len(bins), pa.int64()), pa.array(np.arange(len(bins))), pa.array(found == CONTENT)], ["doc_id", "line", "content"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).where("text is not null")
    return rows.mapInArrow(run, "doc_id long, line long, content boolean")
