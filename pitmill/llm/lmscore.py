"""Masked pseudo-likelihood scores by a bidirectional window network, trained in numpy.

A word is one of 64 endings (a hash of its last three bytes) and, within the ending, one of 128 slots
(a hash of the whole word). The network sees the words next to a hidden one on both sides, and the endings
of those one further, and predicts first its ending and then, given the ending, its slot. Both
steps read the whole context and are normalised. Words that share an ending and a slot are told apart by a lexicon: the counts of the
``VOCAB`` most frequent words of the corpus within their class; the words of a class that aren't among them, and one never seen, share
what the class has left alike. So a word's conditional probability is

    p(ending | two words before, two words after) * p(slot | ending, two words before, two words after) * p(word | ending, slot)

and a text's score is the sum of the logs over all its words. Before training the first two steps are the
counts of the corpus, whatever the context.

The counts and the training cover the whole corpus: every word of every text is a training target
once, those at even places of their text in the first round and the others in the second. For
training the texts are dealt into streams of about ``STREAM`` words by a hash of id and text, and a
stream is read in the order of that hash, in steps of ``STEP`` words that don't depend on batches. So
the model is the same (up to the rounding of sums) however the table is partitioned. The weights after each stream are averaged by the
number of words, and the next round starts from the average. What is sent grows with the input (words,
counts, and the summed weights of each task), what the driver holds does not.

Defined results: a null text or one without words has no words, a sum of 0 and a null mean;
repeated rows are scored alike, and those of one id are in one stream; with an empty corpus there is nothing to score; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.llm import wordvec
from pitmill.llm.workers import lean
from pitmill.plans.staging import stage

ENDINGS, SLOTS, SUFFIX = 64, 128, 3
BUCKETS = ENDINGS * SLOTS
HIDDEN = 24
ROUNDS, RATE = 2, 0.1
#: Words of a stream, of the texts that are trained on together, of a training step, and of a scoring step.
STREAM, GROUP, STEP, ROWS = 1 << 21, 1 << 16, 4096, 4096
#: Words of the lexicon at most: as many of the most frequent ones, with all that are as frequent as the last, as fit.
VOCAB = 1 << 18
#: Weights are summed in so many slices, so that no task sums all of them.
SLICES = 128


@dataclass
class Network:
    near: np.ndarray  # (2, BUCKETS + 1, HIDDEN): what the words before and after add; the last row: beyond an end
    far: np.ndarray  # (2, ENDINGS + 1, HIDDEN): what the endings one further add
    bias: np.ndarray
    ending: np.ndarray  # (HIDDEN, ENDINGS)
    ending_bias: np.ndarray
    gate: np.ndarray  # (ENDINGS, HIDDEN): what an ending lets through to its slots
    slot: np.ndarray  # (HIDDEN, SLOTS)
    slot_bias: np.ndarray  # (ENDINGS, SLOTS)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, f.name).ravel() for f in fields(self)]).astype(np.float32)


_SHAPES = ((2, BUCKETS + 1, HIDDEN), (2, ENDINGS + 1, HIDDEN), (HIDDEN,), (HIDDEN, ENDINGS), (ENDINGS,), (ENDINGS, HIDDEN), (HIDDEN, SLOTS), (ENDINGS, SLOTS))


def network(flat: np.ndarray) -> Network:
    cut = np.cumsum([0, *(int(np.prod(s)) for s in _SHAPES)])
    return Network(*(flat[a:b].reshape(s).astype(np.float32) for a, b, s in zip(cut, cut[1:], _SHAPES, strict=False)))


def untrained(counts: np.ndarray, seed: int = 3) -> Network:
    """The network whose probabilities are the counts'."""
    rng = np.random.default_rng(seed)
    small = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
    smooth = (counts + 0.5).reshape(ENDINGS, SLOTS)
    of_ending = smooth.sum(axis=1)
    zero = [np.zeros(s, np.float32) for s in _SHAPES]
    return Network(small(*_SHAPES[0]), small(*_SHAPES[1]), zero[2], small(*_SHAPES[3]), np.log(of_ending / of_ending.sum()).astype(np.float32), 1 + small(*_SHAPES[5]), small(*_SHAPES[6]), np.log(smooth / of_ending[:, None]).astype(np.float32))


@dataclass
class Lexicon:
    """Sorted hashes of words, the log-probability of each within its bucket, and that of any other word of a bucket."""

    word: np.ndarray
    log_p: np.ndarray
    other: np.ndarray

    def of(self, word: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        if not len(self.word):
            return self.other[bucket]
        at = np.minimum(np.searchsorted(self.word, word), len(self.word) - 1)
        return np.where(self.word[at] == word, self.log_p[at], self.other[bucket])


def buckets(texts: list[bytes], hashes: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words laid end to end, and how many each text has; the words' hashes are added to ``hashes``."""
    parts, count = [np.empty(0, np.uint16)], np.zeros(len(texts), np.int64)
    for own, pieces in wordvec.batches(texts):
        word, piece, tail = wordvec.hashes(pieces, suffix=SUFFIX)
        parts.append(((tail % np.uint64(ENDINGS)) * np.uint64(SLOTS) + word % np.uint64(SLOTS)).astype(np.uint16))
        if hashes is not None:
            hashes.append(word)
        np.add.at(count, own, np.bincount(piece, minlength=len(pieces)))
    return np.concatenate(parts), count


def contexts(bucket: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(2, words) buckets of the words before and after, and (2, words) endings one further; beyond an end of the text the last row."""
    end = np.repeat(np.cumsum(count), count)
    first = end - np.repeat(count, count)
    at = np.arange(len(bucket))
    out = []
    for o in (-1, 1, -2, 2):
        inside = (at + o >= first) & (at + o < end)
        got = bucket[np.clip(at + o, 0, max(0, len(bucket) - 1))].astype(np.int32)
        out.append(np.where(inside, got, BUCKETS) if abs(o) == 1 else np.where(inside, got // SLOTS, ENDINGS))
    return np.stack(out[:2]), np.stack(out[2:])


def _hidden(n: Network, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    h = np.take(n.near[0], near[0], axis=0)
    for table, x in ((n.near[1], near[1]), (n.far[0], far[0]), (n.far[1], far[1])):
        h += np.take(table, x, axis=0)
    h += n.bias
    return np.tanh(h, out=h)


def _exp(y: np.ndarray) -> np.ndarray:
    """Row sums of the exponentials, which replace ``y``; rows are shifted only where they could overflow."""
    if len(y) and y.max() > 60:
        y -= y.max(axis=1, keepdims=True)
    np.exp(y, out=y)
    return y.sum(axis=1)


def log_p(n: Network, bucket: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Log-probability of each word in its context."""
    out, ending, slot = np.empty(len(bucket)), bucket // SLOTS, bucket % SLOTS
    for lo in range(0, len(bucket), ROWS):
        e, s, at = ending[lo : lo + ROWS], slot[lo : lo + ROWS], np.arange(len(bucket[lo : lo + ROWS]))
        h = _hidden(n, near[:, lo : lo + ROWS], far[:, lo : lo + ROWS])
        y = h @ n.ending
        y += n.ending_bias
        total = _exp(y)
        each = np.log(y[at, e] / total)
        h *= np.take(n.gate, e, axis=0)
        y = h @ n.slot
        y += np.take(n.slot_bias, e, axis=0)
        total = _exp(y)
        out[lo : lo + ROWS] = each + np.log(np.maximum(y[at, s], 1e-37) / total)
    return out


def targets(count: np.ndarray, turn: int) -> np.ndarray:
    """Places of the words that are trained on in a round; each word of each text is in one round."""
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.flatnonzero(at % ROUNDS == turn)


class Trainer:
    """Adagrad steps from a network; the state is kept over all steps."""

    def __init__(self, n: Network, rate: float = RATE):
        self.n, self.rate = n, rate
        self.square = {f.name: np.full(getattr(n, f.name).shape, 1e-4, np.float32) for f in fields(n)}

    def _whole(self, name: str, g: np.ndarray) -> None:
        s, p = self.square[name], getattr(self.n, name)
        s += g * g
        p -= self.rate * g / np.sqrt(s)

    def _rows(self, name: str, side: int | None, rows: np.ndarray, g: np.ndarray) -> None:
        s, p = self.square[name], getattr(self.n, name)
        s, p = (s, p) if side is None else (s[side], p[side])
        held = s[rows] + g * g
        s[rows] = held
        p[rows] -= self.rate * g / np.sqrt(held)

    def step(self, bucket: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        order = np.argsort((bucket // SLOTS).astype(np.uint8), kind="stable")
        bucket, near, far = bucket[order], near[:, order], far[:, order]
        n, at, e, s = self.n, np.arange(len(bucket)), bucket // SLOTS, bucket % SLOTS
        first = np.flatnonzero(np.append(True, e[1:] != e[:-1]))
        live, scale = e[first], np.float32(1 / len(bucket))
        h = _hidden(n, near, far)
        p = h @ n.ending
        p += n.ending_bias
        p *= (scale / _exp(p))[:, None]
        p[at, e] -= scale
        d_h = p @ n.ending.T
        self._whole("ending", h.T @ p)
        self._whole("ending_bias", p.sum(axis=0))
        gate = np.take(n.gate, e, axis=0)
        through = h * gate
        p = through @ n.slot
        p += np.take(n.slot_bias, e, axis=0)
        p *= (scale / _exp(p))[:, None]
        p[at, s] -= scale
        d = p @ n.slot.T
        self._whole("slot", through.T @ p)
        self._rows("slot_bias", None, live, np.add.reduceat(p, first, axis=0))
        self._rows("gate", None, live, np.add.reduceat(d * h, first, axis=0))
        d *= gate
        d_h += d
        d_h *= 1 - h * h
        self._whole("bias", d_h.sum(axis=0))
        for name, xs in (("near", near), ("far", far)):
            for side in (0, 1):
                by = np.argsort(xs[side].astype(np.uint16), kind="stable")
                x = xs[side][by]
                first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
                self._rows(name, side, x[first], np.add.reduceat(np.take(d_h, by, axis=0), first, axis=0))

    def texts(self, words: list[np.ndarray], turn: int) -> int:
        """Train on one group of texts; the number of its targets."""
        count = np.array([len(w) for w in words])
        bucket = np.concatenate(words).astype(np.int32)
        near, far = contexts(bucket, count)
        take = targets(count, turn)
        for lo in range(0, len(take), STEP):
            t = take[lo : lo + STEP]
            self.step(bucket[t], near[:, t], far[:, t])
        return len(take)


def log_likelihood(n: Network, bucket: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Summed conditional log-probabilities of each text."""
    bucket = bucket.astype(np.int32)
    total = np.concatenate(([0.0], np.cumsum(log_p(n, bucket, *contexts(bucket, count)))))
    end = np.cumsum(count)
    return total[end] - total[end - count]


def _words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(key, words)`` of every text with words: a hash of id and text, and the buckets as bytes; written to the shared folder."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, count = buckets([x or b"" for x in batch.column(1).to_pylist()])
            cut = np.concatenate(([0], np.cumsum(count)))
            words = pa.array([bucket[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), words], ["key", "words"]).filter(pa.array(count > 0))

    rows = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(text_col).cast("binary").alias("text"))
    return stage(rows.mapInArrow(run, "key long, words binary"), "words")


def _count(words: DataFrame) -> np.ndarray:
    """Words of each bucket over all texts; at most BUCKETS rows reach the driver."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for w in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(w, np.uint16), minlength=BUCKETS) if len(w) > BUCKETS else 0
                if len(w) <= BUCKETS:
                    np.add.at(total, np.frombuffer(w, np.uint16), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in words.select("words").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def count_buckets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Words of each bucket over all documents."""
    return _count(_words(docs, id_col, text_col))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stream: int = STREAM) -> Network:
    """The network, from all documents."""
    words = _words(docs, id_col, text_col)
    counts = _count(words)
    net, streams, context = untrained(counts), max(1, -(-int(counts.sum()) // stream)), docs.sparkSession.sparkContext
    dealt = words.withColumn("stream", F.pmod("key", F.lit(streams)))
    tasks = min(streams, 1 << 14)

    for turn in range(ROUNDS):
        start = context.broadcast(net.flat())  # a fixed number of weights

        @lean
        def run(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            total, seen = np.zeros(len(start.value)), 0
            now, trainer, done, held, size = None, None, 0, [], 0

            def end_group() -> None:
                nonlocal done, held, size
                if held:
                    done += trainer.texts(held, turn)
                held, size = [], 0

            def end_stream() -> None:
                nonlocal seen, total
                if trainer is not None:
                    end_group()
                    total += trainer.n.flat() * np.float64(done)
                    seen += done

            for batch in batches:
                for s, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if s != now:
                        end_stream()
                        now, trainer, done = s, Trainer(network(start.value), RATE / (1 + turn)), 0
                    held.append(np.frombuffer(w, np.uint16))
                    size += len(held[-1])
                    if size >= GROUP:
                        end_group()
            end_stream()
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLICES, dtype=np.int32)), pa.array([seen] * SLICES, pa.int64()), pa.array([x.tobytes() for x in np.array_split(total, SLICES)], pa.binary())], ["slice", "n", "weights"])

        @lean
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            for batch in batches:
                for k, n, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    held = sums.setdefault(k, [0, 0.0])
                    held[0], held[1] = held[0] + n, held[1] + np.frombuffer(w, np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s[0] for s in sums.values()], pa.int64()), pa.array([s[1].tobytes() for s in sums.values()], pa.binary())], ["slice", "n", "weights"])

        trained = dealt.repartitionByRange(tasks, "stream").sortWithinPartitions("stream", "key").select("stream", "words").mapInArrow(run, "slice int, n long, weights binary")
        # a slice's sums of all tasks are added in one task, SLICES of them reach the driver
        sums = {r["slice"]: r for r in trained.repartition("slice").mapInArrow(add, "slice int, n long, weights binary").collect()}
        if sums:
            net = network(np.concatenate([np.frombuffer(bytes(sums[k]["weights"]), np.float64) / sums[k]["n"] for k in range(SLICES)]))
    return net


def fit_lexicon(docs: DataFrame, text_col: str = "text", vocab: int = VOCAB) -> Lexicon:
    """The lexicon, from all words of all documents; ``vocab`` words at most, and one number a bucket for the others, reach the driver."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list = [np.empty(0, np.uint64)]
            bucket, _ = buckets([x or b"" for x in batch.column(0).to_pylist()], held)
            word, first, n = np.unique(np.concatenate(held), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(bucket[first].astype(np.int32)), pa.array(n)], ["word", "bucket", "n"])

    counted = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "word long, bucket int, n long")
    counted = stage(counted.groupBy("word", "bucket").agg(F.sum("n").alias("n")), "lexicon")
    least, so_far = 1, 0
    for r in sorted(counted.groupBy("n").agg(F.count("*").alias("words")).collect(), reverse=True):  # a row for each different count
        so_far += r["words"]
        if so_far > vocab:
            least = r["n"] + 1
            break
    total, rest, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(BUCKETS)
    few = F.col("n") < least
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(few, F.col("n"))), F.lit(0)).alias("rest"), F.count_if(few).alias("kinds")).collect():
        total[r["bucket"]], rest[r["bucket"]], kinds[r["bucket"]] = r["n"], r["rest"], r["kinds"]
    known = counted.where(~few).toArrow()
    word = np.asarray(known.column("word")).view(np.uint64)
    order = np.argsort(word)
    own = np.asarray(known.column("bucket"))
    return Lexicon(word[order], np.log(np.asarray(known.column("n")) / (total[own] + 1))[order], np.log((rest + 1) / ((total + 1) * (kinds + 1))))


def score(docs: DataFrame, model: Network, lexicon: Lexicon | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, log_likelihood, mean_log_likelihood)`` of every row; without a lexicon, of its words' endings and slots only."""
    held = docs.sparkSession.sparkContext.broadcast((model.flat(), lexicon))  # a fixed number of weights, and at most VOCAB words

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, words = network(held.value[0]), held.value[1]
        for batch in batches:
            seen: list = [np.empty(0, np.uint64)]
            bucket, count = buckets([x or b"" for x in batch.column(1).to_pylist()], seen)
            total = log_likelihood(net, bucket, count)
            if words is not None:
                within = np.concatenate(([0.0], np.cumsum(words.of(np.concatenate(seen), bucket))))
                end = np.cumsum(count)
                total = total + within[end] - within[end - count]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.array(total)], ["doc_id", "n_words", "log_likelihood"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, log_likelihood double").withColumn("mean_log_likelihood", F.try_divide("log_likelihood", "n_words"))
