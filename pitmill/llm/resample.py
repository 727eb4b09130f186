"""Importance resampling towards a target distribution of hashed n-gram features.

A 256-byte table lower-cases A-Z and blanks every separator in UTF-8, ``bytes.split`` yields the words, and ``zlib.crc32``,
chained from one word to the next, gives the bucket of every run of words. Tasks count buckets with ``Counter``; their counts are
added up by Spark. A bucket's gain is the logarithm of its smoothed share in the target over that in the source; a
document's weight is the mean gain of its features, and with Gumbel noise from a hash of its id the highest scores
are a draw without replacement in proportion to the exponent of the weights.

Only a table of ``buckets`` gains passes the driver. Documents that may be drawn are numbered in the order of their scores by
ranges of (score, id, place), which split ties of any number.

Defined results: null texts have no words, weight 0 and are never drawn; ties of score and id are taken in an order
of their own, each once; a null id is the empty text in the noise and goes last among ties; an empty target or source counts as all zeros; repeated rows count each time;
long texts are read in slices that runs of words cross; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.plans.numbering import numbered
from pitmill.llm.workers import lean
from pitmill.plans.staging import stage

SLICE = 1 << 20
_LOWER = bytes(range(256)).lower()
#: A-Z become a-z; bytes that are no ASCII letter or digit and no part of a longer character become blanks.
TABLE = bytes(c if c >= 128 or bytes((c,)).isalnum() else 32 for c in _LOWER)


def word_slices(text: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of ``text``, some at a time; no word is cut."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and TABLE[text[end]] != 32:
            end += 1
        yield text[at:end].translate(TABLE).split()
        at = end


class _Buckets(dict):
    """Bucket of a word and its checksum, kept from word to word of a task's batch."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = zlib.crc32(word)
        return out


def runs(words: list[bytes], first: int, n: int, sums: _Buckets) -> Iterator[list[int]]:
    """Checksums of the runs of 1 to ``n`` words, shorter ones first, that don't end within the ``first`` words."""
    crc = [sums[w] for w in words]
    yield crc[first:]
    for k in range(1, n):
        crc = [zlib.crc32(b" " + w, c) for c, w in zip(crc, words[k:], strict=False)]
        yield crc[max(0, first - k) :]


def _features(text: bytes, n: int, sums: _Buckets) -> Iterator[tuple[int, list[int]]]:
    """(new words, checksums of runs) of a text, some at a time; runs cross slices."""
    tail: list[bytes] = []
    for words in word_slices(text):
        both = tail + words
        for k, crc in enumerate(runs(both, len(tail), n, sums)):
            yield 0 if k else len(words), crc
        tail = both[-(n - 1) :] if n > 1 else []


def bucket_counts(docs: DataFrame, text_col: str = "text", n: int = 1, buckets: int = 10_000) -> list[int]:
    """How often each bucket occurs in all texts."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            sums, held = _Buckets(), Counter()
            for text in batch.column(0):
                for _, crc in _features(text.as_py() or b"", n, sums):
                    held.update(crc)
            for c, k in held.items():
                total[c % buckets] += k
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["bucket", "n"])

    counted = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "bucket int, n long")
    out = [0] * buckets
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the source, rounded down."""
    m, s_all, t_all = len(source), sum(source), sum(target)
    return [math.floor(1000 * math.log((float(t + 1) * float(s_all + m)) / (float(s + 1) * float(t_all + m)))) for s, t in zip(source, target, strict=True)]


def weigh(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text", n: int = 1) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row."""
    buckets = len(gain)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, out = _Buckets(), []
            for text in batch.column(1):
                words = features = total = 0
                for new, crc in _features(text.as_py() or b"", n, sums):
                    words, features = words + new, features + len(crc)
                    total += sum([gain[c % buckets] for c in crc])
                out.append((words, features, total // features if features else 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in zip(*out, strict=True)]] if out else [batch.column(0), *[pa.array([], pa.int64())] * 3], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(id_col: str = "doc_id", seed: int = 2024) -> F.Column:
    """Gumbel noise in thousandths, rounded down, from the first 32 bits of a hash of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(u)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", n: int = 1, buckets: int = 10_000, least: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every row.

    Of the documents with at least ``least`` words, ``percent`` in a hundred are drawn, rounded down; ``rank`` is the place in the draw, else null.
    """
    gain = gains(bucket_counts(docs, text_col, n, buckets), bucket_counts(target, target_col, n, buckets))
    weighed = weigh(docs, gain, id_col, text_col, n)
    scored = stage(weighed.withColumn("score", F.col("weight") + noise(seed=seed)).withColumn("place", F.monotonically_increasing_id()), "scored")
    drawn = scored.where(F.col("n_words") >= least)
    most = percent * drawn.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("place")]
    ranked = numbered(drawn.repartitionByRange(*order).sortWithinPartitions(*order), "ranked", "at")
    rank = F.when(F.col("at") < most, F.col("at") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank.alias("rank")).unionByName(scored.where(F.col("n_words") < least).select(*columns, F.lit(None).cast("long").alias("rank")))
