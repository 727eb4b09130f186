"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Words are runs of ASCII letters, digits and characters beyond ASCII, in lower case; a text's
shingles are its distinct runs of five words (fewer words: all of them as one). A document is
contaminated by an item if it holds at least ``share`` of the item's shingles.

Containment of a short item in a long text has a tiny Jaccard similarity, so sizes are matched
first. Items of at most ``BLOCK // 2`` shingles are part -1: their shingles themselves are the keys, so
whatever document holds one of them is found. Larger items are partitioned by size: part c holds those of
up to ``BLOCK * 2**c`` shingles. For part c a document is read in blocks of that many shingles, and every two neighbouring blocks are one
window, so that a passage as long as an item of the part lies whole in a window at most four times
the item's size. A contained item then has a similarity of 0.19 or more to its window, and one of
64 MinHash values agrees in all but about one case in a million. A document's window values pass a
Bloom filter of the items' values (of bounded size), what is left meets the items in a join, and
the pairs found are verified by exact containment of shingles, as text, in the whole document.

Defined results: null and wordless texts or items match nothing; repeated documents are found
alike, repeated items are one each; rows with a null id are found with that id; an empty table on
either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.llm import wordvec
from pitmill.llm.workers import lean
from pitmill.plans.staging import maybe_broadcast, stage

SHINGLE, BLOCK, HASHES = 5, 16, 64
#: The Bloom filter has so many bits and probes a value, and between these many bits in all (the upper bound is 32 MB).
BITS_PER_KEY, PROBES, BLOOM_BITS = 256, 4, (1 << 20, 1 << 28)
#: Words of 64 bits that a task packs for the driver.
BLOOM_WORDS = 1 << 14
_A = (wordvec.mix(np.arange(1, HASHES + 1, dtype=np.uint64)).astype(np.uint32)) | np.uint32(1)
_B = wordvec.mix(np.arange(1001, 1001 + HASHES, dtype=np.uint64)).astype(np.uint32)


def shingle_hashes(word: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """A hash of each run of ``width`` words, in order; of all words, where there are fewer."""
    if len(word) < width:
        width = len(word)
    if not width:
        return np.empty(0, np.uint64)
    out = np.zeros(len(word) - width + 1, np.uint64)
    for k in range(width):
        out = wordvec.mix(out * np.uint64(0x9E3779B97F4A7C15) + word[k : len(word) - width + 1 + k])
    return out


def _minima(shingles: np.ndarray) -> np.ndarray:
    """Least values (blocks, HASHES) of each block of ``BLOCK`` shingles."""
    parts, x = [], shingles.astype(np.uint32)
    for lo in range(0, len(x), BLOCK * 512):
        part = x[lo : lo + BLOCK * 512, None] * _A + _B
        whole = len(part) // BLOCK * BLOCK
        parts.append(part[:whole].reshape(-1, BLOCK, HASHES).min(axis=1))
        if whole < len(part):
            parts.append(part[whole:].min(axis=0, keepdims=True))
    return np.concatenate(parts) if parts else np.empty((0, HASHES), np.uint32)


def _keys(minima: np.ndarray, part: int) -> np.ndarray:
    place = np.uint64(part * HASHES) + np.arange(HASHES, dtype=np.uint64)
    return wordvec.mix((minima.astype(np.uint64) << np.uint64(16)) + place)


def _own_keys(shingles: np.ndarray) -> np.ndarray:
    return wordvec.mix(shingles + np.uint64(0x632BE59BD9B4E019))


def part_of(n: int) -> int:
    """The size part of an item with ``n`` shingles; -1 where the shingles are the keys."""
    return -1 if n <= BLOCK // 2 else max(0, -(-n // BLOCK) - 1).bit_length()


def item_keys(shingles: np.ndarray) -> np.ndarray:
    """The item's MinHash values, or its few shingles, as keys of its part."""
    if part_of(len(shingles)) < 0:
        return _own_keys(shingles)
    return _keys(_minima(shingles).min(axis=0, keepdims=True), part_of(len(shingles)))[0]


def window_keys(shingles: np.ndarray, parts: list[int]) -> Iterator[np.ndarray]:
    """The keys of all windows of a document, for each part that has items, and of its shingles for part -1."""
    if -1 in parts:
        yield _own_keys(shingles)
    if max(parts) < 0:
        return
    low, part = _minima(shingles), 0
    while len(low):
        if part in parts:
            yield _keys(np.minimum(low[:-1], low[1:]) if len(low) > 1 else low, part).ravel()
        part += 1
        if part > max(parts):
            return
        if len(low) % 2 and len(low) > 1:
            low = np.concatenate((low, low[-1:]))
        low = low.reshape(-1, 2, HASHES).min(axis=1) if len(low) > 1 else low


def shingles_of(text: str) -> set[str]:
    """The distinct shingles of a text in lower case, as text."""
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", text)
    if len(w) < SHINGLE:
        return {" ".join(w)} if w else set()
    return {" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}


def _bloom(keys: DataFrame) -> np.ndarray:
    """Words of 64 bits; ``PROBES`` bits for each key."""
    n = keys.count()
    bits = min(max(1 << max(1, (BITS_PER_KEY * n - 1).bit_length()), BLOOM_BITS[0]), BLOOM_BITS[1])
    places = keys.select(F.explode(F.array(*[F.expr(f"((key & {bits - 1}) + {j} * ((shiftrightunsigned(key, 32) & {bits - 1}) | 1)) & {bits - 1}") for j in range(PROBES)])).alias("p"))
    words = places.select(F.expr("p div 64").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b")).groupBy("w").agg(F.expr("bit_or(b)").alias("b"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros(BLOOM_WORDS, np.uint64)
        part[pdf["w"].to_numpy() % BLOOM_WORDS] = pdf["b"].to_numpy().view(np.uint64)
        return pd.DataFrame({"c": [int(pdf["c"].iloc[0])], "words": [part.tobytes()]})

    # words are packed in tasks: at most BLOOM_BITS / 64 / BLOOM_WORDS rows come to the driver
    rows = words.withColumn("c", F.expr(f"w div {BLOOM_WORDS}")).groupBy("c").applyInPandas(pack, "c long, words binary").collect()
    out = np.zeros(max(bits // 64, BLOOM_WORDS), np.uint64)
    for r in rows:
        out[r["c"] * BLOOM_WORDS : (r["c"] + 1) * BLOOM_WORDS] = np.frombuffer(bytes(r["words"]), np.uint64)
    return out[: bits // 64]


def _passes(bloom: np.ndarray, keys: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(bloom) * 64 - 1)
    for j in range(PROBES):
        p = ((keys & mask) + np.uint64(j) * (((keys >> np.uint64(32)) & mask) | np.uint64(1))) & mask
        keys = keys[(bloom[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1]
    return keys


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", share: float = 0.8) -> DataFrame:
    """``(doc_id, item_id, shared, item_shingles, containment, text_sha256)`` of each document and item that it holds."""

    @lean
    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, part, keys = [], [], []
            for i, word in wordvec.text_words([x or b"" for x in batch.column(1).to_pylist()]):
                shingles = np.unique(shingle_hashes(word))
                if len(shingles):
                    ids.append(batch.column(0)[i].as_py())
                    part.append(part_of(len(shingles)))
                    keys.append(np.unique(item_keys(shingles)).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(part, pa.int32()), pa.array(keys, pa.list_(pa.int64()))], ["item_id", "part", "keys"])

    tests = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("item")).distinct()
    of_item = stage(tests.select("item_id", F.lower("item").cast("binary")).mapInArrow(of_items, "item_id long, part int, keys array<long>"), "items")
    parts = sorted(r[0] for r in of_item.select("part").distinct().collect())  # one for each doubling of the item size
    spread = of_item.select("item_id", F.explode("keys").alias("key"))
    bloom = docs.sparkSession.sparkContext.broadcast(_bloom(spread.select("key").distinct()))

    @lean
    def of_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[np.ndarray] = [np.empty(0, np.uint64)] * batch.num_rows
            if parts:
                for i, word in wordvec.text_words([x or b"" for x in batch.column(2).to_pylist()]):
                    got = [_passes(bloom.value, k) for k in window_keys(shingle_hashes(word), parts)]
                    found[i] = np.unique(np.concatenate(got)) if got else found[i]
            hit = pa.array([len(f) > 0 for f in found], pa.bool_())
            keys = pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys], ["doc_id", "text", "keys"]).filter(hit)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.lower(text_col).cast("binary").alias("lower"))
    hits = stage(rows.mapInArrow(of_docs, "doc_id long, text string, keys array<long>").withColumn("row", F.monotonically_increasing_id()), "hits")
    pairs = hits.select("row", F.explode("keys").alias("key")).join(spread, "key").select("row", "item_id").distinct()
    # a document's items are gathered before they meet its text, which is sent once
    named = pairs.join(tests.select("item_id", F.lower("item").alias("item")), "item_id").groupBy("row").agg(F.collect_list(F.struct("item_id", "item")).alias("items"))
    both = named.join(hits.select("row", "doc_id", F.lower("text").alias("lower"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")), "row")

    @lean
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[str]] = {}
        for batch in batches:
            out = []
            for doc, sha, text, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = shingles_of(text)
                for one in items:
                    item = one["item"]
                    if item not in known:
                        known = {} if len(known) > 10_000 else known
                        known[item] = shingles_of(item)
                    n, shared = len(known[item]), len(known[item] & held)
                    if n and shared >= share * n - 1e-9:
                        out.append((doc, one["item_id"], shared, n, shared / n, sha))
            cols = list(zip(*out, strict=True)) or [()] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "item_id", "shared", "item_shingles", "containment", "text_sha256"])

    return both.select("doc_id", "text_sha256", "lower", "items").mapInArrow(verify, "doc_id long, item_id long, shared long, item_shingles long, containment double, text_sha256 string")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pipeline stage: the rows of ``docs`` that hold no item, with their columns, whatever their names; rows without an id count by their text."""
    bad = stage(contaminated(docs, items, id_col, text_col).select(F.col("text_sha256").alias("sha")).distinct(), "bad")
    rows = docs.select(F.struct("*").alias("row"), F.sha2(F.col(text_col).cast("binary"), 256).alias("sha"))
    return rows.join(maybe_broadcast(bad, 100), "sha", "left_anti").select("row.*")
