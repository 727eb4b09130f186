"""SimHash near-duplicates: fingerprints, and binary-trie self-joins within a Hamming error budget.

Links within three bits of 64 (``near_duplicates``) are found whole: four tries are traversed, each over the
fingerprints rotated by another 16 bits, since two fingerprints within three bits of each other agree on at least one
16-bit quarter: in that trie the pair of their nodes reaches level 16 without spending any error. Spark's shuffle walks
those 16 levels (equal quarters meet), tasks walk the other 48 on pairs of nodes. A node with more than
``max_node`` fingerprints is dealt again by the quarters of its remaining bits, for the same reason without loss, and
again, until no node is larger.

Similarity of 0.8 (``similar_links``) is about 39 of 256 bits of a fingerprint over the set of five-word shingles, too
many for quarters. There the tries are of the fingerprint's bits in a random order: similar texts agree on the
first ``k`` bits of one with a known chance, so as many tries are walked as leave ``MISS`` of the pairs at
the threshold unseen; ``k`` and the tries grow with the logarithm and a root of the number of fingerprints, so that nodes stay small.
Tasks walk node pairs up to ``MOST`` differing bits. A node with more than ``max_node`` fingerprints is split into blocks, and each
pair of blocks is a task. Pairs within ``SURE`` bits are links, the others are verified by the exact Jaccard similarity of
their shingles. The first walk leaves a pair out where closer pairs, verified or not, connect it already; where one of these fails,
what candidates connect (a cluster) is walked again with the shingles at hand: there only verified links connect (``decide_clusters``), so
no pair is left out on the strength of a link that isn't one. A few tries go before the others: what they bring together is decided first, and the others
leave pairs within one such cluster out. So a large group of near copies has links of a few tries, not of all of them.

Defined results: null or blank texts have fingerprint zero and are linked like any other; repeated
rows get equal results; rows with a null id keep their fingerprint and, if no row of the component
has an id, a null component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitmill.llm import wordvec
from pitmill.llm.decontaminate import shingle_hashes
from pitmill.llm.workers import lean
from pitmill.operators.graph import connected_components
from pitmill.plans.staging import maybe_broadcast, stage

BITS, QUARTER = 64, 16
MAX_NODE = 200_000
#: Node pairs with at most this many leaf pairs are compared leaf by leaf.
LEAF_PAIRS = 32
#: Node pairs, leaf pairs and rows of whole nodes that a task holds at once, but for a larger node.
FRONT, LEAVES, FLUSH = 1 << 19, 1 << 18, 1 << 15
#: Fingerprints of similar texts: words of 64 bits, shingle, similarity; differing bits of sure and of possible links (at a similarity of 0.8, 39 are expected, with a deviation of 5.7).
WORDS, SHINGLE, SIMILARITY, SURE, MOST = 4, 5, 0.8, 20, 52
#: Share of the pairs at the threshold that no trie may bring together.
MISS = 0.02
#: Tries that go before the others at least, and one in so many of many.
FIRST, FIRST_SHARE = 4, 12
#: Shingles of the texts of a block of a cluster that is walked again.
BLOCK_SHINGLES = 2 << 20


def fingerprint(data: bytes | None, shingle: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of every word shingle, repeats included."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(text, 42)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begin = np.concatenate(([0], end[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(text[s:e], 42) for s, e in zip(begin[: 1 - shingle].tolist(), end[shingle - 1 :].tolist(), strict=True)]
    return int.from_bytes(_majority(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)), "big")


def _majority(rows: np.ndarray) -> bytes:
    """The bits that are set in over half of the rows of bytes."""
    count = np.zeros(rows.shape[1] * 8, np.int64)
    for k in range(0, len(rows), 255 * 64):  # byte counters hold 255 rows
        part = np.unpackbits(rows[k : k + 255 * 64], axis=1)
        whole = len(part) // 255 * 255
        count += part[:whole].reshape(-1, 255, len(count)).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        count += part[whole:].sum(axis=0, dtype=np.int64)
    return np.packbits(2 * count > len(rows)).tobytes()


def wide_fingerprint(shingles: np.ndarray) -> np.ndarray:
    """``WORDS`` words of majority bits over distinct shingle hashes."""
    if not len(shingles):
        return np.zeros(WORDS, np.uint64)
    rows = np.stack([wordvec.mix(shingles + wordvec.mix(np.array([k + 1], np.uint64))) for k in range(WORDS)], axis=1)
    return np.frombuffer(_majority(rows.astype(">u8").view(np.uint8).reshape(len(rows), -1)), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` holds the 64 bits as a signed long."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.fromiter((fingerprint(x.as_py(), shingle) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


class _Forest:
    """Trees of links found so far, by labels (the smallest index of a tree), and the links themselves."""

    def __init__(self, n: int, label: np.ndarray | None = None, accept: Callable[[int, int], bool] | None = None):
        self.label = np.arange(n) if label is None else label.copy()
        self.accept = accept
        self.links: list[np.ndarray] = []

    def link(self, i: np.ndarray, j: np.ndarray, far: np.ndarray) -> None:
        """Join trees by the given pairs, nearest first; only pairs that join two trees, and are accepted, are kept."""
        order = np.argsort(far, kind="stable")
        i, j, far = i[order], j[order], far[order]
        while True:
            a, b = self.label[i], self.label[j]
            open_ = a != b
            i, j, far, a, b = i[open_], j[open_], far[open_], a[open_], b[open_]
            if not len(i):
                return
            # each tree's nearest pair
            _, first = np.unique(np.concatenate((a, b)), return_index=True)
            pick = np.unique(first % len(i))
            if self.accept is not None:
                fine = np.array([self.accept(x, y) for x, y in zip(i[pick].tolist(), j[pick].tolist(), strict=True)])
                left = np.ones(len(i), bool)
                left[pick[~fine]] = False
                if not fine.any():
                    i, j, far = i[left], j[left], far[left]
                    continue
                pick = (np.cumsum(left) - 1)[pick[fine]]
                i, j, far, a, b = i[left], j[left], far[left], a[left], b[left]
            self.links.append(np.stack((i[pick], j[pick], far[pick])))
            a, b = a[pick], b[pick]
            while len(a):
                np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
                while (up := self.label[self.label]) is not None and (up != self.label).any():
                    self.label = up
                a, b = self.label[a], self.label[b]
                a, b = a[a != b], b[a != b]


def trie_links(bits: np.ndarray, pairs: tuple[np.ndarray, ...], budgets: tuple[int, ...], level: int, label: np.ndarray | None = None, accept: Callable[[int, int], bool] | None = None) -> np.ndarray:
    """Joint traversal of node pairs; (leaf, leaf, differing bits) of links that connect all pairs within the last budget.

    ``bits``: (words, leaves) of fingerprints, ascending within a node. ``pairs``: (begin, end, begin, end, differing
    bits) of the node pairs at ``level``; a node paired with itself stands for its inner pairs.
    The budget is raised step by step to the whole, and pairs of nodes that are one tree already
    are left out, so a dense family of copies costs few comparisons. ``label``: trees that are known already, named by their smallest leaf;
    ``accept`` decides whether a pair within the budget is a link.
    """
    n_bits, forest, sums = len(bits) * BITS, _Forest(bits.shape[1], label, accept), {}

    def ones(at: int) -> np.ndarray:
        if at not in sums:
            sums[at] = np.concatenate(([0], np.cumsum((bits[at // BITS] >> np.uint64(BITS - 1 - at % BITS)) & np.uint64(1), dtype=np.int32)))
        return sums[at]

    for allowed in budgets:
        stack = [(level, *pairs)]
        while stack:
            at, al, ah, bl, bh, diff = stack.pop()
            change = np.concatenate(([0], np.cumsum(forest.label[1:] != forest.label[:-1]))) if bits.size else np.zeros(1, int)
            one_tree = (forest.label[al] == forest.label[bl]) & (change[ah - 1] == change[al]) & (change[bh - 1] == change[bl])
            keep = ~one_tree & (diff <= allowed)
            al, ah, bl, bh, diff = (x[keep] for x in (al, ah, bl, bh, diff))
            if not len(al):
                continue
            if len(al) > FRONT:
                half = len(al) // 2
                stack += [(at, *(x[half:] for x in (al, ah, bl, bh, diff))), (at, *(x[:half] for x in (al, ah, bl, bh, diff)))]
                continue
            size = (ah - al) * (bh - bl)
            small = (size <= LEAF_PAIRS) | (at == n_bits)  # at the last level a leaf holds one fingerprint
            if small.any():
                n, width, lows, highs = size[small], (bh - bl)[small], al[small], bl[small]
                cut = np.searchsorted(np.cumsum(n), np.arange(LEAVES, n.sum() + LEAVES, LEAVES), "right")
                for lo, hi in zip([0, *cut[:-1]], cut, strict=True):
                    m = n[lo:hi]
                    own = np.repeat(np.arange(lo, hi), m)
                    k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                    i, j = lows[own] + k // width[own], highs[own] + k % width[own]
                    pair = (i < j) | (lows[own] != highs[own])
                    i, j = i[pair], j[pair]
                    far = np.zeros(len(i), np.int64)
                    for word in bits:
                        far += np.bitwise_count(word[i] ^ word[j])
                    near = far <= allowed
                    forest.link(i[near], j[near], far[near])
                al, ah, bl, bh, diff = (x[~small] for x in (al, ah, bl, bh, diff))
                if not len(al):
                    continue
            c = ones(at)
            am, bm, self_ = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl]), al == bl
            made = [
                np.concatenate(x)
                for x in zip(
                    (al, am, bl, bm, diff), (am, ah, bm, bh, diff), (al, am, bm, bh, diff + 1),
                    tuple(x[~self_] for x in (am, ah, bl, bm, diff + 1)), strict=True,
                )
            ]
            full = (made[0] < made[1]) & (made[2] < made[3])
            stack.append((at + 1, *(x[full] for x in made)))
    return np.concatenate(forest.links, axis=1) if forest.links else np.empty((3, 0), np.int64)


def _walk(nodes: DataFrame, node: list[str], words: list[str], budgets: tuple[int, ...], max_node: int) -> DataFrame:
    """Links ``(a, b, far)`` within the nodes of ``nodes``: columns of a node's name, the first its level, fingerprint words, and ``rep``.

    Where the name ends in ``side`` (0 or 1), the two sides of a node are walked against each other; -1 stands for a node by itself.
    Rows of one ``settled``, where there is this column, are one tree from the start.
    """
    known = ["settled"] if "settled" in nodes.columns else []
    names = [*node, *words, "rep", *known]

    def links(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        key = np.stack([rows[k] for k in node])
        begin = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
        end = np.append(begin[1:], key.shape[1])
        bits, levels, out = np.stack([rows[k] for k in words]), key[0][begin], [np.empty((3, 0), np.int64)]
        label = None
        if known:
            _, first, tree = np.unique(rows["settled"], return_index=True, return_inverse=True)
            label = first[tree]
        alone = np.ones(len(begin), bool)
        if node[-1] == "side":
            alone = key[-1][begin] == -1
            two = np.flatnonzero(~alone[:-1] & (key[:-1, begin[1:]] == key[:-1, begin[:-1]]).all(axis=0))  # the sides of a node are next to each other
            for k in two.tolist():
                pair = tuple(np.array([x]) for x in (begin[k], end[k], begin[k + 1], end[k + 1], 0))
                out.append(trie_links(bits, pair, budgets, int(levels[k]), label))
        for level in np.unique(levels):
            mine = (levels == level) & (end - begin > 1) & alone
            if mine.any():
                b, e = begin[mine], end[mine]
                out.append(trie_links(bits, (b, e, b, e, np.zeros(len(b), np.int64)), budgets, int(level), label))
        i, j, far = np.concatenate(out, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(rows["rep"][i]), pa.array(rows["rep"][j]), pa.array(far)], ["a", "b", "far"])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        n = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            rows = {k: np.concatenate([h[k] for h in held]) for k in names}
            key = np.stack([rows[k] for k in node if k != "side"])
            edge = key.shape[1] if last else int(np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))[-1])
            if edge:
                yield links({k: x[:edge] for k, x in rows.items()})
            held, n = ([{k: x[edge:] for k, x in rows.items()}], key.shape[1] - edge) if not last else ([], 0)

        for batch in batches:
            if batch.num_rows:
                held.append({k: np.asarray(batch.column(i)).view(np.uint64) if k in words else np.asarray(batch.column(i)) for i, k in enumerate(names)})
                n += batch.num_rows
                if n >= min(max_node, FLUSH):
                    yield from flush(False)
        if held:
            yield from flush(True)

    # signed order is not trie order: the sign bit is flipped for the sort
    order = [*node, *[F.expr(f"{w} ^ (-9223372036854775807L - 1)") for w in words]]
    return nodes.select(*names).repartition(*[k for k in node if k != "side"]).sortWithinPartitions(*order).mapInArrow(run, "a long, b long, far long")


def _dealt_again(nodes: DataFrame, node: list[str], max_node: int, again) -> DataFrame:
    """``nodes`` with the rows of nodes above ``max_node`` replaced by ``again(rows, turn)``, until it gives None or no node is larger."""
    done, turn = None, 0
    while True:
        large = stage(nodes.groupBy(*node).agg(F.count("*").alias("n")).where(F.col("n") > max_node).drop("n"), "large")
        more = again(nodes.join(large, node, "left_semi"), turn) if large.count() else None
        if more is None:
            return nodes if done is None else done.unionByName(nodes)
        rest = nodes.join(large, node, "left_anti")
        done = rest if done is None else done.unionByName(rest)
        nodes, turn = stage(more, "dealt"), turn + 1


def _blocks(nodes: DataFrame, node: list[str], max_node: int) -> tuple[DataFrame, list[str]]:
    """``nodes`` with those above ``max_node`` rows, if there are any, split into blocks by a hash of ``rep``: each block by itself, and each two as the sides of a node; and the name of a node."""
    named = [*node, "block", "other", "side"]
    alone = {"block": F.lit(0), "other": F.lit(0), "side": F.lit(-1)}
    large = stage(nodes.groupBy(*node).agg(F.count("*").alias("n")).where(F.col("n") > max_node).select(*node, F.ceil(2 * F.col("n") / max_node).cast("int").alias("g")), "large")
    if large.isEmpty():
        return nodes, node
    small = nodes.join(large, node, "left_anti").withColumns(alone)
    split = nodes.join(large, node).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("g")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    side = F.when(F.col("mine") == F.col("with"), -1).otherwise((F.col("mine") > F.col("with")).cast("int"))
    split = split.withColumns({"block": F.least("mine", "with"), "other": F.greatest("mine", "with"), "side": side})
    return small.unionByName(split.drop("g", "mine", "with")), named


def trie_self_join(fps: DataFrame, budget: int = 3, max_node: int = MAX_NODE) -> DataFrame:
    """Links ``(a, b)`` of a forest that connects what pairs of ``(fp, rep)`` rows within ``budget`` bits connect.

    ``fp`` must be distinct; ``rep`` names it. The budget is at most three, one less than the tries.
    """
    parts = BITS // QUARTER
    if not 1 <= budget < parts:
        raise ValueError("the budget must be 1, 2 or 3 bits")
    turned = fps.withColumn("path", F.explode(F.array(*[F.lit(k) for k in range(parts)]))).withColumn("level", F.lit(QUARTER))
    rotated = F.expr(f"shiftleft(fp, path * {QUARTER}) | CASE path WHEN 0 THEN 0L ELSE shiftrightunsigned(fp, {BITS} - path * {QUARTER}) END")
    top = F.expr(f"shiftrightunsigned(bits, {BITS} - level)")
    node = ["level", "path", "top"]

    def again(rows: DataFrame, turn: int) -> DataFrame | None:
        """Each row in a trie for each quarter of the bits below its node's level."""
        level = QUARTER
        for _ in range(turn):
            level += (BITS - level) // parts
        rest = BITS - level
        step = rest // parts
        if not step:
            return None
        low, mask = f"(bits & {(1 << rest) - 1}L)", f"{(1 << rest) - 1}L"
        moved = F.expr(f"(bits & ~{mask}) | (CASE part WHEN 0 THEN {low} ELSE (shiftleft({low}, part * {step}) | shiftrightunsigned({low}, {rest} - part * {step})) & {mask} END)")
        rows = rows.withColumn("part", F.explode(F.array(*[F.lit(k) for k in range(parts)]))).withColumn("bits", moved)
        return rows.withColumns({"level": F.lit(level + step), "path": F.expr(f"path * {parts} + part")}).withColumn("top", top).drop("part")

    nodes = turned.withColumn("bits", rotated).withColumn("top", top).select(*node, "bits", "rep")
    return _walk(_dealt_again(nodes, node, max_node, again), node, ["bits"], tuple(range(1, budget + 1)), max_node).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, budget: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``; see the module for edge cases."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle), "simhash")
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("first_"))
    found = connected_components(trie_self_join(reps.select("fp", F.col("fp").alias("rep")), budget)).withColumnRenamed("node", "fp")
    placed = reps.join(found, "fp", "left").select("fp", "first_", F.coalesce("component", "fp").alias("c_"))
    least = placed.groupBy("c_").agg(F.min("first_").alias("component_id"))
    return prints.join(placed.join(least, "c_").select("fp", "component_id"), "fp", "left").select("doc_id", "fp", "component_id")


def hex_digits(fp: str = "fp") -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def plan_tries(n: int) -> tuple[int, int]:
    """(bits that a trie's nodes agree on, tries) for ``n`` fingerprints: nodes of a few fingerprints, and ``MISS`` of the pairs at the threshold in none."""
    agree = 1 - math.acos(2 * SIMILARITY / (1 + SIMILARITY)) / math.pi
    bits = max(16, math.ceil(math.log2(max(2, n))) - 2)
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree**bits))


def similar_links(fps: DataFrame, max_node: int = MAX_NODE) -> DataFrame:
    """Links ``(a, b, far)`` of at most ``MOST`` bits between ``(w0 .. w3, rep)`` rows; the fingerprints must be distinct.

    With ``settled``, a further column, only what links rows of different values of it.
    """
    return _trie_links_of(fps, *plan_tries(fps.count()), 17, max_node)


def first_links(fps: DataFrame) -> DataFrame | None:
    """Links as ``similar_links`` has them, of a few further tries; None where there are hardly more tries than that."""
    bits, tries = plan_tries(fps.count())
    few = max(FIRST, tries // FIRST_SHARE)
    return _trie_links_of(fps, bits, few, 18, MAX_NODE) if tries > 2 * few else None


def _trie_links_of(fps: DataFrame, bits: int, tries: int, seed: int, max_node: int) -> DataFrame:
    words, node = [f"w{k}" for k in range(WORDS)], ["level", "top"]
    carried = [*words, "rep", *(["settled"] if "settled" in fps.columns else [])]
    rng = np.random.default_rng(seed)
    picked = np.stack([rng.permutation(WORDS * BITS)[:bits] for _ in range(tries)])

    @lean
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                n = batch.num_rows
                own = np.stack([np.asarray(batch.column(k)).view(np.uint64) for k in range(WORDS)], axis=1)
                bit = np.unpackbits(own.astype(">u8").view(np.uint8).reshape(n, -1), axis=1)
                top = (bit[:, picked.T].astype(np.int64) << np.arange(bits)[:, None]).sum(axis=1)  # (rows, tries)
                top += np.arange(tries) << bits  # a node's name holds its trie
                columns = [pa.array(np.zeros(n * tries, np.int32)), pa.array(top.ravel())]
                at = pa.array(np.repeat(np.arange(n), tries))
                yield pa.RecordBatch.from_arrays([*columns, *[c.take(at) for c in batch.columns]], [*node, *carried])

    nodes = fps.select(*carried).mapInArrow(spread, "level int, top long, " + ", ".join(f"{c} long" for c in carried))
    nodes, named = _blocks(stage(nodes, "tries"), node, max_node)
    links = _walk(nodes, named, words, (4, 10, SURE, 28, 36, 44, MOST), max_node)
    return links.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("far").alias("far"))


def _prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, sha, w0 .. w3)`` of every row."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, WORDS), np.uint64)
            for i, word in wordvec.text_words([x or b"" for x in batch.column(2).to_pylist()]):
                out[i] = wide_fingerprint(np.unique(shingle_hashes(word, SHINGLE)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(np.ascontiguousarray(c).view(np.int64)) for c in out.T]], ["doc_id", "sha", *[f"w{k}" for k in range(WORDS)]])

    text = F.col(text_col).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(F.coalesce(text, F.lit(b"")), 256).alias("sha"), text.alias("text"))
    return stage(rows.mapInArrow(run, "doc_id long, sha string, " + ", ".join(f"w{k} long" for k in range(WORDS))), "prints")


def _sets(wanted: DataFrame, reps: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """``(rep, shingles)`` of the representatives in ``wanted``."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.empty(0, np.uint64)] * batch.num_rows
            for i, word in wordvec.text_words([x or b"" for x in batch.column(1).to_pylist()]):
                sets[i] = np.unique(shingle_hashes(word, SHINGLE))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["rep", "shingles"])

    ends = wanted.select("rep").distinct().join(reps.select("rep", "sha"), "rep")
    rows = docs.select(F.sha2(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")), 256).alias("sha"), F.col(text_col).cast("binary").alias("text"))
    # a limit within each group before and after the shuffle: of a text that many rows hold, one is sent a task
    one = rows.join(maybe_broadcast(stage(ends, "ends"), 100), "sha").withColumn("k", F.row_number().over(Window.partitionBy("rep").orderBy("rep"))).where("k = 1")
    return stage(one.select("rep", "text").mapInArrow(run, "rep long, shingles array<long>"), "sets")


def _verified(links: DataFrame, sets: DataFrame) -> DataFrame:
    """The links whose representatives' shingle sets have a Jaccard similarity of ``SIMILARITY`` or more."""
    both = links.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared >= SIMILARITY * (F.size("x") + F.size("y") - shared) - 1e-9).select("a", "b")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets of hashes have a Jaccard similarity of ``SIMILARITY`` or more."""
    least, most = sorted((len(x), len(y)))
    if least < SIMILARITY * most - 1e-9:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared >= SIMILARITY * (least + most - shared) - 1e-9


def decide_clusters(rows: DataFrame, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Verified links ``(a, b)`` within clusters, so that they and the known trees connect what pairs of at most ``MOST`` bits that are similar connect.

    ``rows``: ``(cluster, tree, w0 .. w3, rep, shingles)``. A cluster of more than ``block_shingles`` is dealt into blocks, and every two blocks of it, and every block
    by itself, are one task's, so no pair is lost and no task holds more than two blocks. With ``settled``, a further column, pairs of one value of it are decided already.
    """
    words = [f"w{k}" for k in range(WORDS)]
    size = rows.groupBy("cluster").agg(F.ceil(F.sum(F.size("shingles")) / block_shingles).cast("int").alias("g"))
    size = maybe_broadcast(stage(size, "sizes"), 24)
    dealt = rows.join(size, "cluster").withColumn("g", F.greatest("g", F.lit(1))).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("g")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    dealt = dealt.withColumns({"p": F.least("mine", "with"), "q": F.greatest("mine", "with")})
    node, known = ["cluster", "p", "q"], ["settled"] if "settled" in rows.columns else []

    def decided(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        col = lambda k: table.column(k).combine_chunks()
        p, q, mine = (table.column(k)[0].as_py() if k != "mine" else np.asarray(col(k)) for k in ("p", "q", "mine"))
        bits = np.stack([np.asarray(col(w)).view(np.uint64) for w in words])
        shingles = col("shingles")
        off, flat = np.asarray(shingles.offsets), np.asarray(shingles.values).view(np.uint64)
        order = np.lexsort((*bits[::-1], mine))
        bits, rep = bits[:, order], np.asarray(col("rep"))[order]
        _, first, tree = np.unique(np.asarray(col("tree"))[order], return_index=True, return_inverse=True)
        settled = np.asarray(col("settled"))[order] if known else rep
        accept = lambda i, j: settled[i] != settled[j] and similar(flat[off[order[i]] : off[order[i] + 1]], flat[off[order[j]] : off[order[j] + 1]])
        n, cut = len(rep), int((mine == p).sum())
        pair = (0, n, 0, n, 0) if p == q else (0, cut, cut, n, 0)
        budgets = (SURE, 28, 36, 44, MOST)
        i, j, _ = trie_links(bits, tuple(np.array([x]) for x in pair), budgets, 0, first[tree], accept) if pair[0] < pair[1] and pair[2] < pair[3] else np.empty((3, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(rep[i]), pa.array(rep[j])], ["a", "b"])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            key = np.stack([np.asarray(batch.column(k)) for k in node])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                own = tuple(key[:, lo].tolist())
                if held and own != last:
                    yield decided(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
                last = own
        if held:
            yield decided(held)

    return dealt.select(*node, "mine", "tree", *words, "rep", *known, "shingles").repartition(*node).sortWithinPartitions(*node).mapInArrow(run, "a long, b long")


def _components(links: DataFrame, name: str, before: DataFrame | None = None) -> DataFrame:
    """``(rep, name)``: what ``links`` connect, with what is in one of the components ``before``."""
    links = links.select("a", "b")
    if before is not None:
        links = links.unionByName(before.select(F.col("rep").alias("a"), F.col(name).alias("b")))
    return stage(connected_components(links).select(F.col("node").alias("rep"), F.col("component").alias(name)), name)


def _decided(links: DataFrame, reps: DataFrame, docs: DataFrame, text_col: str, trees: DataFrame | None = None, clusters: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rep, tree)`` of what verified links connect and ``(rep, cluster)`` of what ``links`` connect, verified or not: within a cluster all pairs of at most ``MOST`` bits are decided.

    ``trees`` and ``clusters``: what earlier links, decided likewise, have made; ``links`` are between such clusters.
    """
    words = [f"w{k}" for k in range(WORDS)]
    unsure = links.where(F.col("far") > SURE)
    verified = stage(_verified(unsure, _sets(unsure.select(F.explode(F.array("a", "b")).alias("rep")), reps, docs, text_col)), "verified")
    found = _components(links.where(F.col("far") <= SURE).select("a", "b").unionByName(verified), "tree", trees)
    if clusters is None and unsure.select("a", "b").join(verified, ["a", "b"], "left_anti").isEmpty():
        return found, found.withColumnRenamed("tree", "cluster")
    # what hid behind a link that failed, or behind one that joins other trees of a cluster, is in one cluster of candidates with it
    cluster = _components(links, "cluster", clusters)
    touched = stage(links.select(F.col("a").alias("rep")).join(cluster, "rep").select("cluster").distinct(), "touched")
    open_ = cluster.join(maybe_broadcast(touched, 16), "cluster", "left_semi")
    held = open_.join(found, "rep", "left").select("rep", "cluster", F.coalesce("tree", "rep").alias("tree"))
    several = held.groupBy("cluster").agg(F.count("*").alias("n"), F.min("tree").alias("least"), F.max("tree").alias("most")).where("n > 2 and least < most").select("cluster")
    members = stage(held.join(maybe_broadcast(stage(several, "several"), 16), "cluster", "left_semi"), "members")
    rows = members.join(reps.select("rep", *words), "rep").join(_sets(members, reps, docs, text_col), "rep")
    if clusters is not None:
        rows = rows.join(clusters.withColumnRenamed("cluster", "settled"), "rep", "left").withColumn("settled", F.coalesce("settled", "rep"))
    return _components(stage(decide_clusters(rows), "more"), "tree", found), cluster


def later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, sha)`` of the texts that are not the first of their group; ``sha`` is the SHA-256 of a text.

    Texts of five-word shingles with a similarity of 0.8 or more are linked, groups are what links connect, and the
    first text of a group has its smallest id (then the smaller ``sha``). Rows without an id link others and are not returned.
    """
    words = [f"w{k}" for k in range(WORDS)]
    prints = _prints(docs, id_col, text_col)
    reps = stage(prints.groupBy(*words).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha")).alias("first"), F.min("sha").alias("sha")).withColumn("rep", F.monotonically_increasing_id()), "reps")
    trees, clusters = None, None
    early = first_links(reps)
    if early is not None:
        trees, clusters = _decided(stage(early, "links"), reps, docs, text_col)
    rest = reps if clusters is None else reps.join(clusters, "rep", "left").withColumn("settled", F.coalesce("cluster", "rep"))
    found, _ = _decided(stage(similar_links(rest), "links"), reps, docs, text_col, trees, clusters)
    placed = reps.join(found, "rep", "left").select(*words, "first", F.coalesce("tree", "rep").alias("c"))
    least = placed.groupBy("c").agg(F.min("first").alias("first"))
    kept = placed.join(least.select("c", F.col("first").alias("kept")), "c").select(*words, "kept")
    named = prints.where("doc_id is not null").select("doc_id", "sha", *words).distinct()
    return named.join(kept, words).where(~((F.col("doc_id") == F.col("kept.doc_id")) & (F.col("sha") == F.col("kept.sha")))).select("doc_id", "sha")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pipeline stage: of each group of similar texts (see ``later_copies``) the rows of the first, once, with their columns, whatever their names.

    Rows without an id can't be compared by it and stay.
    """
    sha = F.sha2(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")), 256)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), sha.alias("sha"))
    repeated = stage(rows.where("doc_id is not null").groupBy("doc_id", "sha").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    gone = stage(later_copies(docs, id_col, text_col), "gone")
    kept = rows.join(maybe_broadcast(gone, 100), ["doc_id", "sha"], "left_anti")
    once, often = kept, None
    if repeated.count():  # rows with one id and one text: the first of them in the order of their columns
        held = maybe_broadcast(repeated, 100)
        once = kept.join(held, ["doc_id", "sha"], "left_anti")
        often = kept.join(held, ["doc_id", "sha"], "left_semi").withColumn("k", F.row_number().over(Window.partitionBy("doc_id", "sha").orderBy(F.to_json("row")))).where("k = 1")
    out = once.select("row.*")
    return out if often is None else out.unionByName(often.select("row.*"))
