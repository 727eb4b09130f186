"""Nearest neighbours by inner product: one hierarchical small-world graph a shard, results merged.

Equal vectors are one node (a third of all rows may be copies of one); a node keeps as many of its
smallest ids as an answer can use. Nodes are dealt to cells by the nearest of some centroids, which are
fitted on a bounded sample (``SAMPLE`` vectors); every node is indexed. There are ``sqrt(nodes) / SPREAD``
cells, so their number and their size both grow as the root of the table; a cell of more than twice the
usual size is dealt to several shards by a hash. A shard's graph is flat arrays: an int32 matrix of
neighbours for each level (-1: none), the level of each node, and the vectors. Inside a shard
vectors get one more component that makes all lengths equal, so the largest inner product is the
smallest distance. Nodes are inserted in batches that double in size: a batch searches the graph
built so far, is linked to the diverse among what it found, and links back.

A query is sent to the shards of its ``probes`` nearest cells: all of them where there are at most ``PROBES``. Beyond, a bounded
sample of the queries is compared with every node, and as many cells are asked as hold ``TARGET`` of the sample's true
neighbours, so recall stays as the table grows; what that costs is the data's affair (of isotropic vectors most cells must be asked). Queries are
sent to shards and a shard's graph is read once for ``PART_QUERIES`` of them. A shard's answers are its ``k``
best nodes, scored in double precision on the original vectors, and the answers of all shards are merged.

Defined results: null or zero vectors and those with null or non-finite components take no part, as
queries or as candidates; of rows with one id and several vectors each is a row, as a candidate and as a query
(with a list of its own); equal query rows count once; a null id takes no part;
fewer than ``k`` candidates give fewer rows; vectors of another length than the query's are no candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitmill.llm.sampling import first_by_hash
from pitmill.llm.workers import lean
from pitmill.plans.staging import stage

#: Cells are the root of the number of nodes divided by SPREAD; a query asks PROBES of them at least.
SPREAD, PROBES = 32, 16
#: Share of the true neighbours of at most so many sampled queries (of each length) that the cells asked must hold.
TARGET, CALIBRATION = 0.95, 256
#: Queries that one copy of a shard's graph serves, and that are searched at once.
PART_QUERIES, BLOCK = 50_000, 512
#: Vectors of each length that centroids are fitted on, and components of all of them, at most.
SAMPLE, SAMPLE_SIZE = 16_384, 1 << 23
#: Components of the vectors of a shard at most.
SHARD_SIZE = 1 << 25
LINKS, WIDTH, SEARCH, ENTRIES = 24, 96, 128, 16
#: Marks of visited nodes that a search holds at once.
SEEN = 1 << 26


def _entries(found: np.ndarray) -> np.ndarray:
    """The first nodes found; -1 where there are fewer."""
    return found[:, :ENTRIES]


def _lengthened(x: np.ndarray) -> np.ndarray:
    """Vectors with one more component, all of one length."""
    own = np.einsum("ij,ij->i", x, x)
    return np.concatenate((x, np.sqrt(np.maximum(own.max(initial=0.0) - own, 0))[:, None]), axis=1).astype(np.float32)


def _beam(vec: np.ndarray, links: np.ndarray, query: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all queries in step: their ``width`` nearest nodes found, nearest first, and inner products.

    Each turn widens, for every query, the nearest node it has not widened yet.
    """
    n, q = len(vec), len(query)
    row = np.arange(q)
    node = np.full((q, width), -1, np.int64)
    score = np.full((q, width), -np.inf, np.float32)
    done = np.ones((q, width), bool)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True
    e = entry.shape[1]
    node[:, :e], done[:, :e] = entry, entry < 0
    score[:, :e] = np.where(entry < 0, -np.inf, np.einsum("qkd,qd->qk", vec[np.maximum(entry, 0)], query))
    seen[row[:, None], np.where(entry < 0, n, entry)] = True
    live = row
    while len(live):
        best = np.argmax(np.where(done[live], -np.inf, score[live]), axis=1)
        open_ = ~done[live, best]
        live, best = live[open_], best[open_]
        if not len(live):
            break
        done[live, best] = True
        near = links[node[live, best]]
        near = np.where(near < 0, n, near)
        new = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        got = np.where(new, np.einsum("qkd,qd->qk", vec[np.minimum(near, n - 1)], query[live]), -np.inf).astype(np.float32)
        all_node = np.concatenate((node[live], near), axis=1)
        all_score = np.concatenate((score[live], got), axis=1)
        all_done = np.concatenate((done[live], ~new), axis=1)
        top = np.argpartition(-all_score, width - 1, axis=1)[:, :width]
        take = lambda x: np.take_along_axis(x, top, axis=1)
        node[live], score[live], done[live] = take(all_node), take(all_score), take(all_done) | ~np.isfinite(take(all_score))
    order = np.argsort(-score, axis=1, kind="stable")
    return np.take_along_axis(np.where(np.isfinite(score), node, -1), order, axis=1), np.take_along_axis(score, order, axis=1)


def _diverse(vec: np.ndarray, own: np.ndarray, found: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1: none) those nearer to the row's node than to any taken before; the rest fill up."""
    q, width = found.shape
    safe = np.maximum(found, 0)
    cand = vec[safe]
    to_own = np.einsum("qkd,qd->qk", cand, vec[own])
    between = np.einsum("qid,qjd->qij", cand, cand)
    ok = (found >= 0) & (found != own[:, None])
    taken = np.zeros((q, width), bool)
    for k in range(width):
        shaded = (taken & (between[:, k, :] > to_own[:, k, None])).any(axis=1)
        taken[:, k] = ok[:, k] & ~shaded & (taken.sum(axis=1) < most)
    rank = np.where(taken, 0, np.where(ok, 1, 2)) * width + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :most]
    return np.where(np.take_along_axis(ok, order, axis=1), np.take_along_axis(found, order, axis=1), -1)


def build(x: np.ndarray, links: int = LINKS, width: int = WIDTH, seed: int = 7) -> dict[str, np.ndarray]:
    """The graph of one shard's vectors: ``level`` of each node, ``graph<l>`` for each level, ``entry``."""
    vec, n = _lengthened(x.astype(np.float64)), len(x)
    rng = np.random.default_rng(seed)
    level = np.minimum(np.floor(-np.log(np.maximum(rng.random(n), 1e-12)) / np.log(links)), 6).astype(np.int8)
    order = np.argsort(-level, kind="stable")  # upper nodes first: every level has its entry
    top = int(level[order[0]])
    graph = [np.full((n, links * (2 if at == 0 else 1)), -1, np.int32) for at in range(top + 1)]

    def join(at: int, own: np.ndarray, found: np.ndarray) -> None:
        g = graph[at]
        most = g.shape[1]
        picked = _diverse(vec, own, found, links)
        g[own, : picked.shape[1]] = picked
        src, dst = np.repeat(own, picked.shape[1]), picked.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        to, first, count = np.unique(dst, return_index=True, return_counts=True)
        for lo in range(0, len(to), 512):
            t, f, c = to[lo : lo + 512], first[lo : lo + 512], count[lo : lo + 512]
            back = np.full((len(t), int(c.max())), -1, np.int64)
            k = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            back[np.repeat(np.arange(len(t)), c), k] = src[f[0] : f[0] + c.sum()]
            both = np.sort(np.concatenate((g[t].astype(np.int64), back), axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            near = np.where(both >= 0, np.einsum("qkd,qd->qk", vec[np.maximum(both, 0)], vec[t]), -np.inf)
            both = np.take_along_axis(both, np.argsort(-near, axis=1, kind="stable"), axis=1)
            full = (both >= 0).sum(axis=1) > most
            out = both[:, :most].copy()
            if full.any():
                out[full] = _diverse(vec, t[full], both[full][:, : 3 * most], most)
            g[t, : out.shape[1]] = out

    at, size = 1, 1
    while at < n:
        own = order[at : at + size]
        size = min(size * 2, 256)
        at += len(own)
        entry = np.full((len(own), 1), order[0])
        for lv in range(top, -1, -1):
            mine = level[own] >= lv
            found, _ = _beam(vec, graph[lv], vec[own], entry, width if mine.any() else ENTRIES)
            if mine.any():
                near = found[mine]
                peers = own[mine]  # the batch itself: its members don't see each other in the graph yet
                s = vec[peers] @ vec[peers].T
                np.fill_diagonal(s, -np.inf)
                k = min(links, len(peers) - 1)
                if k > 0:
                    mates = peers[np.argpartition(-s, k - 1, axis=1)[:, :k]]
                    near = np.concatenate((near, mates), axis=1)
                    score = np.where(near >= 0, np.einsum("qkd,qd->qk", vec[np.maximum(near, 0)], vec[peers]), -np.inf)
                    near = np.take_along_axis(near, np.argsort(-score, axis=1, kind="stable"), axis=1)
                join(lv, peers, near)
            entry = _entries(found)
    return {"level": level, "entry": order[:1].astype(np.int32), **{f"graph{i}": g for i, g in enumerate(graph)}}


def search(x: np.ndarray, graph: dict[str, np.ndarray], query: np.ndarray, k: int, width: int = SEARCH) -> np.ndarray:
    """Indices of the ``k`` nodes found for each query, in no order; -1 where there are fewer."""
    vec = _lengthened(x.astype(np.float64))
    ask = np.concatenate((query, np.zeros((len(query), 1))), axis=1).astype(np.float32)
    levels = sum(name.startswith("graph") for name in graph)
    out, step = [np.empty((0, max(width, k)), np.int64)], max(1, SEEN // len(x))
    for lo in range(0, len(ask), step):
        part = ask[lo : lo + step]
        entry = np.full((len(part), 1), graph["entry"][0])
        for lv in range(levels - 1, -1, -1):
            # several entries, so that tight clusters with few ways between them are all reached
            entry, _ = _beam(vec, graph[f"graph{lv}"], part, _entries(entry), max(width, k) if lv == 0 else ENTRIES)
        out.append(entry)
    return np.concatenate(out)


def _distances(c: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared distances (rows, centroids), less what is the same for a row's centroids."""
    return np.einsum("ij,ij->i", c, c) - 2 * (x @ c.T)


def centroids(x: np.ndarray, count: int, turns: int = 8, seed: int = 1) -> np.ndarray:
    """k-means of the rows of ``x``, from ``count`` of them at first."""
    c = x[np.random.default_rng(seed).choice(len(x), min(count, len(x)), replace=False)]
    for _ in range(turns):
        own = _distances(c, x).argmin(axis=1)
        n = np.bincount(own, minlength=len(c))
        order = np.argsort(own, kind="stable")
        live = np.flatnonzero(n)
        c[live] = np.add.reduceat(x[order], (np.cumsum(n) - n)[live], axis=0) / n[live, None]
    return c


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


_INDEX = "shard int, dim int, cell int, centroid array<double>, top double, n int, ids binary, n_ids binary, vectors binary, level binary, entry binary, graphs array<binary>"


def _valid(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, v)`` of the rows that take part, components as doubles."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))


def _to_centroids(nodes: DataFrame, spread: float) -> dict[int, tuple[float, np.ndarray]]:
    """For each vector length: the largest squared length, and the centroids of its lengthened vectors."""
    own = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    sizes = {r["dim"]: (r["n"], r["top"]) for r in nodes.groupBy("dim").agg(F.count("*").alias("n"), F.max(own).alias("top")).collect()}
    rows = max(256, min(SAMPLE, SAMPLE_SIZE // max([1, *sizes])))
    sample = first_by_hash(nodes.select("dim", "v", F.xxhash64("v").alias("key_")), "dim", "key_", rows).select("dim", "v").collect()
    out = {}
    for dim, (n, top) in sizes.items():
        x = np.array(sorted(r["v"] for r in sample if r["dim"] == dim), np.float64)
        x = np.concatenate((x, np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0))[:, None]), axis=1)
        cells = max(math.ceil(math.sqrt(n) / spread), math.ceil(n * dim / SHARD_SIZE))
        out[dim] = (top, centroids(x, cells))
    return out


def build_index(rows: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", spread: float = SPREAD) -> DataFrame:
    """One row a shard and vector length: the flat arrays of its graph, written to the shared folder."""
    valid = _valid(rows, id_col, vec_col)
    # -0.0 + 0.0 is 0.0: equal vectors hash alike
    valid = valid.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    kept = valid.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    nodes = stage(kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("dim", F.size("v")), "vectors")
    held = nodes.sparkSession.sparkContext.broadcast(_to_centroids(nodes, spread))  # the root of the number of nodes, and of bounded size

    @lean
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, cell = np.asarray(batch.column(2)), np.zeros(batch.num_rows, np.int32)
            for dim in np.unique(dims):
                top, c = held.value[int(dim)]
                at = np.flatnonzero(dims == dim)
                x = _matrix(batch.column(0).take(pa.array(at)))
                x = np.concatenate((x, np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0))[:, None]), axis=1)
                cell[at] = _distances(c, x).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["v", "ids", "dim", "cell"])

    placed = stage(nodes.select("v", "ids", "dim").mapInArrow(place, "v array<double>, ids array<long>, dim int, cell int"), "cells")
    counts = placed.groupBy("dim", "cell").agg(F.count("*").alias("n")).collect()  # a row for each centroid at most
    usual = {d: max(1, sum(r["n"] for r in counts if r["dim"] == d) // len(held.value[d][1])) for d in {r["dim"] for r in counts}}
    first, total = [], 0
    for r in sorted(counts):
        parts = 1 if r["n"] <= 2 * usual[r["dim"]] else -(-r["n"] // usual[r["dim"]])
        first.append((r["dim"], r["cell"], total, parts))
        total += parts
    shards = nodes.sparkSession.createDataFrame(first, "dim int, cell int, first int, parts int")

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[np.argsort([i[0] for i in pdf["ids"]], kind="stable")]
        x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        g = build(x)
        ids = np.concatenate([np.asarray(i, np.int64) for i in pdf["ids"]])
        count = np.array([len(i) for i in pdf["ids"]], np.int32)
        graphs = [g[f"graph{i}"].astype(np.int32).tobytes() for i in range(sum(n.startswith("graph") for n in g))]
        top, c = held.value[x.shape[1]]
        cell = int(pdf["cell"].iloc[0])
        return pd.DataFrame({
            "shard": [int(pdf["shard"].iloc[0])], "dim": [x.shape[1]], "cell": [cell], "centroid": [c[cell]], "top": [top], "n": [len(x)], "ids": [ids.tobytes()], "n_ids": [count.tobytes()],
            "vectors": [x.tobytes()], "level": [g["level"].tobytes()], "entry": [g["entry"].tobytes()], "graphs": [graphs],
        })

    dealt = placed.join(F.broadcast(shards), ["dim", "cell"]).withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("v"), F.col("parts"))).cast("int")).drop("first", "parts")
    dealt = dealt.repartitionByRange(max(1, total), "shard")  # by ranges, so that shards do not meet in a task by their hashes
    return stage(dealt.groupBy("shard", "dim").applyInPandas(make, _INDEX), "hnsw")


def _probes(index: DataFrame, asked: DataFrame, route: dict[int, tuple], k: int) -> dict[int, int]:
    """Of each vector length how many cells a query must ask; see the module."""
    out = {dim: len(members) for dim, (_, _, members) in route.items()}
    many = [dim for dim, cells in out.items() if cells > PROBES]
    if not many:
        return out
    some = first_by_hash(asked.where(F.col("dim").isin(many)).select("dim", "q", "v"), "dim", "q", CALIBRATION).collect()
    sample = {dim: (np.array([r["q"] for r in some if r["dim"] == dim], np.int64), np.array([r["v"] for r in some if r["dim"] == dim], np.float64)) for dim in many}
    held = index.sparkSession.sparkContext.broadcast(sample)  # at most CALIBRATION vectors of a length

    @lean
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, cell, n = (batch.column(c)[i].as_py() for c in ("dim", "cell", "n"))
                q, v = held.value[dim]
                x = np.frombuffer(batch.column("vectors")[i].as_py(), np.float64).reshape(n, dim)
                for lo in range(0, len(q), 32):
                    score = v[lo : lo + 32] @ x.T
                    score[np.stack([(x == w).all(axis=1) for w in v[lo : lo + 32]])] = -np.inf  # its own vector
                    top = np.argpartition(-score, min(k, n) - 1, axis=1)[:, : min(k, n)]
                    best = np.take_along_axis(score, top, axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q[lo : lo + 32], top.shape[1])), pa.array(np.full(top.size, dim, np.int32)), pa.array(np.full(top.size, cell, np.int32)), pa.array(best.ravel())], ["q", "dim", "cell", "score"])

    near = index.where(F.col("dim").isin(many)).select("dim", "cell", "n", "vectors").mapInArrow(exact, "q long, dim int, cell int, score double").where(F.col("score") > float("-inf"))
    near = near.withColumn("k", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cell"))).where(F.col("k") <= k).select("q", "dim", "cell").collect()
    held_cells = index.select("dim", "cell").distinct().collect()
    for dim in many:
        q, v = sample[dim]
        if not len(q):
            continue
        top, c, members = route[dim]
        rank = np.argsort(_near_cells(v, top, c), axis=1)  # the place of each cell for each query
        place = {x: i for i, x in enumerate(q.tolist())}
        name = {cell: i for i, cell in enumerate(sorted(r["cell"] for r in held_cells if r["dim"] == dim))}
        need = np.sort([rank[place[r["q"]], name[r["cell"]]] for r in near if r["dim"] == dim])
        out[dim] = max(PROBES, int(need[math.ceil(TARGET * len(need)) - 1]) + 1) if len(need) else PROBES
    return out


def _near_cells(x: np.ndarray, top: float, centroids_: np.ndarray) -> np.ndarray:
    """The cells of each query, nearest first."""
    x = x * np.sqrt(top / np.einsum("ij,ij->i", x, x))[:, None]
    return np.argsort(_distances(centroids_, np.concatenate((x, np.zeros((len(x), 1))), axis=1)), axis=1, kind="stable")


def search_index(index: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", probes: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each query row, its own id excluded. ``probes``: cells to ask, by default as many as recall takes."""
    spark = index.sparkSession
    asked = _valid(queries, id_col, vec_col).select(F.col("vec_id").alias("query_id"), F.col("v"), F.size("v").alias("dim")).dropDuplicates(["query_id", "v"])
    asked = stage(asked.withColumn("q", F.monotonically_increasing_id()), "queries")
    shards = index.select("dim", "shard", "cell", "centroid", "top").collect()  # the root of the number of nodes
    route: dict[int, tuple] = {}
    for dim in {r["dim"] for r in shards}:
        own = sorted((r["cell"], r["shard"]) for r in shards if r["dim"] == dim)
        cells = {r["cell"]: (r["centroid"], r["top"]) for r in shards if r["dim"] == dim}
        names = sorted(cells)
        members = [np.array([s for c, s in own if c == name], np.int32) for name in names]
        route[dim] = (cells[names[0]][1], np.array([cells[n][0] for n in names], np.float64), members)
    ask = _probes(index, asked, route, k) if probes is None else dict.fromkeys(route, probes)
    held = spark.sparkContext.broadcast((route, ask))

    @lean
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways, most = held.value
        for batch in batches:
            dims, to = np.asarray(batch.column(2)), [np.empty(0, np.int32)] * batch.num_rows
            for dim in np.unique(dims):
                if int(dim) not in ways:
                    continue
                top, c, members = ways[int(dim)]
                at = np.flatnonzero(dims == dim)
                near = _near_cells(_matrix(batch.column(1).take(pa.array(at))), top, c)[:, : most[int(dim)]]
                for i, row in zip(at, near, strict=True):
                    to[i] = np.concatenate([members[j] for j in row])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(to, pa.list_(pa.int32()))], ["q", "shards"])

    sent = stage(asked.select("q", "v", "dim").mapInArrow(send, "q long, shards array<int>").select("q", F.explode("shards").alias("shard")), "sent")
    # a busy shard's queries are served by several copies of its graph; each copy comes before its queries and is read once
    parts = sent.groupBy("shard").agg(F.ceil(F.count("*") / PART_QUERIES).cast("int").alias("parts"))
    copies = index.select("shard", "dim", "n", "ids", "n_ids", "vectors", "entry", "graphs").join(F.broadcast(parts), "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    ours = sent.join(F.broadcast(parts), "shard").withColumn("part", F.pmod(F.xxhash64("q"), F.col("parts")).cast("int")).drop("parts").join(asked.select("q", "query_id", "v"), "q")
    rows = copies.withColumn("kind", F.lit(0)).unionByName(ours.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def answers(r: dict, here: pa.RecordBatch) -> pa.RecordBatch:
        n, dim = r["n"], r["dim"]
        x = np.frombuffer(r["vectors"], np.float64).reshape(n, dim)
        g = {"entry": np.frombuffer(r["entry"], np.int32), **{f"graph{i}": np.frombuffer(b, np.int32).reshape(n, -1) for i, b in enumerate(r["graphs"])}}
        q, q_rows, q_ids = _matrix(here.column("v")), np.asarray(here.column("q")), np.asarray(here.column("query_id"))
        ids, count = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["n_ids"], np.int32)
        first = np.cumsum(count) - count
        out: list[list] = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]]
        for lo in range(0, len(q), BLOCK):
            found = search(x, g, q[lo : lo + BLOCK], k + 1)
            for j, hits in enumerate(found, lo):
                f = hits[hits >= 0]
                s = (x[f] * q[j]).sum(axis=-1)
                best = np.argsort(-s, kind="stable")[: 2 * k + 2]
                f, s = f[best], s[best]
                mine = np.concatenate([ids[first[e] : first[e] + count[e]] for e in f]) if len(f) else np.empty(0, np.int64)
                s = np.repeat(s, count[f])
                keep = mine != q_ids[j]
                mine, s = mine[keep], s[keep]
                top = np.lexsort((mine, -s))[:k]
                for column, values in zip(out, (np.full(len(top), q_rows[j]), np.full(len(top), q_ids[j]), mine[top], s[top]), strict=True):
                    column.append(values)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["q", "query_id", "vec_id", "score"])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph: dict = {}
        for batch in batches:
            kind = np.asarray(batch.column("kind"))
            heads = np.flatnonzero(kind == 0)
            edges = sorted({0, *heads.tolist(), *(heads + 1).tolist(), batch.num_rows})
            for lo, hi in zip(edges, edges[1:], strict=False):
                if kind[lo] == 0:
                    graph = {name: batch.column(name)[lo].as_py() for name in ("dim", "n", "ids", "n_ids", "vectors", "entry", "graphs")}
                else:
                    yield answers(graph, batch.slice(lo, hi - lo))

    dealt = rows.repartition("shard", "part").sortWithinPartitions("shard", "part", "kind")
    found = dealt.mapInArrow(run, "q long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
