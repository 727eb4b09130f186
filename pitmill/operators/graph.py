"""Connected components by alternating star contraction (iterative DataFrame joins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.plans.staging import SMALL, cut

#: Edges of a task where there are few of them.
TASK_EDGES = 1 << 15


def _signature(edges: DataFrame) -> tuple:
    """Two small aggregates that change whenever the set of edges does."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that has an edge; ``component`` is the smallest node reachable.

    Each round is a large-star and a small-star step: neighbours are linked to the smallest known
    neighbour, which halves path lengths, so rounds grow with the logarithm of the longest chain.
    A hub's neighbours are never gathered: the minimum is a partial aggregate and the join can be
    split by the skew-join rule. Null ends and self loops are ignored; repeated edges count once.
    Few edges (whose minima are ``SMALL`` together) lie in a few partitions and get their minima by a broadcast, so that
    a round shuffles from a few tasks only and leaves a few files, however many shuffle partitions are set.
    """
    now = cut(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b"))).distinct()
        if (a, b) != ("a", "b")
        else edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = _signature(now)
    few = 32 * seen[0] <= SMALL  # at most two nodes an edge, 16 bytes each
    tasks = max(2, seen[0] // TASK_EDGES)
    sent, held = (F.broadcast, lambda rows: rows.coalesce(tasks)) if few else (lambda rows: rows, lambda rows: rows)
    now = held(now)
    for _ in range(max_rounds):
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(sent(low), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large if few else large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        to_least = large.join(sent(low), "a")
        if few:
            small = to_least.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x")).select("x.*")
        else:
            small = to_least.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = cut(held(small.where("a <> b").distinct()))
        after = _signature(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return held(now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
