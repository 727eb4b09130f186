"""Running numbers of rows without gathering them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.plans.staging import SMALL, stage

_SHIFT = 33


def numbered(rows: DataFrame, label: str, name: str = "index") -> DataFrame:
    """``rows`` with numbers from 0 without gaps, in the order of the partitions and of the rows within them.

    The rows are written with their place in their partition, so that a task that runs again numbers alike; then only
    the sizes of the partitions, one number for each task, are added up. No row moves.
    """
    held = stage(rows.withColumn("at_", F.monotonically_increasing_id()), label)
    part = F.shiftright("at_", _SHIFT)
    sizes = sorted(held.groupBy(part.alias("part_")).agg(F.count("*").alias("n_")).collect())
    starts, so_far = [], 0
    for r in sizes:
        starts.append((r["part_"], so_far))
        so_far += r["n_"]
    start = held.sparkSession.createDataFrame(starts, "part_ long, start_ long")
    start = F.broadcast(start) if 16 * len(starts) <= SMALL else start
    at = F.col("start_") + F.col("at_").bitwiseAND((1 << _SHIFT) - 1)
    return held.join(start, part == F.col("part_")).select(*[F.col(f"`{c}`") for c in rows.columns], at.alias(name))
