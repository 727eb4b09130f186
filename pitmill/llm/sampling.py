"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that pass the first cut, as a multiple of those wanted.
SPARE = 4
_SCALE = 1 << 31


def first_by_hash(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """Of each value of ``group`` the ``most`` rows with the smallest hashes of ``key``.

    Groups are counted first, and rows whose hash is beyond ``SPARE`` times the share wanted are
    left out before the rows of a group meet, so what is gathered doesn't grow with the input.
    """
    counts = rows.groupBy(group).agg(F.count("*").alias("n_"))
    place = F.pmod(F.xxhash64(key), F.lit(_SCALE))
    cut = rows.withColumn("h_", place).join(counts, group).where(F.col("h_") < F.lit(float(SPARE * most) * _SCALE) / F.col("n_"))
    first = F.row_number().over(Window.partitionBy(group).orderBy("h_", key))
    return cut.withColumn("k_", first).where(F.col("k_") <= most).select(*rows.columns)
