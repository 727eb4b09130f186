"""Lineage cuts in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Paths for staged tables given out in this process, oldest first.
_STAGED: list[str] = []
#: A side of at most so many bytes may be sent to every task.
SMALL = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where none is named, a local folder in local mode (tests) and an error elsewhere."""
    held = spark.conf.get("spark.checkpoint.dir", None)
    if not held:
        held = spark.sparkContext.getCheckpointDir()
    if not held:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        held = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(held)
    return held


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and forget how it was made; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for a written table."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again."""
    path = staged_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """A place in the list of staged tables, for ``release``."""
    return len(_STAGED)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the tables staged since a mark, but for the last ``keep``; what still reads them must be written before."""
    end = len(_STAGED) - keep
    for path in _STAGED[since:end]:
        there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)
    del _STAGED[since:end]


def maybe_broadcast(df: DataFrame, width: F.Column | int) -> DataFrame:
    """``df``, marked for a broadcast if its rows, of ``width`` bytes each, are ``SMALL`` together; else as it is."""
    size = df.agg(F.sum(width if isinstance(width, F.Column) else F.lit(width)).alias("n")).first()["n"] or 0
    return F.broadcast(df) if size <= SMALL else df
