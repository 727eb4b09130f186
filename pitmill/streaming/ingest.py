"""Incremental ingestion, streaming findings and daily coverage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pitmill.functions.fields import ohlc_findings
from pitmill.sources.files import file_date


class ContentChanged(RuntimeError):
    """A dated file came again with other content."""


def ingest_days(spark: SparkSession, source: str, target: str, checkpoint: str) -> None:
    """Take each new dated file of ``source`` into ``target`` once: (source_date, sha256, bytes, content).

    The same content again changes nothing; other content for a day that is held is an error, and
    the batch is not taken. Runs over what is there and stops.
    """
    def take(batch: DataFrame, epoch: int) -> None:
        new = batch.select(file_date(F.col("path")).alias("source_date"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"), "content").where("source_date is not null").dropDuplicates(["source_date", "sha256"])
        try:
            held = batch.sparkSession.read.parquet(target).select("source_date", F.col("sha256").alias("old"))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
                raise
            held = batch.sparkSession.createDataFrame([], "source_date date, old string")
        both = new.join(held, "source_date", "left")
        changed = both.where("old is not null and old <> sha256").select("source_date").unionByName(new.groupBy("source_date").count().where("count > 1").select("source_date"))
        if bad := [str(r[0]) for r in changed.limit(5).collect()]:
            raise ContentChanged(f"other content for {', '.join(bad)}")
        both.where("old is null").drop("old").write.mode("append").parquet(target)

    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(source)
    query = files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_findings(stream: DataFrame, key: list[str], time: str = "ts", lateness: str = "1 day") -> DataFrame:
    """Broken price rules of a stream of observations, each key's first row within the bounded lateness only."""
    once = stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(key)
    return once.select(*key, time, F.explode(ohlc_findings(*[F.col(c) for c in ("open", "high", "low", "close", "volume")])).alias("check"))


def stream_daily_counts(stream: DataFrame, time: str = "ts", lateness: str = "1 day", key: str | None = None) -> DataFrame:
    """Rows of each day (and key), final once the watermark has passed it."""
    by = [F.window(time, "1 day")] + ([F.col(key)] if key else [])
    out = stream.withWatermark(time, lateness).groupBy(*by).agg(F.count("*").alias("rows"))
    return out.select(F.col("window.start").cast("date").alias("date"), *([key] if key else []), "rows")


def run_to_memory(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run over what is there into an in-memory table (tests and small results)."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_to_table(stream: DataFrame, path: str, checkpoint: str, schema: StructType | None = None) -> DataFrame:
    """Run over what is there into Parquet at ``path`` and read it."""
    stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(schema or stream.schema).parquet(path)


def coverage_status(counts: DataFrame, calendar: DataFrame) -> DataFrame:
    """``(date, status)``: PRESENT, MISSING or EXTRA days of a day count against the calendar."""
    got, want = counts.select("date").distinct().withColumn("g", F.lit(True)), calendar.select("date").distinct().withColumn("w", F.lit(True))
    return got.join(want, "date", "full").select("date", F.when(F.col("g").isNull(), "MISSING").when(F.col("w").isNull(), "EXTRA").otherwise("PRESENT").alias("status"))


def stream_session_status(stream: DataFrame, sessions: DataFrame, time: str = "ts", lateness: str = "1 day", zone: str = "UTC") -> DataFrame:
    """``(date, rows, status)`` of each day, once, when the watermark has passed it: PRESENT, MISSING (a session without rows) or EXTRA (rows, but no session).

    ``sessions`` is a stream of the calendar's dates, which may run ahead. Only the data move the watermark, so a session waits in state, one row
    a day, until the data have passed it; what has been given out isn't given out again after a restart from
    the checkpoint. Rows, and sessions, later than the watermark are dropped.
    """
    rows = stream.select(F.col(time).alias("at_"), F.lit(1).cast("long").alias("row_"), F.lit(0).alias("session_")).withWatermark("at_", lateness)
    days = sessions.select(F.to_utc_timestamp(F.col("date").cast("timestamp"), zone).alias("at_"), F.lit(0).cast("long").alias("row_"), F.lit(1).alias("session_"))
    counted = rows.unionByName(days).groupBy(F.window("at_", "1 day")).agg(F.sum("row_").alias("rows"), F.max("session_").alias("session_"))
    status = F.when(F.col("session_") == 0, "EXTRA").when(F.col("rows") == 0, "MISSING").otherwise("PRESENT")
    return counted.select(F.col("window.start").cast("date").alias("date"), "rows", status.alias("status"))


def run_counted(stream: DataFrame, path: str, checkpoint: str) -> tuple[DataFrame, int]:
    """As ``run_to_table``, with the number of rows that came after the watermark had passed them."""
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    late = sum(op.numRowsDroppedByWatermark for progress in query.recentProgress for op in progress.stateOperators)
    return stream.sparkSession.read.schema(stream.schema).parquet(path), late
