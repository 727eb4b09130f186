"""Official sessions: dates with data, densely numbered. A calendar has a few thousand rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_sessions(calendar: DataFrame, date: str = "date", start: int = 1) -> DataFrame:
    """``(date, session_number)``; the one unpartitioned window, over distinct dates only."""
    days = calendar.select(F.col(date).cast("date").alias("date")).where("date is not null").distinct()
    return days.select("date", (F.row_number().over(Window.orderBy("date")) + (start - 1)).cast("long").alias("session_number"))


def trading_calendar(prices: DataFrame, date: str = "date") -> DataFrame:
    """One row a session: its dense index, source files, and counts of entities and observations."""
    plain = F.col("instrument_type") == "ORDINARY_EQUITY"
    daily = prices.groupBy(date).agg(
        F.array_sort(F.collect_set("source_file_id")).alias("source_file_ids"),
        F.countDistinct("security_id").alias("observed_security_count"),
        F.count_if(plain).alias("ordinary_equity_observation_count"),
        F.count_if(~plain).alias("non_ordinary_observation_count"),
        F.count("*").alias("observation_count"),
    )
    index = number_sessions(daily, date, 0).withColumnRenamed("session_number", "session_index")
    return daily.join(F.broadcast(index), daily[date] == index["date"]).drop(index["date"]).withColumn("source_file_count", F.size("source_file_ids").cast("long"))


def coverage(dates: DataFrame, calendar: DataFrame) -> DataFrame:
    """``(date, finding)``: MISSING and EXTRA against the calendar, DUPLICATE within ``dates``."""
    got, want = dates.select("date"), calendar.select("date").distinct()
    return (
        want.join(got, "date", "left_anti").select("date", F.lit("MISSING").alias("finding"))
        .unionByName(got.distinct().join(want, "date", "left_anti").select("date", F.lit("EXTRA").alias("finding")))
        .unionByName(got.groupBy("date").count().where("count > 1").select("date", F.lit("DUPLICATE").alias("finding")))
    )


def feature_readiness(requests: DataFrame, calendar: DataFrame, windows: tuple[int, ...] = (20, 60, 126, 252, 272, 273, 300)) -> DataFrame:
    """For each requested ``date`` the sessions before it, and for each window whether they suffice.

    The count is that of the last session before the date: one merged sort of dates and sessions, not a theta join.
    """
    days = requests.select("date").distinct()
    sessions = number_sessions(calendar)
    both = days.withColumns({"session_number": F.lit(None).cast("long"), "ask": F.lit(0)}).unionByName(sessions.withColumn("ask", F.lit(1)))
    prior = F.coalesce(F.last("session_number", ignorenulls=True).over(Window.orderBy("date", "ask").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    counted = both.withColumn("prior_sessions", prior).where("ask = 0").select("date", "prior_sessions")
    return counted.select("*", *[(F.col("prior_sessions") >= n).alias(f"ready_{n}") for n in windows])


def warmup_coverage(calendar: DataFrame, windows: tuple[int, ...] = (20, 60, 126, 252, 272, 273, 300)) -> DataFrame:
    """``(window, ready_date)``: the first session with so many before it; null where there is none."""
    need = calendar.sparkSession.createDataFrame([(n,) for n in windows], "window long")
    return need.join(number_sessions(calendar, start=0), F.col("window") == F.col("session_number"), "left").select("window", F.col("date").alias("ready_date"))
