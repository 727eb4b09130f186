"""Effective-dated joins and the overlay of intervals; ends are inclusive, a null end is open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAR = "9999-12-31"


def open_end(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(FAR).cast("date"))


def interval_join(rows: DataFrame, spans: DataFrame, key: str | list[str], date: str = "date", start: str = "effective_from", end: str = "effective_to", how: str = "left") -> DataFrame:
    """Rows with the spans of their key that hold their date: an equi join with a range residual."""
    keys = [key] if isinstance(key, str) else key
    s = spans.withColumnsRenamed({k: f"{k}_k" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & (rows[k] == s[f"{k}_k"])
    return rows.join(s, on & (rows[date] >= s[start]) & (s[end].isNull() | (rows[date] <= s[end])), how).drop(*[f"{k}_k" for k in keys])


def holders(points: DataFrame, spans: DataFrame, key: str, date: str, holder: str, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """``(key, date, least, most)``: the smallest and the greatest ``holder`` of the key's spans that hold the date; points without one are left out.

    There is one holder if both are the same. Points that are equal, and spans of a key with the same bounds, are one row each before they meet, so that
    pairs of a key grow with the dates there are, not with its holders or its points.
    """
    asked = points.select(F.col(key).alias("key_"), F.col(date).alias("date_")).where("key_ is not null and date_ is not null").distinct()
    bounds = spans.groupBy(F.col(key).alias("k_"), F.col(start).alias("from_"), F.col(end).alias("to_")).agg(F.min(holder).alias("least"), F.max(holder).alias("most"))
    held = asked.join(bounds, (F.col("key_") == F.col("k_")) & (F.col("date_") >= F.col("from_")) & (F.col("to_").isNull() | (F.col("date_") <= F.col("to_"))))
    return held.groupBy(F.col("key_").alias(key), F.col("date_").alias(date)).agg(F.min("least").alias("least"), F.max("most").alias("most"))


def last_and_next(points: DataFrame, rows: DataFrame, key: str, date: str, row: list[str], at: str = "date") -> DataFrame:
    """``points`` with ``before`` and ``next``: the key's last row before the point's date and its first one on or after it, as structs of ``at`` and ``row``.

    Points and rows are laid together and sorted by key and date, once in each direction; each point takes the row last
    passed. So a key's rows are read once, however many points it has. ``points`` must be distinct.
    """
    kind, held = F.col("kind_"), [at, *row]
    a = points.select(key, F.col(date).alias("on_"), F.lit(0).alias("kind_"), F.lit(None).cast(rows.select(F.struct(*held)).schema[0].dataType).alias("row_"))
    b = rows.where(F.col(at).isNotNull()).join(points.select(key).distinct(), key, "left_semi").select(key, F.col(at).alias("on_"), F.lit(1).alias("kind_"), F.struct(*held).alias("row_"))
    both = a.unionByName(b)
    up = Window.partitionBy(key).orderBy("on_", "kind_", "row_").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(key).orderBy(F.desc("on_"), F.desc("kind_"), F.desc("row_")).rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumns({"before": F.last("row_", ignorenulls=True).over(up), "next": F.last("row_", ignorenulls=True).over(down)})
    return placed.where(kind == 0).select(key, F.col("on_").alias(date), "before", "next")


def point_in_time(requests: DataFrame, spans: DataFrame, key: str, value: str, date: str = "date") -> DataFrame:
    """For each request the only ``value`` valid on its date; ``lookup`` tells FOUND, MISSING or AMBIGUOUS.

    Spans of a key with the same bounds are counted before they meet the requests, so that pairs grow with the bounds there are.
    """
    numbered = requests.withColumn("request_", F.monotonically_increasing_id())  # equal requests stay apart
    bounds = spans.groupBy(key, "effective_from", "effective_to").agg(F.count(F.lit(1)).alias("spans_"), F.min(value).alias("value_"))
    hit = interval_join(numbered, bounds, key, date).groupBy("request_", *requests.columns).agg(F.coalesce(F.sum("spans_"), F.lit(0)).alias("n"), F.min("value_").alias("value_"))
    return hit.select(*requests.columns, F.when(F.col("n") == 1, F.col("value_")).alias(value), F.when(F.col("n") == 1, "FOUND").when(F.col("n") == 0, "MISSING").otherwise("AMBIGUOUS").alias("lookup"))


def history_between(spans: DataFrame, begin, finish, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """Spans that overlap [begin, finish]."""
    return spans.where((F.col(start) <= F.lit(finish).cast("date")) & (open_end(end) >= F.lit(begin).cast("date")))


def overlaps(spans: DataFrame, key: str = "security_id", start: str = "status_start", end: str = "status_end") -> DataFrame:
    """Spans that begin before an earlier one of their key has ended."""
    earlier = Window.partitionBy(key).orderBy(start, open_end(end)).rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("held_until", F.max(open_end(end)).over(earlier)).where(F.col(start) <= F.col("held_until"))


def overlay_intervals(base: DataFrame, patches: DataFrame, attributes: list[str], key: str = "security_id", start: str = "status_start", end: str = "status_end") -> DataFrame:
    """``base`` cut at the bounds of ``patches``; within a patch its ``attributes`` hold.

    Where patches overlap the one with the greater ``priority`` wins. Every base interval is cut at
    all bounds inside it at once, so any number of patches costs one join and one window.
    """
    b = base.withColumn("row_", F.xxhash64(key, start, F.coalesce(end, F.lit(FAR)), *[F.coalesce(F.col(a).cast("string"), F.lit("")) for a in attributes]))
    p = patches.select(F.col(key).alias("k_"), F.col(start).alias("ps_"), open_end(end).alias("pe_"), "priority", F.struct(*attributes).alias("new_"))
    hit = b.join(p, (F.col(key) == F.col("k_")) & (F.col("ps_") <= open_end(end)) & (F.col("pe_") >= F.col(start)))
    inner = hit.select("row_", F.explode(F.array(F.greatest("ps_", F.col(start)), F.date_add(F.least("pe_", F.lit("9999-12-30").cast("date")), 1))).alias("cut"), open_end(end).alias("last_")).where(F.col("cut") <= F.col("last_"))
    cuts = inner.select("row_", "cut").unionByName(b.select("row_", F.col(start).alias("cut"))).distinct()
    segment = cuts.withColumn("next_", F.lead("cut").over(Window.partitionBy("row_").orderBy("cut")))
    pieces = b.join(segment, "row_").withColumns({"s_": F.col("cut"), "e_": F.when(F.col("next_").isNotNull(), F.date_sub("next_", 1)).otherwise(F.col(end))})
    won = pieces.join(p, (F.col(key) == F.col("k_")) & (F.col("ps_") <= F.col("s_")) & (F.col("pe_") >= F.coalesce("e_", F.lit(FAR).cast("date"))), "left")
    best = won.groupBy("row_", "s_").agg(F.max_by("new_", "priority").alias("new_"))
    done = pieces.join(best, ["row_", "s_"], "left")
    keep = [c for c in base.columns if c not in (start, end, *attributes)]
    changed = F.col("new_").isNotNull()
    return done.select(*keep, F.col("s_").alias(start), F.col("e_").alias(end), *[F.when(changed, F.col(f"new_.{a}")).otherwise(F.col(a)).alias(a) for a in attributes])
