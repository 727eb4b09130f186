"""Session-correct rolling liquidity features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitmill.operators.calendar import number_sessions
from pitmill.operators.rolling import rolling_windows

WINDOWS = (20, 60, 126, 252)


def quintile(pct: Column, q: int = 5) -> Column:
    """LIQUIDITY_Q1 (above 0.8) to LIQUIDITY_Q5; a null share is the last."""
    out = F.lit(f"LIQUIDITY_Q{q}")
    for k in range(q - 1, 0, -1):
        out = F.when(pct > F.lit(round(1 - k / q, 6)), f"LIQUIDITY_Q{k}").otherwise(out)
    return out


def session_grid(rows: DataFrame, sessions: DataFrame, key: str = "security_id") -> DataFrame:
    """Every session between an entity's first and last one, with its row where it has one (``observed``)."""
    placed = rows.join(F.broadcast(sessions), "date")
    bounds = placed.groupBy(key).agg(F.min("session_number").alias("lo"), F.max("session_number").alias("hi"))
    grid = bounds.select(key, F.explode(F.sequence("lo", "hi")).alias("session_number"))
    return grid.join(placed.withColumn("observed", F.lit(True)), [key, "session_number"], "left").withColumn("observed", F.coalesce("observed", F.lit(False)))


def _figures(n: int) -> dict[str, str]:
    return {"median": f"median_traded_value_{n}", "average": f"average_traded_value_{n}", "valid": f"valid_trade_days_{n}"}


def liquidity_features(prices: DataFrame, calendar: DataFrame, windows: tuple[int, ...] = WINDOWS, rank_window: int = 126, stale_window: int = 60, at: DataFrame | None = None, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Rolling counts, medians and averages over official sessions, for each observed row.

    Windows count sessions, absent ones too, between an entity's first and last session; EQ rows
    only, where there is a series. A window of n sessions is a RANGE frame over session numbers, so
    absent sessions need no rows: they are the sessions of the window less the observed ones. All figures of a window
    are kept up as rows enter and leave it (``rolling_windows``): select before the columns that are needed, as all pass through Python. One
    shuffle by entity serves all windows and medians, one by date the ranks. With ``at``, a table of a few dates, only rows
    of these dates are returned, and only rows that their windows may hold pass through Python. With ``columns``, only these are made and returned.
    """
    rows = prices.where("series = 'EQ'") if "series" in prices.columns else prices
    keep = rows.columns
    sessions = number_sessions(calendar)
    if at is not None:  # each session with the next one that is asked for
        asked = F.when(F.col("asked_"), F.col("session_number"))
        days = sessions.join(at.select("date").distinct().withColumn("asked_", F.lit(True)), "date", "left")
        sessions = days.select("date", "session_number", F.last(asked, ignorenulls=True).over(Window.orderBy(F.desc("session_number")).rowsBetween(Window.unboundedPreceding, 0)).alias("next_"))
    placed = rows.join(F.broadcast(sessions), "date")
    entity = Window.partitionBy("security_id")
    by = entity.orderBy("session_number")
    session, volume = F.col("session_number"), F.coalesce(F.col("volume"), F.lit(0))
    before = F.when(F.lag("session_number").over(by) == session - 1, F.lag("raw_close").over(by))
    placed = placed.withColumns({
        "stale_": F.coalesce(F.col("raw_close") == before, F.lit(False)),
        "history_sessions": session - F.min("session_number").over(entity) + 1,
        "observed_history_sessions": F.row_number().over(by).cast("long"),
        "first_session": F.min("date").over(entity),
    })
    made = placed.withColumn("positive_", volume > 0)
    metric, stale = f"median_traded_value_{rank_window}", f"stale_price_days_{stale_window}"
    figures = {n: _figures(n) | {"rows": f"rows_{n}_", "positive": f"positive_volume_days_{n}"} for n in windows}
    marks = {stale: ("stale_", stale_window)}
    if columns is not None:  # what these columns are made of
        ranked = {f"liquidity_{x}_{rank_window}" for x in ("percentile", "rank", "bucket")} & set(columns)
        needs = {*columns, *[metric for _ in ranked], *[x for n in windows for x, of in ((f"rows_{n}_", (f"zero_volume_days_{n}", f"absent_observation_days_{n}")), (f"positive_volume_days_{n}", (f"zero_volume_days_{n}",))) if {*of} & {*columns}]}
        figures = {n: held for n, named in figures.items() if (held := {what: name for what, name in named.items() if name in needs})}
        marks = {k: v for k, v in marks.items() if k in needs}
    number = "observed_history_sessions"
    if at is not None and (figures or marks):
        reach = max([*figures, *[n for _, n in marks.values()]])
        made = made.where(F.col("next_") - session < reach).withColumns({"number_": F.row_number().over(by).cast("long"), "only_": F.col("next_") == session})
        number = "number_"
    elif at is not None:
        made = made.where(F.col("next_") == session)
    if columns is not None:
        inner = {"security_id", "date", "session_number", "observed_history_sessions", "history_sessions", "first_session", "traded_value", "positive_", "stale_", "number_", "only_"} | ({"raw_close"} if "price" in columns else set())
        made = made.select(*[c for c in made.columns if c in inner or c in columns])
    made = made.drop("next_")
    if figures or marks:
        made = rolling_windows(made, "security_id", "session_number", number, "traded_value", figures, "positive_", marks, None if at is None else "only_")
    out = {}
    for n in figures:
        held, up = F.col(f"rows_{n}_"), F.col(f"positive_volume_days_{n}")
        out |= {f"valid_trade_days_{n}": F.col(f"valid_trade_days_{n}"), f"positive_volume_days_{n}": up, f"zero_volume_days_{n}": held - up, f"absent_observation_days_{n}": F.least("history_sessions", F.lit(n)) - held, f"average_traded_value_{n}": F.col(f"average_traded_value_{n}")}
    out[stale] = F.col(stale)
    out |= {f"median_traded_value_{n}": F.col(f"median_traded_value_{n}") for n in figures}
    day = Window.partitionBy("date")
    pct = F.cume_dist().over(day.orderBy(F.asc_nulls_last(metric)))
    rank = F.row_number().over(day.orderBy(F.desc_nulls_last(metric), "security_id"))
    if columns is None or ranked:
        made = made.withColumns({f"liquidity_percentile_{rank_window}": pct, f"liquidity_rank_{rank_window}": rank.cast("long")})
    whole = {"history_sessions": F.col("history_sessions"), "observed_history_sessions": F.col("observed_history_sessions")} | out | {
        "listing_age_sessions": F.col("history_sessions"),
        "listing_age_calendar_days": F.datediff("date", "first_session").cast("long"),
        "price": F.col("raw_close"),
        "listing_status": F.lit("ACTIVE_TRADING"),
        f"liquidity_percentile_{rank_window}": F.col(f"liquidity_percentile_{rank_window}"), f"liquidity_rank_{rank_window}": F.col(f"liquidity_rank_{rank_window}"),
        f"liquidity_bucket_{rank_window}": quintile(F.col(f"liquidity_percentile_{rank_window}")),
    }
    return made.select(*[F.col(c) for c in keep if columns is None or c in columns], *[c.alias(k) for k, c in whole.items() if columns is None or k in columns])


def recent(prices: DataFrame, calendar: DataFrame, at, sessions: int) -> DataFrame:
    """Rows of the last ``sessions`` sessions up to ``at``: all that figures of windows of so many sessions depend on at that date (not histories).

    The first of these dates is one value, so that the condition reaches what ``prices`` are made of.
    """
    end = F.lit(at).cast("date")
    days = calendar.select(F.col("date").cast("date").alias("date")).where(F.col("date") <= end).distinct()
    first = days.orderBy(F.desc("date")).limit(sessions).agg(F.min("date")).first()[0]
    return prices.where(F.col("date").between(F.lit(first).cast("date"), end))


def observation_liquidity(prices: DataFrame, windows: tuple[int, ...] = WINDOWS, last: Column | None = None) -> DataFrame:
    """The older features whose windows count an entity's rows, not sessions; shares are taken of the 60-row median.

    With ``last``, a date that no row is after, only rows of this date are returned, and only rows that their windows may hold pass through Python.
    """
    by = Window.partitionBy("security_id").orderBy("date")
    out = {
        "history_sessions": F.row_number().over(by).cast("long"), "listing_age_calendar_days": F.datediff("date", F.min("date").over(Window.partitionBy("security_id"))).cast("long"),
        "positive_": F.coalesce(F.col("volume"), F.lit(0)) > 0, "same_": F.col("raw_close") == F.lag("raw_close").over(by),
    }
    figures = {n: _figures(n) | {"rows": f"rows_{n}_", "positive": f"positive_{n}_"} for n in windows}
    # the frame's own first row has no row before it in the frame
    marks = {"stale_price_days_60": ("same_", 59)} if 60 in windows else {}
    rows = prices.withColumns({k: c for k, c in out.items() if marks or k != "same_"})
    number, only = "history_sessions", None
    if last is not None:
        entity = Window.partitionBy("security_id")
        near = (F.col("end_") == last) & (F.col("rows_") - F.col("history_sessions") < max(windows))
        rows = rows.withColumns({"end_": F.max("date").over(entity), "rows_": F.count(F.lit(1)).over(entity)}).where(near).drop("end_", "rows_")
        rows = rows.withColumns({"number_": F.row_number().over(by).cast("long"), "only_": F.col("date") == last})
        number, only = "number_", "only_"
    made = rolling_windows(rows, "security_id", "history_sessions", number, "traded_value", figures, "positive_", marks, only).drop("number_")
    made = made.withColumns({f"zero_volume_days_{n}": F.col(f"rows_{n}_") - F.col(f"positive_{n}_") for n in windows}).drop(*[f"{x}_{n}_" for n in windows for x in ("rows", "positive")])
    if 60 in windows:
        day = Window.partitionBy("date", F.col("median_traded_value_60").isNull())
        share = F.row_number().over(day.orderBy("median_traded_value_60", "security_id")) / F.count(F.lit(1)).over(day)
        pct = F.when(F.col("median_traded_value_60").isNotNull(), share)
        return made.withColumn("liquidity_percentile_60", pct).withColumn("liquidity_bucket_60", F.when(F.col("liquidity_percentile_60").isNotNull(), quintile(F.col("liquidity_percentile_60"))))
    return made.withColumn("liquidity_percentile_60", F.lit(None).cast("double")).withColumn("liquidity_bucket_60", F.lit(None).cast("string"))


def liquidity_as_of(prices: DataFrame, at, window: int = 60) -> DataFrame:
    """Features of the rows dated exactly ``at``, of rows up to it only."""
    day = F.lit(at).cast("date")
    return observation_liquidity(prices.where(F.col("date") <= day), (window,), day).where(F.col("date") == day)
