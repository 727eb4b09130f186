"""Candidate starts of a research history: what fails in the history from each start on, gates, and intervals to recommend.

A start is judged by all required rows (eligible or in the top list) from it up to the control start. As the
start moves on, rows, entities and events drop out and none comes in, so each counts up to a last date:
a row up to its own, an entity up to its last row (a failing entity up to its last failing one), and an event up to the
last snapshot for which it lies within the history or its warm-up. What is counted at a start is therefore the running sum,
from the end, of what drops out at each date: one row a date, whatever the number of starts. Nothing is joined by a range of dates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Event types that change share counts, statuses that don't block, statuses that may contaminate, and those of a boundary before the first price.
MATERIAL = ("SPLIT", "REVERSE_SPLIT", "BONUS", "BONUS_RIGHTS_COMPOSITE", "SELECTIVE_BONUS")
NON_BLOCKING = ("PASS", "ADVISORY_BOUNDARY_DRIFT", "PASS_VERIFIED_GENUINE_MARKET_MOVE", "PASS_REVIEWED_ECONOMIC_ACTION")
HARD = ("WARNING_LARGE_BOUNDARY_MOVE", "INVALID_PRE_EVENT_PRICE", "NO_BOUNDARY_OBSERVATIONS", "NO_BOUNDARY_VALIDATION")
LEFT_CENSORED = ("NO_PRE_EVENT_OBSERVATION", "LEFT_CENSORED_BOUNDARY_VALIDATION")
SESSION_WINDOW = "OFFICIAL_NSE_SESSION_WINDOW"

_ROWS = ("monthly_rows", "monthly_snapshots", "fully_warmed_rows", "signal_ready_252_rows", "signal_ready_273_rows", "required_rows", "fully_warmed_required_rows", "session_liquidity_window_failures")
_ENTITIES = ("required_securities", "identity_failures", "price_adjustment_failures", "instrument_failures", "status_failures")
_IN_SCOPE = ("material_events", "material_missing_factors", "non_pass_boundaries", "left_censored_boundaries")
_IN_SIGNAL = ("signal_window_non_pass_boundaries", "left_censored_non_pass_no_crossing_boundaries", "contaminating_signal_window_non_pass_boundaries")
COUNTS = (*_ROWS, *_ENTITIES, *_IN_SCOPE, *_IN_SIGNAL)
#: What must be zero for a snapshot to be a refined boundary.
_BOUNDARY_GATES = ("identity_failures", "instrument_failures", "status_failures", "session_liquidity_window_failures", "material_missing_factors", "contaminating_signal_window_non_pass_boundaries")


def _yes(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def _dropping(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``rows`` with a last date in each of ``names``: how many end at each date, a column a name."""
    ends = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).alias("date")) for k in names])).alias("x")
    return rows.select(ends).select("x.*").where("date is not null").groupBy("date").agg(*[F.count_if(F.col("name") == k).alias(k) for k in names])


def _last_dates(events: DataFrame, boundaries: DataFrame, adjusted: DataFrame, entities: DataFrame, days: DataFrame, stop: Column, max_window: int) -> DataFrame:
    """Of each event the last start that each count takes it for."""
    last = days.agg(F.max("session_index").alias("end_"))
    later = days.select(F.col("session_index").alias("reach_"), F.col("date").alias("until_"))
    e = (
        events.where(F.col("event_type").isin(*MATERIAL) & (F.col("event_date") < stop))
        .select("event_id", "security_id", "event_date", (F.col("price_factor").isNull() | F.col("share_factor").isNull()).alias("missing_"))
        .join(boundaries.select("event_id", "validation_status"), "event_id", "left")
        .join(F.broadcast(days.select(F.col("date").alias("event_date"), F.col("session_index").alias("e_"))), "event_date", "left")
        .crossJoin(F.broadcast(last)).withColumn("reach_", F.when(F.col("e_").isNotNull(), F.least(F.col("e_") + max_window, "end_")))
        .join(F.broadcast(later), "reach_", "left")
    )
    # the snapshots of an entity are at most one a month, so they travel as an array
    priced = adjusted.groupBy("security_id").agg(F.min("date").alias("p0_"), F.max("date").alias("p1_"))
    e = e.join(entities.select("security_id", "dates", "sessions"), "security_id").join(priced, "security_id", "left")
    of = lambda dates, end: F.array_max(F.filter(dates, lambda d: d <= F.col(end)))
    scope = F.greatest(of("dates", "event_date"), of("sessions", "until_"))
    signal = F.when(F.col("e_") + max_window > F.col("end_"), F.col("scope_")).when(F.col("e_").isNotNull() & F.col("scope_").isNotNull(), F.least("scope_", "until_"))
    status = F.coalesce("validation_status", F.lit("NO_BOUNDARY_VALIDATION"))
    before, after = F.coalesce(F.col("p0_") < F.col("event_date"), F.lit(False)), F.coalesce(F.col("p1_") >= F.col("event_date"), F.lit(False))
    open_, hard = ~status.isin(*NON_BLOCKING), status.isin(*HARD)
    when = {
        "material_events": F.col("scope_"), "material_missing_factors": F.when(F.col("missing_"), F.col("scope_")), "non_pass_boundaries": F.when(open_, F.col("scope_")),
        "left_censored_boundaries": F.when(status.isin(*LEFT_CENSORED), F.col("scope_")), "signal_window_non_pass_boundaries": F.when(open_, F.col("signal_")),
        "left_censored_non_pass_no_crossing_boundaries": F.when(open_ & ~before & after, F.col("signal_")),
        "contaminating_signal_window_non_pass_boundaries": F.when(hard & before & after, F.col("signal_")),
    }
    dated = e.withColumn("scope_", scope).withColumn("signal_", signal)
    # an event of several rows counts as long as one of them does
    return dated.where("event_id is not null").groupBy("event_id").agg(*[F.max(c).alias(k) for k, c in when.items()])


def _scan(monthly: DataFrame, calendar: DataFrame, events: DataFrame, boundaries: DataFrame, adjusted: DataFrame, windows: DataFrame, starts: DataFrame, control_start, top: str, max_window: int) -> DataFrame:
    """A row for each snapshot (``is_snapshot``) and each of ``starts`` (``is_start``), with all counts from there on."""
    stop = F.lit(control_start).cast("date")
    days = calendar.select("date").distinct().withColumn("session_index", F.row_number().over(Window.orderBy("date")) - 1)  # a row a session
    scope = monthly.where(F.col("security_id").isNotNull() & (F.col("date") < stop))
    inside = scope.where(_yes("liquid_v1_eligible") | _yes(top))
    snapshots = scope.groupBy("date").agg(
        F.count("*").alias("monthly_rows"), F.lit(1).cast("long").alias("monthly_snapshots"), F.count_if("model_handoff_history_ready_300").alias("fully_warmed_rows"),
        F.count_if("signal_history_ready_252").alias("signal_ready_252_rows"), F.count_if("signal_history_ready_273").alias("signal_ready_273_rows"))
    # only the snapshots' rows of the daily features are joined, and the others are left out before they are made
    known = windows.select("security_id", "date", "liquidity_window_definition").join(F.broadcast(inside.select("date").distinct()), "date", "left_semi")
    required = inside.join(known, ["security_id", "date"], "left").groupBy("date").agg(
        F.count("*").alias("required_rows"), F.count_if("model_handoff_history_ready_300").alias("fully_warmed_required_rows"),
        F.count_if(~F.col("liquidity_window_definition").eqNullSafe(F.lit(SESSION_WINDOW))).alias("session_liquidity_window_failures"))
    ordinary = (F.col("instrument_type") == "ORDINARY_EQUITY") & F.col("instrument_type_quality").isNotNull() & (F.col("instrument_type_quality") != "UNRESOLVED")
    fails = {
        "identity_failures": ~_yes("research_identity_ok"), "price_adjustment_failures": ~_yes("price_adjustment_ok"), "instrument_failures": ~F.coalesce(ordinary, F.lit(False)),
        "status_failures": F.coalesce(F.col("status_quality").isin("UNKNOWN_STATUS", "UNRESOLVED"), F.lit(True)),
    }
    traded = inside.join(F.broadcast(days), "date", "left")
    entities = traded.groupBy("security_id").agg(
        F.max("date").alias("required_securities"), *[F.max(F.when(c, F.col("date"))).alias(k) for k, c in fails.items()],
        F.collect_set("date").alias("dates"), F.collect_set(F.when(F.col("session_index").isNotNull(), F.col("date"))).alias("sessions"))
    ends = _last_dates(events, boundaries, adjusted, entities, days, stop, max_window)
    parts = [snapshots, required, _dropping(entities, _ENTITIES), _dropping(ends, (*_IN_SCOPE, *_IN_SIGNAL)), days]
    each = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy("date").agg(*[F.sum(k).alias(k) for k in COUNTS], F.max("session_index").alias("session_index"))
    rows = each.withColumn("is_start", F.lit(False)).unionByName(starts.select(F.col("candidate_start").cast("date").alias("date"), F.lit(True).alias("is_start")), allowMissingColumns=True)

    # one row a date from here on: running sums from the end; a start comes after the row of its own date
    down = Window.orderBy(F.desc("date"), "is_start").rowsBetween(Window.unboundedPreceding, 0)
    session = F.col("session_index").isNotNull() & (F.col("date") < stop)
    sums = rows.select(
        "date", "is_start", "session_index", (F.col("monthly_snapshots") > 0).alias("is_snapshot"), *[F.coalesce(F.sum(k).over(down), F.lit(0)).alias(k) for k in COUNTS],
        F.min(F.when(session, F.col("date"))).over(down).alias("first_decision_session"), F.min(F.when(session, F.col("session_index"))).over(down).alias("decision_session_index"),
        F.min(F.when(F.col("monthly_snapshots") > 0, F.col("date"))).over(down).alias("first_materialized_snapshot"))
    none = F.when(F.col("is_start"), F.col("decision_session_index").isNull()).otherwise(F.col("session_index").isNull())
    sums = sums.withColumns({k: F.when(none, 0).otherwise(F.col(k)) for k in _IN_SIGNAL})
    passes = reduce(lambda a, k: a & (F.col(k) == 0), _BOUNDARY_GATES, (F.col("required_rows") > 0) & (F.col("required_securities") > 0))
    judged = sums.withColumn("passes", passes)
    refined = F.min(F.when(_yes("is_snapshot") & F.col("passes"), F.col("date"))).over(down)
    at_session = lambda c: F.last(F.when(session, c), ignorenulls=True).over(down)
    held = judged.withColumn("refined_", refined)
    # what holds from the first decision session on, which is that of the last session passed
    held = held.withColumns({"monthly_snapshots_after_decision": F.coalesce(at_session(F.col("monthly_snapshots")), F.lit(0)), "at_": F.last(F.when(session, F.struct("refined_")), ignorenulls=True).over(down)})
    month_end = days.where(F.col("date") < stop).groupBy(F.trunc("date", "month").alias("month_")).agg(F.max("date").alias("first_expected_snapshot"))
    return held.withColumn("refined_earliest_passing_snapshot", F.col("at_.refined_")).withColumn("month_", F.trunc("first_decision_session", "month")).join(F.broadcast(month_end), "month_", "left").drop("month_", "at_", "refined_")


def refined_boundaries(monthly: DataFrame, calendar: DataFrame, events: DataFrame, boundaries: DataFrame, adjusted: DataFrame, windows: DataFrame, control_start, top: str = "top750_liquidity", max_window: int = 300) -> DataFrame:
    """Each snapshot with required rows as a possible start: counts over the history from it on, and whether it ``passes``."""
    none = monthly.sparkSession.createDataFrame([], "candidate_start date")
    x = _scan(monthly, calendar, events, boundaries, adjusted, windows, none, control_start, top, max_window)
    names = ("required_rows", "required_securities", "identity_failures", "price_adjustment_failures", "instrument_failures", "status_failures", "session_liquidity_window_failures", "material_missing_factors", *_IN_SIGNAL)
    return x.where(_yes("is_snapshot") & (F.col("required_rows") > 0)).select(F.col("date").alias("boundary_date"), *names, "passes")


def candidate_audit(monthly: DataFrame, calendar: DataFrame, events: DataFrame, boundaries: DataFrame, adjusted: DataFrame, windows: DataFrame, starts: list, control_start, top: str = "top750_liquidity", max_window: int = 300) -> DataFrame:
    """For each candidate start: decision session, first snapshots, counts over the history from it on, and gates.

    ``adjusted``: rows ``(security_id, date)`` that have adjusted prices; ``windows``: the daily features' ``liquidity_window_definition``.
    """
    c = monthly.sparkSession.createDataFrame([(str(s),) for s in starts], "candidate_start string")
    x = _scan(monthly, calendar, events, boundaries, adjusted, windows, c, control_start, top, max_window).where("is_start")
    first = ("first_decision_session", "decision_session_index", "first_expected_snapshot", "first_materialized_snapshot", "refined_earliest_passing_snapshot")
    return candidate_gates(x.select(F.col("date").alias("candidate_start"), *first, "monthly_snapshots_after_decision", *COUNTS), max_window)


def candidate_gates(audit: DataFrame, max_window: int = 300) -> DataFrame:
    """Gate columns of an audit with any number of starts."""
    zero = lambda *names: reduce(lambda a, k: a & (F.col(k) == 0), names, F.lit(True))
    there = (F.col("required_securities") > 0) & (F.col("monthly_snapshots") > 0) & F.col("first_expected_snapshot").isNotNull() & F.col("first_expected_snapshot").eqNullSafe(F.col("first_materialized_snapshot"))
    decided = F.col("first_decision_session").isNotNull() & (F.col("monthly_snapshots_after_decision") > 0)
    warm = F.coalesce((F.col("required_rows") > 0) & (F.col("decision_session_index") >= max_window), F.lit(False))
    gates = {
        "pit_universe_gate_pass": there & decided & zero("identity_failures", "instrument_failures", "status_failures", "session_liquidity_window_failures"),
        "price_action_gate_pass": zero("price_adjustment_failures", "material_missing_factors"),
        "boundary_validation_review_required": ~zero("contaminating_signal_window_non_pass_boundaries"), "feature_gate_pass": warm,
        "not_fully_warmed_required_rows": F.col("required_rows") - F.col("fully_warmed_required_rows"),
    }
    every = F.col("pit_universe_gate_pass") & F.col("price_action_gate_pass") & ~F.col("boundary_validation_review_required") & F.col("feature_gate_pass")
    return audit.withColumns(gates).withColumn("all_gates_pass", every).withColumn("status", F.when(F.col("all_gates_pass"), "PASS").otherwise("FAIL"))


def recommended_intervals(gated: DataFrame, coverage_end) -> DataFrame:
    """Two rows: the interval that passes all gates from the earliest such start, and the point-in-time interval from the earliest refined boundary."""
    both = gated.agg(F.min(F.when(F.col("all_gates_pass"), F.col("candidate_start"))).alias("r"), F.min("refined_earliest_passing_snapshot").alias("p"))

    def row(kind: str, start: str, found: str, none: str) -> Column:
        return F.struct(F.lit(kind).alias("interval_type"), F.when(F.col(start).isNull(), none).otherwise(found).alias("status"), F.col(start).alias("start"), F.lit(coverage_end).cast("date").alias("end"))

    rows = F.array(row("RESEARCH", "r", "CANDIDATE_RESEARCH_GATE_PASS_AVAILABLE", "NO_RESEARCH_GATE_PASS"), row("PIT_UNIVERSE", "p", "CANDIDATE_REFINED_BOUNDARY_AVAILABLE", "NO_REFINED_BOUNDARY"))
    return both.select(F.explode(rows).alias("x")).select("x.*")


def earliest_ready_start(gated: DataFrame) -> DataFrame:
    """The earliest start that passes all gates, and the earliest that is point-in-time ready."""
    return gated.agg(F.min(F.when(F.col("all_gates_pass"), F.col("candidate_start"))).alias("earliest_research_ready"), F.min(F.when(F.col("pit_universe_gate_pass"), F.col("candidate_start"))).alias("earliest_pit_ready"))


def price_action_candidates(audit: DataFrame) -> DataFrame:
    """What an audit's starts have to do about events and boundaries; starts without events are left out."""
    return audit.where(F.col("material_events") > 0).select("candidate_start", *_IN_SCOPE, *_IN_SIGNAL)


def boundary_blockers(boundaries: DataFrame, starts: list, limit: int = 100) -> DataFrame:
    """Boundaries that block, for each start they lie after; the largest moves first."""
    c = F.broadcast(boundaries.sparkSession.createDataFrame([(str(s),) for s in starts], "s string").select(F.col("s").cast("date").alias("candidate_start")))
    x = boundaries.where(~F.col("validation_status").isin(*NON_BLOCKING)).join(c, F.col("ex_date") >= F.col("candidate_start"))
    rank = F.row_number().over(Window.partitionBy("candidate_start").orderBy(F.desc_nulls_last(F.abs(F.col("holder_value_ratio") - 1)), "event_id"))
    return x.withColumn("k", rank).where(F.col("k") <= limit).select("candidate_start", "k", "event_id", "security_id", "ex_date", "validation_status")
