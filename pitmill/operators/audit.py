"""Data-quality, promotion and survivorship audits over a monthly universe and its tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitmill.operators.calendar import number_sessions
from pitmill.operators.leakage import differing_rows
from pitmill.operators.universe import month_ends, profile_predicate
from pitmill.plans.staging import stage
from pitmill.spec import ProfileSpec

STRONG = ("OFFICIAL_EXCHANGE_IDENTITY", "MULTI_SOURCE_VERIFIED", "RECONSTRUCTED_HIGH_CONFIDENCE", "RECONSTRUCTED_TRADING_IDENTITY")


def unpivot(one_row: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """A row of numbers as (name, value) rows."""
    return one_row.select(F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("long").alias(value)) for c in one_row.columns])).alias("x")).select("x.*")


def _yes(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(False))


def row_invariants(monthly: DataFrame, spec: ProfileSpec, top: str = "top750_liquidity", start=None) -> DataFrame:
    """Counters of the rules that a single row can break, all in one pass."""
    inside = _yes("liquid_v1_eligible") | _yes(top)
    tops = [(f"top{n}_liquidity", n) for n in sorted(spec.tops)]
    flags = F.lit(False)
    for c, n in tops:
        flags = flags | (_yes(c) != F.coalesce(F.col("rank_126") <= n, F.lit(False)))
    for (a, _), (b, _) in zip(tops, tops[1:], strict=False):
        flags = flags | (_yes(a) & ~_yes(b))
    needed = [c for c in ("date", "security_id", "symbol_at_date", "instrument_type", "price", "history_sessions", "positive_volume_days_60", "median_traded_value_60", "median_traded_value_126", "liquid_v1_eligible", "research_identity_ok", "price_adjustment_quality", "status_quality") if c in monthly.columns]
    missing = reduce(lambda a, c: a | F.col(c).isNull(), needed, F.lit(False))
    any_top = reduce(lambda a, t: a | _yes(t[0]), tops, F.lit(False))
    has = set(monthly.columns)
    passed = F.lit(f"PASSED_{spec.profile_version}")
    metadata = {"profile_id", "profile_version", "as_of_date", "eligibility_result", "eligibility_reason_codes"} <= has
    own = (F.col("profile_id") == spec.profile_id) & (F.col("profile_version") == spec.profile_version) & (F.col("as_of_date") == F.col("date")) if metadata else F.lit(True)
    other = (F.col("profile_id") != spec.profile_id) | (F.col("profile_version") != spec.profile_version) | (F.col("as_of_date") != F.col("date")) | (F.col("eligibility_result") != "EXCLUDED") if metadata else F.lit(False)
    alias = F.lit(False)
    if "liquid_v1_alias" in has:
        alias = alias | (_yes("liquid_v1_alias") != _yes("liquid_v1_eligible"))
    if {"liquidity_percentile", "liquidity_percentile_126"} <= has:
        alias = alias | ~F.col("liquidity_percentile").eqNullSafe(F.col("liquidity_percentile_126"))
    rules = {
        "artifact_alias_failures": alias,
        "eligible_profile_metadata_failures": _yes("liquid_v1_eligible") & ~_yes(own & (F.col("eligibility_result") == "ELIGIBLE") & (F.col("eligibility_reason_codes") == passed)) if metadata else F.lit(False),
        "excluded_profile_metadata_failures": ~F.col("liquid_v1_eligible") & (_yes(other) | F.col("eligibility_reason_codes").isNull()) if metadata else F.lit(False),
        "pre_research_start_rows": F.col("date") < F.lit(start).cast("date") if start else F.lit(False),
        "non_ordinary_rows": F.col("instrument_type") != spec.instrument_type,
        "non_active_trading_rows": ~F.col("trading_status").eqNullSafe(spec.trading_status),
        "missing_quality_fields": F.col("research_identity_ok").isNull() | F.col("price_adjustment_quality").isNull() | F.col("price_adjustment_ok").isNull() | F.col("status_quality").isNull(),
        "required_scope_quality_failures": inside & (~_yes("research_identity_ok") | ~_yes("price_adjustment_ok")),
        "required_scope_missing_research_fields": inside & missing,
        "top_liquidity_null_metric_failures": any_top & F.col("median_traded_value_126").isNull(),
        "liquid_predicate_failures": _yes("liquid_v1_eligible") & ~profile_predicate(spec),
        "top_liquidity_flag_failures": flags,
    }
    return unpivot(monthly.agg(*[F.count_if(v).alias(k) for k, v in rules.items()]))


def table_invariants(monthly: DataFrame, required: DataFrame, prices: DataFrame, calendar: DataFrame, top: str = "top750_liquidity", start=None, instrument_type: str = "ORDINARY_EQUITY") -> DataFrame:
    """Counters of the rules that need other rows or tables; those that need the same rows together are counted in one pass."""
    inside = monthly.where(_yes("liquid_v1_eligible") | _yes(top))
    scope = inside.groupBy("security_id").agg(
        F.bool_or(_yes("liquid_v1_eligible")).alias("l"), F.bool_or(_yes(top)).alias("t"), F.min("date").alias("a"), F.max("date").alias("b"), F.min("rank_126").alias("r0"), F.max("rank_126").alias("r1"),
        F.max("median_traded_value_60").alias("m60"), F.max("positive_volume_days_60").alias("p60"), F.lit(True).alias("in_scope_"))
    both = required.withColumn("in_required_", F.lit(True)).join(scope, "security_id", "full")
    there, scoped = F.col("in_required_").isNotNull(), F.col("in_scope_").isNotNull()
    differs = lambda *p: there & scoped & reduce(lambda x, y: x | y, [~F.col(a).eqNullSafe(F.col(b)) for a, b in p])
    kind = F.col("instrument_type").eqNullSafe(instrument_type) & ~F.coalesce(F.col("instrument_type_quality") == "UNRESOLVED", F.lit(True)) if {"instrument_type", "instrument_type_quality"} <= set(required.columns) else F.lit(True)
    of_required = {
        "required_artifact_instrument_classification_failures": there & ~kind,
        "required_scope_missing_from_required_artifact": ~there,
        "required_artifact_security_without_monthly_scope": ~scoped,
        "required_artifact_flag_failures": differs(("enters_liquid_v1", "l"), ("enters_top750", "t")),
        "required_artifact_date_range_failures": differs(("first_research_date", "a"), ("last_research_date", "b")),
        "required_artifact_rank_evidence_failures": differs(("best_rank_126", "r0"), ("worst_rank_126", "r1")),
        "required_artifact_liquidity_evidence_failures": differs(("max_median_traded_value_60", "m60"), ("max_positive_volume_days_60", "p60")),
        "required_artifact_identity_quality_failures": there & ~_yes(F.col("research_identity_quality").isin(*STRONG)),
        "required_artifact_price_adjustment_failures": there & (~_yes("price_adjustment_ok") | F.coalesce(F.col("price_adjustment_quality").isin("UNRESOLVED_CORPORATE_ACTION", "RAW_ONLY_UNKNOWN"), F.lit(True))),
        "required_artifact_status_failures": there & (~_yes("active_trading_ok") | F.coalesce(F.col("status_quality").isin("UNKNOWN_STATUS", "UNRESOLVED"), F.lit(True))),
    }

    ends = month_ends(calendar if start is None else calendar.where(F.col("date") >= F.lit(start).cast("date"))).withColumnsRenamed({"month": "month_", "date": "end_"})
    w = Window.orderBy("date")  # a row a month
    by_month = monthly.groupBy("date").agg(F.count_if(_yes("liquid_v1_eligible")).alias("n"), F.avg("history_sessions").alias("h"))
    months = by_month.withColumns({"n0": F.lag("n").over(w), "n1": F.lead("n").over(w), "h0": F.lag("h").over(w)})
    months = months.join(ends, F.trunc("date", "month") == F.col("month_"), "left").join(calendar.select("date").distinct().withColumn("session_", F.lit(True)), "date", "left")
    of_months = {
        "non_month_final_session_dates": F.col("date") != F.col("end_"),
        "non_calendar_dates": F.col("session_").isNull(),
        "zero_liquid_collapse_months": F.expr("n = 0 and coalesce(n0, 0) >= 100 and coalesce(n1, 0) >= 100"),
        "population_history_reset_months": F.expr("h0 >= 300 and h < h0 * 0.5"),
    }
    begins = (~F.min("date").eqNullSafe(F.lit(start).cast("date"))).cast("long") if start else F.lit(0)

    wy = Window.orderBy("y")  # a row a year
    years = monthly.groupBy(F.year("date").alias("y")).agg(F.count_distinct("security_id").alias("n"))
    spikes = years.withColumns({"n0": F.lag("n").over(wy), "n1": F.lead("n").over(wy)})
    first = prices.groupBy("security_id").agg(F.min("date").alias("first_"))
    rows = monthly.groupBy("date", "security_id").agg(F.count("*").alias("n")).join(first, "security_id", "left")
    counted = lambda rules: [F.count_if(v).alias(k) for k, v in rules.items()]
    parts = [
        both.agg(*counted(of_required)),
        months.agg(begins.alias("monthly_snapshot_start_mismatch"), *counted(of_months)),
        spikes.agg(F.count_if(F.expr("n > n0 * 1.5 and n1 < n / 1.5")).alias("active_security_count_spike_reversal_failures")),
        rows.agg(F.count_if(F.col("n") > 1).alias("duplicate_month_security_rows"), F.coalesce(F.sum(F.when(F.expr("date < first_"), F.col("n"))), F.lit(0)).alias("future_listing_rows")),
    ]
    return reduce(DataFrame.unionByName, [unpivot(p) for p in parts])


def validate_release(monthly: DataFrame, required: DataFrame, prices: DataFrame, calendar: DataFrame, spec: ProfileSpec, top: str = "top750_liquidity", start=None) -> DataFrame:
    """``(metric, value)``: violation counters; a sound release has only zeros.

    ``monthly`` is read once for each kind of counter, so one that is costly to make should be staged.
    """
    return row_invariants(monthly, spec, top, start).unionByName(table_invariants(monthly, required, prices, calendar, top, start, spec.instrument_type))


def validate_handoff(monthly: DataFrame, calendar: DataFrame, start, end, profile_id: str | None = None) -> DataFrame:
    """``(metric, value)`` of a monthly handoff: bounds, duplicates, one snapshot a month on its last session, rank coverage."""
    ends = month_ends(calendar.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))))
    got = monthly.select(F.trunc("date", "month").alias("month"), F.col("date").alias("got")).distinct()
    m = ends.join(got, "month", "full")
    ranks = monthly.groupBy("date").agg(F.count("*").alias("n"), F.count("rank_126").alias("r"), F.count_distinct("rank_126").alias("d"))
    outside = ~F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    parts = [
        monthly.agg(F.count_if(outside).alias("value")).select(F.lit("rows_out_of_bounds").alias("metric"), "value"),
        monthly.groupBy("date", "security_id").count().agg(F.count_if(F.col("count") > 1).alias("value")).select(F.lit("duplicate_rows").alias("metric"), "value"),
        m.agg(F.count_if(F.col("got").isNull()).alias("missing_months"), F.count_if(F.col("date").isNull()).alias("extra_months"), F.count_if(F.col("got") != F.col("date")).alias("snapshot_date_mismatches")).transform(unpivot),
        ranks.agg(F.count_if((F.col("r") < F.col("n")) | (F.col("d") < F.col("r"))).alias("value")).select(F.lit("rank_coverage_failures").alias("metric"), "value"),
    ]
    if profile_id is not None:
        parts.append(monthly.agg(F.count_if(~F.col("profile_id").eqNullSafe(profile_id)).alias("value")).select(F.lit("profile_mismatches").alias("metric"), "value"))
    return reduce(DataFrame.unionByName, [p.select("metric", F.col("value").cast("long")) for p in parts])


def _set_moves(monthly: DataFrame, days: DataFrame, flag: str) -> DataFrame:
    """``(n, size, before, kept)`` of each snapshot: members meet their own next snapshot in an equi join on its number."""
    m = monthly.where(_yes(flag)).select("date", "security_id").distinct().join(F.broadcast(days), "date").select("n", "security_id")
    kept = m.join(m.select((F.col("n") + 1).alias("n"), "security_id"), ["n", "security_id"]).groupBy("n").agg(F.count("*").alias("kept"))
    size = m.groupBy("n").agg(F.count("*").alias("size"))
    return days.join(size, "n", "left").join(kept, "n", "left").join(size.select((F.col("n") + 1).alias("n"), F.col("size").alias("before")), "n", "left").na.fill(0, ["size", "kept", "before"]).select("n", "size", "before", "kept")


def universe_stability(monthly: DataFrame, flag: str, top: str, turnover_max: float = 0.25, overlap_min: float = 0.70) -> DataFrame:
    """For each snapshot the members of ``flag``, entries, exits and turnover against the mean size of it and the one before, and the overlap of ``top``.

    The first snapshot is compared with an empty one; what is compared with an empty set raises no flag.
    """
    days = monthly.select("date").distinct().withColumn("n", F.row_number().over(Window.orderBy("date")))  # a row a month
    x = days.join(_set_moves(monthly, days, flag), "n").join(_set_moves(monthly, days, top).withColumnsRenamed({"size": "top_size", "before": "top_before", "kept": "top_kept"}), "n")
    x = x.withColumns({"entries": F.col("size") - F.col("kept"), "exits": F.col("before") - F.col("kept")})
    overlap = F.col("top_kept") / F.greatest(F.lit(1), F.col("top_size") + F.col("top_before") - F.col("top_kept"))
    x = x.withColumns({"turnover": (F.col("entries") + F.col("exits")) / F.greatest(F.lit(1.0), (F.col("size") + F.col("before")) / 2), "top_overlap": overlap})
    flags = F.array_compact(F.array(F.when((F.col("turnover") > turnover_max) & (F.col("before") > 0), "LARGE_LIQUID_V1_TURNOVER"), F.when((F.col("top_overlap") < overlap_min) & (F.col("top_before") > 0), "LOW_TOP750_OVERLAP")))
    return x.select("date", F.col("size").alias("members"), "entries", "exits", "turnover", "top_size", "top_overlap", F.when(F.size(flags) == 0, "OK").otherwise(F.array_join(flags, ",")).alias("flags"))


def scale_summary(monthly: DataFrame, prices: DataFrame, flag: str, top: str) -> DataFrame:
    """One row: snapshots, member counts, entities that ever were members, those gone and those observed on the last date, and the mean overlap."""
    s = universe_stability(monthly, flag, top).withColumn("first", F.col("date") == F.min("date").over(Window.partitionBy(F.lit(1))))  # a row a month
    sizes = s.agg(F.count("*").alias("snapshots"), F.avg("members").alias("average_size"), F.min("members").alias("minimum_size"), F.max("members").alias("maximum_size"), F.avg(F.when(~F.col("first"), F.col("top_overlap"))).alias("mean_overlap"), F.count_if(~F.col("first")).alias("overlap_observations"))
    last = prices.agg(F.max("date").alias("end"))
    alive = prices.join(F.broadcast(last), F.col("date") == F.col("end")).select("security_id").distinct().withColumn("alive", F.lit(True))
    ever = monthly.where(_yes(flag)).select("security_id").distinct().join(alive, "security_id", "left").agg(F.count("*").alias("unique_members"), F.count_if(_yes("alive")).alias("surviving_members"))
    gone = prices.select("security_id").distinct().join(alive, "security_id", "left_anti").agg(F.count("*").alias("disappeared"))
    return sizes.crossJoin(ever).crossJoin(gone)  # one row each


def universe_history(monthly: DataFrame, spec: ProfileSpec, cutoff: int | None = None) -> DataFrame:
    """A row a month, of its last snapshot: active rows, those with the profile's history, those of them with its liquidity, and the ranking metric at the cutoff rank."""
    n, month = cutoff or min(spec.tops), F.trunc("date", "month")
    last = monthly.withColumn("last", F.max("date").over(Window.partitionBy(month))).where("date = last")
    last = last.withColumn("k", F.row_number().over(Window.partitionBy(month).orderBy(F.desc_nulls_last(spec.ranking_metric), "security_id")))
    seasoned = _yes(F.col("history_sessions") >= spec.listing_age_sessions_min)
    return last.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.max("date").alias("final_session"), F.count("*").alias("active_ordinary_equities"), F.count_if(seasoned).alias("history_eligible"),
        F.count_if(seasoned & _yes(F.col("median_traded_value_60") >= spec.median_traded_value_60_min)).alias("example_liquid_v1"), F.max(F.when(F.col("k") == n, F.col(spec.ranking_metric))).alias("cutoff_value"))


def liquidity_history(monthly: DataFrame, thresholds: tuple[float, ...] = (1e6, 5e6, 1e7, 5e7, 1e8)) -> DataFrame:
    """A row a year, of its last snapshot: exact quantiles of the 60-session median where there is one, and counts from thresholds on."""
    last = monthly.withColumn("last_", F.max("date").over(Window.partitionBy(F.year("date")))).where("date = last_ and median_traded_value_60 is not null")
    x = "median_traded_value_60"
    return last.groupBy(F.year("date").alias("year")).agg(F.max("date").alias("date"), F.count("*").alias("rows"), *[F.percentile(x, p / 100).alias(f"p{p}") for p in (50, 90, 95)], *[F.count_if(F.col(x) >= t).alias(f"above_{i}") for i, t in enumerate(thresholds)])


def survivorship(prices: DataFrame, terminal_events: DataFrame, alive_days: int = 30) -> DataFrame:
    """Entities that were gone ``alive_days`` before the end of the table, with the year, last price and the best known terminal event."""
    last = prices.groupBy("security_id").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.max_by("raw_close", "date").alias("last_price"), F.count("*").alias("observations"))
    end = prices.agg(F.max("date").alias("end_"))
    rank = F.when(F.col("event_quality") == "OFFICIAL_NSE_NOTICE", 0).otherwise(1)
    best = terminal_events.where("security_id is not null").groupBy("security_id").agg(F.min_by("terminal_event_type", F.struct(rank, "terminal_event_date", "event_id")).alias("terminal_event_type"))
    gone = last.crossJoin(F.broadcast(end)).where(F.datediff("end_", "last_date") > alive_days)
    return gone.join(best, "security_id", "left").select("security_id", "first_date", "last_date", F.year("last_date").alias("year"), "last_price", "observations", F.coalesce("terminal_event_type", F.lit("NONE")).alias("terminal_event_type"))


def terminal_priority(monthly: DataFrame, prices: DataFrame, master: DataFrame, terminal_events: DataFrame, top: str = "top750_liquidity", before=None, limit: int = 200) -> DataFrame:
    """Required entities that stop before the last snapshot, with what is known of their end; the best ranked first, at most ``limit`` (a report's length)."""
    inside = monthly.where(_yes("liquid_v1_eligible") | _yes(top))
    inside = inside if before is None else inside.where(F.col("date") < F.lit(before).cast("date"))
    need = inside.groupBy("security_id").agg(F.min("date").alias("first_required_month"), F.max("date").alias("last_required_month"), F.min("rank_126").alias("best_rank_126"), F.count_distinct("date").alias("research_months"), F.bool_or(_yes("liquid_v1_eligible")).alias("enters_liquid_v1"), F.bool_or(_yes(top)).alias("enters_top750"))
    seen = prices.groupBy("security_id").agg(F.max("date").alias("last_observed_date"))
    names = master.groupBy("security_id").agg(F.min("symbol").alias("symbol"), F.min("company_name").alias("company_name"))
    ends = terminal_events.where("security_id is not null").groupBy("security_id").agg(F.min("terminal_event_date").alias("first_"), F.array_join(F.array_sort(F.collect_set("terminal_event_type")), ", ").alias("types_"))
    stop = monthly.agg(F.max("date").alias("end_"))
    x = need.join(seen, "security_id").join(names, "security_id").join(ends, "security_id", "left").crossJoin(F.broadcast(stop)).where("last_observed_date < end_")
    out = x.select("security_id", "symbol", "company_name", "first_required_month", "last_required_month", "best_rank_126", "research_months", "enters_liquid_v1", "enters_top750", "last_observed_date", F.coalesce("first_", "last_observed_date").alias("terminal_reference_date"), F.coalesce("types_", F.lit("UNKNOWN_TERMINAL_EVENT")).alias("terminal_event_types"))
    return out.orderBy(F.asc_nulls_last("best_rank_126"), F.desc("research_months"), "security_id").limit(limit)


def survivor_comparison(monthly: DataFrame, prices: DataFrame, flag: str) -> DataFrame:
    """One row: entities that ever were members, those observed on the last date, and the others."""
    last = prices.agg(F.max("date").alias("end"))
    alive = prices.join(F.broadcast(last), F.col("date") == F.col("end")).select("security_id").distinct().withColumn("alive", F.lit(True))
    x = monthly.where(_yes(flag)).select("security_id").distinct().join(alive, "security_id", "left")
    return x.agg(F.count("*").alias("historical_eligible"), F.count_if(_yes("alive")).alias("current_survivors"), F.count_if(~_yes("alive")).alias("gone"))


def survivorship_by_year(prices: DataFrame, monthly: DataFrame, flag: str) -> DataFrame:
    """For each year the entities observed, those still observed in the last year, members of the flag and surviving members."""
    alive = prices.withColumn("y_", F.year("date")).select("y_", "security_id").distinct()
    final = alive.agg(F.max("y_").alias("m_"))
    survivors = alive.join(F.broadcast(final), F.col("y_") == F.col("m_")).select("security_id").withColumn("alive_", F.lit(True))
    members = monthly.where(_yes(flag)).select(F.year("date").alias("y_"), "security_id").distinct().withColumn("member_", F.lit(True))
    x = alive.join(survivors, "security_id", "left").join(members, ["y_", "security_id"], "left")
    return x.groupBy(F.col("y_").alias("year")).agg(F.count("*").alias("historical"), F.count_if(_yes("alive_")).alias("survivors"), F.count_if(_yes("member_")).alias("members"), F.count_if(_yes("member_") & _yes("alive_")).alias("surviving_members"))


#: Boundary statuses that warn.
BOUNDARY_WARNINGS = ("WARNING_LARGE_BOUNDARY_MOVE", "INVALID_PRE_EVENT_PRICE", "NO_BOUNDARY_OBSERVATIONS", "NO_LOCAL_BOUNDARY_OBSERVATION", "NO_PRE_EVENT_OBSERVATION", "NO_POST_EVENT_OBSERVATION", "LEFT_CENSORED_BOUNDARY_VALIDATION")
MATERIAL = ("SPLIT", "REVERSE_SPLIT", "BONUS", "BONUS_RIGHTS_COMPOSITE", "SELECTIVE_BONUS")


def readiness_by_year(monthly: DataFrame, calendar: DataFrame, events: DataFrame, boundaries: DataFrame, terminal_events: DataFrame, top: str = "top750_liquidity", max_window: int = 300) -> DataFrame:
    """A row a year: sessions, counts over the required entities of the year, five true or false dimensions as a score, and a status.

    The dimensions are sessions, a session warmed for ``max_window`` sessions, and no failure of identity, of price action (or missing
    factors), and of instrument. A year without failures passes, with limits if boundaries warn.
    """
    year = lambda c: F.year(c).alias("year")
    days = calendar.select("date").distinct().withColumn("n", F.row_number().over(Window.orderBy("date")) - 1)  # a row a session
    sessions = days.groupBy(year("date")).agg(F.count("*").alias("sessions"), F.count_if(F.col("n") >= max_window).alias("fully_warmed"))
    inside = monthly.where(_yes("liquid_v1_eligible") | _yes(top))
    some = lambda c: F.count_distinct(F.when(c, F.col("security_id")))
    quality = F.col("instrument_type_quality") if "instrument_type_quality" in monthly.columns else F.lit("")
    required = inside.groupBy(year("date")).agg(
        F.count_distinct("security_id").alias("required"), some(~F.col("research_identity_ok")).alias("identity_failures"), some(~F.col("price_adjustment_ok")).alias("price_failures"),
        some((F.col("instrument_type") != "ORDINARY_EQUITY") | quality.isNull() | (quality == "UNRESOLVED")).alias("instrument_failures"), some(F.col("status_quality") == "UNKNOWN_STATUS").alias("unknown_status"))
    scope = inside.select(year("date"), "security_id").distinct()
    material = events.where(F.col("event_type").isin(*MATERIAL)).withColumn("year", F.year("event_date")).join(scope, ["year", "security_id"]).groupBy("year").agg(F.count_if(F.col("price_factor").isNull() | F.col("share_factor").isNull()).alias("missing_factors"))
    warned = boundaries.withColumn("year", F.year("ex_date")).join(scope, ["year", "security_id"]).groupBy("year").agg(F.count_distinct(F.when(F.col("validation_status").isin(*BOUNDARY_WARNINGS), F.col("event_id"))).alias("boundary_warnings"))
    unknown = terminal_events.where(F.col("terminal_value").isNull() | F.col("terminal_value_quality").isin("UNKNOWN", "UNRESOLVED") if "terminal_value_quality" in terminal_events.columns else F.col("terminal_value").isNull())
    terminal = scope.join(unknown.select("security_id").distinct(), "security_id").groupBy("year").agg(F.count("*").alias("terminal_sensitivity"))
    x = sessions.join(monthly.select(year("date")).distinct(), "year", "full")
    for part in (required, material, warned, terminal):
        x = x.join(part, "year", "left")
    x = x.na.fill(0)
    invariant = F.col("identity_failures") + F.col("price_failures") + F.col("instrument_failures")
    score = sum((c.cast("int") for c in (F.col("sessions") > 0, F.col("fully_warmed") > 0, F.col("identity_failures") == 0, (F.col("price_failures") == 0) & (F.col("missing_factors") == 0), F.col("instrument_failures") == 0)), F.lit(0))
    status = F.when((F.col("sessions") == 0) | (F.col("fully_warmed") == 0) | (invariant > 0) | (F.col("missing_factors") > 0), "FAIL").when(F.col("boundary_warnings") > 0, "PASS_WITH_SCOPED_LIMITATION").otherwise("PASS")
    return x.withColumns({"invariant_failures": invariant, "score": score, "promotion_status": status})


def identity_review_queue(master: DataFrame, features: DataFrame, levels: tuple[float, float] = (5_000_000.0, 1_000_000.0)) -> DataFrame:
    """Entities none of whose identities rests on the official source, by the greatest liquidity they ever had; the caller may take the first."""
    weak = master.groupBy("security_id").agg(
        F.min("symbol").alias("symbol"), F.min("company_name").alias("company_name"), F.min("isin").alias("candidate_isin"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.min("identity_quality").alias("identity_quality"),
        F.bool_and(F.col("identity_quality") != "SINGLE_OFFICIAL_SOURCE").alias("weak")).where("weak").drop("weak")
    most = features.groupBy("security_id").agg(F.max("median_traded_value_126").alias("max_median_traded_value_126"), F.max("median_traded_value_60").alias("max_median_traded_value_60"), F.count_if(F.col("instrument_type") == "ORDINARY_EQUITY").alias("feature_rows"))
    x = weak.join(most, "security_id", "left").na.fill(0, ["feature_rows"])
    value = F.coalesce("max_median_traded_value_126", F.lit(0.0))
    return x.withColumn("downstream_priority", F.when(value >= levels[0], "HIGH").when(value >= levels[1], "MEDIUM").otherwise("LOW"))


def recovery_scenarios(events: DataFrame, prices: DataFrame) -> DataFrame:
    """Rows of what an event's holders may recover: nothing, the last close, and the documented value where there is one (the only canonical one)."""
    last = prices.groupBy("security_id").agg(F.max_by("raw_close", "date").alias("last_price"))
    basis = F.col("terminal_value_basis") if "terminal_value_basis" in events.columns else F.lit(None).cast("string")

    def case(name: str, value: Column, of: Column, canonical: bool) -> Column:
        return F.struct(F.lit(name).alias("scenario"), value.cast("double").alias("value"), of.alias("value_basis"), F.lit(canonical).alias("canonical"))

    cases = F.array_compact(F.array(
        case("ZERO_RECOVERY", F.lit(0.0), F.lit("DOWNSTREAM_ASSUMPTION"), False), case("LAST_OBSERVED_PRICE", F.col("last_price"), F.lit("LAST_OBSERVED_RAW_CLOSE"), False),
        F.when(F.col("terminal_value").isNotNull(), case("DOCUMENTED_VALUE", F.col("terminal_value"), basis, True))))
    return events.where("security_id is not null").join(last, "security_id", "left").select("event_id", "security_id", "terminal_event_type", F.explode(cases).alias("c")).select("event_id", "security_id", "terminal_event_type", "c.*")


def resolution_queue(events: DataFrame, prices: DataFrame, holdings: DataFrame) -> DataFrame:
    """Terminal events of held entities with their scenarios; only the prices of held entities are read."""
    held = holdings.select("security_id").distinct()
    return recovery_scenarios(events.join(held, "security_id", "left_semi"), prices.join(held, "security_id", "left_semi"))


def identity_transitions(spans: DataFrame, prices: DataFrame) -> DataFrame:
    """Adjacent spans of one symbol that change the entity, with the ratio of the closes around the change.

    The next span comes from ``lead`` in the symbol's order; of the closes, the last before and the first after.
    """
    w = Window.partitionBy("symbol").orderBy("effective_from", "security_id")
    x = spans.select("symbol", "security_id", "effective_from", F.coalesce("effective_to", F.lit("9999-12-31").cast("date")).alias("until")).withColumns({"next_id": F.lead("security_id").over(w), "next_from": F.lead("effective_from").over(w)})
    x = x.where("next_id is not null and next_id <> security_id and next_from > until")
    p = prices.groupBy("security_id").agg(F.max_by("raw_close", "date").alias("last_close"), F.min_by("raw_close", "date").alias("first_close"))
    return x.join(p.select("security_id", "last_close"), "security_id", "left").join(p.select(F.col("security_id").alias("next_id"), F.col("first_close").alias("next_close")), "next_id", "left").select("symbol", "security_id", "next_id", F.col("until").alias("effective_to"), "next_from", F.datediff("next_from", "until").alias("gap_days"), F.try_divide("next_close", "last_close").alias("close_ratio"))


def fragmentation_by_year(master: DataFrame) -> DataFrame:
    """Symbols with several entities, and entities with several symbols, by the year in which spans begin."""
    y = F.year("effective_from").alias("year")
    a = master.groupBy(y, "symbol").agg(F.count_distinct("security_id").alias("n")).groupBy("year").agg(F.count("*").alias("symbols"), F.count_if(F.col("n") > 1).alias("split_symbols"))
    b = master.groupBy(y, "security_id").agg(F.count_distinct("symbol").alias("n")).groupBy("year").agg(F.count("*").alias("securities"), F.count_if(F.col("n") > 1).alias("renamed_securities"))
    return a.join(b, "year", "full")


def conflict_statistics(master: DataFrame) -> DataFrame:
    """``(conflict, keys, worst)``: symbols with several entities, ISINs with several, entities with several ISINs or episodes."""
    def of(name: str, key: str, value: str) -> DataFrame:
        g = master.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(value).alias("n"))
        return g.agg(F.count_if(F.col("n") > 1).alias("keys"), F.max("n").alias("worst")).select(F.lit(name).alias("conflict"), "keys", "worst")

    return reduce(DataFrame.unionByName, [of("symbol_security", "symbol", "security_id"), of("isin_security", "isin", "security_id"), of("security_isin", "security_id", "isin"), of("security_episode", "security_id", "listing_episode_id")])


def identity_promotion(monthly: DataFrame, starts: list, top: str) -> DataFrame:
    """For each start the required entities by identity quality, and how many of them fail."""
    c = F.broadcast(monthly.sparkSession.createDataFrame([(str(s),) for s in starts], "s string").select(F.col("s").cast("date").alias("candidate_start")))
    x = monthly.where(_yes("liquid_v1_eligible") | _yes(top)).join(c, F.col("date") >= F.col("candidate_start"))
    return x.groupBy("candidate_start", "research_identity_quality").agg(F.count_distinct("security_id").alias("securities"), F.count_distinct(F.when(~_yes("research_identity_ok"), F.col("security_id"))).alias("failures"))


def instrument_review(master: DataFrame) -> DataFrame:
    """Ordinary entities whose name or symbol looks like a product's, and those whose symbol is known to be one."""
    from pitmill.functions.fields import known_product, product_marker

    rows = master.select("security_id", "symbol", "company_name", "instrument_type", product_marker(F.col("symbol"), F.col("company_name")).alias("product_like_marker"), known_product(F.col("symbol")).alias("known_product_symbol"))
    return rows.where("instrument_type = 'ORDINARY_EQUITY' and (product_like_marker or known_product_symbol)").select("security_id", "symbol", "company_name", "known_product_symbol").distinct()


def frequency(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("rows"))


def dataset_manifest(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """``(table, first, last, rows, securities, dates)`` of each table given with its date and entity column."""
    def of(name: str, df: DataFrame, date: str, key: str) -> DataFrame:
        return df.agg(F.min(date).alias("first"), F.max(date).alias("last"), F.count("*").alias("rows"), F.count_distinct(key).alias("securities"), F.count_distinct(date).alias("dates")).select(F.lit(name).alias("table"), "*")

    return reduce(DataFrame.unionByName, [of(n, *t) for n, t in tables.items()])


def coverage_counts(active: DataFrame, master: DataFrame) -> DataFrame:
    """``(kind, name, rows)``: active rows by year, and identities by quality (UNKNOWN where there is none)."""
    years = active.groupBy(F.year("date").cast("string").alias("name")).agg(F.count("*").alias("rows")).select(F.lit("active_rows_by_year").alias("kind"), "*")
    quality = master.groupBy(F.coalesce("identity_quality", F.lit("UNKNOWN")).alias("name")).agg(F.count("*").alias("rows")).select(F.lit("identity_quality").alias("kind"), "*")
    return years.unionByName(quality)


def release_facts(intervals: DataFrame, boundaries: DataFrame, events: DataFrame) -> DataFrame:
    """``(metric, value)``: interval overlaps, open and suspended intervals, boundary statuses that need work, unlinked events."""
    from pitmill.operators.intervals import overlaps

    i = intervals.agg(F.count("*").alias("status_intervals"), F.count_if(F.col("status_end").isNull()).alias("open_intervals"), F.count_if(F.col("trading_status") == "SUSPENDED").alias("suspended_intervals"))
    b = boundaries.agg(F.count("*").alias("boundaries"), F.count_if(F.col("validation_status").startswith("PASS")).alias("boundaries_pass"), F.count_if(F.col("validation_status") == "WARNING_LARGE_BOUNDARY_MOVE").alias("boundaries_warning"))
    e = events.agg(F.count("*").alias("events"), F.count_if(F.col("security_id").isNull()).alias("events_unlinked"))
    o = overlaps(intervals).agg(F.count("*").alias("status_overlaps"))
    return reduce(DataFrame.unionByName, [unpivot(x) for x in (i, b, e, o)])


#: Fields that evidence must state.
EVIDENCE_FIELDS = ("publisher", "accessed_at", "source_type", "evidence_quality", "symbol", "event_id", "event_date")


def _empty(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""


def _no_url(c: str = "source_url") -> Column:
    url = F.coalesce(F.col(c), F.lit(""))
    return ~(url.startswith("https://") | url.startswith("http://"))


def evidence_registry_failures(evidence: DataFrame) -> DataFrame:
    """``(evidence_id, failure)`` for every broken rule of a registered piece of evidence: no id, an id of several pieces (once for each but one), no http(s) URL, MISSING_ and the field, no facts.

    ``evidence``: evidence_id, source_url, ``facts`` (a map) and ``EVIDENCE_FIELDS``. An id's pieces are counted, not gathered.
    """
    codes = F.array_compact(F.array(
        F.when(_empty("evidence_id"), "MISSING_EVIDENCE_ID"), F.when(_no_url(), "URL_NOT_HTTP"), *[F.when(_empty(k), f"MISSING_{k.upper()}") for k in EVIDENCE_FIELDS],
        F.when(F.coalesce(F.size("facts"), F.lit(0)) <= 0, "MISSING_FACTS")))
    rules = evidence.select("evidence_id", F.explode(codes).alias("failure"))
    again = evidence.where(~_empty("evidence_id")).groupBy("evidence_id").agg(F.count("*").alias("n")).where("n > 1").select("evidence_id", F.explode(F.array_repeat(F.lit("DUPLICATE_EVIDENCE_ID"), (F.col("n") - 1).cast("int"))).alias("failure"))
    return rules.unionByName(again)


def validate_evidence(resolutions: DataFrame, evidence: DataFrame) -> DataFrame:
    """``(event_id, evidence_id, failure)`` of approved resolutions: no reference, one to unknown evidence, to evidence of another event or symbol, or to evidence that lacks a field.

    ``resolutions``: event_id, symbol, review_status, evidence_references. Of pieces with one id the first by its fields counts.
    """
    fields = ("event_id", "symbol", "publisher", "accessed_at", "evidence_quality", "source_url", "facts_")
    known = evidence.withColumn("facts_", F.coalesce(F.size("facts"), F.lit(0)) > 0).groupBy("evidence_id").agg(F.min(F.struct(*fields)).alias("e"))
    r = resolutions.where("review_status = 'APPROVED'").select("event_id", "symbol", F.explode_outer("evidence_references").alias("evidence_id"))
    x = r.join(known, "evidence_id", "left").select("event_id", "symbol", "evidence_id", F.col("e").isNotNull().alias("known"), *[F.col(f"e.{k}").alias(f"e_{k}") for k in fields])
    has = F.col("known")
    codes = F.array_compact(F.array(
        F.when(F.col("evidence_id").isNull(), "NO_EVIDENCE"), F.when(F.col("evidence_id").isNotNull() & ~has, "UNKNOWN_EVIDENCE"),
        F.when(has & ~F.col("e_event_id").eqNullSafe(F.col("event_id")), "EVENT_MISMATCH"), F.when(has & ~F.col("e_symbol").eqNullSafe(F.col("symbol")), "SYMBOL_MISMATCH"),
        *[F.when(has & _empty(f"e_{k}"), f"MISSING_{k.upper()}") for k in ("publisher", "accessed_at", "evidence_quality")], F.when(has & _no_url("e_source_url"), "MISSING_URL"), F.when(has & ~F.col("e_facts_"), "MISSING_FACTS")))
    return x.select("event_id", "evidence_id", F.explode(codes).alias("failure"))


def evidence_by_quality(evidence: DataFrame) -> DataFrame:
    """``(evidence_quality, rows)``; UNKNOWN where there is none."""
    return evidence.groupBy(F.coalesce(F.nullif(F.trim("evidence_quality"), F.lit("")), F.lit("UNKNOWN")).alias("evidence_quality")).agg(F.count("*").alias("rows"))


def research_quality_on(dates: DataFrame, intervals: DataFrame, start, end, warm_from) -> DataFrame:
    """Label of each date: that of the first interval (by ``ordinal``) that holds it, else by coverage and warm-up."""
    i = intervals.select(F.col("start").alias("a_"), F.col("end").alias("b_"), "status", "ordinal")
    hit = dates.select("date").distinct().join(F.broadcast(i), (F.col("a_").isNull() | (F.col("a_") <= F.col("date"))) & (F.col("b_").isNull() | (F.col("date") <= F.col("b_"))), "left").groupBy("date").agg(F.min_by("status", "ordinal").alias("s_"))
    d = lambda v: F.lit(v).cast("date")
    return hit.select("date", F.when(F.col("s_").isNotNull(), F.col("s_")).when((F.col("date") < d(start)) | (F.col("date") > d(end)), "COVERAGE_ERROR").when(F.col("date") < d(warm_from), "FEATURE_WARMUP").otherwise("RESEARCH_EXPLORATORY").alias("research_quality"))


def pit_audit(op, panel: DataFrame, at, changed: DataFrame) -> DataFrame:
    """Rows in which ``op``'s result up to ``at`` differs between ``panel`` and ``panel`` with rows after ``at`` replaced by ``changed``; none, if nothing leaks."""
    cut = F.lit(at).cast("date")
    a = op(panel).where(F.col("date") <= cut)
    b = op(panel.where(F.col("date") <= cut).unionByName(changed.where(F.col("date") > cut).select(*panel.columns))).where(F.col("date") <= cut)
    return a.exceptAll(b).withColumn("side", F.lit("BEFORE")).unionByName(b.exceptAll(a).withColumn("side", F.lit("AFTER")))


def pit_report(ops: dict, panel: DataFrame, at, changed: DataFrame) -> DataFrame:
    """``(operator, leaking_rows)`` of each named operator."""
    cut = F.lit(at).cast("date")
    later = panel.where(F.col("date") <= cut).unionByName(changed.where(F.col("date") > cut).select(*panel.columns))
    a, b = stage(panel, "audit"), stage(later, "audit-changed")  # once for all operators
    upto = lambda df: df.where(F.col("date") <= cut)
    parts = [differing_rows(upto(op(a)), upto(op(b))).select(F.lit(name).alias("operator"), "leaking_rows") for name, op in ops.items()]
    return reduce(DataFrame.unionByName, parts)


def recent_id_changes(prices: DataFrame, calendar: DataFrame, sessions: int = 60) -> DataFrame:
    """``(date, symbol, ids)``: symbols that several entities had within ``sessions`` sessions up to a month's end.

    The few month ends are exploded to the sessions of their windows and meet the prices in an equi join.
    """
    days = calendar.select("date").distinct().withColumn("n", F.row_number().over(Window.orderBy("date")))
    ends = month_ends(calendar).join(days, "date").select(F.col("date").alias("month_end"), F.explode(F.sequence(F.greatest(F.col("n") - sessions, F.lit(1)), F.col("n"))).alias("n"))
    window = F.broadcast(ends.join(days, "n").select("month_end", "date"))
    used = prices.select("date", F.upper("symbol_at_date").alias("symbol"), "security_id").join(window, "date")
    return used.groupBy(F.col("month_end").alias("date"), "symbol").agg(F.count_distinct("security_id").alias("ids")).where("ids > 1")


def duplicate_symbols(monthly: DataFrame) -> DataFrame:
    """``(date, symbol, ids)``: symbols of a snapshot that belong to several entities."""
    return monthly.groupBy("date", F.upper("symbol_at_date").alias("symbol")).agg(F.count_distinct("security_id").alias("ids")).where("ids > 1")


def monthly_diagnostics(monthly: DataFrame, prices: DataFrame, calendar: DataFrame, top: str = "top750_liquidity", start=None, end=None, sessions: int = 60) -> DataFrame:
    """A row a snapshot: sizes, distinct symbols and ISINs, symbols of several entities now and within the last ``sessions`` sessions, history, and how many rows fail each rule.

    One pass over the snapshots makes all counts but the two of symbols, each an aggregate by date and symbol before it is one by date; ``prices`` are read
    for the sessions near snapshots only, ordinary EQ rows.
    """
    within = F.lit(True)
    if start is not None:
        within = within & (F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        within = within & (F.col("date") <= F.lit(end).cast("date"))
    m, p = monthly.where(within), prices.where(within & (F.col("series") == "EQ") & (F.col("instrument_type") == "ORDINARY_EQUITY"))
    ordinary, out = F.col("instrument_type") == "ORDINARY_EQUITY", ~_yes("liquid_v1_eligible")
    failed = lambda code: F.count_if(out & F.coalesce(F.contains("eligibility_reason_codes", F.lit(code)), F.lit(False)))
    base = m.groupBy("date").agg(
        F.count_if(ordinary & (F.col("trading_status") == "ACTIVE_TRADING")).alias("active_ordinary_security_ids"), F.count_distinct("symbol_at_date").alias("unique_symbols"), F.count_distinct("isin").alias("unique_isins"),
        F.count_if(_yes("liquid_v1_eligible")).alias("liquid_v1"), F.count_if(_yes(top)).alias("top"), F.min("history_sessions").alias("min_history_sessions"), F.max("history_sessions").alias("max_history_sessions"),
        F.round(F.avg("history_sessions"), 2).alias("avg_history_sessions"), F.count_if(F.col("history_sessions") <= sessions).alias("short_history"),
        failed("FAILED_MIN_HISTORY").alias("failed_min_history"), failed("FAILED_MIN_PRICE").alias("failed_min_price"), failed("FAILED_POSITIVE_VOLUME_DAYS_60").alias("failed_positive_volume_60"), failed("FAILED_MEDIAN_TRADED_VALUE_60").alias("failed_median_traded_value_60"),
        F.count_if(~F.col("research_identity_ok")).alias("failed_identity_gate"), F.count_if(F.col("instrument_type") != "ORDINARY_EQUITY").alias("failed_instrument_gate"), F.count_if(F.col("trading_status") != "ACTIVE_TRADING").alias("failed_status_gate"))
    double = m.groupBy("date", "symbol_at_date").agg(F.count_distinct("security_id").alias("ids")).where("ids > 1").groupBy("date").agg(F.count("*").alias("symbols_with_multiple_security_ids"))
    days = calendar.select("date").distinct().withColumn("n", F.row_number().over(Window.orderBy("date")))  # a row a session
    near = m.select("date").distinct().join(days, "date").select(F.col("date").alias("at_"), F.explode(F.sequence(F.greatest(F.col("n") - sessions, F.lit(1)), F.col("n"))).alias("n")).join(days, "n").select("at_", "date")
    used = p.select("date", "symbol_at_date", "security_id").join(F.broadcast(near), "date")
    changed = used.groupBy(F.col("at_").alias("date"), "symbol_at_date").agg(F.count_distinct("security_id").alias("ids")).where("ids > 1").groupBy("date").agg(F.count("*").alias("symbols_changed_security_id"))
    return base.join(double, "date", "left").join(changed, "date", "left").na.fill(0, ["symbols_with_multiple_security_ids", "symbols_changed_security_id"])


def session_gaps(prices: DataFrame, calendar: DataFrame, long: int = 20) -> DataFrame:
    """``(security_id, max_gap, long_gaps)``: the most sessions without a row between two rows of an entity, and how often they are more than ``long``."""
    o = prices.select("security_id", "date").join(F.broadcast(number_sessions(calendar)), "date")
    o = o.withColumn("gap", F.col("session_number") - F.lag("session_number").over(Window.partitionBy("security_id").orderBy("session_number")) - 1)
    return o.groupBy("security_id").agg(F.coalesce(F.max("gap"), F.lit(0).cast("long")).alias("max_gap"), F.count_if(F.col("gap") > long).alias("long_gaps"))


def episode_audit(master: DataFrame, monthly: DataFrame, prices: DataFrame, calendar: DataFrame, before, top: str = "top750_liquidity") -> DataFrame:
    """A row for each entity required before a date: its episodes, symbols, ISINs and names, how many entities share these, and the longest gap in sessions before the date.

    Shares are counted among the identities of the required entities.
    """
    stop = F.lit(before).cast("date")
    required = monthly.where((F.col("date") < stop) & (_yes("liquid_v1_eligible") | _yes(top))).select("security_id").distinct()
    m = master.join(required, "security_id", "left_semi")
    symbols = m.groupBy("symbol").agg(F.count_distinct("security_id").alias("a_"), F.count_distinct("isin").alias("b_"))
    isins = m.where("isin is not null").groupBy("isin").agg(F.count_distinct("security_id").alias("c_"), F.count_distinct("symbol").alias("d_"))
    gaps = session_gaps(prices.where(F.col("date") < stop).join(required, "security_id", "left_semi"), calendar).select("security_id", F.col("max_gap").alias("gap_"))
    most = lambda c, name: F.coalesce(F.max(c), F.lit(0)).alias(name)
    each = m.join(symbols, "symbol", "left").join(isins, "isin", "left").groupBy("security_id").agg(
        F.min("symbol").alias("representative_symbol"), F.min("company_name").alias("representative_company"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.count_distinct("listing_episode_id").alias("episode_count"), F.count_distinct("symbol").alias("symbol_count"), F.count_distinct("isin").alias("isin_count"), F.count_distinct("company_name").alias("company_name_count"),
        most("a_", "max_symbol_security_count"), most("b_", "max_symbol_isin_count"), most("c_", "max_isin_security_count"), most("d_", "max_isin_symbol_count"), F.coalesce(F.bool_or("listing_history_left_censored"), F.lit(False)).alias("has_left_censored_episode"))
    return each.join(gaps, "security_id", "left").withColumn("max_absent_official_sessions", F.coalesce("gap_", F.lit(0).cast("long"))).drop("gap_")


def last_prices(prices: DataFrame, held: DataFrame) -> DataFrame:
    """``(security_id, last_date, last_price)`` of each entity in ``held``; null for one without prices. Only prices of held entities are sent."""
    last = prices.join(held.select("security_id").distinct(), "security_id", "left_semi").groupBy("security_id").agg(F.max("date").alias("last_date"), F.max_by("raw_close", "date").alias("last_price"))
    return held.join(last, "security_id", "left")


def identity_priority(required: DataFrame, master: DataFrame, monthly: DataFrame, top: str = "top750_liquidity") -> DataFrame:
    """A row for each required entity with the evidence of its identity: names, symbols, ISINs, span, ranks and months in scope."""
    inside = monthly.where(_yes("liquid_v1_eligible") | _yes(top))
    seen = inside.groupBy("security_id").agg(F.max("rank_126").alias("max_liquidity_rank_126"), F.count_distinct(F.when(_yes("liquid_v1_eligible"), F.col("date"))).alias("liquid_dates"), F.bool_and("research_identity_ok").alias("research_identity_ok"))
    known = master.groupBy("security_id").agg(
        F.min("symbol").alias("symbol"), F.min("company_name").alias("company_name"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.min("identity_quality").alias("identity_quality"),
        F.array_join(F.array_sort(F.collect_set("isin")), ", ").alias("isin_evidence"), F.count_distinct("company_name").alias("company_name_count"), F.count_distinct("symbol").alias("symbol_count"))
    return required.select("security_id").distinct().join(known, "security_id").join(seen, "security_id", "left")


def conflict_audit(monthly: DataFrame, master: DataFrame, top: str = "top750_liquidity") -> DataFrame:
    """For each required entity its months in scope, best rank, name variants, candidate ISINs and listing episodes; doubtful ones first by the caller's order."""
    inside = monthly.where(_yes("liquid_v1_eligible") | _yes(top))
    episodes = master.groupBy("security_id").agg(F.count_distinct("listing_episode_id").alias("episode_count"))
    g = inside.groupBy("security_id").agg(
        F.min("symbol_at_date").alias("symbol"), F.min("company_name").alias("company_name"), F.min("date").alias("first_research_month"), F.max("date").alias("last_research_month"), F.array_join(F.array_sort(F.collect_set("isin")), ", ").alias("candidate_isin"),
        F.min("research_identity_quality").alias("research_identity_quality"), F.min("rank_126").alias("best_liquidity_rank_126"), F.count_distinct("date").alias("research_months"), F.count_distinct("company_name").alias("company_name_variants"), F.bool_and("research_identity_ok").alias("research_identity_ok"))
    return g.join(episodes, "security_id", "left").na.fill(0, ["episode_count"])


def scope_summary(monthly: DataFrame, top: str) -> DataFrame:
    """A row a year: snapshots, rows, entities, and entities of each scope."""
    y = F.year("date").alias("year")
    some = lambda c: F.count_distinct(F.when(c, F.col("security_id")))
    return monthly.groupBy(y).agg(F.count_distinct("date").alias("snapshots"), F.count("*").alias("rows"), F.count_distinct("security_id").alias("securities"), some(_yes("liquid_v1_eligible")).alias("liquid_securities"), some(_yes(top)).alias("top_securities"), some(_yes("liquid_v1_eligible") | _yes(top)).alias("required_securities"))


def event_detail(events: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Priced events with the raw and the adjusted return over their date."""
    b = boundaries.select("event_id", "validation_status", (F.try_divide(F.coalesce("post_event_open", "post_event_close"), "pre_event_close") - 1).alias("raw_return"), F.col("residual_adjusted_return").alias("adjusted_return"))
    return events.where("price_factor is not null").select("event_id", "security_id", "event_type", "event_date", "price_factor").join(b, "event_id", "left").withColumn("validation_status", F.coalesce("validation_status", F.lit("NO_BOUNDARY_VALIDATION")))
