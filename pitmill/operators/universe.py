"""Active, monthly and profile-filtered universes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitmill.functions.fields import observation_status
from pitmill.operators.intervals import interval_join
from pitmill.spec import ProfileSpec


def active_universe(prices: DataFrame) -> DataFrame:
    """Ordinary EQ rows with a close: listed and trading on their date."""
    return prices.where("instrument_type = 'ORDINARY_EQUITY' and series = 'EQ' and raw_close is not null").withColumns({"trading_status": F.lit("ACTIVE_TRADING"), "observation_status": observation_status(F.col("volume")), "active": F.lit(True), "active_definition_version": F.lit("ACTIVE_V1")})


def active_on(prices: DataFrame, at) -> DataFrame:
    return active_universe(prices.where(F.col("date") == F.lit(at).cast("date")))


def month_ends(calendar: DataFrame) -> DataFrame:
    """The last session of each month."""
    return calendar.groupBy(F.trunc("date", "month").alias("month")).agg(F.max("date").alias("date"))


def _good(identity: Column, episodes: Column, series: Column) -> tuple[Column, Column]:
    strong = identity.isin("OFFICIAL_EXCHANGE_IDENTITY", "MULTI_SOURCE_VERIFIED", "RECONSTRUCTED_HIGH_CONFIDENCE", "RECONSTRUCTED_TRADING_IDENTITY")
    rebuilt = identity.isin("PARTIAL", "SINGLE_OFFICIAL_SOURCE") & (episodes == 1) & (series == 1)
    return F.coalesce(strong | rebuilt, F.lit(False)), F.when(~strong & rebuilt, "RECONSTRUCTED_TRADING_IDENTITY").otherwise(identity)


def profile_rules(spec: ProfileSpec) -> list[tuple[Column, str]]:
    """(rule, reason if it fails), in the order in which reasons are given; a null fails."""
    return [
        (F.col("instrument_type") == spec.instrument_type, "FAILED_INSTRUMENT_TYPE"),
        (F.col("trading_status") == spec.trading_status, "FAILED_TRADING_STATUS"),
        (F.col("research_identity_ok"), "FAILED_RESEARCH_IDENTITY"),
        (F.col("price_adjustment_ok"), "FAILED_PRICE_ADJUSTMENT"),
        (F.col("price") >= spec.price_min, "FAILED_MIN_PRICE"),
        (F.col("listing_age_sessions") >= spec.listing_age_sessions_min, "FAILED_MIN_HISTORY"),
        (F.col("positive_volume_days_60") >= spec.positive_volume_days_60_min, "FAILED_POSITIVE_VOLUME_DAYS_60"),
        (F.col("median_traded_value_60") >= spec.median_traded_value_60_min, "FAILED_MEDIAN_TRADED_VALUE_60"),
    ]


def profile_predicate(spec: ProfileSpec) -> Column:
    out = F.lit(True)
    for rule, _ in profile_rules(spec):
        out = out & F.coalesce(rule, F.lit(False))
    return out


def eligibility_reason(spec: ProfileSpec) -> Column:
    rules = profile_rules(spec)
    out = F.when(~F.coalesce(rules[0][0], F.lit(False)), rules[0][1])
    for rule, reason in rules[1:]:
        out = out.when(~F.coalesce(rule, F.lit(False)), reason)
    return out.otherwise(f"PASSED_{spec.profile_id}")


def research_universe_monthly(active: DataFrame, features: DataFrame, adjusted: DataFrame, master: DataFrame, intervals: DataFrame, calendar: DataFrame, spec: ProfileSpec, start=None, end=None) -> DataFrame:
    """Month-end snapshots with features, qualities, ranks, top flags, eligibility and its reason.

    All inputs are cut to month-end sessions before they are joined, about a twentieth of the rows.
    """
    ends = month_ends(calendar if start is None else calendar.where(F.col("date") >= F.lit(start).cast("date")))
    if end is not None:
        ends = ends.where(F.col("date") <= F.lit(end).cast("date"))
    ends = F.broadcast(ends)
    cut = lambda df: df.join(ends.select("date"), "date", "left_semi")
    a = active.where("active").join(ends, "date").select("date", "month", "security_id", "listing_episode_id", "symbol_at_date", "instrument_type", F.col("trading_status").alias("daily_status"), "observation_status")
    measures = ["price", "history_sessions", "observed_history_sessions", "listing_age_sessions", "listing_age_calendar_days", "positive_volume_days_60", "median_traded_value_60", "median_traded_value_126", "absent_observation_days_60", "zero_volume_days_60", "liquidity_rank_126", "liquidity_percentile_126", "liquidity_bucket_126"]
    f = cut(features).select("date", "security_id", *measures)
    adj = cut(adjusted).select("date", "security_id", F.col("adjustment_quality").alias("price_adjustment_quality"))
    checks = master.groupBy("security_id").agg(F.count_distinct("listing_episode_id").alias("episodes_"), F.count_distinct("series").alias("series_"))
    m = master.select("security_id", "listing_episode_id", "identity_quality", "effective_from", "effective_to")
    s = intervals.select("security_id", "status_start", "status_end", F.col("trading_status").alias("status_"), F.col("status_quality").alias("quality_"))
    rows = a.join(f, ["date", "security_id"]).join(adj, ["date", "security_id"], "left")
    rows = interval_join(rows, m, ["security_id", "listing_episode_id"]).join(checks, "security_id", "left")
    rows = interval_join(rows, s, "security_id", start="status_start", end="status_end")
    ok, quality = _good(F.col("identity_quality"), F.col("episodes_"), F.col("series_"))
    status = F.coalesce("status_", "daily_status")
    rows = rows.withColumns({
        "trading_status": status, "research_identity_ok": ok, "research_identity_quality": quality,
        "price_adjustment_ok": F.coalesce(F.col("price_adjustment_quality").isin("NO_ADJUSTMENT_REQUIRED", "PRICE_ACTION_ADJUSTED_VERIFIED"), F.lit(False)),
        "status_quality": F.coalesce("quality_", F.when(status == "ACTIVE_TRADING", "OBSERVED_TRADING_RECORD").otherwise("STATUS_EXCLUDED")),
    }).where((F.col("instrument_type") == spec.instrument_type) & (F.col("trading_status") == spec.trading_status))
    rank = F.row_number().over(Window.partitionBy("date").orderBy(F.desc_nulls_last(spec.ranking_metric), "security_id"))
    rows = rows.withColumn("rank_126", rank.cast("long")).withColumn("liquid_v1_eligible", profile_predicate(spec))
    seen = F.coalesce("observed_history_sessions", F.lit(0))
    return rows.select(
        "date", "month", "security_id", "listing_episode_id", "symbol_at_date", "instrument_type", "trading_status", "status_quality", "observation_status", *measures,
        "price_adjustment_quality", "price_adjustment_ok", "research_identity_quality", "research_identity_ok", "rank_126", "liquid_v1_eligible",
        *[(F.col(spec.ranking_metric).isNotNull() & (F.col("rank_126") <= n)).alias(f"top{n}_liquidity") for n in spec.tops],
        *[(seen >= n).alias(flag) for flag, n in spec.readiness],
        eligibility_reason(spec).alias("eligibility_reason_codes"),
    )


def required_research_security(monthly: DataFrame, top: str = "top750_liquidity") -> DataFrame:
    """Entities that were ever eligible or in the top, with the span and extremes of those months."""
    inside = F.col("liquid_v1_eligible") | F.col(top)
    of = lambda c: F.when(inside, F.col(c))
    return monthly.groupBy("security_id").agg(
        F.min(of("date")).alias("first_research_date"), F.max(of("date")).alias("last_research_date"),
        F.bool_or("liquid_v1_eligible").alias("enters_liquid_v1"), F.bool_or(top).alias("enters_top750"),
        F.min(of("rank_126")).alias("best_rank_126"), F.max(of("rank_126")).alias("worst_rank_126"),
        F.max(of("median_traded_value_60")).alias("max_median_traded_value_60"), F.max(of("median_traded_value_126")).alias("max_median_traded_value_126"), F.max(of("positive_volume_days_60")).alias("max_positive_volume_days_60"),
        F.min(of("research_identity_quality")).alias("research_identity_quality"), F.min(of("price_adjustment_quality")).alias("price_adjustment_quality"), F.bool_and(of("price_adjustment_ok")).alias("price_adjustment_ok"),
        F.min(of("status_quality")).alias("status_quality"), F.bool_and(F.when(inside, F.col("trading_status") == "ACTIVE_TRADING")).alias("active_trading_ok"),
    ).where("enters_liquid_v1 or enters_top750")


def top_n(features: DataFrame, at, n: int, metric: str = "median_traded_value_126") -> DataFrame:
    """The ``n`` ordinary entities of a date with the greatest metric."""
    return features.where((F.col("date") == F.lit(at).cast("date")) & (F.col("instrument_type") == "ORDINARY_EQUITY") & F.col(metric).isNotNull()).orderBy(F.desc(metric), "security_id").limit(n)


def eligible_on(features: DataFrame, at=None, price_min: float | None = None, age_min: int | None = None, positive_min: int | None = None, median_min: float | None = None) -> DataFrame:
    """Rows that pass the thresholds given; without a count of positive days, those of the window less the zero ones."""
    out = features if at is None else features.where(F.col("date") == F.lit(at).cast("date"))
    positive = F.col("positive_volume_days_60") if "positive_volume_days_60" in out.columns else F.least("history_sessions", F.lit(60)) - F.col("zero_volume_days_60")
    for col, least in ((F.col("price"), price_min), (F.col("listing_age_sessions"), age_min), (positive, positive_min), (F.col("median_traded_value_60"), median_min)):
        out = out if least is None else out.where(col >= least)
    return out


def profile_on(monthly: DataFrame, spec: ProfileSpec, at=None, flag: str = "liquid_v1_eligible") -> DataFrame:
    """The profile's rows: the stored flag where there is one, else the rule."""
    rule = profile_predicate(spec)
    rule = F.coalesce(F.col(flag), rule) if flag in monthly.columns else rule
    out = monthly if at is None else monthly.where(F.col("date") == F.lit(at).cast("date"))
    return out.where(rule).withColumns({"profile_id": F.lit(spec.profile_id), "as_of_date": F.col("date")})


def observation_status_on(requests: DataFrame, calendar: DataFrame, master: DataFrame, intervals: DataFrame, prices: DataFrame) -> DataFrame:
    """Requests ``(security_id, date)`` with the first that holds: no session, not listed, suspended, delisted (as not listed), traded or not, unknown."""
    s = calendar.select("date").distinct().withColumn("session_", F.lit(True))
    r = requests.select("security_id", "date").distinct().join(F.broadcast(s), "date", "left")
    listed = interval_join(r.select("security_id", "date"), master.select("security_id", "effective_from", "effective_to"), "security_id", how="inner").select("security_id", "date").distinct().withColumn("listed_", F.lit(True))
    held = interval_join(r.select("security_id", "date"), intervals.select("security_id", "status_start", "status_end", "trading_status"), "security_id", start="status_start", end="status_end", how="inner").groupBy("security_id", "date").agg(F.bool_or(F.col("trading_status") == "SUSPENDED").alias("suspended_"), F.bool_or(F.col("trading_status") == "DELISTED").alias("delisted_"))
    p = prices.join(r.select("security_id", "date"), ["security_id", "date"], "left_semi").groupBy("security_id", "date").agg(F.max(F.coalesce("volume", F.lit(0))).alias("volume_"))
    x = r.join(listed, ["security_id", "date"], "left").join(held, ["security_id", "date"], "left").join(p, ["security_id", "date"], "left")
    return x.select("security_id", "date", F.when(F.col("session_").isNull(), "NO_MARKET_SESSION").when(F.col("listed_").isNull(), "SECURITY_NOT_LISTED").when(F.col("suspended_"), "SECURITY_SUSPENDED").when(F.col("delisted_"), "SECURITY_NOT_LISTED").when(F.col("volume_") > 0, "TRADED").when(F.col("volume_").isNotNull(), "NO_TRADE").otherwise("UNKNOWN").alias("observation_status"))


def enrich(snapshot: DataFrame, features: DataFrame, columns: list[str]) -> DataFrame:
    """The snapshot with those of ``columns`` that the features have and it lacks."""
    there = [c for c in columns if c in features.columns and c not in snapshot.columns]
    return snapshot.join(features.select("security_id", "date", *there), ["security_id", "date"], "left")
