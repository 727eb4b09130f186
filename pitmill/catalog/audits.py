"""Audit, regression and source queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitmill.catalog.domain import _ADJUSTED, _BOUNDARIES, _R, _STATUS, adjusted_of, boundaries_of, intervals_of
from pitmill.catalog.inputs import sql, table
from pitmill.catalog.panel import PRICES
from pitmill.operators import audit, intervals, leakage, promotion, regression, universe
from pitmill.operators.actions import adjust_as_of, price_adjustments
from pitmill.operators.features import liquidity_as_of, liquidity_features, observation_liquidity
from pitmill.plans.staging import mark, release, stage
from pitmill.spec import ProfileSpec

QUERIES: dict = {}
ORACLE: dict = {}


def query(oracle: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = sql(oracle)
        return f

    return keep


FLAGS = {"LIQUID_V1": ("liquid_v1_eligible", None), "TOP10": ("top10_liquidity", 10), "TOP25": ("top25_liquidity", 25)}
SPEC = ProfileSpec(price_min=900.0, listing_age_sessions_min=120, positive_volume_days_60_min=5, median_traded_value_60_min=210_000.0, tops=(10, 25, 50))
STARTS = ["1995-06-01", "1996-06-01", "1997-06-01", "1998-06-01"]
_INSIDE = "(liquid_v1_eligible OR top25_liquidity)"


@query("""WITH m AS (SELECT * FROM {monthly_in}), i AS (SELECT *, coalesce(liquid_v1_eligible, false) OR coalesce(top25_liquidity, false) AS ins FROM m),
c AS (SELECT count(*) FILTER (WHERE coalesce(liquid_v1_alias, false) <> coalesce(liquid_v1_eligible, false) OR liquidity_percentile IS DISTINCT FROM liquidity_percentile_126) AS artifact_alias_failures,
  count(*) FILTER (WHERE liquid_v1_eligible AND NOT coalesce(profile_id = 'LIQUID_V1' AND profile_version = 'LIQUID_V1' AND as_of_date = date AND eligibility_result = 'ELIGIBLE' AND eligibility_reason_codes = 'PASSED_LIQUID_V1', false)) AS eligible_profile_metadata_failures,
  count(*) FILTER (WHERE NOT liquid_v1_eligible AND (profile_id <> 'LIQUID_V1' OR profile_version <> 'LIQUID_V1' OR as_of_date <> date OR eligibility_result <> 'EXCLUDED' OR eligibility_reason_codes IS NULL)) AS excluded_profile_metadata_failures,
  count(*) FILTER (WHERE date < date '1995-03-01') AS pre_research_start_rows, count(*) FILTER (WHERE instrument_type <> 'ORDINARY_EQUITY') AS non_ordinary_rows, count(*) FILTER (WHERE trading_status IS DISTINCT FROM 'ACTIVE_TRADING') AS non_active_trading_rows,
  count(*) FILTER (WHERE research_identity_ok IS NULL OR price_adjustment_quality IS NULL OR price_adjustment_ok IS NULL OR status_quality IS NULL) AS missing_quality_fields, count(*) FILTER (WHERE ins AND NOT (research_identity_ok AND price_adjustment_ok)) AS required_scope_quality_failures,
  count(*) FILTER (WHERE ins AND (price IS NULL OR median_traded_value_60 IS NULL OR symbol_at_date IS NULL)) AS required_scope_missing_research_fields, count(*) FILTER (WHERE (top10_liquidity OR top25_liquidity OR top50_liquidity) AND median_traded_value_126 IS NULL) AS top_liquidity_null_metric_failures,
  count(*) FILTER (WHERE liquid_v1_eligible AND NOT (instrument_type = 'ORDINARY_EQUITY' AND trading_status = 'ACTIVE_TRADING' AND research_identity_ok AND price_adjustment_ok AND price >= 900 AND listing_age_sessions >= 120 AND positive_volume_days_60 >= 5 AND median_traded_value_60 >= 210000)) AS liquid_predicate_failures,
  count(*) FILTER (WHERE top10_liquidity <> (rank_126 <= 10) OR top25_liquidity <> (rank_126 <= 25) OR top50_liquidity <> (rank_126 <= 50) OR (top10_liquidity AND NOT top25_liquidity) OR (top25_liquidity AND NOT top50_liquidity)) AS top_liquidity_flag_failures FROM i),
s AS (SELECT security_id, bool_or(liquid_v1_eligible) AS l, bool_or(top25_liquidity) AS t, min(date) AS a, max(date) AS b, min(rank_126) AS r0, max(rank_126) AS r1, max(median_traded_value_60) AS m60, max(positive_volume_days_60) AS p60 FROM i WHERE ins GROUP BY 1),
r AS (SELECT * FROM {required_in}), rb AS (SELECT * FROM r JOIN s USING (security_id)),
me AS (SELECT date_trunc('month', date)::DATE AS month, max(date) AS date FROM {calendar} WHERE date >= date '1995-03-01' GROUP BY 1),
bm AS (SELECT date, count(*) FILTER (WHERE liquid_v1_eligible) AS n, avg(history_sessions) AS h FROM m GROUP BY 1), mv AS (SELECT *, lag(n) OVER w AS n0, lead(n) OVER w AS n1, lag(h) OVER w AS h0 FROM bm WINDOW w AS (ORDER BY date)),
yr AS (SELECT year(date) AS y, count(DISTINCT security_id) AS n FROM m GROUP BY 1), yx AS (SELECT *, lag(n) OVER w AS n0, lead(n) OVER w AS n1 FROM yr WINDOW w AS (ORDER BY y)),
fs AS (SELECT security_id, min(date) AS f FROM {panel} GROUP BY 1)
SELECT metric, CAST(value AS BIGINT) AS value FROM (UNPIVOT c ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'monthly_snapshot_start_mismatch', count(*) FROM (SELECT min(date) AS d FROM m) WHERE d IS DISTINCT FROM date '1995-03-01'
UNION ALL SELECT 'required_artifact_instrument_classification_failures', count(*) FROM r WHERE instrument_type IS DISTINCT FROM 'ORDINARY_EQUITY' OR instrument_type_quality IS NULL OR instrument_type_quality = 'UNRESOLVED'
UNION ALL SELECT 'duplicate_month_security_rows', count(*) FROM (SELECT 1 FROM m GROUP BY date, security_id HAVING count(*) > 1)
UNION ALL SELECT 'non_month_final_session_dates', count(*) FROM (SELECT DISTINCT date FROM m) d JOIN me ON date_trunc('month', d.date) = me.month WHERE d.date <> me.date
UNION ALL SELECT 'non_calendar_dates', count(*) FROM (SELECT DISTINCT date FROM m) WHERE date NOT IN (SELECT date FROM {calendar})
UNION ALL SELECT 'required_scope_missing_from_required_artifact', count(*) FROM s WHERE security_id NOT IN (SELECT security_id FROM r)
UNION ALL SELECT 'required_artifact_security_without_monthly_scope', count(*) FROM r WHERE security_id NOT IN (SELECT security_id FROM s)
UNION ALL SELECT 'required_artifact_flag_failures', count(*) FROM rb WHERE enters_liquid_v1 IS DISTINCT FROM l OR enters_top750 IS DISTINCT FROM t
UNION ALL SELECT 'required_artifact_date_range_failures', count(*) FROM rb WHERE first_research_date IS DISTINCT FROM a OR last_research_date IS DISTINCT FROM b
UNION ALL SELECT 'required_artifact_rank_evidence_failures', count(*) FROM rb WHERE best_rank_126 IS DISTINCT FROM r0 OR worst_rank_126 IS DISTINCT FROM r1
UNION ALL SELECT 'required_artifact_liquidity_evidence_failures', count(*) FROM rb WHERE max_median_traded_value_60 IS DISTINCT FROM m60 OR max_positive_volume_days_60 IS DISTINCT FROM p60
UNION ALL SELECT 'required_artifact_identity_quality_failures', count(*) FROM r WHERE coalesce(research_identity_quality, '') NOT IN ('OFFICIAL_EXCHANGE_IDENTITY', 'MULTI_SOURCE_VERIFIED', 'RECONSTRUCTED_HIGH_CONFIDENCE', 'RECONSTRUCTED_TRADING_IDENTITY')
UNION ALL SELECT 'required_artifact_price_adjustment_failures', count(*) FROM r WHERE price_adjustment_ok IS DISTINCT FROM true OR price_adjustment_quality IS NULL OR price_adjustment_quality IN ('UNRESOLVED_CORPORATE_ACTION', 'RAW_ONLY_UNKNOWN')
UNION ALL SELECT 'required_artifact_status_failures', count(*) FROM r WHERE active_trading_ok IS DISTINCT FROM true OR status_quality IS NULL OR status_quality IN ('UNKNOWN_STATUS', 'UNRESOLVED')
UNION ALL SELECT 'future_listing_rows', count(*) FROM m JOIN fs USING (security_id) WHERE date < f
UNION ALL SELECT 'zero_liquid_collapse_months', count(*) FROM mv WHERE n = 0 AND coalesce(n0, 0) >= 100 AND coalesce(n1, 0) >= 100
UNION ALL SELECT 'active_security_count_spike_reversal_failures', count(*) FROM yx WHERE n > n0 * 1.5 AND n1 < n / 1.5
UNION ALL SELECT 'population_history_reset_months', count(*) FROM mv WHERE h0 >= 300 AND h < h0 * 0.5""")
def h31_release_invariants(spark: SparkSession, d: str) -> DataFrame:
    # the snapshots are made once, without the names that no rule reads; the required entities come from them
    monthly = stage(table(spark, d, "monthly_in").drop("month", "isin", "listing_episode_id", "company_name"), "monthly")
    return audit.validate_release(monthly, table(spark, d, "required_in", {"monthly_in": monthly}), table(spark, d, "panel"), table(spark, d, "calendar"), SPEC, "top25_liquidity", "1995-03-01")


@query("""WITH m AS (SELECT * FROM {candidate_in}), me AS (SELECT date_trunc('month', date)::DATE AS month, max(date) AS date FROM {calendar} WHERE date BETWEEN date '1995-01-01' AND date '2001-06-30' GROUP BY 1), g AS (SELECT DISTINCT date_trunc('month', date)::DATE AS month, date AS got FROM m), j AS (SELECT * FROM me FULL JOIN g USING (month)),
k AS (SELECT date, count(*) AS n, count(rank_126) AS r, count(DISTINCT rank_126) AS d FROM m GROUP BY 1)
SELECT 'profile_mismatches' AS metric, count(*) AS value FROM (SELECT * FROM {monthly_in} WHERE security_id NOT LIKE '%7') WHERE profile_id IS DISTINCT FROM 'LIQUID_V1' UNION ALL SELECT 'rows_out_of_bounds' AS metric, count(*) AS value FROM m WHERE date NOT BETWEEN date '1995-01-01' AND date '2001-06-30' UNION ALL SELECT 'duplicate_rows', count(*) FROM (SELECT 1 FROM m GROUP BY date, security_id HAVING count(*) > 1)
UNION ALL SELECT 'missing_months', count(*) FROM j WHERE got IS NULL UNION ALL SELECT 'extra_months', count(*) FROM j WHERE date IS NULL UNION ALL SELECT 'snapshot_date_mismatches', count(*) FROM j WHERE got <> date UNION ALL SELECT 'rank_coverage_failures', count(*) FROM k WHERE r < n OR d < r""")
def h52_monthly_handoff(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "candidate_in").withColumn("profile_id", F.lit(None).cast("string"))
    own = table(spark, d, "monthly_in").where("security_id not like '%7'").select("date", F.regexp_replace("security_id", "^(S.*5)$", "N$1").alias("security_id"), F.col("profile_id").alias("profile_"))
    rows = rows.join(own, ["date", "security_id"], "left").withColumn("profile_id", F.col("profile_")).drop("profile_")
    return audit.validate_handoff(rows, table(spark, d, "calendar"), "1995-01-01", "2001-06-30", "LIQUID_V1")


_STABLE = """
dn AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM (SELECT DISTINCT date FROM {monthly_in})), lm AS (SELECT DISTINCT n, security_id FROM {monthly_in} JOIN dn USING (date) WHERE liquid_v1_eligible), tm AS (SELECT DISTINCT n, security_id FROM {monthly_in} JOIN dn USING (date) WHERE top25_liquidity),
ls AS (SELECT dn.n, dn.date, count(m.security_id) AS size, count(p.security_id) AS kept FROM dn LEFT JOIN lm m ON m.n = dn.n LEFT JOIN lm p ON p.n = m.n - 1 AND p.security_id = m.security_id GROUP BY 1, 2),
ts AS (SELECT dn.n, count(m.security_id) AS tsize, count(p.security_id) AS tkept FROM dn LEFT JOIN tm m ON m.n = dn.n LEFT JOIN tm p ON p.n = m.n - 1 AND p.security_id = m.security_id GROUP BY 1),
sb AS (SELECT *, coalesce(lag(size) OVER (ORDER BY n), 0) AS before, coalesce(lag(tsize) OVER (ORDER BY n), 0) AS tbefore FROM ls JOIN ts USING (n)),
stab AS (SELECT n, date, size AS members, size - kept AS entries, before - kept AS exits, (size - kept + before - kept) / greatest(1, (size + before) / 2) AS turnover, tsize AS top_size, tkept / greatest(1, tsize + tbefore - tkept) AS top_overlap, before, tbefore FROM sb)"""


@query(f"""WITH {_STABLE} SELECT date, members, entries, exits, round(turnover + 1e-9, 6) AS turnover, top_size, round(top_overlap + 1e-9, 6) AS top_overlap,
  CASE WHEN turnover > 0.25 AND before > 0 AND top_overlap < 0.7 AND tbefore > 0 THEN 'LARGE_LIQUID_V1_TURNOVER,LOW_TOP750_OVERLAP' WHEN turnover > 0.25 AND before > 0 THEN 'LARGE_LIQUID_V1_TURNOVER' WHEN top_overlap < 0.7 AND tbefore > 0 THEN 'LOW_TOP750_OVERLAP' ELSE 'OK' END AS flags FROM stab""")
def h39_universe_stability(spark: SparkSession, d: str) -> DataFrame:
    return audit.universe_stability(table(spark, d, "monthly_in"), "liquid_v1_eligible", "top25_liquidity").select("date", "members", "entries", "exits", _R("turnover"), "top_size", _R("top_overlap"), "flags")


@query(f"""WITH {_STABLE}, pe AS (SELECT * FROM {{ending}}), al AS (SELECT DISTINCT security_id FROM pe WHERE date = (SELECT max(date) FROM pe)), ev AS (SELECT DISTINCT security_id FROM {{monthly_in}} WHERE liquid_v1_eligible)
SELECT count(*) AS snapshots, round(avg(members) + 1e-9, 6) AS average_size, min(members) AS minimum_size, max(members) AS maximum_size, round(avg(top_overlap) FILTER (WHERE n > 1) + 1e-9, 6) AS mean_overlap, count(*) FILTER (WHERE n > 1) AS overlap_observations,
  (SELECT count(*) FROM ev) AS unique_members, (SELECT count(*) FROM ev WHERE security_id IN (SELECT security_id FROM al)) AS surviving_members, (SELECT count(DISTINCT security_id) FROM pe WHERE security_id NOT IN (SELECT security_id FROM al)) AS disappeared FROM stab""")
def h39_scale_summary(spark: SparkSession, d: str) -> DataFrame:
    out = audit.scale_summary(table(spark, d, "monthly_in"), table(spark, d, "ending"), "liquid_v1_eligible", "top25_liquidity")
    return out.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in ("average_size", "mean_overlap")})


@query("""WITH l AS (SELECT *, strftime(date, '%Y-%m') AS mo, max(date) OVER (PARTITION BY date_trunc('month', date)) AS x FROM {monthly_in}), r AS (SELECT *, row_number() OVER (PARTITION BY mo ORDER BY median_traded_value_126 DESC NULLS LAST, security_id) AS k FROM l WHERE date = x)
SELECT mo AS month, max(date) AS final_session, count(*) AS active_ordinary_equities, count(*) FILTER (WHERE history_sessions >= 120) AS history_eligible, count(*) FILTER (WHERE history_sessions >= 120 AND median_traded_value_60 >= 210000) AS example_liquid_v1, max(median_traded_value_126) FILTER (WHERE k = 10) AS cutoff_value FROM r GROUP BY 1""")
def h40_universe_history(spark: SparkSession, d: str) -> DataFrame:
    return audit.universe_history(table(spark, d, "monthly_in"), SPEC)


@query("WITH l AS (SELECT *, max(date) OVER (PARTITION BY year(date)) AS x FROM {monthly_in}) SELECT year(date) AS year, max(date) AS date, count(*) AS rows, round(quantile_cont(median_traded_value_60, 0.5) + 1e-7, 4) AS p50, round(quantile_cont(median_traded_value_60, 0.9) + 1e-7, 4) AS p90, round(quantile_cont(median_traded_value_60, 0.95) + 1e-7, 4) AS p95, count(*) FILTER (WHERE median_traded_value_60 >= 100000) AS above_0, count(*) FILTER (WHERE median_traded_value_60 >= 300000) AS above_1 FROM l WHERE date = x AND median_traded_value_60 IS NOT NULL GROUP BY 1")
def h40_liquidity_history(spark: SparkSession, d: str) -> DataFrame:
    four = lambda c: F.round(F.col(c) + 1e-7, 4).alias(c)
    return audit.liquidity_history(table(spark, d, "monthly_in"), (100_000.0, 300_000.0)).select("year", "date", "rows", four("p50"), four("p90"), four("p95"), "above_0", "above_1")


@query("""WITH l AS (SELECT security_id, min(date) AS first_date, max(date) AS last_date, max_by(raw_close, date) AS last_price, count(*) AS observations FROM {panel} GROUP BY 1), b AS (SELECT security_id, min_by(terminal_event_type, (CASE WHEN event_quality = 'OFFICIAL_NSE_NOTICE' THEN 0 ELSE 1 END, terminal_event_date, event_id)) AS t FROM {terminal_events} GROUP BY 1)
SELECT security_id, first_date, last_date, year(last_date) AS year, round(last_price, 6) AS last_price, observations, coalesce(t, 'NONE') AS terminal_event_type FROM l LEFT JOIN b USING (security_id) WHERE (SELECT max(date) FROM {panel}) - last_date > 3""")
def h37_survivorship(spark: SparkSession, d: str) -> DataFrame:
    return audit.survivorship(table(spark, d, "panel"), table(spark, d, "terminal_events"), 3).withColumn("last_price", F.round("last_price", 6))


@query(f"""WITH pe AS (SELECT * FROM {{ending}}), nd AS (SELECT security_id, min(date) AS first_required_month, max(date) AS last_required_month, min(rank_126) AS best_rank_126, count(DISTINCT date) AS research_months, bool_or(liquid_v1_eligible) AS enters_liquid_v1, bool_or(top25_liquidity) AS enters_top750 FROM {{monthly_in}} WHERE {_INSIDE} AND date < date '2001-06-30' GROUP BY 1),
ls AS (SELECT security_id, max(date) AS last_observed_date FROM pe GROUP BY 1), nm AS (SELECT security_id, min(symbol) AS symbol, min(company_name) AS company_name FROM {{master}} GROUP BY 1), te AS (SELECT security_id, min(terminal_event_date) AS f, string_agg(DISTINCT terminal_event_type, ', ' ORDER BY terminal_event_type) AS t FROM {{terminal_events}} GROUP BY 1)
SELECT security_id, symbol, company_name, first_required_month, last_required_month, best_rank_126, research_months, enters_liquid_v1, enters_top750, last_observed_date, coalesce(f, last_observed_date) AS terminal_reference_date, coalesce(t, 'UNKNOWN_TERMINAL_EVENT') AS terminal_event_types
FROM nd JOIN ls USING (security_id) JOIN nm USING (security_id) LEFT JOIN te USING (security_id) WHERE last_observed_date < (SELECT max(date) FROM {{monthly_in}}) ORDER BY best_rank_126 NULLS LAST, research_months DESC, security_id LIMIT 200""")
def h37_terminal_priority(spark: SparkSession, d: str) -> DataFrame:
    return audit.terminal_priority(table(spark, d, "monthly_in"), table(spark, d, "ending"), table(spark, d, "master"), table(spark, d, "terminal_events"), "top25_liquidity", "2001-06-30")


@query(f"""WITH pe AS (SELECT * FROM {{ending}}), al AS (SELECT DISTINCT security_id FROM pe WHERE date = (SELECT max(date) FROM pe)), ev AS (SELECT DISTINCT security_id FROM {{monthly_in}} WHERE liquid_v1_eligible)
SELECT count(*) AS historical_eligible, count(al.security_id) AS current_survivors, count(*) - count(al.security_id) AS gone FROM ev LEFT JOIN al USING (security_id)""")
def h37_survivor_comparison(spark: SparkSession, d: str) -> DataFrame:
    return audit.survivor_comparison(table(spark, d, "monthly_in"), table(spark, d, "ending"), "liquid_v1_eligible")


@query("""WITH a AS (SELECT DISTINCT year(date) AS y, security_id FROM {ending}), s AS (SELECT security_id FROM a WHERE y = (SELECT max(y) FROM a)), m AS (SELECT DISTINCT year(date) AS y, security_id FROM {monthly_in} WHERE top25_liquidity)
SELECT a.y AS year, count(*) AS historical, count(s.security_id) AS survivors, count(m.security_id) AS members, count(m.security_id) FILTER (WHERE s.security_id IS NOT NULL) AS surviving_members FROM a LEFT JOIN s ON s.security_id = a.security_id LEFT JOIN m ON m.y = a.y AND m.security_id = a.security_id GROUP BY 1""")
def h37_survivorship_by_year(spark: SparkSession, d: str) -> DataFrame:
    return audit.survivorship_by_year(table(spark, d, "ending"), table(spark, d, "monthly_in"), "top25_liquidity")


@query(f"""WITH {_BOUNDARIES}, dy AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS n FROM (SELECT DISTINCT date FROM {{calendar}})), se AS (SELECT year(date) AS year, count(*) AS sessions, count(*) FILTER (WHERE n >= 300) AS fully_warmed FROM dy GROUP BY 1),
ins AS (SELECT *, year(date) AS y FROM {{monthly_in}} WHERE {_INSIDE}), rq AS (SELECT y AS year, count(DISTINCT security_id) AS required, count(DISTINCT security_id) FILTER (WHERE NOT research_identity_ok) AS identity_failures, count(DISTINCT security_id) FILTER (WHERE NOT price_adjustment_ok) AS price_failures,
  count(DISTINCT security_id) FILTER (WHERE instrument_type <> 'ORDINARY_EQUITY' OR instrument_type_quality IS NULL OR instrument_type_quality = 'UNRESOLVED') AS instrument_failures, count(DISTINCT security_id) FILTER (WHERE status_quality = 'UNKNOWN_STATUS') AS unknown_status FROM ins GROUP BY 1),
sc AS (SELECT DISTINCT y AS year, security_id FROM ins), ma AS (SELECT year(event_date) AS year, count(*) FILTER (WHERE price_factor IS NULL OR share_factor IS NULL) AS missing_factors FROM {{events_in}} e JOIN sc ON sc.security_id = e.security_id AND sc.year = year(event_date) WHERE event_type IN ('SPLIT', 'REVERSE_SPLIT', 'BONUS', 'BONUS_RIGHTS_COMPOSITE', 'SELECTIVE_BONUS') GROUP BY 1),
bw AS (SELECT year(ex_date) AS year, count(DISTINCT event_id) FILTER (WHERE validation_status IN ('WARNING_LARGE_BOUNDARY_MOVE', 'INVALID_PRE_EVENT_PRICE', 'NO_BOUNDARY_OBSERVATIONS', 'NO_LOCAL_BOUNDARY_OBSERVATION', 'NO_PRE_EVENT_OBSERVATION', 'NO_POST_EVENT_OBSERVATION', 'LEFT_CENSORED_BOUNDARY_VALIDATION')) AS boundary_warnings FROM bounds v JOIN sc ON sc.security_id = v.security_id AND sc.year = year(ex_date) GROUP BY 1),
ts AS (SELECT sc.year, count(DISTINCT sc.security_id) AS terminal_sensitivity FROM sc JOIN {{terminal_events}} t USING (security_id) WHERE t.terminal_value IS NULL OR t.terminal_value_quality IN ('UNKNOWN', 'UNRESOLVED') GROUP BY 1),
al AS (SELECT year, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ('sessions', 'fully_warmed', 'required', 'identity_failures', 'price_failures', 'instrument_failures', 'unknown_status', 'missing_factors', 'boundary_warnings', 'terminal_sensitivity'))}
  FROM se FULL JOIN (SELECT DISTINCT year(date) AS year FROM {{monthly_in}}) USING (year) LEFT JOIN rq USING (year) LEFT JOIN ma USING (year) LEFT JOIN bw USING (year) LEFT JOIN ts USING (year)),
iv AS (SELECT *, identity_failures + price_failures + instrument_failures AS invariant_failures FROM al)
SELECT *, CAST(sessions > 0 AS INT) + CAST(fully_warmed > 0 AS INT) + CAST(identity_failures = 0 AS INT) + CAST(price_failures = 0 AND missing_factors = 0 AS INT) + CAST(instrument_failures = 0 AS INT) AS score,
  CASE WHEN sessions = 0 OR fully_warmed = 0 THEN 'FAIL' WHEN invariant_failures = 0 AND missing_factors = 0 THEN CASE WHEN boundary_warnings = 0 THEN 'PASS' ELSE 'PASS_WITH_SCOPED_LIMITATION' END ELSE 'FAIL' END AS promotion_status FROM iv""")
def h38_readiness_by_year(spark: SparkSession, d: str) -> DataFrame:
    return audit.readiness_by_year(table(spark, d, "monthly_in"), table(spark, d, "calendar"), table(spark, d, "events_in"), boundaries_of(spark, d), table(spark, d, "terminal_events"), "top25_liquidity")


_NON_BLOCKING, _HARD = str(promotion.NON_BLOCKING), str(promotion.HARD)
_OPEN = f"v NOT IN {_NON_BLOCKING}"
#: Counts over the history from each row of ``st`` (s, decision) on, each by its own triangular join.
_FROM_STARTS = f"""
pr AS (SELECT * FROM {{promotion_in}} WHERE date < date '2000-01-01' AND security_id IS NOT NULL), inq AS (SELECT * FROM pr WHERE {_INSIDE}),
ap AS (SELECT security_id, min(date) AS p0, max(date) AS p1 FROM {{adjusted_in}} GROUP BY 1),
mo AS (SELECT s, count(*) AS monthly_rows, min(date) AS first_materialized_snapshot, count(*) FILTER (WHERE model_handoff_history_ready_300) AS fully_warmed_rows, count(*) FILTER (WHERE signal_history_ready_252) AS signal_ready_252_rows,
  count(*) FILTER (WHERE signal_history_ready_273) AS signal_ready_273_rows, count(DISTINCT date) AS monthly_snapshots, count(DISTINCT date) FILTER (WHERE date >= decision) AS monthly_snapshots_after_decision FROM st JOIN pr ON date >= s GROUP BY 1),
pe AS (SELECT s, decision, security_id, min(date) AS fr, bool_and(coalesce(research_identity_ok, false)) AS i, bool_and(coalesce(price_adjustment_ok, false)) AS p,
  bool_and(coalesce(instrument_type = 'ORDINARY_EQUITY' AND instrument_type_quality <> 'UNRESOLVED', false)) AS o, bool_and(coalesce(status_quality NOT IN ('UNKNOWN_STATUS', 'UNRESOLVED'), false)) AS t FROM st JOIN inq ON date >= s GROUP BY 1, 2, 3),
en AS (SELECT s, count(*) AS required_securities, count(*) FILTER (WHERE NOT i) AS identity_failures, count(*) FILTER (WHERE NOT p) AS price_adjustment_failures, count(*) FILTER (WHERE NOT o) AS instrument_failures, count(*) FILTER (WHERE NOT t) AS status_failures FROM pe GROUP BY 1),
ro AS (SELECT s, count(*) AS required_rows, count(*) FILTER (WHERE model_handoff_history_ready_300) AS fully_warmed_required_rows, count(*) FILTER (WHERE w.liquidity_window_definition IS DISTINCT FROM 'OFFICIAL_NSE_SESSION_WINDOW') AS session_liquidity_window_failures
  FROM st JOIN inq q ON q.date >= s LEFT JOIN {{windows_in}} w ON w.security_id = q.security_id AND w.date = q.date GROUP BY 1),
ma AS (SELECT pe.s, e.event_id, e.price_factor IS NULL OR e.share_factor IS NULL AS missing, coalesce(b.validation_status, 'NO_BOUNDARY_VALIDATION') AS v, coalesce(xe.n >= xd.n - 300, false) AS sig, coalesce(p0 < e.event_date, false) AS pre, coalesce(p1 >= e.event_date, false) AS post
  FROM pe JOIN {{promotion_events}} e USING (security_id) LEFT JOIN bounds b ON b.event_id = e.event_id LEFT JOIN ap USING (security_id) LEFT JOIN dy xe ON xe.date = e.event_date LEFT JOIN dy xd ON xd.date = decision LEFT JOIN dy xf ON xf.date = fr
  WHERE e.event_type IN ('SPLIT', 'REVERSE_SPLIT', 'BONUS', 'BONUS_RIGHTS_COMPOSITE', 'SELECTIVE_BONUS') AND e.event_date < date '2000-01-01' AND (e.event_date >= fr OR xe.n >= xf.n - 300)),
mc AS (SELECT s, count(DISTINCT event_id) AS material_events, count(DISTINCT event_id) FILTER (WHERE missing) AS material_missing_factors, count(DISTINCT event_id) FILTER (WHERE {_OPEN}) AS non_pass_boundaries,
  count(DISTINCT event_id) FILTER (WHERE v IN ('NO_PRE_EVENT_OBSERVATION', 'LEFT_CENSORED_BOUNDARY_VALIDATION')) AS left_censored_boundaries, count(DISTINCT event_id) FILTER (WHERE {_OPEN} AND sig) AS signal_window_non_pass_boundaries,
  count(DISTINCT event_id) FILTER (WHERE {_OPEN} AND sig AND NOT pre AND post) AS left_censored_non_pass_no_crossing_boundaries, count(DISTINCT event_id) FILTER (WHERE v IN {_HARD} AND sig AND pre AND post) AS contaminating_signal_window_non_pass_boundaries FROM ma GROUP BY 1)"""
_DAYS = "dy AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS n FROM (SELECT DISTINCT date FROM {calendar}))"
_SCOPED = (
    "required_rows", "required_securities", "identity_failures", "price_adjustment_failures", "instrument_failures", "status_failures", "session_liquidity_window_failures", "material_missing_factors",
    "signal_window_non_pass_boundaries", "left_censored_non_pass_no_crossing_boundaries", "contaminating_signal_window_non_pass_boundaries",
)
_PASSES = "required_rows > 0 AND required_securities > 0 AND identity_failures = 0 AND instrument_failures = 0 AND status_failures = 0 AND session_liquidity_window_failures = 0 AND coalesce(material_missing_factors, 0) = 0 AND coalesce(contaminating_signal_window_non_pass_boundaries, 0) = 0"
#: Every snapshot as a start.
_REFINED = f"""{_BOUNDARIES}, {_DAYS}, st AS (SELECT DISTINCT date AS s, date AS decision FROM {{promotion_in}} WHERE date < date '2000-01-01' AND security_id IS NOT NULL), {_FROM_STARTS},
rb AS (SELECT s AS boundary_date, {', '.join(f'coalesce({k}, 0) AS {k}' for k in _SCOPED)}, {_PASSES} AS passes FROM ro JOIN en USING (s) LEFT JOIN mc USING (s))"""


def _history(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """The tables that starts are judged by; the snapshots, of the columns that these read, and the sessions are made once."""
    monthly = table(spark, d, "monthly_in").select("date", "security_id", "history_sessions", "liquid_v1_eligible", "top25_liquidity", "research_identity_ok", "price_adjustment_ok", "instrument_type_quality", "status_quality")
    held = {"monthly_in": stage(monthly, "monthly"), "calendar": stage(table(spark, d, "calendar"), "calendar")}
    t = lambda name: table(spark, d, name, held)
    return t("promotion_in"), t("calendar"), t("promotion_events"), boundaries_of(spark, d, held), t("adjusted_in"), t("windows_in")


@query(f"WITH {_REFINED} SELECT * FROM rb")
def h27_refined_boundary(spark: SparkSession, d: str) -> DataFrame:
    return promotion.refined_boundaries(*_history(spark, d), "2000-01-01", "top25_liquidity")


#: The candidates as starts; ``rb`` of the snapshots comes in under other names.
_RENAMED = {k: f"{k}_b" for k in ("st", "pr", "inq", "ap", "mo", "pe", "en", "ro", "ma", "mc")}
_SNAPSHOTS = re.sub(r"\b(" + "|".join(_RENAMED) + r")\b", lambda m: _RENAMED[m[1]], _REFINED.removeprefix(f"{_BOUNDARIES}, {_DAYS}, "))
_AUDIT = f"""{_BOUNDARIES}, {_DAYS}, {_SNAPSHOTS},
cs AS (SELECT CAST(unnest({STARTS}) AS DATE) AS s), st AS (SELECT s, min(date) AS decision FROM cs LEFT JOIN dy ON date >= s AND date < date '2000-01-01' GROUP BY 1), {_FROM_STARTS},
ex AS (SELECT s, min(d) AS first_expected_snapshot FROM (SELECT s, date_trunc('month', date) AS mo_, max(date) AS d FROM cs JOIN dy ON date >= s AND date < date '2000-01-01' GROUP BY 1, 2) GROUP BY 1),
rf AS (SELECT s, min(boundary_date) AS refined_earliest_passing_snapshot FROM st JOIN rb ON boundary_date >= decision WHERE passes GROUP BY 1),
au AS (SELECT st.s AS candidate_start, decision AS first_decision_session, dy.n AS decision_session_index, first_expected_snapshot, first_materialized_snapshot, refined_earliest_passing_snapshot, coalesce(monthly_snapshots_after_decision, 0) AS monthly_snapshots_after_decision,
    {', '.join(f'coalesce({k}, 0) AS {k}' for k in promotion.COUNTS)}
  FROM st LEFT JOIN dy ON dy.date = decision LEFT JOIN ex USING (s) LEFT JOIN mo USING (s) LEFT JOIN ro USING (s) LEFT JOIN en USING (s) LEFT JOIN mc USING (s) LEFT JOIN rf USING (s)),
ga AS (SELECT *, required_securities > 0 AND monthly_snapshots > 0 AND first_expected_snapshot IS NOT DISTINCT FROM first_materialized_snapshot AND first_expected_snapshot IS NOT NULL AND first_decision_session IS NOT NULL AND monthly_snapshots_after_decision > 0
    AND identity_failures = 0 AND instrument_failures = 0 AND status_failures = 0 AND session_liquidity_window_failures = 0 AS pit_universe_gate_pass,
  price_adjustment_failures = 0 AND material_missing_factors = 0 AS price_action_gate_pass, contaminating_signal_window_non_pass_boundaries <> 0 AS boundary_validation_review_required,
  coalesce(required_rows > 0 AND decision_session_index >= 300, false) AS feature_gate_pass, required_rows - fully_warmed_required_rows AS not_fully_warmed_required_rows FROM au),
gs AS (SELECT *, pit_universe_gate_pass AND price_action_gate_pass AND NOT boundary_validation_review_required AND feature_gate_pass AS all_gates_pass FROM ga)"""


def _audit(spark: SparkSession, d: str) -> DataFrame:
    return promotion.candidate_audit(*_history(spark, d), STARTS, "2000-01-01", "top25_liquidity")


@query(f"WITH {_AUDIT} SELECT *, CASE WHEN all_gates_pass THEN 'PASS' ELSE 'FAIL' END AS status FROM gs")
def h26_candidate_audit(spark: SparkSession, d: str) -> DataFrame:
    return _audit(spark, d)


@query(f"WITH {_AUDIT} SELECT min(candidate_start) FILTER (WHERE all_gates_pass) AS earliest_research_ready, min(candidate_start) FILTER (WHERE pit_universe_gate_pass) AS earliest_pit_ready FROM gs")
def h51_candidate_gates(spark: SparkSession, d: str) -> DataFrame:
    return promotion.earliest_ready_start(_audit(spark, d))


@query(f"""WITH {_AUDIT}, be AS (SELECT min(candidate_start) FILTER (WHERE all_gates_pass) AS r, min(refined_earliest_passing_snapshot) AS p FROM gs)
SELECT 'RESEARCH' AS interval_type, CASE WHEN r IS NULL THEN 'NO_RESEARCH_GATE_PASS' ELSE 'CANDIDATE_RESEARCH_GATE_PASS_AVAILABLE' END AS status, r AS start, date '1998-12-31' AS "end" FROM be
UNION ALL SELECT 'PIT_UNIVERSE', CASE WHEN p IS NULL THEN 'NO_REFINED_BOUNDARY' ELSE 'CANDIDATE_REFINED_BOUNDARY_AVAILABLE' END, p, date '1998-12-31' FROM be""")
def h51_recommended_intervals(spark: SparkSession, d: str) -> DataFrame:
    return promotion.recommended_intervals(_audit(spark, d), "1998-12-31")


@query(f"WITH {_AUDIT} SELECT candidate_start, {', '.join(promotion.COUNTS[-7:])} FROM gs WHERE material_events > 0")
def h41_price_action_candidates(spark: SparkSession, d: str) -> DataFrame:
    return promotion.price_action_candidates(_audit(spark, d))


_NORMAL = ", ".join([f"{f}({'coalesce(' + c + ', 0)' if f == 'max' else c}) AS {c}" for c, f in (("security_id", "min"), ("isin", "min"), ("instrument_type", "min"), ("trading_status", "min"), ("history_sessions", "max"), ("listing_age_sessions", "max"), ("positive_volume_days_60", "max"), ("median_traded_value_60", "max"), ("median_traded_value_126", "max"), ("rank_126", "min"))])
_DIFFS = f"""
nb AS (SELECT date, upper(symbol_at_date) AS sym, {_NORMAL}, bool_or(price_adjustment_ok) AS pok, bool_or(liquid_v1_eligible) AS f1, bool_or(top10_liquidity) AS f2, bool_or(top25_liquidity) AS f3 FROM {{monthly_in}} GROUP BY 1, 2),
nc AS (SELECT date, upper(symbol_at_date) AS sym, {_NORMAL}, bool_or(price_adjustment_ok) AS pok, bool_or(liquid_v1_eligible) AS f1, bool_or(top10_liquidity) AS f2, bool_or(top25_liquidity) AS f3 FROM {{candidate_in}} GROUP BY 1, 2),
jo AS (SELECT coalesce(b.date, c.date) AS date, coalesce(b.sym, c.sym) AS symbol_at_date, b AS b, c AS c FROM nb b FULL JOIN nc c ON b.date = c.date AND b.sym = c.sym),
df AS ({' UNION ALL '.join(f"SELECT date, symbol_at_date, '{n}' AS universe_flag, CAST({k} AS INT) AS cutoff, coalesce(b.{f}, false) AS bm, coalesce(c.{f}, false) AS cm, b, c FROM jo WHERE coalesce(b.{f}, false) <> coalesce(c.{f}, false)" for n, k, f in (("LIQUID_V1", "NULL", "f1"), ("TOP10", "10", "f2"), ("TOP25", "25", "f3")))})"""


@query(f"""WITH {_DIFFS}, tr AS (SELECT date, universe_flag, bm, string_agg(symbol_at_date, ', ' ORDER BY symbol_at_date) AS trigger_symbol FROM df WHERE cutoff IS NOT NULL GROUP BY 1, 2, 3)
SELECT df.date, symbol_at_date, df.universe_flag, df.bm AS baseline_member, cm AS candidate_member, trigger_symbol, CASE WHEN coalesce(b.instrument_type, c.instrument_type, '') <> 'ORDINARY_EQUITY' OR regexp_matches(symbol_at_date, 'GOLD|NIFTY|ETF|BEES|HANGSENG|LIQUID|MOM|NV20|PSUBNK|BANKETF') THEN 'NON_ORDINARY_INSTRUMENT_REMOVAL'
  WHEN b.security_id = c.security_id AND (b.rank_126 <= cutoff) <> (c.rank_126 <= cutoff) THEN 'RANK_CUTOFF_SECOND_ORDER_EFFECT' WHEN cm AND trigger_symbol IS NOT NULL THEN 'RANK_CUTOFF_SECOND_ORDER_EFFECT' WHEN b.security_id <> c.security_id OR b.isin <> c.isin THEN 'IDENTITY_V2_CONTINUITY_CORRECTION'
  WHEN abs(c.history_sessions - b.history_sessions) >= 100 THEN 'IDENTITY_V2_CONTINUITY_CORRECTION' WHEN df.universe_flag = 'LIQUID_V1' AND (b.listing_age_sessions >= 272) <> (c.listing_age_sessions >= 272) THEN 'SESSION_CORRECT_HISTORY_RECALCULATION' WHEN abs(c.listing_age_sessions - b.listing_age_sessions) >= 100 THEN 'LISTING_HISTORY_CONTINUITY_CORRECTION'
  WHEN b.trading_status IS DISTINCT FROM c.trading_status THEN 'TRADING_STATUS_CORRECTION' WHEN abs(c.positive_volume_days_60 - b.positive_volume_days_60) >= 5 THEN 'POSITIVE_VOLUME_RULE_CORRECTION' WHEN abs(c.median_traded_value_60 - b.median_traded_value_60) > 1000000 THEN 'SESSION_CORRECT_LIQUIDITY_RECALCULATION'
  WHEN b.pok IS DISTINCT FROM c.pok THEN 'CORPORATE_ACTION_ADJUSTMENT_CORRECTION' WHEN b.security_id IS NULL THEN 'ADDED_OFFICIAL_SOURCE_RECORD' WHEN c.security_id IS NULL THEN 'SOURCE_OBSERVATION_CORRECTION' ELSE 'UNEXPLAINED' END AS primary_attribution
FROM df LEFT JOIN tr ON tr.date = df.date AND tr.universe_flag = df.universe_flag AND tr.bm <> df.bm""")
def h28_membership_attribution(spark: SparkSession, d: str) -> DataFrame:
    return regression.attribute_membership(table(spark, d, "monthly_in"), table(spark, d, "candidate_in"), FLAGS).select("date", "symbol_at_date", "universe_flag", "baseline_member", "candidate_member", "trigger_symbol", "primary_attribution")


@query(f"WITH {_DIFFS} SELECT universe_flag, symbol_at_date, count(*) AS rows FROM df GROUP BY 1, 2 ORDER BY rows DESC, universe_flag, symbol_at_date LIMIT 25")
def d23_top_contributors(spark: SparkSession, d: str) -> DataFrame:
    return regression.top_contributors(regression.membership_diffs(table(spark, d, "monthly_in"), table(spark, d, "candidate_in"), FLAGS))


def _releases(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Adjusted prices and events without and with the events of even keys."""
    p, e = table(spark, d, "panel"), table(spark, d, "events_in")
    old = e.where("event_id not like '%8'")
    return price_adjustments(p, old), price_adjustments(p, e), old, e


_TWO = """
ne AS (SELECT * FROM {events_in}), oe AS (SELECT * FROM ne WHERE event_id NOT LIKE '%8'),
fo AS (SELECT p.security_id, p.date, p.raw_close, coalesce(product(e.price_factor), 1) AS f FROM {panel} p LEFT JOIN oe e ON e.security_id = p.security_id AND e.event_date > p.date AND e.price_factor > 0 GROUP BY 1, 2, 3),
fn AS (SELECT p.security_id, p.date, p.raw_close, coalesce(product(e.price_factor), 1) AS f FROM {panel} p LEFT JOIN ne e ON e.security_id = p.security_id AND e.event_date > p.date AND e.price_factor > 0 GROUP BY 1, 2, 3),
ad AS (SELECT DISTINCT security_id, event_date FROM ne WHERE event_type IN ('SPLIT', 'BONUS') AND price_factor IS NOT NULL AND NOT EXISTS (SELECT 1 FROM oe WHERE oe.security_id = ne.security_id AND oe.event_date = ne.event_date AND oe.event_type = ne.event_type))"""


@query(f"""WITH {_TWO} SELECT fo.security_id, fo.date, round(fn.f / fo.f - 1 + 1e-9, 6) AS relative_difference, CASE WHEN EXISTS (SELECT 1 FROM ad WHERE ad.security_id = fo.security_id AND ad.event_date > fo.date) THEN 'ADDED_OFFICIAL_MATERIAL_ACTION_FORWARD_FACTOR' ELSE 'UNEXPLAINED' END AS cause FROM fo JOIN fn USING (security_id, date) WHERE abs(fo.raw_close * fo.f - fn.raw_close * fn.f) > 0.000001""")
def h29_signal_attribution(spark: SparkSession, d: str) -> DataFrame:
    a, b, old, new = _releases(spark, d)
    return regression.attribute_signal(a, b, old, new).select("security_id", "date", _R("relative_difference"), "cause")


_COUNTERS = f"""{_DIFFS}, {_TWO},
ct AS (SELECT 'baseline_rows' AS "check", count(*) AS rows FROM {{monthly_in}} UNION ALL SELECT 'candidate_rows', count(*) FROM {{candidate_in}}
UNION ALL SELECT 'baseline_only_rows', count(*) FROM {{monthly_in}} b WHERE NOT EXISTS (SELECT 1 FROM {{candidate_in}} c WHERE c.date = b.date AND c.security_id = b.security_id) UNION ALL SELECT 'candidate_only_rows', count(*) FROM {{candidate_in}} c WHERE NOT EXISTS (SELECT 1 FROM {{monthly_in}} b WHERE c.date = b.date AND c.security_id = b.security_id)
UNION ALL SELECT 'membership_' || universe_flag, count(*) FROM df GROUP BY 1 UNION ALL SELECT 'raw_price_differences', count(*) FROM fo JOIN fn USING (security_id, date) WHERE abs(fo.raw_close - fn.raw_close) > 0.000001 UNION ALL SELECT 'adjustment_factor_differences', count(*) FROM fo JOIN fn USING (security_id, date) WHERE abs(fo.f - fn.f) > 0.000001)"""


def _counters(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events_in")
    columns = [*regression.MONTHLY, *[c for c, _ in FLAGS.values()]]
    monthly = stage(table(spark, d, "monthly_in"), "monthly")  # read by many counters, and by the candidate
    candidate = stage(table(spark, d, "candidate_in", {"monthly_in": monthly}).select(*columns), "candidate")
    paired = regression.paired_factors(table(spark, d, "panel"), e.where("event_id not like '%8'"), e)
    return regression.regression_counters(monthly.select(*columns), candidate, paired, FLAGS)


@query(f"WITH {_COUNTERS} SELECT * FROM ct")
def h30_regression_counters(spark: SparkSession, d: str) -> DataFrame:
    return _counters(spark, d)


@query(f"""WITH {_COUNTERS} SELECT count(*) FILTER (WHERE rows > 0) AS failing, count(*) FILTER (WHERE rows > 0 AND "check" <> 'adjustment_factor_differences') AS unjustified, 'REVIEW_REQUIRED' AS verdict FROM ct WHERE "check" NOT IN ('baseline_rows', 'candidate_rows')""")
def h30_regression_verdict(spark: SparkSession, d: str) -> DataFrame:
    return regression.verdict(_counters(spark, d), ("adjustment_factor_differences",))


@query("""WITH w AS (SELECT security_id, min(symbol) AS symbol, min(company_name) AS company_name, min(isin) AS candidate_isin, min(first_seen) AS first_seen, max(last_seen) AS last_seen, min(identity_quality) AS identity_quality FROM {master} GROUP BY 1 HAVING bool_and(identity_quality <> 'SINGLE_OFFICIAL_SOURCE')),
f AS (SELECT security_id, max(median_traded_value_126) AS max_median_traded_value_126, max(median_traded_value_60) AS max_median_traded_value_60, count(*) FILTER (WHERE instrument_type = 'ORDINARY_EQUITY') AS feature_rows FROM {monthly_in} GROUP BY 1)
SELECT w.*, max_median_traded_value_126, max_median_traded_value_60, coalesce(feature_rows, 0) AS feature_rows, CASE WHEN coalesce(max_median_traded_value_126, 0) >= 500000 THEN 'HIGH' WHEN coalesce(max_median_traded_value_126, 0) >= 300000 THEN 'MEDIUM' ELSE 'LOW' END AS downstream_priority FROM w LEFT JOIN f USING (security_id)""")
def h35_identity_review_queue(spark: SparkSession, d: str) -> DataFrame:
    return audit.identity_review_queue(table(spark, d, "master"), table(spark, d, "monthly_in"), (500_000.0, 300_000.0))


@query("""WITH l AS (SELECT security_id, max_by(raw_close, date) AS p FROM {panel} GROUP BY 1), e AS (SELECT t.*, p FROM {terminal_events} t LEFT JOIN l USING (security_id) WHERE security_id IN (SELECT security_id FROM {holdings}))
SELECT event_id, security_id, terminal_event_type, 'ZERO_RECOVERY' AS scenario, 0.0 AS value, 'DOWNSTREAM_ASSUMPTION' AS value_basis, false AS canonical FROM e UNION ALL SELECT event_id, security_id, terminal_event_type, 'LAST_OBSERVED_PRICE', p, 'LAST_OBSERVED_RAW_CLOSE', false FROM e UNION ALL SELECT event_id, security_id, terminal_event_type, 'DOCUMENTED_VALUE', terminal_value, terminal_value_basis, true FROM e WHERE terminal_value IS NOT NULL""")
def h36_resolution_queue(spark: SparkSession, d: str) -> DataFrame:
    return audit.resolution_queue(table(spark, d, "terminal_events"), table(spark, d, "panel"), table(spark, d, "holdings"))


@query("""WITH x AS (SELECT symbol, security_id, coalesce(effective_to, date '9999-12-31') AS u, lead(security_id) OVER w AS ni, lead(effective_from) OVER w AS nf FROM {handover} WINDOW w AS (PARTITION BY symbol ORDER BY effective_from, security_id)), p AS (SELECT security_id, max_by(raw_close, date) AS l, min_by(raw_close, date) AS f FROM {panel} GROUP BY 1)
SELECT symbol, x.security_id, ni AS next_id, u AS effective_to, nf AS next_from, nf - u AS gap_days, round(b.f / a.l + 1e-9, 6) AS close_ratio FROM x LEFT JOIN p a ON a.security_id = x.security_id LEFT JOIN p b ON b.security_id = ni WHERE ni <> x.security_id AND nf > u""")
def h34_identity_transitions(spark: SparkSession, d: str) -> DataFrame:
    return audit.identity_transitions(table(spark, d, "handover"), table(spark, d, "panel")).withColumn("close_ratio", F.round(F.col("close_ratio") + 1e-9, 6))


@query("""WITH a AS (SELECT year, count(*) AS symbols, count(*) FILTER (WHERE n > 1) AS split_symbols FROM (SELECT year(effective_from) AS year, symbol, count(DISTINCT security_id) AS n FROM {master} GROUP BY 1, 2) GROUP BY 1), b AS (SELECT year, count(*) AS securities, count(*) FILTER (WHERE n > 1) AS renamed_securities FROM (SELECT year(effective_from) AS year, security_id, count(DISTINCT symbol) AS n FROM {master} GROUP BY 1, 2) GROUP BY 1) SELECT * FROM a FULL JOIN b USING (year)""")
def h34_fragmentation_by_year(spark: SparkSession, d: str) -> DataFrame:
    return audit.fragmentation_by_year(table(spark, d, "master"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS conflict, count(*) FILTER (WHERE n > 1) AS keys, max(n) AS worst FROM (SELECT {k}, count(DISTINCT {v}) AS n FROM {{master}} WHERE {k} IS NOT NULL GROUP BY 1)" for n, k, v in (("symbol_security", "symbol", "security_id"), ("isin_security", "isin", "security_id"), ("security_isin", "security_id", "isin"), ("security_episode", "security_id", "listing_episode_id"))))
def h42_conflict_statistics(spark: SparkSession, d: str) -> DataFrame:
    return audit.conflict_statistics(table(spark, d, "master"))


@query(f"WITH c AS (SELECT CAST(unnest({STARTS}) AS DATE) AS candidate_start) SELECT candidate_start, research_identity_quality, count(DISTINCT security_id) AS securities, count(DISTINCT security_id) FILTER (WHERE NOT research_identity_ok) AS failures FROM c JOIN {{monthly_in}} ON date >= candidate_start WHERE {_INSIDE} GROUP BY 1, 2")
def h41_identity_promotion(spark: SparkSession, d: str) -> DataFrame:
    return audit.identity_promotion(table(spark, d, "monthly_in"), STARTS, "top25_liquidity")


@query(f"WITH {_BOUNDARIES}, c AS (SELECT CAST(unnest({STARTS}) AS DATE) AS candidate_start), r AS (SELECT candidate_start, row_number() OVER (PARTITION BY candidate_start ORDER BY abs(holder_value_ratio - 1) DESC NULLS LAST, event_id) AS k, event_id, security_id, ex_date, validation_status FROM bounds JOIN c ON ex_date >= candidate_start WHERE validation_status NOT IN {_NON_BLOCKING}) SELECT * FROM r WHERE k <= 100")
def h41_boundary_blockers(spark: SparkSession, d: str) -> DataFrame:
    return promotion.boundary_blockers(boundaries_of(spark, d), STARTS)


@query("SELECT DISTINCT concat('P', CAST(p_partkey AS VARCHAR)) AS security_id, concat('P', CAST(p_partkey AS VARCHAR)) AS symbol, concat(p_name, CASE p_partkey % 9 WHEN 1 THEN ' warrant' ELSE '' END) AS company_name, false AS known_product_symbol FROM {part} WHERE p_partkey % 9 = 1 OR regexp_matches(upper(p_name), 'ETF|BEES|LIQUID|GILT|GOLD|SILVER|FUND|MUTUAL|NIFTY|SENSEX|BANKBEES|JUNIORBEES|PSUBNKBEES|SHARIAHBEES|PREF|PREFERENCE|WARRANT|RIGHTS|REIT|INVIT')")
def h41_instrument_review(spark: SparkSession, d: str) -> DataFrame:
    p = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    return audit.instrument_review(table(spark, d, "part").select(p.alias("security_id"), p.alias("symbol"), F.expr("concat(p_name, CASE p_partkey % 9 WHEN 1 THEN ' warrant' ELSE '' END)").alias("company_name"), F.lit("ORDINARY_EQUITY").alias("instrument_type")))


@query("SELECT research_identity_quality, price_adjustment_quality, count(*) AS rows FROM {monthly_in} GROUP BY 1, 2")
def h44_quality_frequency(spark: SparkSession, d: str) -> DataFrame:
    return audit.frequency(table(spark, d, "monthly_in"), "research_identity_quality", "price_adjustment_quality")


@query(f"WITH {_BOUNDARIES} SELECT validation_status, count(*) AS rows FROM bounds GROUP BY 1")
def h44_boundary_frequency(spark: SparkSession, d: str) -> DataFrame:
    return audit.frequency(boundaries_of(spark, d), "validation_status")


@query("SELECT 'panel' AS \"table\", min(date) AS first, max(date) AS last, count(*) AS rows, count(DISTINCT security_id) AS securities, count(DISTINCT date) AS dates FROM {panel} UNION ALL SELECT 'monthly', min(date), max(date), count(*), count(DISTINCT security_id), count(DISTINCT date) FROM {monthly_in}")
def h55_dataset_manifest(spark: SparkSession, d: str) -> DataFrame:
    return audit.dataset_manifest({"panel": (table(spark, d, "panel"), "date", "security_id"), "monthly": (table(spark, d, "monthly_in"), "date", "security_id")})


@query("SELECT 'active_rows_by_year' AS kind, CAST(year(date) AS VARCHAR) AS name, count(*) AS rows FROM {panel} GROUP BY 2 UNION ALL SELECT 'identity_quality', coalesce(identity_quality, 'UNKNOWN'), count(*) FROM {master} GROUP BY 2")
def h55_coverage_counts(spark: SparkSession, d: str) -> DataFrame:
    return audit.coverage_counts(table(spark, d, "panel"), table(spark, d, "master"))


@query(f"""WITH {_BOUNDARIES}, {_STATUS}, o AS (SELECT *, max(coalesce(status_end, date '9999-12-31')) OVER (PARTITION BY security_id ORDER BY status_start, coalesce(status_end, date '9999-12-31') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM stat)
SELECT 'status_intervals' AS metric, count(*) AS value FROM stat UNION ALL SELECT 'open_intervals', count(*) FROM stat WHERE status_end IS NULL UNION ALL SELECT 'suspended_intervals', count(*) FROM stat WHERE trading_status = 'SUSPENDED' UNION ALL SELECT 'boundaries', count(*) FROM bounds UNION ALL SELECT 'boundaries_pass', count(*) FROM bounds WHERE validation_status LIKE 'PASS%'
UNION ALL SELECT 'boundaries_warning', count(*) FROM bounds WHERE validation_status = 'WARNING_LARGE_BOUNDARY_MOVE' UNION ALL SELECT 'events', count(*) FROM {{events_in}} UNION ALL SELECT 'events_unlinked', count(*) FROM {{events_in}} WHERE security_id IS NULL UNION ALL SELECT 'status_overlaps', count(*) FROM o WHERE status_start <= h""")
def h54_release_facts(spark: SparkSession, d: str) -> DataFrame:
    return audit.release_facts(intervals_of(spark, d), boundaries_of(spark, d), table(spark, d, "events_in"))


_NO_URL = "NOT (coalesce({0}, '') LIKE 'https://%' OR coalesce({0}, '') LIKE 'http://%')"
_BLANK = "trim(coalesce(CAST({0} AS VARCHAR), '')) = ''"
_EVIDENCE_RULES = [
    (_BLANK.format("evidence_id"), "MISSING_EVIDENCE_ID"), (_NO_URL.format("source_url"), "URL_NOT_HTTP"), ("NOT has_facts", "MISSING_FACTS"),
    *[(_BLANK.format(k), f"MISSING_{k.upper()}") for k in ("publisher", "accessed_at", "source_type", "evidence_quality", "symbol", "event_id", "event_date")],
]


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "evidence_in").withColumn("facts", F.when(F.col("has_facts"), F.create_map(F.lit("ratio"), F.lit("1:1")))).drop("has_facts")


@query("WITH e AS (SELECT * FROM {evidence_in}) " + " UNION ALL ".join(f"SELECT evidence_id, '{name}' AS failure FROM e WHERE {rule}" for rule, name in _EVIDENCE_RULES)
       + " UNION ALL SELECT evidence_id, 'DUPLICATE_EVIDENCE_ID' FROM (SELECT evidence_id, row_number() OVER (PARTITION BY evidence_id) AS k FROM e WHERE trim(evidence_id) <> '') WHERE k > 1")
def h16_evidence_registry(spark: SparkSession, d: str) -> DataFrame:
    return audit.evidence_registry_failures(_evidence(spark, d))


@query(f"""WITH k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY evidence_id ORDER BY event_id NULLS FIRST, symbol, publisher, accessed_at NULLS FIRST, evidence_quality NULLS FIRST, source_url, has_facts) AS n FROM {{evidence_in}}) WHERE n = 1),
r AS (SELECT event_id, symbol, unnest(coalesce(evidence_references, [NULL])) AS evidence_id FROM {{reviewed_in}} WHERE review_status = 'APPROVED'),
x AS (SELECT r.*, k.evidence_id IS NOT NULL AS known, k.event_id AS e_event, k.symbol AS e_symbol, publisher, accessed_at, evidence_quality, source_url, has_facts FROM r LEFT JOIN k USING (evidence_id))
SELECT event_id, evidence_id, 'NO_EVIDENCE' AS failure FROM x WHERE evidence_id IS NULL UNION ALL SELECT event_id, evidence_id, 'UNKNOWN_EVIDENCE' FROM x WHERE evidence_id IS NOT NULL AND NOT known
UNION ALL SELECT event_id, evidence_id, 'EVENT_MISMATCH' FROM x WHERE known AND e_event IS DISTINCT FROM event_id UNION ALL SELECT event_id, evidence_id, 'SYMBOL_MISMATCH' FROM x WHERE known AND e_symbol IS DISTINCT FROM symbol
{' '.join(f"UNION ALL SELECT event_id, evidence_id, 'MISSING_{k.upper()}' FROM x WHERE known AND {_BLANK.format(k)}" for k in ("publisher", "accessed_at", "evidence_quality"))}
UNION ALL SELECT event_id, evidence_id, 'MISSING_URL' FROM x WHERE known AND {_NO_URL.format("source_url")} UNION ALL SELECT event_id, evidence_id, 'MISSING_FACTS' FROM x WHERE known AND NOT has_facts""")
def h16_evidence_integrity(spark: SparkSession, d: str) -> DataFrame:
    return audit.validate_evidence(table(spark, d, "reviewed_in"), _evidence(spark, d))


@query("SELECT coalesce(nullif(trim(evidence_quality), ''), 'UNKNOWN') AS evidence_quality, count(*) AS rows FROM {evidence_in} GROUP BY 1")
def h16_evidence_by_quality(spark: SparkSession, d: str) -> DataFrame:
    return audit.evidence_by_quality(_evidence(spark, d))


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM {orders}) SELECT date, CASE WHEN date BETWEEN date '1996-03-01' AND date '1996-12-31' THEN 'PIT_VERIFIED' WHEN date >= date '1996-06-01' AND date <= date '1997-06-01' THEN 'EXPLORATORY' WHEN date < date '1995-02-01' OR date > date '2001-06-01' THEN 'COVERAGE_ERROR' WHEN date < date '1995-09-01' THEN 'FEATURE_WARMUP' ELSE 'RESEARCH_EXPLORATORY' END AS research_quality FROM d""")
def h48_research_quality(spark: SparkSession, d: str) -> DataFrame:
    i = spark.sql("SELECT date '1996-03-01' AS start, date '1996-12-31' AS end, 'PIT_VERIFIED' AS status, 0 AS ordinal UNION ALL SELECT date '1996-06-01', date '1997-06-01', 'EXPLORATORY', 1")
    return audit.research_quality_on(table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date")), i, "1995-02-01", "2001-06-01", "1995-09-01")


@query("""WITH p AS (SELECT *, traded_value * 7 + 1 AS other FROM {panel}), x AS (SELECT security_id, date, sum(coalesce(traded_value, 0)) OVER (PARTITION BY security_id) AS a, sum(coalesce(CASE WHEN date > date '1999-06-30' THEN other ELSE traded_value END, 0)) OVER (PARTITION BY security_id) AS b FROM p)
SELECT 'liquidity' AS operator, 0 AS leaking_rows UNION ALL SELECT 'calendar_age', 0 UNION ALL SELECT 'leaking_total', 2 * count(*) FROM x WHERE date <= date '1999-06-30' AND round(a, 2) <> round(b, 2)""")
def h53_pit_audit(spark: SparkSession, d: str) -> DataFrame:
    """Results up to a date must not change when every later row does; an operator that sums over all dates is found."""
    p = table(spark, d, "panel").select("security_id", "date", "raw_close", "volume", "traded_value")
    cents = F.col("traded_value").cast("decimal(20,2)")
    ops = {
        "liquidity": lambda x: observation_liquidity(x, (60,)).select("security_id", "date", "median_traded_value_60"),
        "calendar_age": lambda x: x.select("security_id", "date", F.row_number().over(Window.partitionBy("security_id").orderBy("date")).alias("age")),
        "leaking_total": lambda x: x.select("security_id", "date", F.sum(F.coalesce(cents, F.lit(0))).over(Window.partitionBy("security_id")).alias("total")),
    }
    return audit.pit_report(ops, p, "1999-06-30", p.withColumn("traded_value", F.col("traded_value") * 7 + 1))


_DATED = ("liquidity", "session_liquidity", "active", "adjusted", "symbols", "top")


@query(f"""WITH n AS (SELECT count(*) AS n FROM {{panel}} WHERE date <= date '1998-06-30'), sc AS (SELECT unnest({list(leakage.SCENARIOS)}) AS scenario)
SELECT unnest({list(_DATED)}) AS operator, scenario, 0 AS leaking_rows FROM sc UNION ALL SELECT 'control', scenario, 2 * n FROM sc, n""")
def h53_leakage_scenarios(spark: SparkSession, d: str) -> DataFrame:
    """Every operator with a date under every scenario; the control looks at all rows of all tables and is found in each."""
    at = "1998-06-30"
    begun = mark()
    held = {"panel": stage(table(spark, d, "panel").select(*PRICES, "symbol_at_date", "listing_episode_id", "isin", "company_name"), "panel")}
    held["spans"] = stage(table(spark, d, "spans", held), "spans")
    cal, day = stage(table(spark, d, "calendar"), "calendar"), spark.sql(f"SELECT date '{at}' AS date")
    t = {"prices": held["panel"].select(*PRICES, "symbol_at_date"), "symbols": table(spark, d, "handover", held).unionByName(table(spark, d, "master", held).select("symbol", "security_id", "effective_from", "effective_to")), "events": stage(table(spark, d, "events_in"), "events")}

    def control(x: dict) -> DataFrame:
        seen = [v.agg(F.sum(F.xxhash64(*v.columns).cast("decimal(20,0)")).alias(k)) for k, v in x.items()]
        return x["prices"].select("security_id", "date").crossJoin(F.broadcast(seen[0].crossJoin(seen[1]).crossJoin(seen[2])))

    def rows(x: dict, *more: str) -> DataFrame:
        return x["prices"].select("security_id", "date", "series", "raw_close", "volume", "traded_value", *more)

    def symbols(x: dict) -> DataFrame:
        asked = x["prices"].where(F.col("date") <= F.lit(at).cast("date")).select(F.col("symbol_at_date").alias("symbol"), "date").distinct()
        return intervals.point_in_time(asked, x["symbols"], "symbol", "security_id")

    ops = {
        "liquidity": lambda x: liquidity_as_of(x["prices"], at), "session_liquidity": lambda x: liquidity_features(rows(x), cal, (20, 126), columns=("security_id", "date", "history_sessions", "median_traded_value_126", "liquidity_rank_126")),
        "active": lambda x: universe.active_on(x["prices"], at), "adjusted": lambda x: adjust_as_of(x["prices"].select("security_id", "date", "raw_close"), x["events"], at, ids=False).select("security_id", "date", "price_return_adjustment_factor"),
        "symbols": symbols, "top": lambda x: universe.top_n(liquidity_features(rows(x, "instrument_type"), cal, (126,), at=day, columns=("security_id", "date", "instrument_type", "median_traded_value_126", "liquidity_rank_126")), at, 20).select("security_id", "date", "liquidity_rank_126"), "control": control,
    }
    report = leakage.leakage_report(ops, t, at)
    release(spark, begun)
    return report


@query("""WITH s AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM {calendar}), me AS (SELECT max(date) AS date FROM {calendar} GROUP BY date_trunc('month', date)), e AS (SELECT s.date AS month_end, s.n FROM s JOIN me USING (date))
SELECT month_end AS date, upper(symbol_at_date) AS symbol, count(DISTINCT security_id) AS ids FROM e JOIN s ON s.n BETWEEN e.n - 60 AND e.n JOIN {panel} p ON p.date = s.date GROUP BY 1, 2 HAVING count(DISTINCT security_id) > 1""")
def h34_recent_id_changes(spark: SparkSession, d: str) -> DataFrame:
    return audit.recent_id_changes(table(spark, d, "panel"), table(spark, d, "calendar"))


_REASONS = "CASE WHEN history_sessions < 100 THEN 'FAILED_MIN_HISTORY;FAILED_MIN_PRICE' WHEN median_traded_value_60 < 200000 THEN 'FAILED_MEDIAN_TRADED_VALUE_60' WHEN history_sessions % 3 = 0 THEN 'FAILED_POSITIVE_VOLUME_DAYS_60' ELSE eligibility_reason_codes END"


@query(f"""WITH mm AS (SELECT * EXCLUDE (eligibility_reason_codes), {_REASONS} AS eligibility_reason_codes FROM {{monthly_in}} WHERE date BETWEEN date '1996-01-01' AND date '1999-12-31'), rw AS (SELECT * FROM {{panel}} WHERE series = 'EQ' AND instrument_type = 'ORDINARY_EQUITY' AND date BETWEEN date '1996-01-01' AND date '1999-12-31'),
ca AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM (SELECT DISTINCT date FROM {{calendar}})),
ba AS (SELECT date, count(*) FILTER (WHERE trading_status = 'ACTIVE_TRADING' AND instrument_type = 'ORDINARY_EQUITY') AS active_ordinary_security_ids, count(DISTINCT symbol_at_date) AS unique_symbols, count(DISTINCT isin) AS unique_isins, count(*) FILTER (WHERE liquid_v1_eligible) AS liquid_v1, count(*) FILTER (WHERE top25_liquidity) AS top,
  min(history_sessions) AS min_history_sessions, max(history_sessions) AS max_history_sessions, round(avg(history_sessions), 2) AS avg_history_sessions, count(*) FILTER (WHERE history_sessions <= 60) AS short_history,
  {', '.join(f"count(*) FILTER (WHERE NOT liquid_v1_eligible AND eligibility_reason_codes LIKE '%{code}%') AS {name}" for code, name in (("FAILED_MIN_HISTORY", "failed_min_history"), ("FAILED_MIN_PRICE", "failed_min_price"), ("FAILED_POSITIVE_VOLUME_DAYS_60", "failed_positive_volume_60"), ("FAILED_MEDIAN_TRADED_VALUE_60", "failed_median_traded_value_60")))},
  count(*) FILTER (WHERE NOT research_identity_ok) AS failed_identity_gate, count(*) FILTER (WHERE instrument_type <> 'ORDINARY_EQUITY') AS failed_instrument_gate, count(*) FILTER (WHERE trading_status <> 'ACTIVE_TRADING') AS failed_status_gate FROM mm GROUP BY 1),
du AS (SELECT date, count(*) AS a FROM (SELECT date, symbol_at_date FROM mm GROUP BY 1, 2 HAVING count(DISTINCT security_id) > 1) GROUP BY 1),
ch AS (SELECT date, count(*) AS b FROM (SELECT x.date, rw.symbol_at_date FROM (SELECT DISTINCT date FROM mm) x JOIN ca USING (date) JOIN ca cw ON cw.n BETWEEN ca.n - 60 AND ca.n JOIN rw ON rw.date = cw.date GROUP BY 1, 2 HAVING count(DISTINCT rw.security_id) > 1) GROUP BY 1)
SELECT ba.*, coalesce(a, 0) AS symbols_with_multiple_security_ids, coalesce(b, 0) AS symbols_changed_security_id FROM ba LEFT JOIN du USING (date) LEFT JOIN ch USING (date)""")
def h34_monthly_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "monthly_in").withColumn("eligibility_reason_codes", F.expr(_REASONS))
    return audit.monthly_diagnostics(m, table(spark, d, "panel"), table(spark, d, "calendar"), "top25_liquidity", "1996-01-01", "1999-12-31")


@query(f"""WITH ma AS (SELECT *, first_seen < date '1995-01-10' AS lc FROM {{master}} WHERE security_id IN (SELECT security_id FROM {{monthly_in}} WHERE date < date '1999-01-01' AND {_INSIDE})),
ss AS (SELECT symbol, count(DISTINCT security_id) AS a, count(DISTINCT isin) AS b FROM ma GROUP BY 1), si AS (SELECT isin, count(DISTINCT security_id) AS c, count(DISTINCT symbol) AS e FROM ma WHERE isin IS NOT NULL GROUP BY 1),
ca AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM (SELECT DISTINCT date FROM {{calendar}})),
ga AS (SELECT security_id, max(n - q - 1) AS g FROM (SELECT p.security_id, n, lag(n) OVER (PARTITION BY p.security_id ORDER BY n) AS q FROM {{panel}} p JOIN ca USING (date) WHERE date < date '1999-01-01') WHERE q IS NOT NULL GROUP BY 1)
SELECT ma.security_id, min(ma.symbol) AS representative_symbol, min(company_name) AS representative_company, min(first_seen) AS first_seen, max(last_seen) AS last_seen, count(DISTINCT listing_episode_id) AS episode_count, count(DISTINCT ma.symbol) AS symbol_count, count(DISTINCT ma.isin) AS isin_count, count(DISTINCT company_name) AS company_name_count,
  max(coalesce(a, 0)) AS max_symbol_security_count, max(coalesce(b, 0)) AS max_symbol_isin_count, max(coalesce(c, 0)) AS max_isin_security_count, max(coalesce(e, 0)) AS max_isin_symbol_count, coalesce(max(g), 0) AS max_absent_official_sessions, bool_or(lc) AS has_left_censored_episode
FROM ma LEFT JOIN ss ON ss.symbol = ma.symbol LEFT JOIN si ON si.isin = ma.isin LEFT JOIN ga ON ga.security_id = ma.security_id GROUP BY 1""")
def h42_episode_audit(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "master").withColumn("listing_history_left_censored", F.expr("first_seen < date '1995-01-10'"))
    return audit.episode_audit(m, table(spark, d, "monthly_in"), table(spark, d, "panel"), table(spark, d, "calendar"), "1999-01-01", "top25_liquidity")


@query("SELECT date, upper(symbol_at_date) AS symbol, count(DISTINCT security_id) AS ids FROM {monthly_in} GROUP BY 1, 2 HAVING count(DISTINCT security_id) > 1")
def h34_duplicate_symbols(spark: SparkSession, d: str) -> DataFrame:
    return audit.duplicate_symbols(table(spark, d, "monthly_in"))


@query(f"""WITH u AS (SELECT security_id, max(rank_126) AS max_liquidity_rank_126, count(DISTINCT date) FILTER (WHERE liquid_v1_eligible) AS liquid_dates, bool_and(research_identity_ok) AS research_identity_ok FROM {{monthly_in}} WHERE {_INSIDE} GROUP BY 1),
k AS (SELECT security_id, min(symbol) AS symbol, min(company_name) AS company_name, min(first_seen) AS first_seen, max(last_seen) AS last_seen, min(identity_quality) AS identity_quality, coalesce(string_agg(DISTINCT isin, ', ' ORDER BY isin), '') AS isin_evidence, count(DISTINCT company_name) AS company_name_count, count(DISTINCT symbol) AS symbol_count FROM {{master}} GROUP BY 1)
SELECT security_id, symbol, company_name, first_seen, last_seen, identity_quality, isin_evidence, company_name_count, symbol_count, max_liquidity_rank_126, liquid_dates, research_identity_ok FROM (SELECT DISTINCT security_id FROM {{required_in}}) JOIN k USING (security_id) LEFT JOIN u USING (security_id)""")
def h42_identity_priority(spark: SparkSession, d: str) -> DataFrame:
    return audit.identity_priority(table(spark, d, "required_in"), table(spark, d, "master"), table(spark, d, "monthly_in"), "top25_liquidity")


@query(f"""WITH e AS (SELECT security_id, count(DISTINCT listing_episode_id) AS episode_count FROM {{master}} GROUP BY 1), g AS (SELECT security_id, min(symbol_at_date) AS symbol, min(company_name) AS company_name, min(date) AS first_research_month, max(date) AS last_research_month, coalesce(string_agg(DISTINCT isin, ', ' ORDER BY isin), '') AS candidate_isin,
  min(research_identity_quality) AS research_identity_quality, min(rank_126) AS best_liquidity_rank_126, count(DISTINCT date) AS research_months, count(DISTINCT company_name) AS company_name_variants, bool_and(research_identity_ok) AS research_identity_ok FROM {{monthly_in}} WHERE {_INSIDE} GROUP BY 1) SELECT g.*, coalesce(episode_count, 0) AS episode_count FROM g LEFT JOIN e USING (security_id)""")
def h42_conflict_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.conflict_audit(table(spark, d, "monthly_in"), table(spark, d, "master"), "top25_liquidity")


@query(f"SELECT year(date) AS year, count(DISTINCT date) AS snapshots, count(*) AS rows, count(DISTINCT security_id) AS securities, count(DISTINCT security_id) FILTER (WHERE liquid_v1_eligible) AS liquid_securities, count(DISTINCT security_id) FILTER (WHERE top25_liquidity) AS top_securities, count(DISTINCT security_id) FILTER (WHERE {_INSIDE}) AS required_securities FROM {{monthly_in}} GROUP BY 1")
def h44_scope_summary(spark: SparkSession, d: str) -> DataFrame:
    return audit.scope_summary(table(spark, d, "monthly_in"), "top25_liquidity")


@query(f"WITH {_BOUNDARIES}, r AS (SELECT event_id, coalesce(o1, c1) / nullif(c0, 0) - 1 AS raw FROM bx) SELECT e.event_id, e.security_id, e.event_type, e.event_date, e.price_factor, coalesce(b.validation_status, 'NO_BOUNDARY_VALIDATION') AS validation_status, round(raw + 1e-9, 6) AS raw_return, round(residual_adjusted_return + 1e-9, 6) AS adjusted_return FROM {{events_in}} e LEFT JOIN bounds b USING (event_id) LEFT JOIN r USING (event_id) WHERE e.price_factor IS NOT NULL")
def h44_event_detail(spark: SparkSession, d: str) -> DataFrame:
    return audit.event_detail(table(spark, d, "events_in"), boundaries_of(spark, d)).select("event_id", "security_id", "event_type", "event_date", "price_factor", "validation_status", _R("raw_return"), _R("adjusted_return"))
