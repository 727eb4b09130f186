"""Invariants of a release: counters that share rows are counted together, and the snapshots are made once."""

from datetime import date

import pytest
from pyspark.sql import DataFrame

import __spark_entry__ as entry
from pitmill.operators import audit

D = date.fromisoformat
SF = "/root/testdata/sf0.001"


def _reads(df: DataFrame, column: str) -> int:
    """How many scans of files in the plan read ``column``."""
    return sum(column in line.split("ReadSchema:")[-1] for line in df._jdf.queryExecution().sparkPlan().toString().splitlines() if "FileScan" in line)


@pytest.fixture(scope="module")
def release(spark, tmp_path_factory):
    monthly = [
        ("2020-01-31", "A", True, 1), ("2020-02-28", "A", True, 2), ("2020-02-28", "A", False, 2), ("2020-03-31", "B", True, 3), ("2020-03-30", "C", False, 4), ("2021-01-31", None, True, 5), (None, "C", False, 6)]
    m = spark.createDataFrame([(d and D(d), s, ok, False, k, 400, 1.0, 60) for d, s, ok, k in monthly], "date date, security_id string, liquid_v1_eligible boolean, top25_liquidity boolean, rank_126 long, history_sessions long, median_traded_value_60 double, positive_volume_days_60 long")
    path = str(tmp_path_factory.mktemp("release") / "monthly")
    m.write.parquet(path)
    required = [("A", "2020-01-31", "2020-02-28", 2), ("A", "2020-01-31", "2020-03-31", 1), ("Z", "2020-01-31", "2020-01-31", 1), (None, None, None, 5)]
    r = spark.createDataFrame([(s, a and D(a), b and D(b), True, False, 1, n, 1.0, 60, "MULTI_SOURCE_VERIFIED" if s else None, "NO_ADJUSTMENT_REQUIRED", s != "Z", "OBSERVED", True, "ORDINARY_EQUITY", "HIGH") for s, a, b, n in required],
        "security_id string, first_research_date date, last_research_date date, enters_liquid_v1 boolean, enters_top750 boolean, best_rank_126 long, worst_rank_126 long, max_median_traded_value_60 double, max_positive_volume_days_60 long, research_identity_quality string, price_adjustment_quality string, price_adjustment_ok boolean, status_quality string, active_trading_ok boolean, instrument_type string, instrument_type_quality string")
    prices = spark.createDataFrame([("A", D("2020-02-01")), ("A", D("2020-02-28")), ("B", D("2020-01-01"))], "security_id string, date date")
    calendar = spark.createDataFrame([(D(d),) for d in ("2020-01-31", "2020-02-28", "2020-02-28", "2020-03-30", "2020-03-31", "2020-04-30")], "date date")
    return spark.read.parquet(path), r, prices, calendar


def test_counters_of_shared_rows(release):
    made = audit.table_invariants(*release, "top25_liquidity", "2020-01-01")
    got = {r.metric: r.value for r in made.collect()}
    none = {"required_artifact_instrument_classification_failures": 0, "required_artifact_flag_failures": 0, "required_artifact_liquidity_evidence_failures": 0, "required_artifact_status_failures": 0, "zero_liquid_collapse_months": 0, "population_history_reset_months": 0}
    assert got == none | {
        "monthly_snapshot_start_mismatch": 1, "duplicate_month_security_rows": 1, "non_month_final_session_dates": 1, "non_calendar_dates": 2, "required_scope_missing_from_required_artifact": 2, "required_artifact_security_without_monthly_scope": 2,
        "required_artifact_date_range_failures": 1, "required_artifact_rank_evidence_failures": 1, "required_artifact_identity_quality_failures": 1, "required_artifact_price_adjustment_failures": 1, "future_listing_rows": 1, "active_security_count_spike_reversal_failures": 1}
    assert _reads(made, "security_id") <= 3 and _reads(made, "date") <= 4  # a counter each read the snapshots


def test_release_snapshots_are_made_once(spark, monkeypatch):
    from pitmill.catalog import audits

    staged = []
    monkeypatch.setattr(audits, "stage", lambda df, label: staged.append(label) or df.localCheckpoint())
    monkeypatch.setattr(audit, "stage", lambda df, label: pytest.fail(f"{label} is written again"))
    made = entry.queries()["h31_release_invariants"](spark, SF)
    assert staged == ["monthly"] and _reads(made, "l_extendedprice") == 0 and made.count() == 30


def test_history_of_starts_is_made_once(spark, monkeypatch):
    from pitmill.catalog import audits

    staged = []
    monkeypatch.setattr(audits, "stage", lambda df, label: staged.append(label) or df.localCheckpoint())
    made = entry.queries()["h26_candidate_audit"](spark, SF)
    assert sorted(staged) == ["calendar", "monthly"]
    assert _reads(made, "l_extendedprice") == 1 and _reads(made, "l_shipdate") == 3  # boundaries; and window definitions and adjusted prices
    assert made.count() == 4


def test_rows_that_cannot_meet_are_left_out_before_they_are_made(spark):
    for name in ("h26_candidate_audit", "h15_boundary_validation"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        below = [any("LeftSemi" in x and "strategy=broadcast" in x for x in plan[k + 1 : k + 3]) for k, x in enumerate(plan) if "Aggregate [l_suppkey" in x]
        assert sum(below) == (2 if name[:3] == "h26" else 1), name
