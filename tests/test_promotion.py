"""Candidate starts, the resolver's tiers, running factors and order statistics against plain Python."""

import time
from datetime import date, timedelta
from statistics import median

import numpy as np
from pyspark.sql import functions as F

from pitmill.operators import actions, features, identity, promotion
from pitmill.operators.rolling import rolling_medians

D = date.fromisoformat
MONTHS = [D(d) for d in ("2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30", "2020-05-31", "2020-06-28")]
DAYS = [D("2020-01-01") + timedelta(days=k) for k in range(180)]


def _audit(spark, status="PASS", events=True, adjusted_from="2020-01-01", window=promotion.SESSION_WINDOW, steps=False, **change):
    base = {"liquid_v1_eligible": True, "top750_liquidity": False, "research_identity_ok": True, "price_adjustment_ok": True, "instrument_type": "ORDINARY_EQUITY", "instrument_type_quality": "HIGH", "status_quality": "OBSERVED"}
    flags = {k: True for k in ("signal_history_ready_252", "signal_history_ready_273", "model_handoff_history_ready_300")}
    rows = [(d, s, *({**base, **flags} | (change if s == "A" and d < D("2020-03-01") else {})).values()) for d in MONTHS for s in ("A", "B")]
    kinds = ["boolean"] * 4 + ["string"] * 3 + ["boolean"] * 3
    schema = "date date, security_id string, " + ", ".join(f"{k} {t}" for k, t in zip([*base, *flags], kinds, strict=True))
    cal = spark.createDataFrame([(d,) for d in DAYS], "date date")
    ev = [("E", "A", D("2020-03-10"), "SPLIT", 0.5, 2.0), ("E", "A", D("2020-03-10"), "SPLIT", 0.5, 2.0)] if events else []
    ev = spark.createDataFrame(ev, "event_id string, security_id string, event_date date, event_type string, price_factor double, share_factor double")
    seen = spark.createDataFrame([("E", status)], "event_id string, validation_status string")
    adjusted = spark.createDataFrame([("A", d) for d in DAYS if d >= D(adjusted_from)], "security_id string, date date")
    windows = spark.createDataFrame([(s, d, window) for d in MONTHS for s in ("A", "B")], "security_id string, date date, liquidity_window_definition string")
    args = (spark.createDataFrame(rows, schema), cal, ev, seen, adjusted, windows)
    got = {str(r.candidate_start): r for r in promotion.candidate_audit(*args, ["2020-02-01", "2020-05-01"], "2020-07-01", max_window=20).collect()}
    return got, steps and {str(r.boundary_date): r for r in promotion.refined_boundaries(*args, "2020-07-01", max_window=20).collect()}


def test_a_contaminating_boundary_alone_fails_a_start(spark):
    clean, _ = _audit(spark)
    assert all(r.all_gates_pass and r.status == "PASS" for r in clean.values()) and clean["2020-02-01"].material_events == 1 and clean["2020-02-01"].required_rows == 10
    hard, steps = _audit(spark, "WARNING_LARGE_BOUNDARY_MOVE", steps=True)
    r = hard["2020-02-01"]
    assert r.pit_universe_gate_pass and r.price_action_gate_pass and r.feature_gate_pass and r.boundary_validation_review_required and not r.all_gates_pass
    assert r.contaminating_signal_window_non_pass_boundaries == 1 and str(r.refined_earliest_passing_snapshot) == "2020-03-31" and hard["2020-05-01"].all_gates_pass
    assert [steps[str(d)].passes for d in MONTHS] == [False, False, True, True, True, True]
    advisory, _ = _audit(spark, "ADVISORY_BOUNDARY_DRIFT")
    assert all(r.all_gates_pass for r in advisory.values())
    late, _ = _audit(spark, "WARNING_LARGE_BOUNDARY_MOVE", adjusted_from="2020-03-10")  # nothing before the event is adjusted
    r = late["2020-02-01"]
    assert (r.signal_window_non_pass_boundaries, r.left_censored_non_pass_no_crossing_boundaries, r.contaminating_signal_window_non_pass_boundaries) == (1, 1, 0) and r.all_gates_pass


def test_failures_end_with_their_last_row(spark):
    for name, change in {"identity_failures": {"research_identity_ok": None}, "instrument_failures": {"instrument_type_quality": "UNRESOLVED"}, "status_failures": {"status_quality": None}, "price_adjustment_failures": {"price_adjustment_ok": False}}.items():
        got, steps = _audit(spark, events=False, steps=True, **change)
        assert got["2020-02-01"][name] == 1 and not got["2020-02-01"].all_gates_pass and got["2020-05-01"].all_gates_pass
        assert [steps[str(d)][name] for d in MONTHS[:4]] == [1, 1, 0, 0]
    got, _ = _audit(spark, events=False, window=None)
    assert got["2020-05-01"].session_liquidity_window_failures == 4 and not got["2020-05-01"].pit_universe_gate_pass
    both = promotion.recommended_intervals(spark.createDataFrame([(D("2020-02-01"), False, None), (D("2020-05-01"), True, D("2020-04-28"))], "candidate_start date, all_gates_pass boolean, refined_earliest_passing_snapshot date"), "2020-06-30").collect()
    assert [(r.status, str(r.start)) for r in both] == [("CANDIDATE_RESEARCH_GATE_PASS_AVAILABLE", "2020-05-01"), ("CANDIDATE_REFINED_BOUNDARY_AVAILABLE", "2020-04-28")]


def test_tiers_of_the_resolver(spark):
    ids = spark.createDataFrame([("NSE", "A", "EQ", None, "S1", D("2020-01-01"), None), ("NSE", "A", "EQ", "IN1", "S2", D("2020-01-01"), None), ("NSE", "B", "EQ", "IN2", "S3", D("2020-01-01"), D("2020-01-31")), ("NSE", "B", "EQ", "IN3", "S4", D("2020-02-01"), None)], "exchange string, symbol string, series string, isin string, security_id string, effective_from date, effective_to date")
    over = spark.createDataFrame([("NSE", "B", "EQ", "S1", D("2020-03-01"), D("2020-03-20")), ("NSE", "B", "EQ", "S2", D("2020-03-10"), D("2020-03-31"))], "exchange string, symbol string, series string, security_id string, effective_from date, effective_to date")
    ask = [("A", None, "2020-01-05"), ("A", "IN1", "2020-01-05"), ("A", "IN9", "2020-01-05"), ("B", None, "2020-01-05"), ("B", None, "2020-02-05"), ("B", "IN3", "2020-01-05"), ("B", "IN3", "2020-03-05"), ("B", "IN3", "2020-03-15"), ("B", "IN3", "2020-03-25"), ("Z", None, "2020-01-05"), ("B", "IN3", "2020-03-05")]
    obs = spark.createDataFrame([("NSE", s, "BE" if k % 2 else "EQ", i, D(d), k) for k, (s, i, d) in enumerate(ask)], "exchange string, symbol string, series string, isin string, date date, k int")
    got = {r.k: (r.tier, r.security_id, r.candidate_ids) for r in identity.resolve_observations(obs, ids, over).collect()}
    assert [got[k][:2] for k in range(11)] == [("EXACT", "S1"), ("EXACT", "S2"), (None, None), ("SYMBOL", "S3"), ("SYMBOL", "S4"), ("EXACT", None), ("OVERRIDE", "S1"), ("OVERRIDE", None), ("OVERRIDE", "S2"), (None, None), ("OVERRIDE", "S1")]
    undated = {r.k: r.candidate_ids for r in identity.resolve_observations(obs, ids, dated=False).collect()}
    assert undated[3] == ["S3", "S4"] and undated[5] == ["S4"] and undated[2] == []


def test_an_entity_of_many_events(spark):
    n, m = 100_000, 10_000
    events = spark.range(n).select(F.concat(F.lit("E"), "id").alias("event_id"), F.lit("S").alias("security_id"), F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("event_date"), F.lit("SPLIT").alias("event_type"), F.when(F.col("id") % 2 == 0, 0.5).otherwise(2.0).alias("price_factor"), F.lit(None).cast("double").alias("cash_dividend_per_share"))
    prices = spark.range(m).select(F.lit("S").alias("security_id"), F.date_add(F.lit("1900-01-01").cast("date"), (F.col("id") * 10 - 1).cast("int")).alias("date"), F.lit(8.0).alias("raw_close"))
    began = time.perf_counter()
    got = {(r.date - D("1900-01-01")).days: r for r in actions.adjust_prices(prices, events, ids=False).collect()}
    assert len(got) == m and all(r.source_event_count == n - k - 1 and r.price_return_adjustment_factor == (1.0 if (n - k - 1) % 2 == 0 else 2.0) for k, r in got.items())
    assert time.perf_counter() - began < 60
    few = actions.adjust_prices(prices.orderBy(F.desc("date")).limit(3), events).collect()
    assert all(r.source_event_ids == [f"E{k}" for k in range((r.date - D("1900-01-01")).days + 1, n)] for r in few)


def test_raw_actions_to_boundaries(spark):
    raw = spark.createDataFrame([(1, "EQ", "A", "IN1", D("2020-01-03"), None, "10", "BONUS 1:1"), (2, "EQ", "A", "IN1", D("2020-01-05"), None, "10", "Bonus 1:1 and Rights 1:5 @ Premium Rs.20")], "ordinal long, series string, symbol string, isin string, ex_date date, record_date date, face_value string, subject string")
    master = spark.createDataFrame([("S", "IN1", "EQ")], "security_id string, isin string, series string")
    reviews = spark.createDataFrame([("CA_2", "BONUS_RIGHTS_COMPOSITE", 0.6, 2.0, "RESOLVED_COMPOSITE_ACTION", "FACTOR", "APPROVED", ["letter"], "read", 2.2, 4.0), ("CA_1", None, None, None, None, None, "PENDING", ["x"], "y", None, None), ("CA_9", None, None, None, None, None, "APPROVED", [], "y", None, None), (None, None, None, None, None, None, "APPROVED", ["x"], "y", None, None), ("CA_8", None, None, None, None, None, "APPROVED", ["x"], " ", None, None)],
        "event_id string, resolved_event_type string, resolved_price_factor double, resolved_share_factor double, review_classification string, resolution_type string, review_status string, evidence_references array<string>, rationale string, post_share_count_per_old_share double, cash_contribution_per_old_share double")
    bad = {r.event_id: r.reason for r in actions.invalid_resolutions(reviews).collect()}
    assert bad == {"CA_1": "NOT_APPROVED", "CA_9": "NO_EVIDENCE", None: "MISSING_EVENT_ID", "CA_8": "NO_RATIONALE"}
    events = actions.normalize_actions(raw, master, reviews.where("event_id = 'CA_2'"))
    prices = spark.createDataFrame([("S", D(f"2020-01-0{k}"), None, c) for k, c in ((1, 100.0), (2, 100.0), (3, 50.0), (4, 50.0), (5, 25.0), (6, 25.0))], "security_id string, date date, raw_open double, raw_close double")
    cal = prices.select("date")
    plain = actions.validate_boundaries(actions.normalize_actions(raw, master), prices, cal)  # without any review the columns are there too
    assert {r.event_id: r.validation_status for r in plain.collect()} == {"CA_1": "PASS"}
    got = {r.event_id: r for r in actions.validate_boundaries(events, prices, cal).collect()}
    assert got["CA_1"].validation_status == "PASS" and got["CA_2"].validation_status == "PASS" and abs(got["CA_2"].cash_aware_holder_value_ratio - 1.02) < 1e-9
    adjusted = {str(r.date): r for r in actions.adjust_prices(prices, events).collect()}
    assert adjusted["2020-01-01"].source_event_ids == ["CA_1", "CA_2"] and abs(adjusted["2020-01-01"].price_return_adjustment_factor - 0.3) < 1e-9 and adjusted["2020-01-05"].source_event_ids == []


def test_medians_of_sliding_windows(spark):
    rng = np.random.default_rng(2)
    rows = []
    for s in range(7):
        at = np.cumsum(rng.integers(1, 4, 400 if s == 3 else 40)).tolist()
        rows += [(f"S{s}", int(p), k + 1, None if rng.random() < 0.2 else float(rng.integers(0, 9)), bool(p % 5 == 0)) for k, p in enumerate(at)]
    df = spark.createDataFrame(rows, "security_id string, place int, number int, value double, wanted boolean").repartition("security_id")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 17)
    try:
        got = {(r.security_id, r.place): (r.short, r.long) for r in rolling_medians(df, "security_id", "place", "number", "value", {"short": 3, "long": 60}).collect()}
        some = {(r.security_id, r.place): (r.short, r.long) for r in rolling_medians(df, "security_id", "place", "number", "value", {"short": 3, "long": 60}, only="wanted").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    value = {(s, p): v for s, p, _, v, _ in rows}

    def want(s, p, n):
        held = [v for (t, q), v in value.items() if t == s and p - n < q <= p and v is not None]
        return median(held) if held else None

    due = {(s, p): (want(s, p, 3), want(s, p, 60)) for s, p in value}
    assert got == due and some == {k: v for k, v in due.items() if k[1] % 5 == 0} and features.WINDOWS == (20, 60, 126, 252)


def test_window_figures_are_kept_up_in_one_pass(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from pitmill.operators import features
    from pitmill.operators.rolling import rolling_windows

    rows = spark.range(600).selectExpr("concat('S', id % 3) as security_id", "id div 3 + id div 40 as place", "case when id % 7 = 0 then null else (id * 37 % 101) * 0.5D end as value", "id % 4 = 0 as up", "id % 5 = 0 as same")
    rows = rows.withColumn("number", F.row_number().over(Window.partitionBy("security_id").orderBy("place")))
    w = Window.partitionBy("security_id").orderBy("place").rangeBetween(-8, 0)
    want = rows.select("security_id", "place", F.count("value").over(w).alias("v"), F.avg("value").over(w).alias("a"), F.count_if("up").over(w).alias("p"), F.count(F.lit(1)).over(w).alias("r"), F.count_if("same").over(w.rangeBetween(-3, 0)).alias("s"))
    got = rolling_windows(rows, "security_id", "place", "number", "value", {9: {"valid": "v", "average": "a", "positive": "p", "rows": "r"}}, "up", {"s": ("same", 4)}).select(*want.columns)
    key = lambda r: (r.security_id, r.place)
    for a, b in zip(sorted(want.collect(), key=key), sorted(got.collect(), key=key), strict=True):
        assert (a.v, a.p, a.r, a.s) == (b.v, b.p, b.r, b.s) and (a.a is None) == (b.a is None) and abs((a.a or 0) - (b.a or 0)) < 1e-9
    prices = rows.selectExpr("security_id", "date_add(date '2020-01-01', cast(place as int)) as date", "value as raw_close", "cast(place as bigint) as volume", "value as traded_value")
    for made in (features.observation_liquidity(prices), features.liquidity_features(prices, prices.select("date").distinct())):
        assert "-251" not in made._jdf.queryExecution().toString()  # no frame of a window is read again for each row


def _priced(spark):
    prices = spark.createDataFrame([(s, D(f"2020-01-{k:02d}"), float(k)) for s in ("A", "B", "C") for k in range(1, 9)], "security_id string, date date, raw_close double")
    events = [("E1", "A", 3, "SPLIT", 0.5, None), ("E2", "A", 5, "BONUS", 0.8, None), ("E3", "A", 5, "DIVIDEND", None, 1.0), ("E4", "B", 6, "DIVIDEND", None, 2.0), ("E8", "B", 4, "SPLIT", 0.25, None), ("E5", None, 4, "SPLIT", 0.5, None)]
    schema = "event_id string, security_id string, event_date date, event_type string, price_factor double, cash_dividend_per_share double"
    return prices, spark.createDataFrame([(i, s, D(f"2020-01-{k:02d}"), *rest) for i, s, k, *rest in events], schema)


def test_ids_of_events_meet_the_rows_in_one_join(spark):
    prices, events = _priced(spark)
    made = actions.adjust_prices(prices, events)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1  # a join a list carried the first list's ids along
    got = {(r.security_id, r.date.day): (r.source_event_ids, r.total_return_event_ids) for r in made.collect()}
    assert got["A", 1] == (["E1", "E2"], ["E3"]) and got["A", 3] == (["E2"], ["E3"]) and got["A", 5] == ([], []) and got["B", 4] == ([], ["E4"]) and got["C", 1] == ([], [])


def test_ids_are_put_together_by_dates_and_taken_as_stretches(spark):
    """No task lists the single events of an entity; texts are the lists of ids, without nulls."""
    ids = ["E1", "Ü2", None, "E,4", "", "E6", "E7", "E8"]
    events = spark.createDataFrame([(x, s, D("2020-01-01") + timedelta(days=(5 * k) % 4), "DIVIDEND" if k % 3 == 0 else "SPLIT", None if k % 3 == 0 else 1 + k / 2, 1.0 if k % 3 == 0 else None) for s in "ABN" for k, x in enumerate(ids) if s != "N" or x is None], "event_id string, security_id string, event_date date, event_type string, price_factor double, cash_dividend_per_share double")
    prices = spark.createDataFrame([(s, D("2019-12-31") + timedelta(days=k), 10.0) for s in ("A", "B", "C", "N", None) for k in range(6)], "security_id string, date date, raw_close double")
    for separator in (",", " ü "):
        lists = {(r.security_id, r.date): r for r in actions.adjust_prices(prices, events).collect()}
        made = actions.adjust_prices(prices, events, separator=separator)
        texts = {(r.security_id, r.date): r for r in made.collect()}
        assert len(texts) == len(lists) == 30
        for k, r in texts.items():
            assert (r.source_event_ids, r.total_return_event_ids) == tuple(separator.join(x for x in lists[k][c] if x is not None) for c in ("source_event_ids", "total_return_event_ids"))
    assert lists["A", D("2019-12-31")].source_event_ids == ["", "Ü2", "E6", None, "E8"] and lists["A", D("2020-01-03")].total_return_event_ids == ["E,4"]
    for df in (actions.adjust_prices(prices, events), made):
        plan = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "collect_list(CASE" in x]
        assert plan and all("Aggregate [security_id" in x and "event_date" in x.split("]")[0] for x in plan)


def test_price_side_needs_no_other_rows(spark):
    prices, events = _priced(spark)
    columns = ("security_id", "date", "price_return_adjustment_factor", "price_return_adjusted_close", "adjustment_quality", "source_event_count")
    rows = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    whole = rows(actions.adjust_prices(prices, events, ids=False))
    assert rows(actions.price_adjustments(prices, events)) == whole
    assert rows(actions.price_adjustments(prices.where("day(date) = 2"), events)) == [r for r in whole if r[1].day == 2]


def test_both_releases_factors_in_one_pass(spark):
    from pitmill.operators import regression

    prices, events = _priced(spark)
    old = events.where("event_id not like '%8'")
    rows = lambda df: sorted(tuple(r) for r in df.select("security_id", "date", "r0", "f0", "r1", "f1").collect())
    got = rows(regression.paired_factors(prices, old, events))
    assert got == rows(regression.paired_prices(actions.price_adjustments(prices, old), actions.price_adjustments(prices, events)))
    assert [r[3] != r[5] for r in got if r[0] == "B"] == [True] * 3 + [False] * 5


def test_products_of_many_factors_are_rounded_once(spark):
    """Products that end in the denormal numbers, or pass the range of doubles on their way, are those of exact fractions."""
    from fractions import Fraction
    from math import prod

    factors = {"D": [0.8 if k % 3 else 0.5 for k in range(2200)], "U": [1e200, 1e200, 1e-300, 1e-290, 1e250] * 9, "Z": [0.5] * 3000, "O": [3.0] * 900, "B": [5e-324, 1e308, 1e308], "I": [0.5, float("inf"), 0.5], "N": [0.5, 0.0, 2.0]}
    day = D("2020-01-01")
    events = spark.createDataFrame([(k, day + timedelta(days=n), x) for k, xs in factors.items() for n, x in enumerate(xs)], "security_id string, event_date date, factor double")
    rows = spark.createDataFrame([(k, day + timedelta(days=n)) for k, xs in factors.items() for n in range(-1, len(xs), 61)], "security_id string, date date")
    got = {(r.security_id, (r.date - day).days): (r.x_factor, r.x_count) for r in actions.suffix_factors(rows, {"x": events}).collect()}
    assert len(got) == rows.count()
    for (k, n), (factor, count) in got.items():
        later = factors[k][n + 1 :]
        assert count == len(later)
        if k == "I":
            assert factor == prod(later)
            continue
        exact = prod(map(Fraction, later))
        if exact > Fraction(1.7e308):
            assert factor == float("inf")
            continue
        assert factor < float("inf") and abs(Fraction(factor) - exact) <= max(exact / 10**12, Fraction(5e-324) * Fraction(51, 100)), (k, n)
    assert any(0 < got["D", n][0] < 2e-308 for n in range(-1, 2200, 61))


def test_figures_of_wanted_rows_only(spark):
    """Figures of few rows are those that all rows get, whatever the batches, and a date's own need only the sessions before it."""
    from pitmill.operators import features
    from pitmill.operators.rolling import rolling_windows

    prices = spark.range(900).where("id % 11 <> 3").selectExpr("concat('S', id % 4) as security_id", "date_add(date '2020-01-01', cast(id div 4 as int)) as date", "(id * 37 % 101) * 0.5D as raw_close", "case when id % 5 = 0 then 0 else id end as volume", "case when id % 7 = 0 then null else (id * 53 % 211) * 0.5D end as traded_value")
    days = spark.sql("SELECT explode(sequence(date '2020-01-01', date '2020-08-20')) AS date").where("dayofmonth(date) % 6 <> 0")
    at = days.where("dayofmonth(date) = 17 or date = date '2020-01-01'")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 23)
    try:
        whole = features.liquidity_features(prices, days, (20, 60), 60)
        few = features.liquidity_features(prices, days, (20, 60), 60, at=at)
        want = sorted(map(str, whole.join(at, "date", "left_semi").select(sorted(whole.columns)).collect()))
        assert sorted(map(str, few.select(sorted(whole.columns)).collect())) == want and want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    day = spark.sql("SELECT date '2020-07-17' AS date")
    held = features.recent(prices, days, "2020-07-17", 60)
    assert 0 < held.count() < prices.count() // 3 and features.recent(prices, days, "2019-01-01", 60).count() == 0
    columns = ["security_id", "median_traded_value_60", "average_traded_value_60", "liquidity_rank_60"]
    got = [sorted(map(tuple, features.liquidity_features(x, days, (60,), 60, at=day).select(columns).collect())) for x in (prices, held)]
    assert got[0] == got[1] and len(got[0]) > 1
    assert rolling_windows(prices.limit(0).selectExpr("*", "1 as place", "1 as number", "true as w"), "security_id", "place", "number", "traded_value", {3: {"rows": "r"}}, only="w").count() == 0
