"""Names in texts, leakage scenarios, session status of a stream and running event ids against plain Python."""

import tempfile
from datetime import date, datetime, timedelta

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitmill.operators import audit, leakage, matching, status
from pitmill.streaming import ingest

D = date.fromisoformat


def test_names_in_texts_by_both_ways(spark):
    rng = np.random.default_rng(3)
    pool = ["RED", "BOLT", "BLUE", "RING", "LTD", "CO", "OLD"]
    texts = [" ".join(rng.choice(pool, rng.integers(0, 40))) for _ in range(60)] + [None, "", "RED", "RED BOLT LTD " * 3000]
    names = list({" ".join(rng.choice(pool, rng.integers(1, 5))) for _ in range(40)}) + ["RED", None, "", "RED"]
    t = spark.createDataFrame(list(enumerate(texts)), "n long, t string")
    k = spark.createDataFrame([(x,) for x in names], "name string")
    whole = {(i, x) for i, s in enumerate(texts) for x in names if x and f" {x} " in f" {s or ''} "}
    packed = [None if s is None else s.replace(" ", "") for s in texts]
    p = spark.createDataFrame(list(enumerate(packed)), "n long, t string")
    short = {x.replace(" ", "") for x in names if x}
    inside = {(i, x) for i, s in enumerate(packed) for x in short if len(x) >= 6 and s and x in s}
    q = spark.createDataFrame([(x,) for x in short], "name string")
    for small in (1 << 20, 0):
        assert sorted(map(tuple, matching.names_within(t, "n", "t", k, small=small).collect())) == sorted(whole)
        assert sorted(map(tuple, matching.names_within(p, "n", "t", q, least=6, small=small).collect())) == sorted(inside)
    assert matching.names_within(t, "n", "t", k.limit(0)).count() == 0


def test_scenarios_find_what_leaks(spark):
    days = [D("2020-01-01") + timedelta(days=k) for k in range(6)]
    at = "2020-01-03"
    prices = spark.createDataFrame([(d, s, f"SY{s}", 10.0 + k) for k, d in enumerate(days) for s in "AB"], "date date, security_id string, symbol_at_date string, raw_close double")
    symbols = spark.createDataFrame([("SYA", "A", days[0], None), ("SYB", "B", days[0], days[-1])], "symbol string, security_id string, effective_from date, effective_to date")
    events = spark.createDataFrame([("E1", "A", days[1], 0.5), ("E2", "A", days[4], 0.5)], "event_id string, security_id string, event_date date, price_factor double")
    tables = {"prices": prices, "symbols": symbols, "events": events}
    by = Window.partitionBy("security_id")
    ops = {
        "age": lambda x: x["prices"].select("date", "security_id", F.row_number().over(by.orderBy("date")).alias("age")),
        "total": lambda x: x["prices"].select("date", "security_id", F.sum("raw_close").over(by).alias("total")),
        "latest symbol": lambda x: x["prices"].select("date", "security_id", F.max_by("symbol_at_date", "date").over(by).alias("s")),
        "holders": lambda x: x["prices"].join(x["symbols"].groupBy("symbol").agg(F.count("*").alias("n")), F.col("symbol") == F.col("symbol_at_date")).select("date", "security_id", "n"),
        "all events": lambda x: x["prices"].join(x["events"].groupBy("security_id").agg(F.count("*").alias("n")), "security_id", "left").select("date", "security_id", "n"),
    }
    got = {(r.operator, r.scenario): r.leaking_rows for r in leakage.leakage_report(ops, tables, at).collect()}
    found = {k for k, n in got.items() if n}
    assert len(got) == len(ops) * len(leakage.SCENARIOS)
    assert found == {("total", "changed_values"), ("total", "dead_entity"), ("latest symbol", "rename"), ("holders", "symbol_reuse"), ("all events", "future_action"), ("all events", "dead_entity")}
    assert got["total", "changed_values"] == 12 and got["all events", "future_action"] == 6


def test_session_status_once_across_restarts(spark):
    top = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    sessions = spark.createDataFrame([(D(f"2020-01-{k:02d}"),) for k in (1, 2, 3, 6, 7, 8, 9, 10)], "date date")
    sessions.write.parquet(f"{top}/sessions")
    rows = lambda *days: spark.createDataFrame([(datetime(2020, 1, d, 15), "x") for d in days], "ts timestamp, v string")

    def run():
        stream = ingest.stream_session_status(spark.readStream.schema("ts timestamp, v string").parquet(f"{top}/rows"), spark.readStream.schema("date date").parquet(f"{top}/sessions"))
        return sorted((str(r.date)[-2:], r.rows, r.status) for r in ingest.run_to_table(stream, f"{top}/out", f"{top}/checkpoint").collect())

    rows(1, 1, 3, 4, 5).write.mode("append").parquet(f"{top}/rows")
    first = [("01", 2, "PRESENT"), ("02", 0, "MISSING"), ("03", 1, "PRESENT")]
    assert run() == first
    assert run() == first  # nothing new, nothing twice
    rows(2, 7, 9).write.mode("append").parquet(f"{top}/rows")  # a row of a day that has been given out is late
    assert run() == [*first, ("04", 1, "EXTRA"), ("05", 1, "EXTRA"), ("06", 0, "MISSING"), ("07", 1, "PRESENT")]
    spark.createDataFrame([(D("2020-01-13"),)], "date date").write.mode("append").parquet(f"{top}/sessions")
    rows(15).write.mode("append").parquet(f"{top}/rows")
    assert run()[len(first) + 4 :] == [("08", 0, "MISSING"), ("09", 1, "PRESENT"), ("10", 0, "MISSING"), ("13", 0, "MISSING")]


def test_event_ids_run_on(spark):
    master = spark.createDataFrame([("A-1", "S1", D("2020-01-01"), D("2020-06-30")), ("A1", "S2", D("2020-07-01"), None), ("B", "S3", D("2020-01-01"), None)], "symbol string, security_id string, effective_from date, effective_to date")
    one = spark.createDataFrame([(3, "a1", "x", D("2020-08-01")), (1, "A 1", "y", D("2020-02-01")), (2, "A1", "z", D("2019-02-01")), (4, None, "n", None)], "n int, Symbol string, Company string, Day date").repartition(3)
    two = spark.createDataFrame([("k2", "B", "b"), ("k1", "a1", "c")], "key string, sym string, name string")
    src = [status.NoticeSource(one, "Symbol", "Company", "COMPULSORY", "ONE", ("n",), "Day"), status.NoticeSource(two, "sym", "name", "BOARD", "TWO", ("key",))]
    first = status.normalize_terminal_events(src[:1], master)
    rows = lambda df: sorted((r.event_id, r.security_id, r.company_name, r.identity_match_quality) for r in df.collect())
    want = [("NSE_TERM_000000", "S1", "y", "SYMBOL_DATE_MATCH"), ("NSE_TERM_000001", None, "z", "IDENTITY_REVIEW_REQUIRED"), ("NSE_TERM_000002", "S2", "x", "SYMBOL_DATE_MATCH"), ("NSE_TERM_000003", None, "n", "IDENTITY_REVIEW_REQUIRED")]
    more = [("NSE_TERM_000004", None, "c", "IDENTITY_REVIEW_REQUIRED"), ("NSE_TERM_000005", "S3", "b", "SYMBOL_DATE_MATCH")]
    assert rows(first) == want and rows(status.normalize_terminal_events(src[1:], master, first)) == want + more
    assert rows(status.normalize_terminal_events(src, master)) == want + more and rows(status.normalize_terminal_events(src[:1], master, first.limit(0))) == want


def test_gaps_are_counted_in_sessions_before_the_date(spark):
    cal = spark.createDataFrame([(D(f"2020-01-{k:02d}"),) for k in (1, 2, 3, 6, 7, 8, 20, 21, 22)], "date date")
    prices = spark.createDataFrame([(s, D(f"2020-01-{k:02d}")) for s, ks in (("A", (1, 2, 8)), ("B", (1, 22)), ("C", (3,))) for k in ks], "security_id string, date date")
    assert {r.security_id: (r.max_gap, r.long_gaps) for r in audit.session_gaps(prices, cal, 2).collect()} == {"A": (3, 1), "B": (7, 1), "C": (0, 0)}
    m = spark.createDataFrame([(D("2020-01-08"), s, True, False) for s in "AB"] + [(D("2020-01-22"), "C", True, False)], "date date, security_id string, liquid_v1_eligible boolean, top750_liquidity boolean")
    master = spark.createDataFrame([(s, sym, "I" if s != "C" else None, f"N{s}", f"E{s}", D("2020-01-01"), D("2020-02-01"), None) for s, sym in (("A", "X"), ("A", "Y"), ("B", "X"), ("C", "X"))], "security_id string, symbol string, isin string, company_name string, listing_episode_id string, first_seen date, last_seen date, listing_history_left_censored boolean")
    got = {r.security_id: (r.symbol_count, r.max_symbol_security_count, r.max_isin_security_count, r.max_isin_symbol_count, r.max_absent_official_sessions, r.has_left_censored_episode) for r in audit.episode_audit(master, m, prices, cal, "2020-01-20").collect()}
    assert got == {"A": (2, 2, 2, 2, 3, False), "B": (1, 2, 2, 2, 0, False)}


def test_scenarios_leave_no_tables_and_skip_what_is_not_read(spark):
    from pitmill.operators import leakage
    from pitmill.plans import staging

    one = lambda text: spark.sql(text)
    t = {"prices": one("select 'S' as security_id, date '2020-01-01' as date, 'A' as symbol_at_date, 1.0D as raw_close, 2L as volume, 3.0D as traded_value union all select 'S', date '2020-03-01', 'A', 1.0D, 2L, 3.0D"), "symbols": one("select 'A' as symbol, 'S' as security_id, date '2020-01-01' as effective_from, cast(null as date) as effective_to"), "events": one("select 'E' as event_id, 'S' as security_id, date '2020-02-15' as event_date, 0.5D as price_factor")}
    runs = []

    def prices(x):
        runs.append(1)
        return x["prices"].select("security_id", "date")

    def all_rows(x):
        return x["prices"].select("security_id", "date").crossJoin(x["prices"].agg({"raw_close": "sum"}))

    since = staging.mark()
    got = {(r.operator, r.scenario): r.leaking_rows for r in leakage.leakage_report({"prices": prices, "all": all_rows}, t, "2020-02-01").collect()}
    assert {k for k, n in got.items() if n} == {("all", s) for s in ("future_listing", "changed_values", "dead_entity")} and len(got) == 12
    assert len(runs) == 5 and staging.mark() == since  # once before, and for four scenarios that change prices


def test_texts_that_names_are_looked_up_in_are_made_once(spark):
    from pitmill.operators import matching

    t = spark.sql("SELECT * FROM VALUES (1, 'RED BOLT LTD'), (2, NULL) AS v(n, x)").selectExpr("n", "CASE WHEN x RLIKE 'B' THEN regexp_replace(x, 'O', 'O') ELSE upper(x) END AS t")
    found = matching.names_within(t, "n", "t", spark.sql("SELECT 'RED BOLT' AS name"))
    assert list(map(tuple, found.collect())) == [(1, "RED BOLT")]
    assert found._jdf.queryExecution().optimizedPlan().toString().lower().count("regexp_replace") <= 1


def test_operators_of_unchanged_columns_are_not_run_again(spark, monkeypatch, tmp_path):
    from pitmill.operators import intervals

    days = [D("2020-01-01") + timedelta(days=k) for k in range(6)]
    spark.createDataFrame([(d, s, f"SY{s}", 10.0 + k) for k, d in enumerate(days) for s in "AB"], "date date, security_id string, symbol_at_date string, raw_close double").write.parquet(f"{tmp_path}/prices")
    spark.createDataFrame([("SYA", "A", days[0], None)], "symbol string, security_id string, effective_from date, effective_to date").write.parquet(f"{tmp_path}/symbols")
    spark.createDataFrame([("E1", "A", days[1], 0.5)], "event_id string, security_id string, event_date date, price_factor double").write.parquet(f"{tmp_path}/events")
    tables = {k: spark.read.parquet(f"{tmp_path}/{k}") for k in ("prices", "symbols", "events")}
    by = Window.partitionBy("security_id").orderBy("date")
    ops = {
        "age": lambda x: x["prices"].select("date", "security_id", F.row_number().over(by).alias("age")),
        "up to the date": lambda x: x["prices"].where(F.col("date") <= F.lit("2020-01-03").cast("date")).select("date", "security_id"),
        "total": lambda x: x["prices"].select("date", "security_id", F.sum("raw_close").over(Window.partitionBy("security_id")).alias("total")),
    }
    staged, digests = [], []
    stage, digest = leakage.stage, leakage.digest
    monkeypatch.setattr(leakage, "stage", lambda df, label: staged.append(label) or stage(df, label))
    monkeypatch.setattr(leakage, "digest", lambda df: digests.append(df.columns[-1]) or digest(df))
    got = {(r.operator, r.scenario): r.leaking_rows for r in leakage.leakage_report(ops, tables, "2020-01-03").collect()}
    assert {k: n for k, n in got.items() if n} == {("total", "changed_values"): 12, ("total", "dead_entity"): 12} and len(got) == 18
    assert not [x for x in staged if not x.startswith("before-")]  # picking rows and columns of files needs no copy
    assert digests.count("age") == 2 and digests.count("security_id") == 0  # new and ended entities; nothing for what reads no later rows
    assert digests.count("total") == 2  # found once, then counted
    spans = spark.range(400).selectExpr("'S' AS symbol", "concat('E', id) AS security_id", "date '2020-01-01' AS effective_from", "CAST(NULL AS date) AS effective_to")
    asked = spark.range(50).selectExpr("'S' AS symbol", "date '2020-02-01' AS date")
    found = intervals.point_in_time(asked, spans, "symbol", "security_id")
    assert {r.lookup for r in found.collect()} == {"AMBIGUOUS"} and found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2  # spans of the same bounds meet as one


def test_wanted_columns_alone_are_made(spark):
    from pitmill.operators import features

    prices = spark.range(600).where("id % 11 <> 3").selectExpr("concat('S', id % 4) AS security_id", "date_add(date '2020-01-01', cast(id div 4 as int)) AS date", "(id * 37 % 101) * 0.5D AS raw_close", "id % 5 AS volume", "case when id % 7 > 0 then (id * 53 % 211) * 0.5D end AS traded_value")
    cal = spark.sql("SELECT explode(sequence(date '2020-01-01', date '2020-05-20')) AS date").where("dayofmonth(date) % 6 <> 0")
    rows = lambda df, columns: sorted(map(str, df.select(*columns).collect()))
    for at in (None, cal.where("dayofmonth(date) = 16")):
        whole = features.liquidity_features(prices, cal, (20, 40), 40, at=at).cache()
        for columns in (("security_id", "date", "history_sessions", "median_traded_value_40"), ("security_id", "date", "zero_volume_days_20", "absent_observation_days_40", "price"), ("security_id", "liquidity_rank_40", "stale_price_days_60", "volume"), ("date", "listing_age_calendar_days")):
            few = features.liquidity_features(prices, cal, (20, 40), 40, at=at, columns=columns)
            assert set(few.columns) == set(columns) and rows(few, columns) == rows(whole, columns)
            assert "average_traded_value" not in few._jdf.queryExecution().optimizedPlan().toString()
    old = features.observation_liquidity(prices.where("date <= '2020-04-20'")).where("date = '2020-04-20'")
    new = features.observation_liquidity(prices.where("date <= '2020-04-20'"), last=F.lit("2020-04-20").cast("date"))
    assert rows(new, sorted(old.columns)) == rows(old, sorted(old.columns)) and new.count() > 1
