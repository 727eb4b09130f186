from datetime import date

import pytest
from pyspark.sql import functions as F

from pitmill.functions import fields, text
from pitmill.operators import actions, calendar, features, graph, identity, intervals, status, universe
from pitmill.store import CoverageError, LookupFailed, PanelStore

D = date.fromisoformat


def test_session_windows_count_absent_sessions(spark):
    cal = spark.createDataFrame([(D(f"2020-01-0{k}"),) for k in (1, 2, 3, 6)], "date date")
    rows = [(D("2020-01-01"), "S", 10.0, 5, 100.0), (D("2020-01-03"), "S", 10.0, 0, 50.0), (D("2020-01-06"), "S", 11.0, 7, 80.0)]
    prices = spark.createDataFrame(rows, "date date, security_id string, raw_close double, volume long, traded_value double")
    last = features.liquidity_features(prices, cal).orderBy(F.desc("date")).first()
    assert (last.history_sessions, last.observed_history_sessions, last.positive_volume_days_20, last.absent_observation_days_20, last.zero_volume_days_20) == (4, 3, 2, 1, 1)
    assert last.median_traded_value_20 == 80.0


def test_classification_and_ratios(spark):
    rows = [("BONUS 1:1", "BONUS"), ("Bonus Debentures 1:1", "OTHER_OFFICIAL_ACTION"), ("BON 2:1", "BONUS"), ("FACE VALUE SPLIT FROM RS.10/- TO RS.2/-", "SPLIT"), ("Demerger", "DEMERGER"), ("INTERIM DIVIDEND RS 2", "DIVIDEND"), ("BONUS NCRPS 1:5", "BONUS_PREFERENCE_SECURITY")]
    df = spark.createDataFrame(rows, "subject string, want string").withColumn("got", actions.classify_event(F.col("subject")))
    assert df.where("got <> want").count() == 0
    face = df.where("want = 'SPLIT'").select(actions.face_value_transition(F.col("subject"), F.col("want")).alias("f")).first().f
    assert face == [10.0, 2.0]


@pytest.mark.parametrize(("pre", "post", "factor", "want"), [(100.0, 50.0, 2.0, "PASS"), (100.0, 60.0, 2.0, "ADVISORY_BOUNDARY_DRIFT"), (100.0, 90.0, 2.0, "WARNING_LARGE_BOUNDARY_MOVE"), (None, 50.0, 2.0, "NO_PRE_EVENT_OBSERVATION"), (100.0, None, 2.0, "NO_POST_EVENT_OBSERVATION")])
def test_boundary_status(spark, pre, post, factor, want):
    p = [(D("2020-01-01"), "S", None, pre)] if pre else []
    p += [(D("2020-01-03"), "S", None, post)] if post else []
    prices = spark.createDataFrame(p, "date date, security_id string, raw_open double, raw_close double")
    cal = spark.createDataFrame([(D(f"2020-01-0{k}"),) for k in (1, 2, 3)], "date date")
    ev = spark.createDataFrame([("E", "S", D("2020-01-02"), D("2020-01-02"), "SPLIT", 1 / factor, factor, None, None, None)], "event_id string, security_id string, event_date date, ex_date date, event_type string, price_factor double, share_factor double, review_classification string, post_share_count_per_old_share double, cash_contribution_per_old_share double")
    assert actions.validate_boundaries(ev, prices, cal).first().validation_status == want


def test_suffix_product_and_dividend(spark):
    prices = spark.createDataFrame([("S", D(f"2020-01-0{k}"), 100.0) for k in (1, 2, 3)], "security_id string, date date, raw_close double")
    ev = spark.createDataFrame([("A", "S", D("2020-01-02"), "SPLIT", 0.5, None), ("B", "S", D("2020-01-03"), "BONUS", 0.8, None), ("C", "S", D("2020-01-03"), "DIVIDEND", None, 10.0)], "event_id string, security_id string, event_date date, event_type string, price_factor double, cash_dividend_per_share double")
    got = {str(r.date): r for r in actions.adjust_prices(prices, ev).collect()}
    assert [round(got[f"2020-01-0{k}"].price_return_adjustment_factor, 6) for k in (1, 2, 3)] == [0.4, 0.8, 1.0]
    assert got["2020-01-01"].source_event_ids == ["A", "B"] and got["2020-01-02"].total_return_event_ids == ["C"]
    assert round(got["2020-01-01"].total_return_factor, 6) == 0.44


def test_overlay_cuts_at_all_bounds(spark):
    base = spark.createDataFrame([("S", D("2020-01-01"), None, "ACTIVE_TRADING", None), ("T", D("2020-01-01"), D("2020-01-31"), "ACTIVE_TRADING", None)], "security_id string, status_start date, status_end date, trading_status string, ref string")
    patch = spark.createDataFrame([("S", D("2020-01-05"), D("2020-01-10"), 1, "SUSPENDED", "a"), ("S", D("2020-01-08"), D("2020-01-20"), 2, "SUSPENDED", "b")], "security_id string, status_start date, status_end date, priority int, trading_status string, ref string")
    out = intervals.overlay_intervals(base, patch, ["trading_status", "ref"]).orderBy("security_id", "status_start").collect()
    assert [(str(r.status_start), str(r.status_end), r.ref) for r in out if r.security_id == "S"] == [("2020-01-01", "2020-01-04", None), ("2020-01-05", "2020-01-07", "a"), ("2020-01-08", "2020-01-10", "b"), ("2020-01-11", "2020-01-20", "b"), ("2020-01-21", "None", None)]
    assert [r for r in out if r.security_id == "T"][0].trading_status == "ACTIVE_TRADING"


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 140)) and len(got) == 81
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chains_join_adjacent_sessions_only(spark):
    rows = [("NSE", "A", "EQ", None, D("2020-01-01"), D("2020-01-02")), ("NSE", "A", "EQ", "I1", D("2020-01-03"), D("2020-01-06")), ("NSE", "B", "EQ", "I1", D("2020-01-07"), D("2020-01-08")), ("NSE", "A", "EQ", "I9", D("2020-02-03"), D("2020-02-04"))]
    disc = spark.createDataFrame([(*r, "ORDINARY_EQUITY", "x") for r in rows], "exchange string, symbol string, series string, candidate_isin string, first_seen date, last_seen date, instrument_type string, company_name string")
    cal = spark.createDataFrame([(D(f"2020-01-0{k}"),) for k in (1, 2, 3, 6, 7, 8)] + [(D("2020-02-03"),), (D("2020-02-04"),)], "date date")
    out = {(r.symbol, r.candidate_isin): r for r in identity.build_identity_rows(disc, "identity-v2", cal).collect()}
    assert out["A", None].security_id == out["A", "I1"].security_id == out["B", "I1"].security_id
    assert out["A", "I1"].identity_source == "RECONSTRUCTED_PRE_ISIN_CONTINUITY"
    assert out["A", None].listing_history_left_censored and not out["B", "I1"].listing_history_left_censored


def test_status_intervals_after_delisting(spark):
    m = spark.createDataFrame([("S", "EP", "A", "ISS", D("2020-01-01"), D("2020-02-01")), ("T", "EP2", "B", "ISS", D("2020-01-01"), D("2020-06-01"))], "security_id string, listing_episode_id string, symbol string, issuer_id string, first_seen date, last_seen date")
    t = spark.createDataFrame([("S", "E1", D("2020-01-15"), "COMPULSORY_DELISTING", "OFFICIAL_NSE_NOTICE")], "security_id string, event_id string, terminal_event_date date, terminal_event_type string, event_quality string")
    out = [(r.security_id, str(r.status_start), str(r.status_end), r.trading_status) for r in status.status_intervals(m, t).orderBy("security_id", "status_start").collect()]
    assert out == [("S", "2020-01-01", "2020-02-01", "ACTIVE_TRADING"), ("S", "2020-02-02", "None", "DELISTED"), ("T", "2020-01-01", "2020-06-01", "ACTIVE_TRADING")]


def test_names_and_dates(spark):
    df = spark.createDataFrame([("Société Générale & Company Limited", "Suspended w.e.f. March 5, 2001")], "n string, t string")
    r = df.select(text.normalize_name(F.col("n")).alias("n"), text.effective_date(F.col("t")).alias("d"), text.suspension_type(F.col("t")).alias("k"), fields.parse_number(F.lit("1,234.5")).alias("x"), fields.parse_int(F.lit("-")).alias("y")).first()
    assert (r.n, str(r.d), r.k, r.x, r.y) == ("SOCIETE GENERALE CO LTD", "2001-03-05", "SUSPENSION_START", 1234.5, None)


def test_readiness_counts_prior_sessions(spark):
    cal = spark.createDataFrame([(D(f"2020-01-{k:02d}"),) for k in range(1, 25)], "date date")
    req = spark.createDataFrame([(D("2020-01-21"),), (D("2020-01-20"),), (D("2019-01-01"),)], "date date")
    got = {str(r.date): (r.prior_sessions, r.ready_20) for r in calendar.feature_readiness(req, cal).collect()}
    assert got == {"2020-01-21": (20, True), "2020-01-20": (19, False), "2019-01-01": (0, False)}


def test_store_lookups_and_strict_dates(spark):
    m = spark.createDataFrame([("S", "A", "NSE", "EQ", D("2020-01-01"), None), ("T", "A", "NSE", "EQ", D("2020-03-01"), None)], "security_id string, symbol string, exchange string, series string, effective_from date, effective_to date")
    store = PanelStore(spark, tables={"security_master": m}, start="2020-01-01", end="2020-12-31")
    assert store.resolve_symbol("A", "2020-02-01") == "S"
    with pytest.raises(LookupFailed):
        store.resolve_symbol("A", "2020-04-01")
    with pytest.raises(CoverageError):
        store.active_on("2021-01-01")


def test_no_trade_is_active(spark):
    p = spark.createDataFrame([("S", D("2020-01-01"), "ORDINARY_EQUITY", "EQ", 5.0, 0), ("T", D("2020-01-01"), "ORDINARY_EQUITY", "BE", 5.0, 9)], "security_id string, date date, instrument_type string, series string, raw_close double, volume long")
    assert [(r.security_id, r.observation_status) for r in universe.active_on(p, "2020-01-01").collect()] == [("S", "NO_TRADE")]


def test_ordinals_of_unknown_terminal_events_need_no_single_task(spark):
    master = spark.createDataFrame([(f"S{k:03d}", D("2020-01-01") if k % 3 else D("2020-01-09"), "X", "I") for k in range(200)], "security_id string, last_seen date, symbol string, issuer_id string").repartition(4)
    out = status.unknown_terminal_events(master)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "row_number() windowspecdefinition(p_" in plan
    assert {(r.event_id, r.security_id) for r in out.collect()} == {(f"OBS_GAP_{k:06d}", f"S{k:03d}") for k in range(200) if k % 3}


def test_notice_rules(spark):
    rows = [
        ("The equity shares of Example Limited will be suspended from trading w.e.f August 17, 2007 until further notice.", "2007-08-17", "SUSPENSION_START", "SUSPENSION_START", True),
        ("Recommencement of trading in Manali Petrochemical Limited w.e.f. December 6, 2006.", "2006-12-06", "SUSPENSION_REVOKED", "TRADING_RECOMMENCEMENT", True),
        ("Revocation of the suspension effectively from  the May 2, 2001", "2001-05-02", "SUSPENSION_REVOKED", "SUSPENSION_REVOKED", True),
        ("Trading with effect from February 31, 2001", "None", "SUSPENSION_START", "SUSPENSION_START", False),
    ]
    t = F.col("t")
    got = spark.createDataFrame([(r[0],) for r in rows], "t string").select(text.effective_date(t).alias("d"), text.suspension_type(t).alias("a"), text.block_type(t).alias("b"), text.is_status_action(t).alias("c")).collect()
    assert [(str(r.d), r.a, r.b, r.c) for r in got] == [r[1:] for r in rows]
    assert spark.range(1).select(text.candidate_names(F.lit("Securities Of Nothing Limited; Good Cog Ltd. was suspended; Other-Name & Sons Limited")).alias("n")).first().n == ["Good Cog Ltd", "Sons Limited"]


def test_names_are_folded_like_a_decomposition(spark):
    import unicodedata

    texts = ["Société ½ ﬁne Ångström №5 ｆｕｌｌ", "plain", "日本 Ltd", "ŁódźŠ", None] + ["".join(chr(c) for c in range(a, a + 300)) for a in (0xA0, 0x200, 0x1E00, 0x2100, 0xFB00)]
    got = [r.f for r in spark.createDataFrame([(t,) for t in texts], "t string").select(text.fold_accents(F.col("t")).alias("f")).collect()]
    assert got == [None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]


def test_removals_and_second_order_entrants(spark):
    from pitmill.operators import regression

    def monthly(*rows):
        cols = "date date, security_id string, symbol_at_date string, isin string, instrument_type string, trading_status string, history_sessions long, listing_age_sessions long, positive_volume_days_60 long, median_traded_value_60 double, median_traded_value_126 double, rank_126 long, price_adjustment_ok boolean, liquid_v1_eligible boolean, top750_liquidity boolean"
        return spark.createDataFrame([(D("2013-01-31"), f"SEC_{s}", s, "I" + s, kind, "ACTIVE_TRADING", 300, 300, 60, 1e7, 1e7, rank, True, True, top) for s, kind, rank, top in rows], cols)

    flags = {"LIQUID_V1": ("liquid_v1_eligible", None), "TOP750": ("top750_liquidity", 750)}
    out = regression.attribute_membership(monthly(("KOTAKGOLD", "ETF", 750, True), ("ABC", "ORDINARY_EQUITY", 751, False)), monthly(("ABC", "ORDINARY_EQUITY", 750, True)), flags)
    assert {(r.symbol_at_date, r.universe_flag, r.primary_attribution) for r in out.collect()} == {
        ("KOTAKGOLD", "LIQUID_V1", "NON_ORDINARY_INSTRUMENT_REMOVAL"), ("KOTAKGOLD", "TOP750", "NON_ORDINARY_INSTRUMENT_REMOVAL"), ("ABC", "TOP750", "RANK_CUTOFF_SECOND_ORDER_EFFECT")}


def test_equal_observations_and_requests_stay_apart(spark):
    from pitmill.operators import intervals

    obs = spark.createDataFrame([("NSE", "A", "EQ", "I1", D("2020-02-01"))] * 2, "exchange string, symbol string, series string, isin string, date date")
    ids = spark.createDataFrame([("NSE", "A", "EQ", "I1", "S", D("2020-01-01"), None)], "exchange string, symbol string, series string, isin string, security_id string, effective_from date, effective_to date")
    assert [r.security_id for r in identity.resolve_observations(obs, ids).collect()] == ["S", "S"]
    req = spark.createDataFrame([("S", D("2020-02-01"))] * 3, "security_id string, date date")
    assert intervals.point_in_time(req, ids, "security_id", "symbol").count() == 3


def test_release_metadata_rules(spark):
    from pitmill.operators import audit
    from pitmill.spec import ProfileSpec

    row = ("S", D("2020-01-31"), True, "LIQUID_V1", "LIQUID_V1", D("2020-01-31"), "ELIGIBLE", "PASSED_LIQUID_V1")
    bad = [(*row[:2], True, "OTHER", *row[4:]), (*row[:6], "EXCLUDED", row[7]), (*row[:2], False, *row[3:6], "EXCLUDED", None), (*row[:2], False, *row[3:])]
    cols = "security_id string, date date, liquid_v1_eligible boolean, profile_id string, profile_version string, as_of_date date, eligibility_result string, eligibility_reason_codes string"
    m = spark.createDataFrame([row, *bad], cols).withColumns({c: F.lit(None).cast(t) for c, t in (("rank_126", "long"), ("trading_status", "string"), ("instrument_type", "string"), ("research_identity_ok", "boolean"), ("price_adjustment_quality", "string"), ("price_adjustment_ok", "boolean"), ("status_quality", "string"), ("median_traded_value_126", "double"), ("median_traded_value_60", "double"), ("price", "double"), ("listing_age_sessions", "long"), ("positive_volume_days_60", "long"))})
    m = m.withColumns({f"top{n}_liquidity": F.lit(False) for n in (500, 750, 1000)})
    got = {r.metric: r.value for r in audit.row_invariants(m, ProfileSpec()).collect()}
    assert (got["eligible_profile_metadata_failures"], got["excluded_profile_metadata_failures"]) == (2, 2)


def test_stability_counts_against_the_mean_size(spark):
    from pitmill.operators import audit

    rows = [(D(f"2020-0{m}-28"), s, True, True) for m, members in ((1, "AB"), (2, "AC"), (3, "AC")) for s in members]
    m = spark.createDataFrame(rows, "date date, security_id string, liquid boolean, top boolean")
    got = [(r.members, r.entries, r.exits, r.turnover, round(r.top_overlap, 4), r.flags) for r in audit.universe_stability(m, "liquid", "top").orderBy("date").collect()]
    assert got == [(2, 2, 0, 2.0, 0.0, "OK"), (2, 1, 1, 1.0, 0.3333, "LARGE_LIQUID_V1_TURNOVER,LOW_TOP750_OVERLAP"), (2, 0, 0, 0.0, 1.0, "OK")]


def test_words_of_notices_end_at_letters_that_are_not_ascii(spark):
    rows = spark.createDataFrame([("ÈELLE Red Bolt Limited was suspended éMarch 5, 2001é",)], "t string")
    got = rows.select(text.candidate_names(F.col("t")).alias("n"), text.article_date(F.col("t")).alias("d")).first()
    assert (got.n, str(got.d)) == (["ELLE Red Bolt Limited"], "2001-03-05")


def test_returns_from_a_close_of_zero_are_reviewed(spark):
    rows = [("S", D("2020-01-01"), 0.0), ("S", D("2020-01-02"), 0.0), ("S", D("2020-01-03"), 5.0), ("S", D("2020-01-04"), 5.1), ("S", D("2020-01-05"), None), ("S", D("2020-01-06"), 1.0)]
    adjusted = spark.createDataFrame(rows, "security_id string, date date, price_return_adjusted_close double")
    events = spark.createDataFrame([], "security_id string, event_type string, event_date date")
    got = {str(r.date): (str(r.adjusted_return), r.classification) for r in actions.return_outliers(adjusted, events).collect()}
    assert got == {"2020-01-02": ("nan", "EXTREME_RETURN_GT_60_PCT_REVIEW"), "2020-01-03": ("inf", "EXTREME_RETURN_GT_60_PCT_REVIEW")}


def _join_rows(df) -> int:
    """Rows that the joins of a finished plan gave, adaptive stages included."""
    def walk(p):
        name, kids = p.nodeName(), p.children()
        if name == "AdaptiveSparkPlan":
            return walk(p.executedPlan())
        if "QueryStage" in name:
            return walk(p.plan())
        own = p.metrics().apply("numOutputRows").value() if "Join" in name and p.metrics().contains("numOutputRows") else 0
        return own + sum(walk(kids.apply(k)) for k in range(kids.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_many_entities_of_one_symbol_or_name_do_not_meet_every_event(spark):
    n = 300
    day = "date_add(date '2020-01-01', cast(id % 3 as int))"
    master = spark.range(n).selectExpr("concat('S', id) as security_id", "'AB' as symbol", "'Great Big Cog Limited' as company_name", f"{day} as effective_from", "date '2020-01-02' as effective_to", f"{day} as first_seen", "date '2020-01-02' as last_seen")
    master = master.where("effective_from < date '2020-01-02' or security_id = 'S2'")
    more = spark.sql("select 'T' as security_id, 'CD' as symbol, 'Other Small Cog Limited' as company_name, date '2020-01-01' as effective_from, cast(null as date) as effective_to, date '2020-01-01' as first_seen, date '2021-01-01' as last_seen")
    master = master.unionByName(more)
    events = spark.range(n).selectExpr("concat('E', id) as event_id", "case when id % 100 = 7 then 'CD' else 'AB' end as historical_symbol", "date '2020-01-02' as terminal_event_date")
    found = status.resolve_by_symbol(events, master)
    rows = found.collect()
    assert sorted((r.event_id, r.resolved_id, r.identity_match) for r in rows if r.resolved_id) == [(f"E{k}", "T", "DATE_VALID_SYMBOL") for k in (107, 207, 7)] and len(rows) == n
    assert _join_rows(found) < 10 * n
    notices = events.selectExpr("event_id as doc_id", "concat('press release no. 1 recommencement of trading w.e.f. January 2, 2020 ', case when historical_symbol = 'CD' then 'Other Small Cog Limited' else 'Great Big Cog Limited' end) as body")
    found = status.suspension_event_blocks(notices, master)
    assert {r.security_id for r in found.collect()} == {None, "T"} and _join_rows(found) < 10 * n
    source = status.NoticeSource(events, "historical_symbol", "event_id", "X", "Y", ("event_id",), "terminal_event_date")
    found = status.normalize_terminal_events([source], master)
    assert sorted(r.security_id for r in found.collect() if r.security_id) == ["T"] * 3 and "collect_list" not in found._jdf.queryExecution().toString()
