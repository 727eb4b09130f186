"""Panel-shaped inputs made of the given tables.

Each is one SELECT in the dialect that Spark and DuckDB share; ``{name}`` stands for a table or
another input. They only rename and reshape rows: the operators are what the queries check.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SELECTS = {
    # daily panel: supplier by ship date
    "panel": """
SELECT concat('S', cast(l_suppkey AS string)) AS security_id, cast(l_shipdate AS date) AS date,
  concat('EP', cast(l_suppkey AS string)) AS listing_episode_id, concat('SYM', cast(l_suppkey % 40 AS string)) AS symbol_at_date,
  CASE WHEN l_suppkey % 11 = 0 THEN 'BE' ELSE 'EQ' END AS series,
  CASE WHEN l_suppkey % 13 = 0 THEN 'ETF' ELSE 'ORDINARY_EQUITY' END AS instrument_type,
  concat('CO ', cast(l_suppkey % 20 AS string)) AS company_name, concat('IN', cast(l_suppkey AS string)) AS isin,
  concat('F', cast(year(l_shipdate) AS string)) AS source_file_id,
  round(cast(min(l_extendedprice / l_quantity) AS double) + 2e-7, 4) AS raw_low, round(cast(max(l_extendedprice / l_quantity) AS double) + 2e-7, 4) AS raw_high,
  round(cast(min(l_extendedprice / l_quantity) AS double) + 2e-7, 4) AS raw_open,
  round(cast(sum(cast(l_extendedprice AS decimal(18, 2))) AS double) / cast(sum(cast(l_quantity AS decimal(18, 2))) AS double) + 2e-7, 6) AS raw_close,
  cast(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE cast(l_quantity AS decimal(18, 2)) END) AS bigint) AS volume,
  cast(sum(CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN NULL ELSE cast(l_extendedprice AS decimal(18, 2)) END) AS double) AS traded_value
FROM {lineitem} GROUP BY l_suppkey, cast(l_shipdate AS date), year(l_shipdate)""",
    # the panel with each entity's rows moved, so that most end before the others, some in an earlier year
    "ending": """
SELECT security_id, CASE WHEN security_id LIKE '%2' THEN date WHEN security_id LIKE '%7' THEN date - 400 ELSE date - 70 END AS date, symbol_at_date, raw_close, volume, traded_value FROM {panel}""",
    "calendar": "SELECT DISTINCT cast(l_shipdate AS date) AS date FROM {lineitem}",
    # one row a file observation: raw text fields as a daily market file has them
    "observations": """
SELECT cast(l_shipdate AS date) AS date, 'NSE' AS exchange, concat(CASE WHEN l_partkey % 97 = 0 THEN 'GOLDBEES' ELSE 'SYM' END, cast(l_partkey % 150 AS string)) AS symbol,
  CASE WHEN l_linenumber % 5 = 0 THEN 'BE' ELSE 'EQ' END AS series,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE concat('IN', cast(l_partkey % 150 AS string), 'X', cast(l_orderkey % 3 AS string)) END AS isin,
  concat(p_name, ' ', p_type) AS company_name, l_orderkey AS source_row, l_linenumber AS source_line,
  round(l_extendedprice / l_quantity + 2e-7, 4) AS open, round(l_extendedprice / l_quantity * (1 + l_tax) + 2e-7, 4) AS high,
  round(l_extendedprice / l_quantity * (1 - l_discount) + 2e-7, 4) AS low, round(l_extendedprice / l_quantity * (1 + l_tax - l_discount) + 2e-7, 4) AS close,
  cast(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS bigint) AS volume
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey""",
    # effective-dated identities of the panel's entities: two adjacent spells for a third of them
    "spans": "SELECT security_id, min(date) AS first_seen, max(date) AS last_seen, min(symbol_at_date) AS symbol, min(listing_episode_id) AS listing_episode_id, min(instrument_type) AS instrument_type, min(isin) AS isin, min(company_name) AS company_name FROM {panel} GROUP BY security_id",
    "master": """
SELECT security_id, listing_episode_id, symbol, isin, company_name, concat('ISS', company_name) AS issuer_id, instrument_type, 'NSE' AS exchange, 'EQ' AS series,
  first_seen, CASE WHEN length(security_id) = 3 THEN date '1998-12-31' ELSE last_seen END AS last_seen,
  first_seen AS effective_from, CASE WHEN length(security_id) = 3 THEN date '1998-12-31' WHEN length(security_id) = 2 THEN cast(NULL AS date) ELSE last_seen END AS effective_to,
  CASE WHEN instrument_type = 'ETF' THEN 'PARTIAL' WHEN length(security_id) = 2 THEN 'UNVERIFIED' ELSE 'SINGLE_OFFICIAL_SOURCE' END AS identity_quality
FROM {spans} WHERE first_seen <= date '1998-12-31'
UNION ALL
SELECT security_id, listing_episode_id, concat(symbol, 'N') AS symbol, isin, company_name, concat('ISS', company_name) AS issuer_id, instrument_type, 'NSE' AS exchange, 'EQ' AS series,
  date '1999-01-01' AS first_seen, last_seen, date '1999-01-01' AS effective_from, last_seen AS effective_to, 'RECONSTRUCTED_HIGH_CONFIDENCE' AS identity_quality
FROM {spans} WHERE length(security_id) = 3 AND last_seen >= date '1999-01-01'""",
    # symbols that pass from one entity to another at a year's turn
    "handover": """
SELECT symbol, security_id, effective_from, effective_to FROM {master} WHERE length(security_id) = 3 AND security_id <= 'S49' AND effective_from < date '1999-01-01'
UNION ALL SELECT replace(symbol, 'N', '') AS symbol, security_id, effective_from, effective_to FROM {master} WHERE length(security_id) = 3 AND security_id BETWEEN 'S50' AND 'S89' AND effective_from >= date '1999-01-01'""",
    # corporate actions
    "raw_actions": """
SELECT o_orderkey AS ordinal, CASE WHEN o_orderkey % 7 = 0 THEN 'BE' ELSE 'EQ' END AS series, concat('SYM', cast(o_custkey % 40 AS string)) AS symbol,
  CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE concat('IN', cast(o_custkey % 100 + 1 AS string)) END AS isin,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE cast(o_orderdate AS date) END AS ex_date, CASE WHEN o_orderkey % 35 = 0 THEN NULL ELSE cast(o_orderdate AS date) END AS record_date,
  CASE o_orderkey % 10 WHEN 0 THEN '-' ELSE '10' END AS face_value,
  CASE o_orderkey % 16 WHEN 0 THEN 'BONUS 1:1' WHEN 1 THEN 'Bonus 3:2 and Rights 1:5 @ Premium Rs.20' WHEN 2 THEN 'FACE VALUE SPLIT FROM RS.10/- TO RS.2/-'
    WHEN 3 THEN 'Interim Dividend - Rs 2.50 Per Share' WHEN 4 THEN 'DIVIDEND-35%' WHEN 5 THEN 'Consolidation of shares Rs 1 to Rs 10' WHEN 6 THEN 'RIGHTS 2:7 @ PREMIUM RS 10'
    WHEN 7 THEN 'Scheme of Arrangement / Demerger' WHEN 8 THEN 'AMALGAMATION' WHEN 9 THEN 'Buy Back' WHEN 10 THEN 'Annual General Meeting/Dividend Rs 1.5 + Special Dividend Rs.3'
    WHEN 11 THEN 'BONUS PREFERENCE SHARES 5:1 NCRPS' WHEN 12 THEN 'CHANGE OF NAME' WHEN 13 THEN 'FV SPL-10 TO 5 AND BON 1:2' WHEN 14 THEN 'Bonus Debentures 1:1' ELSE 'Annual General Meeting' END AS subject
FROM {orders}""",
    "resolutions": """
SELECT concat('CA_', cast(o_orderkey AS string)) AS event_id, CASE WHEN o_orderkey % 2 = 0 THEN 'BONUS_RIGHTS_COMPOSITE' ELSE cast(NULL AS string) END AS resolved_event_type,
  0.4 + cast(o_orderkey % 10 AS double) / 20 AS resolved_price_factor, 1 / (0.4 + cast(o_orderkey % 10 AS double) / 20) AS resolved_share_factor,
  CASE WHEN o_orderkey % 4 = 0 THEN 'RESOLVED_COMPOSITE_ACTION' ELSE 'VERIFIED_FACTOR_GENUINE_MARKET_MOVE' END AS review_classification, 'REVIEWED' AS resolution_type,
  CASE WHEN o_orderkey % 11 = 0 THEN 'PENDING' ELSE 'APPROVED' END AS review_status, CASE WHEN o_orderkey % 13 = 0 THEN ' ' ELSE concat('letter ', cast(o_orderkey AS string)) END AS rationale,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE split(concat('circular ', cast(o_orderkey AS string), ';letter'), ';') END AS evidence_references, CASE WHEN o_orderkey % 3 = 0 THEN 'HIGH' ELSE 'MEDIUM' END AS classification_confidence,
  'OFFICIAL_DOCUMENT' AS factor_quality, CASE WHEN o_orderkey % 6 = 0 THEN 2.0 ELSE cast(NULL AS double) END AS post_share_count_per_old_share, CASE WHEN o_orderkey % 6 = 0 THEN 5.0 ELSE cast(NULL AS double) END AS cash_contribution_per_old_share,
  cast(o_orderkey % 5 AS double) / 4 AS bonus_ratio, cast(o_orderkey % 3 AS double) / 2 AS rights_ratio
FROM {orders}""",
    # registered evidence, with gaps, and resolutions that refer to it
    "evidence_in": """
SELECT CASE WHEN c_custkey % 29 = 0 THEN ' ' WHEN c_custkey % 4 = 0 THEN concat('OLD', cast(c_custkey AS string)) ELSE concat('EV', cast(c_custkey - c_custkey % 2 AS string)) END AS evidence_id, CASE WHEN c_custkey % 2 = 0 THEN 'CA_1' ELSE cast(NULL AS string) END AS event_id,
  concat('SYM', cast(c_custkey % 40 AS string)) AS symbol, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN concat('http://x/', cast(c_custkey AS string)) ELSE concat('ftp://x/', cast(c_custkey AS string)) END AS source_url,
  CASE WHEN c_custkey % 7 = 0 THEN '  ' ELSE c_name END AS publisher, CASE WHEN c_custkey % 11 = 0 THEN cast(NULL AS string) ELSE '2020-01-01' END AS accessed_at, 'CIRCULAR' AS source_type,
  CASE WHEN c_custkey % 5 = 0 THEN cast(NULL AS string) WHEN c_custkey % 5 = 1 THEN 'SECONDARY' ELSE 'OFFICIAL' END AS evidence_quality, date '2001-01-01' AS event_date, c_custkey % 13 <> 0 AS has_facts FROM {customer}""",
    "reviewed_in": """
SELECT concat('CA_', cast(o_orderkey AS string)) AS event_id, concat('SYM', cast(o_custkey % 40 AS string)) AS symbol, CASE WHEN o_orderkey % 9 = 0 THEN 'PENDING' ELSE 'APPROVED' END AS review_status,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE split(concat('EV', cast(o_custkey AS string), CASE WHEN o_orderkey % 3 = 0 THEN concat(';OLD', cast(o_custkey AS string)) ELSE '' END), ';') END AS evidence_references FROM {orders}""",
    # simple priced events for adjustment and boundaries, on the panel's entities
    "events_in": """
SELECT concat('E', cast(o_orderkey AS string)) AS event_id, concat('S', cast(o_custkey % 100 + 1 AS string)) AS security_id, cast(o_orderdate AS date) AS event_date, cast(o_orderdate AS date) AS ex_date,
  CASE o_orderkey % 4 WHEN 0 THEN 'BONUS' WHEN 1 THEN 'SPLIT' ELSE 'DIVIDEND' END AS event_type,
  CASE o_orderkey % 4 WHEN 0 THEN 0.5 WHEN 1 THEN 0.8 ELSE cast(NULL AS double) END AS price_factor,
  CASE o_orderkey % 4 WHEN 0 THEN 2.0 WHEN 1 THEN 1.25 ELSE cast(NULL AS double) END AS share_factor,
  CASE WHEN o_orderkey % 4 > 1 THEN cast(o_orderkey % 9 AS double) ELSE cast(NULL AS double) END AS cash_dividend_per_share,
  CASE WHEN o_orderkey % 40 = 0 THEN 'VERIFIED_FACTOR_GENUINE_MARKET_MOVE' WHEN o_orderkey % 40 = 1 THEN 'RESOLVED_COMPOSITE_ACTION' ELSE cast(NULL AS string) END AS review_classification,
  CASE WHEN o_orderkey % 24 = 0 THEN 2.0 ELSE cast(NULL AS double) END AS post_share_count_per_old_share, CASE WHEN o_orderkey % 24 = 0 THEN 5.0 ELSE cast(NULL AS double) END AS cash_contribution_per_old_share
FROM {orders}""",
    # official terminal events and status patches
    "terminal_events": """
SELECT concat('T', cast(c_custkey AS string)) AS event_id, concat('S', cast(c_custkey % 100 + 1 AS string)) AS security_id, concat('SYM', cast(c_custkey % 40 AS string)) AS historical_symbol,
  date_add(date '2000-01-01', cast(c_custkey % 900 AS int)) AS terminal_event_date,
  CASE WHEN c_custkey % 3 = 0 THEN 'COMPULSORY_DELISTING' WHEN c_custkey % 3 = 1 THEN 'VOLUNTARY_DELISTING' ELSE 'UNKNOWN_TERMINAL_EVENT' END AS terminal_event_type,
  CASE WHEN c_custkey % 2 = 0 THEN 'OFFICIAL_NSE_NOTICE' ELSE 'UNRESOLVED' END AS event_quality, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal ELSE cast(NULL AS double) END AS terminal_value, CASE WHEN c_custkey % 4 = 0 THEN 'SCHEME_CASH' ELSE cast(NULL AS string) END AS terminal_value_basis,
  CASE WHEN c_custkey % 8 = 0 THEN 'DOCUMENTED' WHEN c_custkey % 4 = 0 THEN 'UNRESOLVED' ELSE 'UNKNOWN' END AS terminal_value_quality
FROM {customer} WHERE c_acctbal < 0""",
    "suspensions": """
SELECT concat('N', cast(o_orderkey AS string)) AS evidence_id, concat('S', cast(o_custkey % 100 + 1 AS string)) AS security_id, cast(o_orderdate AS date) AS effective_date,
  CASE WHEN o_orderkey % 2 = 0 THEN 'SUSPENSION_START' ELSE 'SUSPENSION_REVOKED' END AS event_type
FROM {orders}""",
    "notices": """
SELECT doc_id, cast(date_add(date '1999-01-01', cast(doc_id % 900 AS int)) AS date) AS published_date, concat(substr(text, 1, 200), CASE doc_id % 10
  WHEN 0 THEN concat(' Press Release No. 11 The shares of ', coalesce(p_name, 'Red Bolt'), ' Limited will be suspended from trading w.e.f. March 5, 2001. ')
  WHEN 1 THEN concat(' PRESS RELEASE NO.12 Revocation of suspension: ', coalesce(p_name, 'Blue Ring'), ' Ltd w . e . f . the January 15, 1999 Press release no. 13 nothing here ')
  WHEN 2 THEN ' Public notice for compulsory delisting by the National Stock Exchange of India, dated June 2, 2003 '
  WHEN 3 THEN concat(' press release no. 7 Recommencement of trading effectively from July 9, 2000 in ', coalesce(p_name, 'Small Widget'), ' Corporation Limited, Big-Cog Ltd. and Securities of Nothing Limited ')
  WHEN 4 THEN ' Annual report of April 31, 2001 ' WHEN 5 THEN ' Voluntary Delisting at the National Stock Exchange '
  WHEN 6 THEN concat(' Press Release No. 1 Proposed suspension of ', coalesce(p_name, 'Round Peg'), ' Limited Press Release No. 2 shares of Old Mill Ltd are available for trading, Recommencement of  trading with effect from the May 2, 2001 ')
  WHEN 7 THEN ' Red Bolt Limited, Green O''Cog Ltd and Co. Limited: suspended ' ELSE ' ' END, substr(text, 201)) AS body
FROM {documents} LEFT JOIN {part} ON p_partkey = doc_id + 1""",
    "holdings": "SELECT DISTINCT concat('S', cast(o_custkey % 100 + 1 AS string)) AS security_id FROM {orders} WHERE o_totalprice >= 300000",
    # month-end snapshots with ranks and flags, and a second release that differs from them
    "month_in": """
SELECT cast(date_trunc('month', date) AS date) AS month, security_id, min(symbol_at_date) AS symbol_at_date, min(isin) AS isin, min(listing_episode_id) AS listing_episode_id, min(instrument_type) AS instrument_type, min(company_name) AS company_name, max(date) AS last_trade, count(*) AS days,
  cast(sum(cast(coalesce(traded_value, 0) AS decimal(18, 2))) AS double) AS traded, max(raw_close) AS price FROM {panel} GROUP BY 1, 2""",
    "snapshots": """
SELECT max(last_trade) OVER (PARTITION BY month) AS date, month, security_id, symbol_at_date, isin, listing_episode_id, instrument_type, company_name, price, traded, days,
  cast(sum(days) OVER (PARTITION BY security_id ORDER BY month) AS bigint) AS history_sessions, cast(row_number() OVER (PARTITION BY month ORDER BY traded DESC, security_id) AS bigint) AS rank_126 FROM {month_in}""",
    "monthly_in": """
SELECT date, month, security_id, symbol_at_date, isin, listing_episode_id, instrument_type, company_name, price, history_sessions, history_sessions AS listing_age_sessions, days AS positive_volume_days_60, traded AS median_traded_value_60, traded AS median_traded_value_126, rank_126,
  CASE WHEN history_sessions % 37 = 0 THEN 'SUSPENDED' ELSE 'ACTIVE_TRADING' END AS trading_status, CASE WHEN history_sessions % 41 = 0 THEN 'UNRESOLVED' ELSE 'OBSERVED_TRADING_RECORD' END AS status_quality,
  CASE WHEN history_sessions % 13 = 0 THEN 'UNVERIFIED' ELSE 'MULTI_SOURCE_VERIFIED' END AS research_identity_quality, history_sessions % 13 <> 0 AS research_identity_ok,
  CASE WHEN history_sessions % 17 = 0 THEN 'RAW_ONLY_UNKNOWN' ELSE 'NO_ADJUSTMENT_REQUIRED' END AS price_adjustment_quality, history_sessions % 17 <> 0 AS price_adjustment_ok,
  history_sessions >= 100 AND traded >= 200000 AS liquid_v1_eligible, rank_126 <= 10 AS top10_liquidity, rank_126 <= 25 AS top25_liquidity, CASE WHEN history_sessions % 53 = 0 THEN true ELSE rank_126 <= 50 END AS top50_liquidity,
  CASE WHEN history_sessions % 59 = 0 THEN 'UNRESOLVED' ELSE 'HEURISTIC_HIGH_CONFIDENCE' END AS instrument_type_quality, history_sessions >= 100 AND traded >= 200000 AND history_sessions % 61 <> 0 AS liquid_v1_alias,
  cast(rank_126 AS double) / 100 AS liquidity_percentile, cast(rank_126 + CASE WHEN history_sessions % 67 = 0 THEN 1 ELSE 0 END AS double) / 100 AS liquidity_percentile_126,
  CASE WHEN history_sessions % 71 = 0 THEN 'OTHER' ELSE 'LIQUID_V1' END AS profile_id, 'LIQUID_V1' AS profile_version, CASE WHEN history_sessions % 73 = 0 THEN cast(NULL AS date) ELSE date END AS as_of_date,
  CASE WHEN history_sessions >= 100 AND traded >= 200000 THEN 'ELIGIBLE' ELSE 'EXCLUDED' END AS eligibility_result, CASE WHEN history_sessions % 79 = 0 THEN cast(NULL AS string) WHEN history_sessions >= 100 AND traded >= 200000 THEN 'PASSED_LIQUID_V1' ELSE 'BELOW' END AS eligibility_reason_codes
FROM {snapshots}""",
    # the snapshots with the readiness columns of a research universe, cleaner from year to year so that starts differ
    "promotion_in": """
SELECT date, security_id, liquid_v1_eligible, top25_liquidity, CASE WHEN date >= date '1997-03-01' AND NOT (date < date '1998-02-01' AND history_sessions % 143 = 0) THEN true ELSE research_identity_ok END AS research_identity_ok,
  CASE WHEN date >= date '1996-02-01' THEN true WHEN history_sessions % 101 = 0 THEN cast(NULL AS boolean) ELSE price_adjustment_ok END AS price_adjustment_ok, 'ORDINARY_EQUITY' AS instrument_type,
  CASE WHEN date >= date '1995-09-01' THEN 'HEURISTIC_HIGH_CONFIDENCE' ELSE instrument_type_quality END AS instrument_type_quality,
  CASE WHEN date >= date '1996-09-01' THEN 'OBSERVED_TRADING_RECORD' WHEN history_sessions % 43 = 0 THEN cast(NULL AS string) ELSE status_quality END AS status_quality,
  history_sessions >= 252 AS signal_history_ready_252, history_sessions >= 273 AS signal_history_ready_273, history_sessions >= 300 AS model_handoff_history_ready_300 FROM {monthly_in}""",
    # window definitions of the daily rows and of the snapshots; some are missing
    "windows_in": """
SELECT security_id, date, 'OFFICIAL_NSE_SESSION_WINDOW' AS liquidity_window_definition FROM {panel} WHERE date NOT IN (SELECT DISTINCT date FROM {monthly_in})
UNION ALL
SELECT security_id, date, CASE WHEN date < date '1996-06-15' AND history_sessions % 19 = 0 THEN 'OBSERVED_ROWS' WHEN date < date '1997-01-20' AND history_sessions % 31 = 0 THEN cast(NULL AS string) ELSE 'OFFICIAL_NSE_SESSION_WINDOW' END AS liquidity_window_definition
FROM {monthly_in} WHERE date >= date '1997-06-01' OR history_sessions % 37 <> 0""",
    # events of which some early ones lack factors, and none is material from the middle of 1997 on
    "promotion_events": """
SELECT event_id, security_id, event_date, CASE WHEN event_date >= date '1997-06-01' THEN 'DIVIDEND' ELSE event_type END AS event_type,
  CASE WHEN event_date < date '1996-06-01' AND event_id LIKE '%7' THEN cast(NULL AS double) ELSE price_factor END AS price_factor, share_factor FROM {events_in}""",
    # adjusted prices that begin late for some entities
    "adjusted_in": """
SELECT security_id, date FROM {panel} WHERE security_id NOT LIKE '%4' OR date >= date '1997-01-01'""",
    "candidate_in": """
SELECT date, month, CASE WHEN security_id LIKE '%5' THEN concat('N', security_id) ELSE security_id END AS security_id, symbol_at_date, isin, listing_episode_id, instrument_type, company_name, price,
  CASE WHEN security_id LIKE '%8' THEN history_sessions + 150 ELSE history_sessions END AS history_sessions, CASE WHEN security_id LIKE '%8' THEN listing_age_sessions + 150 ELSE listing_age_sessions END AS listing_age_sessions,
  positive_volume_days_60, median_traded_value_60, median_traded_value_126, rank_126 + 2 AS rank_126, trading_status, status_quality, research_identity_quality, research_identity_ok, price_adjustment_quality, price_adjustment_ok,
  history_sessions >= 110 AND median_traded_value_60 >= 190000 AS liquid_v1_eligible, rank_126 + 2 <= 10 AS top10_liquidity, rank_126 + 2 <= 25 AS top25_liquidity, rank_126 + 2 <= 50 AS top50_liquidity
FROM {monthly_in} WHERE security_id NOT LIKE '%7'""",
    "required_in": """
SELECT security_id, min(date) AS first_research_date, max(date) AS last_research_date, bool_or(liquid_v1_eligible) AS enters_liquid_v1, bool_or(top25_liquidity) AS enters_top750, min(rank_126) AS best_rank_126, max(rank_126) + CASE WHEN security_id LIKE '%3' THEN 1 ELSE 0 END AS worst_rank_126,
  max(median_traded_value_60) AS max_median_traded_value_60, max(positive_volume_days_60) AS max_positive_volume_days_60, min(research_identity_quality) AS research_identity_quality, min(price_adjustment_quality) AS price_adjustment_quality, bool_and(price_adjustment_ok) AS price_adjustment_ok,
  max(status_quality) AS status_quality, bool_and(trading_status = 'ACTIVE_TRADING') AS active_trading_ok, min(instrument_type) AS instrument_type, CASE WHEN security_id LIKE '%2' THEN cast(NULL AS string) ELSE max(instrument_type_quality) END AS instrument_type_quality
FROM {monthly_in} WHERE (liquid_v1_eligible OR top25_liquidity) AND security_id NOT LIKE '%9' GROUP BY security_id""",
    # discovered identity rows: spells of a symbol under an ISIN
    "discovered": """
SELECT 'NSE' AS exchange, symbol, 'EQ' AS series, candidate_isin, min(date) AS first_seen, max(date) AS last_seen, max(instrument_type) AS instrument_type, min(company_name) AS company_name
FROM (SELECT concat('P', cast(l_partkey % 60 AS string)) AS symbol, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE concat('IN', cast(l_partkey % 25 AS string)) END AS candidate_isin,
    cast(l_shipdate AS date) AS date, 'ORDINARY_EQUITY' AS instrument_type, concat('CO', cast(l_partkey % 30 AS string)) AS company_name, floor((year(l_shipdate) * 12 + month(l_shipdate)) / 7) AS era FROM {lineitem}) AS t
GROUP BY symbol, candidate_isin, era""",
}


def _needs(name: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", SELECTS[name])


def sql(text: str) -> str:
    """``text`` with its ``{input}`` names as DuckDB common tables."""
    made: dict[str, str] = {}

    def need(name: str) -> None:
        if name in SELECTS and name not in made:
            for x in _needs(name):
                need(x)
            made[name] = re.sub(r"\{(\w+)\}", r"\1", SELECTS[name]).replace("AS string)", "AS varchar)")
            made[name] = re.sub(r"date_add\((date '[\d-]+'), cast\((\w+) % 900 AS int\)\)", r"cast(\1 + cast(\2 % 900 AS int) AS date)", made[name])

    body = text.strip()
    for x in re.findall(r"\{(\w+)\}", body):
        need(x)
    body = re.sub(r"\{(\w+)\}", r"\1", body)
    with_ = ", ".join(f"{k} AS ({v})" for k, v in made.items())
    if not with_:
        return body
    start = "WITH RECURSIVE" if re.search(r"\brc\(", body) else "WITH"
    return f"{start} {with_}, {body[5:]}" if body[:5].upper() == "WITH " else f"{start} {with_} {body}"


def table(spark: SparkSession, sf_dir: str, name: str, held: dict[str, DataFrame] | None = None) -> DataFrame:
    """A given table or an input, as a DataFrame; those ``held`` are taken as they are, wherever they are needed."""
    if held and name in held:
        return held[name]
    if name in SELECTS:
        return spark.sql(SELECTS[name], **{x: table(spark, sf_dir, x, held) for x in _needs(name)})
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
