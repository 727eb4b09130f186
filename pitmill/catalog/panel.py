"""Calendar, features, fields, intervals and as-of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitmill.catalog.inputs import sql, table
from pitmill.functions import fields, text
from pitmill.operators import audit, calendar, features, intervals

QUERIES: dict = {}
ORACLE: dict = {}


def query(oracle: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = sql(oracle)
        return f

    return keep


# a nudge takes exact halves, which the engines' sums may miss by a hair, off the fence
_ROUND = lambda c, n=6: F.round(F.col(c) + 1e-7, n).alias(c)


def features_sql(windows=(20, 60, 126, 252), rank=126, stale=60) -> str:
    """Common tables that end in ``feats``."""
    per = ", ".join(
        f"count(traded_value) OVER w{n} AS valid_trade_days_{n}, count(*) FILTER (WHERE observed AND coalesce(volume, 0) > 0) OVER w{n} AS positive_volume_days_{n}, count(*) FILTER (WHERE observed AND coalesce(volume, 0) <= 0) OVER w{n} AS zero_volume_days_{n}, "
        f"count(*) FILTER (WHERE NOT observed) OVER w{n} AS absent_observation_days_{n}, quantile_cont(traded_value, 0.5) OVER w{n} AS median_traded_value_{n}, avg(traded_value) OVER w{n} AS average_traded_value_{n}" for n in windows)
    frames = ", ".join(f"w{n} AS (PARTITION BY security_id ORDER BY sno ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in windows)
    return f"""
ses AS (SELECT date, row_number() OVER (ORDER BY date) AS sno FROM (SELECT DISTINCT date FROM {{calendar}})),
pp AS (SELECT p.*, sno FROM {{panel}} p JOIN ses USING (date) WHERE series = 'EQ'),
bb AS (SELECT security_id, min(sno) AS lo, max(sno) AS hi FROM pp GROUP BY 1),
gg AS (SELECT b.security_id, s.date, s.sno, p.raw_close, p.volume, p.traded_value, p.security_id IS NOT NULL AS observed, lag(p.raw_close) OVER (PARTITION BY b.security_id ORDER BY s.sno) AS prev
  FROM bb b JOIN ses s ON s.sno BETWEEN b.lo AND b.hi LEFT JOIN pp p ON p.security_id = b.security_id AND p.sno = s.sno),
ff AS (SELECT gg.*, count(*) OVER h AS history_sessions, count(*) FILTER (WHERE observed) OVER h AS observed_history_sessions, {per},
    count(*) FILTER (WHERE observed AND raw_close = prev) OVER w{stale} AS stale_price_days_{stale} FROM gg
  WINDOW h AS (PARTITION BY security_id ORDER BY sno ROWS UNBOUNDED PRECEDING), {frames}),
rr AS (SELECT ff.*, cume_dist() OVER (PARTITION BY date ORDER BY median_traded_value_{rank} NULLS LAST) AS liquidity_percentile_{rank}, row_number() OVER (PARTITION BY date ORDER BY median_traded_value_{rank} DESC NULLS LAST, security_id) AS liquidity_rank_{rank} FROM ff WHERE observed),
feats AS (SELECT r.*, history_sessions AS listing_age_sessions, date_diff('day', min(r.date) OVER (PARTITION BY r.security_id), r.date) AS listing_age_calendar_days, r.raw_close AS price,
  CASE WHEN liquidity_percentile_{rank} > 0.8 THEN 'LIQUIDITY_Q1' WHEN liquidity_percentile_{rank} > 0.6 THEN 'LIQUIDITY_Q2' WHEN liquidity_percentile_{rank} > 0.4 THEN 'LIQUIDITY_Q3' WHEN liquidity_percentile_{rank} > 0.2 THEN 'LIQUIDITY_Q4' ELSE 'LIQUIDITY_Q5' END AS liquidity_bucket_{rank} FROM rr r)"""


_COUNTS = [f"{m}_{n}" for n in (20, 60, 126, 252) for m in ("valid_trade_days", "positive_volume_days", "zero_volume_days", "absent_observation_days")]
_VALUES = [f"{m}_{n}" for n in (20, 60, 126, 252) for m in ("median_traded_value", "average_traded_value")]


#: What windows need of the panel; other columns would be sorted and sent along for nothing.
PRICES = ("security_id", "date", "series", "instrument_type", "raw_close", "volume", "traded_value")


def features_of(spark: SparkSession, d: str, windows: tuple[int, ...] = features.WINDOWS, at: DataFrame | None = None, rank: int = 126) -> DataFrame:
    return features.liquidity_features(table(spark, d, "panel").select(*PRICES), table(spark, d, "calendar"), windows, rank, at=at)


@query(f"""WITH {features_sql()} SELECT security_id, date, history_sessions, observed_history_sessions, listing_age_calendar_days, {', '.join(_COUNTS)}, {', '.join(f'round({c} + 1e-7, 4) AS {c}' for c in _VALUES)},
  stale_price_days_60, round(liquidity_percentile_126 + 1e-7, 8) AS liquidity_percentile_126, liquidity_rank_126, liquidity_bucket_126 FROM feats""")
def h10_liquidity_features(spark: SparkSession, d: str) -> DataFrame:
    return features_of(spark, d).select("security_id", "date", "history_sessions", "observed_history_sessions", "listing_age_calendar_days", *_COUNTS, *[_ROUND(c, 4) for c in _VALUES], "stale_price_days_60", _ROUND("liquidity_percentile_126", 8), "liquidity_rank_126", "liquidity_bucket_126")


_OBSERVED = """
WITH w AS (SELECT p.*, row_number() OVER a AS history_sessions, date_diff('day', min(date) OVER (PARTITION BY security_id), date) AS listing_age_calendar_days, count(traded_value) OVER b AS valid_trade_days_60, count(*) FILTER (WHERE coalesce(volume, 0) <= 0) OVER b AS zero_volume_days_60,
    quantile_cont(traded_value, 0.5) OVER b AS med, avg(traded_value) OVER b AS av, lag(raw_close) OVER a AS prev FROM {panel} p
  WINDOW a AS (PARTITION BY security_id ORDER BY date), b AS (PARTITION BY security_id ORDER BY date ROWS 59 PRECEDING)),
x AS (SELECT *, count(*) FILTER (WHERE raw_close = prev) OVER (PARTITION BY security_id ORDER BY date ROWS 58 PRECEDING) AS stale_price_days_60,
    CASE WHEN med IS NOT NULL THEN row_number() OVER (PARTITION BY date, med IS NULL ORDER BY med, security_id) / count(*) OVER (PARTITION BY date, med IS NULL) END AS pct FROM w)
SELECT security_id, date, history_sessions, listing_age_calendar_days, valid_trade_days_60, zero_volume_days_60, round(med + 1e-7, 4) AS median_traded_value_60, round(av + 1e-7, 4) AS average_traded_value_60, stale_price_days_60, round(pct + 1e-7, 8) AS liquidity_percentile_60,
  CASE WHEN pct > 0.8 THEN 'LIQUIDITY_Q1' WHEN pct > 0.6 THEN 'LIQUIDITY_Q2' WHEN pct > 0.4 THEN 'LIQUIDITY_Q3' WHEN pct > 0.2 THEN 'LIQUIDITY_Q4' WHEN pct IS NOT NULL THEN 'LIQUIDITY_Q5' END AS liquidity_bucket_60 FROM x"""


@query(_OBSERVED)
def h11_observation_liquidity(spark: SparkSession, d: str) -> DataFrame:
    out = features.observation_liquidity(table(spark, d, "panel").select("security_id", "date", "raw_close", "volume", "traded_value"), (60,))
    return out.select("security_id", "date", "history_sessions", "listing_age_calendar_days", "valid_trade_days_60", "zero_volume_days_60", _ROUND("median_traded_value_60", 4), _ROUND("average_traded_value_60", 4), "stale_price_days_60", _ROUND("liquidity_percentile_60", 8), "liquidity_bucket_60")


@query(f"SELECT * FROM ({_OBSERVED.strip()}) AS o WHERE date = date '1999-06-30'")
def h11_liquidity_as_of(spark: SparkSession, d: str) -> DataFrame:
    """The rows of one date, made of rows up to it."""
    out = features.liquidity_as_of(table(spark, d, "panel"), "1999-06-30", 60)
    return out.select("security_id", "date", "history_sessions", "listing_age_calendar_days", "valid_trade_days_60", "zero_volume_days_60", _ROUND("median_traded_value_60", 4), _ROUND("average_traded_value_60", 4), "stale_price_days_60", _ROUND("liquidity_percentile_60", 8), "liquidity_bucket_60")


@query("""SELECT date, row_number() OVER (ORDER BY date) - 1 AS session_index, array_to_string(list_sort(list(DISTINCT source_file_id)), ',') AS source_file_ids, count(DISTINCT source_file_id) AS source_file_count, count(DISTINCT security_id) AS observed_security_count,
  count(*) FILTER (WHERE instrument_type = 'ORDINARY_EQUITY') AS ordinary_equity_observation_count, count(*) FILTER (WHERE instrument_type <> 'ORDINARY_EQUITY') AS non_ordinary_observation_count, count(*) AS observation_count FROM {panel} GROUP BY date""")
def d2_trading_calendar(spark: SparkSession, d: str) -> DataFrame:
    return calendar.trading_calendar(table(spark, d, "panel")).withColumn("source_file_ids", F.array_join("source_file_ids", ","))


@query("""WITH o AS (SELECT DISTINCT cast(o_orderdate AS date) AS date FROM {orders}), c AS (SELECT DISTINCT date FROM {calendar}), k AS (SELECT cast(o_orderdate AS date) AS date FROM {orders})
SELECT date, 'MISSING' AS finding FROM c WHERE date NOT IN (SELECT date FROM o) UNION ALL SELECT date, 'EXTRA' FROM o WHERE date NOT IN (SELECT date FROM c) UNION ALL SELECT date, 'DUPLICATE' FROM k GROUP BY date HAVING count(*) > 1""")
def a14_source_coverage(spark: SparkSession, d: str) -> DataFrame:
    return calendar.coverage(table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date")), table(spark, d, "calendar"))


@query("""WITH r AS (SELECT DISTINCT cast(o_orderdate AS date) AS date FROM {orders}), c AS (SELECT DISTINCT date FROM {calendar}), n AS (SELECT r.date, count(c.date) AS prior_sessions FROM r LEFT JOIN c ON c.date < r.date GROUP BY r.date)
SELECT *, prior_sessions >= 20 AS ready_20, prior_sessions >= 60 AS ready_60, prior_sessions >= 126 AS ready_126, prior_sessions >= 252 AS ready_252, prior_sessions >= 272 AS ready_272, prior_sessions >= 273 AS ready_273, prior_sessions >= 300 AS ready_300 FROM n""")
def h49_feature_readiness(spark: SparkSession, d: str) -> DataFrame:
    return calendar.feature_readiness(table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date")), table(spark, d, "calendar"))


@query("""WITH s AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS n FROM {calendar}), w AS (SELECT unnest([20, 60, 126, 252, 272, 273, 300]) AS win) SELECT CAST(win AS BIGINT) AS "window", date AS ready_date FROM w LEFT JOIN s ON n = win""")
def h49_warmup_coverage(spark: SparkSession, d: str) -> DataFrame:
    return calendar.warmup_coverage(table(spark, d, "calendar"))


# fields -----------------------------------------------------------------------------------------


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN ' - ' WHEN 2 THEN 'NA' WHEN 3 THEN '' WHEN 4 THEN concat(cast(l_orderkey AS varchar), ',', cast(l_partkey AS varchar), '.75') ELSE cast(l_extendedprice AS varchar) END AS raw FROM {lineitem}),
c AS (SELECT *, CASE WHEN trim(raw) IN ('', '-', 'NA', 'null') THEN NULL ELSE try_cast(replace(trim(raw), ',', '') AS double) END AS number FROM t)
SELECT l_orderkey, l_linenumber, number, CAST(trunc(number) AS BIGINT) AS whole FROM c""")
def b1_parse_number(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("raw", F.expr("CASE l_linenumber WHEN 1 THEN ' - ' WHEN 2 THEN 'NA' WHEN 3 THEN '' WHEN 4 THEN concat(cast(l_orderkey AS string), ',', cast(l_partkey AS string), '.75') ELSE cast(l_extendedprice AS string) END"))
    return rows.select("l_orderkey", "l_linenumber", fields.parse_number("raw").alias("number"), fields.parse_int("raw").alias("whole"))


_KIND = """CASE WHEN regexp_matches(concat_ws(' ', coalesce(upper(symbol), ''), coalesce(upper(company_name), '')), 'ETF|BEES|LIQUID|AMC\\s*[-–]') OR upper(symbol) IN ('AXISGOLD', 'GOLDSHARE', 'IDBIGOLD', 'IIFLNIFTY', 'KOTAKGOLD', 'MGOLD', 'QGOLDHALF', 'RELGOLD') THEN 'ETF'
  WHEN regexp_matches(upper(concat_ws(' ', symbol, company_name)), '\\bREIT\\b') THEN 'REIT' WHEN regexp_matches(upper(concat_ws(' ', symbol, company_name)), '\\bINVIT\\b') THEN 'INVIT' ELSE 'ORDINARY_EQUITY' END"""
_NAMED = "(SELECT p_partkey, CASE WHEN p_partkey % 50 = 7 THEN 'MGOLD' ELSE concat('P', cast(p_partkey AS varchar)) END AS symbol, concat(p_name, CASE p_partkey % 50 WHEN 1 THEN ' Etf' WHEN 2 THEN ' BEES' WHEN 3 THEN ' office REIT' WHEN 4 THEN ' INVIT trust' WHEN 5 THEN ' AMC - growth' WHEN 6 THEN ' reiterate' WHEN 8 THEN ' Nifty fund' ELSE '' END) AS company_name FROM {part})"


def _named(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_NAMED.replace("varchar", "string"), part=table(spark, d, "part"))


@query(f"""SELECT p_partkey, {_KIND} AS instrument_type, regexp_matches(upper(concat(coalesce(symbol, ''), ' ', coalesce(company_name, ''))), 'ETF|BEES|LIQUID|GILT|GOLD|SILVER|FUND|MUTUAL|NIFTY|SENSEX|BANKBEES|JUNIORBEES|PSUBNKBEES|SHARIAHBEES|PREF|PREFERENCE|WARRANT|RIGHTS|REIT|INVIT') AS product_marker,
  regexp_matches(upper(symbol), 'GOLD|NIFTY|ETF|BEES|HANGSENG|LIQUID|MOM|NV20|PSUBNK|BANKETF') AS has_marker FROM {_NAMED}""")
def b4_instrument_type(spark: SparkSession, d: str) -> DataFrame:
    s, n = F.col("symbol"), F.col("company_name")
    return _named(spark, d).select("p_partkey", fields.classify_instrument(s, n).alias("instrument_type"), fields.product_marker(s, n).alias("product_marker"), fields.has_marker(s).alias("has_marker"))


@query("""SELECT c_custkey, concat('SEC_', substr(sha256(concat_ws('|', upper(trim(c_mktsegment)), upper(trim(c_name)))), 1, 16)) AS id FROM {customer}""")
def b13_stable_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", fields.stable_id("SEC", F.col("c_mktsegment"), F.col("c_name")).alias("id"))


@query("""WITH q AS (SELECT *, row_number() OVER (PARTITION BY date, exchange, symbol, series ORDER BY source_row, source_line) AS nth FROM {observations}),
f AS (SELECT *, list_filter([CASE WHEN nth > 1 THEN 'DUPLICATE_OBSERVATION' END, CASE WHEN open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 THEN 'NON_POSITIVE_PRICE' END, CASE WHEN volume < 0 THEN 'NEGATIVE_VOLUME' END, CASE WHEN low > high THEN 'LOW_ABOVE_HIGH' END,
  CASE WHEN open > high THEN 'OPEN_ABOVE_HIGH' END, CASE WHEN open < low THEN 'OPEN_BELOW_LOW' END, CASE WHEN close > high THEN 'CLOSE_ABOVE_HIGH' END, CASE WHEN close < low THEN 'CLOSE_BELOW_LOW' END], lambda x: x IS NOT NULL) AS codes FROM q)
SELECT date, exchange, symbol, series, source_row, source_line, unnest(codes) AS "check" FROM f""")
def h32_quality_findings(spark: SparkSession, d: str) -> DataFrame:
    return fields.quality_findings(table(spark, d, "observations"))


# texts ------------------------------------------------------------------------------------------


_DATE_SQL = r"(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},\s+\d\d\d\d"
_FROM_SQL = r"(?i)(?:w\s*\.\s*e\s*\.\s*f\s*\.?|effective(?:ly)?\s+from|with\s+effect\s+from)\s+(?:the\s+)?"
_SIGNAL_SQL = r"(?i)suspension|suspended|revocation|recommencement|available\s+for\s+trading"
_NAME_SQL = r"\b[A-Z][A-Za-z0-9&.''’()/-]*(?:\s+[A-Z][A-Za-z0-9&.''’()/-]*){0,8}\s+(?:Limited|Ltd\.?)\b"


def date_sql(found: str) -> str:
    return rf"CAST(try_strptime(regexp_replace({found}, '\s+', ' ', 'g'), '%B %-d, %Y') AS date)"


@query(rf"""WITH t AS (SELECT doc_id, body, lower(body) AS low, lower(trim(regexp_replace(body, '\s+', ' ', 'g'))) AS flat, regexp_extract(body, '{_FROM_SQL}({_DATE_SQL})', 1) AS e, regexp_extract(body, '(?i)\b({_DATE_SQL})\b', 1) AS a,
  string_split_regex(body, '{_SIGNAL_SQL}') AS b, regexp_extract_all(body, '{_SIGNAL_SQL}', 0) AS m FROM {{notices}}),
p AS (SELECT *, list_transform(range(1, len(m) + 1), lambda i: CAST(list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT)) AS pl FROM t),
n AS (SELECT doc_id, flatten(list_transform(pl, lambda s: list_transform(regexp_extract_all(body[greatest(s - 120, 0) + 1:s + 1000], '{_NAME_SQL}', 0), lambda c: trim(regexp_replace(c, '\s+', ' ', 'g'), ' .,-')))) AS c FROM p),
u AS (SELECT doc_id, c[i] AS c, i FROM n, unnest(range(1, len(c) + 1)) AS g(i)),
f AS (SELECT doc_id, c, min(i) AS i FROM u WHERE length(c) BETWEEN 3 AND 140 AND NOT regexp_matches(upper(c), 'NATIONAL STOCK EXCHANGE|PRESS RELEASE|CAPITAL MARKET|LISTING AGREEMENT|TRADING IN|SECURITIES OF') GROUP BY 1, 2),
k AS (SELECT doc_id, string_agg(c, ';' ORDER BY i) AS names FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r FROM f) WHERE r <= 100 GROUP BY 1)
SELECT doc_id, {date_sql('e')} AS effective_date, {date_sql('a')} AS article_date, CASE WHEN regexp_matches(low, 'revocation|recommencement|available for trading') THEN 'SUSPENSION_REVOKED' ELSE 'SUSPENSION_START' END AS event_type,
  CASE WHEN flat = '' THEN 'SCANNED_DOCUMENT_REVIEW_REQUIRED' WHEN contains(flat, 'compulsory delist') AND contains(flat, 'national stock exchange') THEN 'RELEVANT_TEXT_EVIDENCE' WHEN contains(flat, 'delist') AND contains(flat, 'national stock exchange') THEN 'POSSIBLE_TEXT_EVIDENCE_REVIEW_REQUIRED' ELSE 'NOT_RELEVANT_TEXT' END AS relevance,
  array_to_string(list_filter([{', '.join(f"CASE WHEN contains(flat, '{t}') THEN '{t.upper()}' END" for t in text.NOTICE_TERMS)}], lambda x: x IS NOT NULL), ';') AS terms, coalesce(names, '') AS names FROM t LEFT JOIN k USING (doc_id)""")
def b16_notice_fields(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("body")
    return table(spark, d, "notices").select(
        "doc_id", text.effective_date(b).alias("effective_date"), text.article_date(b).alias("article_date"), text.suspension_type(b).alias("event_type"), text.notice_relevance(b).alias("relevance"),
        F.array_join(text.notice_terms(b), ";").alias("terms"), F.array_join(text.candidate_names(b), ";").alias("names"))


@query(r"""WITH a AS (SELECT p_partkey, concat(p_name, CASE p_partkey % 4 WHEN 0 THEN ' & Company Limited' WHEN 1 THEN ' Corporation Ltd.' WHEN 2 THEN ' Société Générale' ELSE ' Limited' END) AS name FROM {part})
SELECT p_partkey, regexp_replace(regexp_replace(trim(regexp_replace(upper(strip_accents(name)), '[^A-Z0-9]+', ' ', 'g')), '\bLIMITED\b', 'LTD', 'g'), '\bCOMPANY\b', 'CO', 'g') AS normal, replace(replace(regexp_replace(upper(name), '[^A-Z0-9]', '', 'g'), 'LIMITED', 'LTD'), 'CORPORATION', 'CORP') AS compact FROM a""")
def b14_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").withColumn("name", F.expr("concat(p_name, CASE p_partkey % 4 WHEN 0 THEN ' & Company Limited' WHEN 1 THEN ' Corporation Ltd.' WHEN 2 THEN ' Société Générale' ELSE ' Limited' END)"))
    return rows.select("p_partkey", text.normalize_name(F.col("name")).alias("normal"), text.compact_name(F.col("name")).alias("compact"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS body FROM {pages}""")
def b20_strip_html(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.strip_html(F.col("html")).alias("body"))


BLOCKS_SQL = r"""bl AS (SELECT doc_id, published_date, string_split_regex(body, '(?i)press\s+release\s+no\.\s*\d+') AS parts FROM {notices}), bu AS (SELECT doc_id, published_date, parts[i] AS block, i AS pos FROM bl, unnest(range(1, len(parts) + 1)) AS g(i)),
bk AS (SELECT doc_id, published_date, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS block_no, block FROM bu WHERE regexp_matches(lower(block), 'revocation\s+of\s+(?:the\s+)?suspension|recommencement\s+of\s+trading|(?:will|shall|would|are|be)\s+suspended\s+from\s+trading|proposed suspension'))"""


@query(f"WITH {BLOCKS_SQL} SELECT doc_id, block_no, block FROM bk")
def b22_notice_blocks(spark: SparkSession, d: str) -> DataFrame:
    return text.explode_blocks(table(spark, d, "notices"), "doc_id", "body")


# intervals and as-of ----------------------------------------------------------------------------


@query("""WITH r AS (SELECT DISTINCT security_id, date FROM {panel}), h AS (SELECT r.security_id, r.date, count(m.effective_from) AS n, min(m.symbol) AS s FROM r LEFT JOIN {master} m ON m.security_id = r.security_id AND r.date >= m.effective_from AND (m.effective_to IS NULL OR r.date <= m.effective_to) GROUP BY 1, 2)
SELECT security_id, date, CASE WHEN n = 1 THEN s END AS symbol, CASE n WHEN 1 THEN 'FOUND' WHEN 0 THEN 'MISSING' ELSE 'AMBIGUOUS' END AS lookup FROM h""")
def c6_point_in_time(spark: SparkSession, d: str) -> DataFrame:
    return intervals.point_in_time(table(spark, d, "panel").select("security_id", "date").distinct(), table(spark, d, "master"), "security_id", "symbol")


@query("SELECT security_id, symbol, effective_from, effective_to FROM {master} WHERE effective_from <= date '1999-06-30' AND coalesce(effective_to, date '9999-12-31') >= date '1998-06-30'")
def c7_history_between(spark: SparkSession, d: str) -> DataFrame:
    return intervals.history_between(table(spark, d, "master"), "1998-06-30", "1999-06-30").select("security_id", "symbol", "effective_from", "effective_to")


@query("""WITH s AS (SELECT security_id, evidence_id, effective_date AS status_start, effective_date + 200 AS status_end FROM {suspensions}), k AS (SELECT *, max(status_end) OVER (PARTITION BY security_id ORDER BY status_start, status_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held_until FROM s)
SELECT security_id, status_start, status_end, held_until FROM k WHERE status_start <= held_until""")
def e10_overlaps(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "suspensions").select("security_id", "evidence_id", F.col("effective_date").alias("status_start"), F.date_add("effective_date", 200).alias("status_end"))
    return intervals.overlaps(s).select("security_id", "status_start", "status_end", "held_until")


@query("""WITH p AS (SELECT security_id, date, raw_close FROM {panel}) SELECT h.security_id, max(date) AS last_date, round(max_by(raw_close, date), 6) AS last_price FROM {holdings} h LEFT JOIN p ON p.security_id = h.security_id GROUP BY 1""")
def c11_last_price(spark: SparkSession, d: str) -> DataFrame:
    return audit.last_prices(table(spark, d, "panel"), table(spark, d, "holdings")).withColumn("last_price", F.round("last_price", 6))


@query("""WITH s AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM {calendar}), o AS (SELECT security_id, n - lag(n) OVER (PARTITION BY security_id ORDER BY n) - 1 AS gap FROM {panel} JOIN s USING (date)) SELECT security_id, coalesce(max(gap), 0) AS max_gap, count(*) FILTER (WHERE gap > 20) AS long_gaps FROM o GROUP BY 1""")
def e13_session_gaps(spark: SparkSession, d: str) -> DataFrame:
    return audit.session_gaps(table(spark, d, "panel"), table(spark, d, "calendar"))


@query("""WITH ses AS (SELECT date, row_number() OVER (ORDER BY date) AS sno FROM (SELECT DISTINCT date FROM {calendar})), pp AS (SELECT p.*, sno FROM {panel} p JOIN ses USING (date)), bb AS (SELECT security_id, min(sno) AS lo, max(sno) AS hi FROM pp GROUP BY 1)
SELECT b.security_id, s.sno AS session_number, p.security_id IS NOT NULL AS observed, p.volume FROM bb b JOIN ses s ON s.sno BETWEEN b.lo AND b.hi LEFT JOIN pp p ON p.security_id = b.security_id AND p.sno = s.sno""")
def c4_session_grid(spark: SparkSession, d: str) -> DataFrame:
    return features.session_grid(table(spark, d, "panel"), calendar.number_sessions(table(spark, d, "calendar"))).select("security_id", "session_number", "observed", "volume")
