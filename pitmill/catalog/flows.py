"""Source, sink and streaming queries: what a written table or a finished stream holds."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from pitmill.catalog.inputs import sql, table
from pitmill.plans.staging import staged_path
from pitmill.sources import files
from pitmill.store import PanelStore
from pitmill.streaming import ingest

QUERIES: dict = {}
ORACLE: dict = {}


def query(oracle: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = sql(oracle)
        return f

    return keep


_MARKET = "SELECT date, concat(symbol, ' ') AS SYMBOL, series AS SERIES, CASE WHEN source_row % 10 = 0 THEN '-' ELSE cast(close AS {s}) END AS CLOSE_PRICE, cast(volume AS {s}) AS TOTTRDQTY, coalesce(isin, '') AS ISIN FROM {{observations}}"


@query(f"WITH m AS ({_MARKET.format(s='varchar')}) SELECT date, trim(SYMBOL) AS symbol, SERIES AS series, round(CASE WHEN CLOSE_PRICE = '-' THEN NULL ELSE CAST(CLOSE_PRICE AS DOUBLE) END, 4) AS close, CAST(TOTTRDQTY AS BIGINT) AS volume, nullif(ISIN, '') AS isin FROM m")
def a1_daily_observations(spark: SparkSession, d: str) -> DataFrame:
    """Market files written by day, read back by header era and file name."""
    rows = spark.sql(_MARKET.format(s="string").replace("{{", "{").replace("}}", "}"), observations=table(spark, d, "observations"))
    path = staged_path(spark, "market")
    rows.withColumn("day", F.concat(F.lit("bhav-"), F.col("date").cast("string"))).drop("date").repartition("day").write.partitionBy("day").option("header", True).csv(path)
    # one folder a day: the date is read from the folder's name, as from a file's
    back = files.read_daily_observations(spark, [[f"{path}/day=*"]])
    day = F.to_date(F.regexp_extract("source_file", r"bhav-(\d\d\d\d-\d\d-\d\d)", 1))
    return back.select(day.alias("date"), "symbol", "series", F.round("close", 4).alias("close"), "volume", "isin")


@query("SELECT security_id, date, raw_close, volume FROM {panel} WHERE date BETWEEN date '1996-01-01' AND date '1996-06-30' AND security_id IN ('S1', 'S2')")
def a8_scan(spark: SparkSession, d: str) -> DataFrame:
    return files.scan(table(spark, d, "panel"), ["security_id", "date", "raw_close", "volume"], date=("1996-01-01", "1996-06-30"), security_id=["S1", "S2"])


@query("SELECT year(date) AS partition_year, count(*) AS expected, count(*) AS written, 'PASS' AS status FROM {panel} GROUP BY 1")
def a9_year_partitioned(spark: SparkSession, d: str) -> DataFrame:
    return files.write_year_partitioned(table(spark, d, "panel"), staged_path(spark, "years"))


@query("SELECT security_id, date, raw_close, volume, CAST(NULL AS VARCHAR) AS note FROM {panel}")
def a6_publish_json(spark: SparkSession, d: str) -> DataFrame:
    """Panel rows through JSON lines and a conforming Parquet publication."""
    schema = StructType([StructField("security_id", StringType()), StructField("date", DateType()), StructField("raw_close", DoubleType()), StructField("volume", LongType()), StructField("note", StringType())])
    lines, out = staged_path(spark, "lines"), staged_path(spark, "published")
    files.write_jsonl(table(spark, d, "panel").select("security_id", "date", "raw_close", "volume"), lines)
    files.publish(files.read_jsonl(spark, lines, "security_id string, date date, raw_close double, volume long"), schema, out)
    return spark.read.parquet(out)


@query("""SELECT coalesce(e.path, a.path) AS path, CASE WHEN a.path IS NULL THEN 'MISSING' WHEN e.path IS NULL THEN 'UNMANIFESTED' WHEN e.b <> a.b THEN 'SIZE_MISMATCH' WHEN e.h <> a.h THEN 'HASH_MISMATCH' ELSE 'OK' END AS status
FROM (SELECT CASE WHEN doc_id % 7 = 0 THEN -1 - doc_id ELSE doc_id END AS path, length(text) + CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END AS b, sha256(text || CASE WHEN doc_id % 13 = 0 THEN 'x' ELSE '' END) AS h FROM {documents}) e FULL JOIN (SELECT CASE WHEN doc_id % 5 = 0 THEN doc_id + 1000000000000 ELSE doc_id END AS path, length(text) AS b, sha256(text) AS h FROM {documents}) a ON a.path = e.path""")
def a11_verify_manifest(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    made = lambda path, b, h: docs.select(F.expr(path).alias("path"), b.alias("bytes"), F.sha2(h.cast("binary"), 256).alias("sha256"))
    e = made("CASE WHEN doc_id % 7 = 0 THEN -1 - doc_id ELSE doc_id END", F.length("text") + F.expr("CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END"), F.concat("text", F.expr("CASE WHEN doc_id % 13 = 0 THEN 'x' ELSE '' END")))
    return files.verify_manifest(e, made("CASE WHEN doc_id % 5 = 0 THEN doc_id + 1000000000000 ELSE doc_id END", F.length("text"), F.col("text")))


#: Archives of eleven years, one a document: what is there, what manifests list, and the manifests' totals.
_THERE = "SELECT CAST(2000 + doc_id % 11 AS int) AS year, concat(CAST(2000 + doc_id % 11 AS {s}), '-', CAST(doc_id AS {s}), '.zip') AS path, CAST(length(text) AS bigint) AS bytes, {sha} AS sha256, doc_id FROM {{documents}}"
_LISTED = """SELECT year, CASE WHEN doc_id % 53 = 0 THEN concat('2020-', CAST(doc_id AS {s}), '.zip') WHEN doc_id % 59 = 0 THEN concat('../', path) ELSE path END AS path, bytes + CASE WHEN doc_id % 61 = 0 THEN 1 ELSE 0 END AS bytes,
  CASE WHEN doc_id % 67 = 0 THEN 'other' ELSE sha256 END AS sha256 FROM {{there}} WHERE doc_id % 71 <> 0 UNION ALL SELECT year, path, bytes, sha256 FROM {{there}} WHERE doc_id % 73 = 0 UNION ALL SELECT year, concat(CAST(year AS {s}), '-gone', CAST(doc_id AS {s}), '.zip'), bytes, sha256 FROM {{there}} WHERE doc_id % 79 = 0"""
_TOTALS = "SELECT year, CAST(count(DISTINCT path) + CASE WHEN year = 2003 THEN 1 ELSE 0 END AS bigint) AS file_count, CAST(sum(bytes) AS bigint) AS total_bytes, split(concat(CAST(year AS {s}), '-01-02;', CASE WHEN year = 2005 THEN '1999' ELSE CAST(year AS {s}) END, '-05-01'), ';') AS known_missing_dates FROM {{listed}} WHERE year <> 2010 GROUP BY year"


@query(f"""WITH there AS ({_THERE.format(s='varchar', sha='sha256(text)')}), listed AS ({_LISTED.format(s='varchar').replace('{there}', 'there')}), mf AS ({_TOTALS.format(s='varchar').replace('{listed}', 'listed')}),
e AS (SELECT year, path, count(*) AS n, max(bytes) AS eb, max(sha256) AS eh FROM listed GROUP BY 1, 2), a AS (SELECT * FROM there WHERE year IN (SELECT year FROM mf)),
b AS (SELECT coalesce(e.year, a.year) AS year, coalesce(e.path, a.path) AS path, n, eb, eh, a.bytes AS ab, a.sha256 AS ah FROM e FULL JOIN a ON a.year = e.year AND a.path = e.path),
f AS (SELECT year, path, CASE WHEN n IS NULL THEN 'UNMANIFESTED' WHEN path LIKE '%/%' OR NOT starts_with(path, concat(year, '-')) THEN 'UNSAFE_OR_CROSS_YEAR' WHEN n > 1 THEN 'DUPLICATE' WHEN ab IS NULL THEN 'MISSING' WHEN ab <> eb THEN 'SIZE_MISMATCH' WHEN ah <> eh THEN 'HASH_MISMATCH' END AS failure FROM b),
t AS (SELECT year, count(*) AS names, coalesce(sum(ab), 0) AS total FROM b WHERE n IS NOT NULL GROUP BY 1)
SELECT * FROM f WHERE failure IS NOT NULL UNION ALL SELECT year, NULL, 'FILE_COUNT_MISMATCH' FROM mf JOIN t USING (year) WHERE file_count <> names UNION ALL SELECT year, NULL, 'TOTAL_BYTES_MISMATCH' FROM mf JOIN t USING (year) WHERE total_bytes <> total
UNION ALL SELECT year, NULL, 'CROSS_YEAR_MISSING_DATE' FROM mf WHERE year = 2005""")
def a11_year_manifests(spark: SparkSession, d: str) -> DataFrame:
    run = lambda text, **given: spark.sql(text.format(s="string", sha="sha2(cast(text as binary), 256)"), **given)
    there = run(_THERE, documents=table(spark, d, "documents"))
    listed = run(_LISTED, there=there)
    return files.verify_year_manifests(run(_TOTALS, listed=listed), listed, there)


@query("SELECT security_id, event_date, event_type, CASE WHEN event_type = 'DIVIDEND' THEN cash_dividend_per_share END AS amount FROM (SELECT DISTINCT security_id, event_date, event_type, cash_dividend_per_share FROM {events_in}) WHERE event_date IS NOT NULL")
def a15_merge_feeds(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events_in").select("security_id", "event_date", "event_type", F.expr("CASE WHEN event_type = 'DIVIDEND' THEN cash_dividend_per_share END").alias("amount"))
    return files.merge_event_feeds([e.where("event_type = 'BONUS'").drop("amount"), e, e.where("event_type = 'SPLIT'")], ["security_id", "event_date"])[0].distinct()


@query("WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM {orders} GROUP BY 1), e AS (SELECT c_custkey AS k, 1 AS n FROM {customer}) SELECT coalesce(a.k, e.k) AS k, coalesce(e.n, 0) AS expected, coalesce(a.n, 0) AS actual FROM e FULL JOIN a ON a.k = e.k WHERE coalesce(e.n, 0) <> 1 OR coalesce(a.n, 0) <> 1")
def a17_one_to_one(spark: SparkSession, d: str) -> DataFrame:
    return files.check_one_to_one(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k")), "k")


def _year_files(spark: SparkSession, d: str) -> str:
    """The panel as one folder of files a year, of two header eras; the later one names neither ISIN nor value. Rows are written where they are, so no task holds a year."""
    path, rows = staged_path(spark, "eras"), table(spark, d, "panel").withColumn("year", F.year("date"))
    old = rows.where("year < 1998").select("year", F.col("symbol_at_date").alias(" symbol"), F.col("series").alias("Series"), F.col("isin").alias("ISIN"), F.col("traded_value").alias("Total Traded Value"))
    new = rows.where("year >= 1998").select("year", F.col("symbol_at_date").alias("TckrSymb"), F.col("series").alias("SctySrs"), F.col("raw_close").alias("ClsPric"))
    old.write.partitionBy("year").option("header", True).csv(f"{path}/old")
    new.write.partitionBy("year").option("header", True).csv(f"{path}/new")
    return path


@query("SELECT year(date) AS year, CASE WHEN year(date) < 1998 THEN 'SYMBOL,SERIES,ISIN,TOTAL_TRADED_VALUE' ELSE 'TCKRSYMB,SCTYSRS,CLSPRIC' END AS columns, count(*) FILTER (WHERE series = 'EQ') > 0 AS has_eq_series, year(date) < 1998 AS has_isin, year(date) < 1998 AS has_traded_value, count(*) FILTER (WHERE series = 'EQ') AS eq_rows, count(*) AS total_rows FROM {panel} GROUP BY 1")
def a13_source_profile(spark: SparkSession, d: str) -> DataFrame:
    got = files.profile_source_schema(spark, f"{_year_files(spark, d)}/*/year=*")
    year = F.regexp_extract("source_file", r"year=(\d+)", 1).cast("int").alias("year")  # a year has several files
    any_ = [F.bool_or(c).alias(c) for c in ("has_eq_series", "has_isin", "has_traded_value")]
    return got.groupBy(year, F.array_join("columns", ",").alias("columns")).agg(*any_, F.sum("eq_rows").alias("eq_rows"), F.sum("total_rows").alias("total_rows"))


@query("SELECT year(date) AS year, CASE WHEN year(date) < 1998 THEN 'OK' ELSE 'MISSING_COLUMN' END AS reason FROM {panel} GROUP BY 1")
def a12_input_files(spark: SparkSession, d: str) -> DataFrame:
    got = files.audit_input_files(spark, f"{_year_files(spark, d)}/*/year=*", ["SYMBOL", "SERIES"])
    return got.select(F.regexp_extract("path", r"year=(\d+)", 1).cast("int").alias("year"), "reason").distinct()


@query("SELECT year(date) AS year, series, count(*) AS rows FROM {panel} GROUP BY 1, 2")
def a10_source_release(spark: SparkSession, d: str) -> DataFrame:
    """The panel published once and read back; a second publication to the same place is refused."""
    path = staged_path(spark, "release")
    files.write_table(table(spark, d, "panel"), path)
    try:
        files.write_table(table(spark, d, "panel").limit(1), path)
    except AnalysisException as e:
        if "PATH_ALREADY_EXISTS" not in str(e):
            raise
    return spark.read.parquet(path).groupBy(F.year("date").alias("year"), "series").agg(F.count("*").alias("rows"))


@query("SELECT date, security_id, listing_episode_id, symbol_at_date AS symbol, 'ACTIVE_TRADING' AS trading_status, 'OBSERVED_TRADING_RECORD' AS status_quality, source_file_id FROM {panel}")
def a7_trading_status_daily(spark: SparkSession, d: str) -> DataFrame:
    return files.trading_status_daily(table(spark, d, "panel"))


@query("SELECT date, security_id, listing_episode_id, symbol_at_date, raw_close, raw_close AS research_adjusted_close, 1.0 AS research_adjustment_factor, raw_close AS price_return_adjusted_close, 1.0 AS price_return_adjustment_factor, 'NO_ADJUSTMENT_REQUIRED' AS adjustment_quality, 0 AS n_events FROM {panel}")
def a7_unadjusted_baseline(spark: SparkSession, d: str) -> DataFrame:
    return files.unadjusted_baseline(table(spark, d, "panel")).withColumn("n_events", F.size("source_event_ids")).drop("source_event_ids")


# streams ----------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a file stream: written once to a staged folder, then read by arrival."""
    rows = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    path = staged_path(spark, "events")
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


@query("WITH w AS (SELECT max(ts) - INTERVAL 1 DAY AS m FROM {events}) SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS rows FROM {events}, w GROUP BY 1, 2, m HAVING CAST(ts AS DATE) + 1 <= m")
def i3_stream_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    """Days that the watermark has passed."""
    return ingest.run_to_table(ingest.stream_daily_counts(_event_stream(spark, d), "ts", "1 day", "event_type"), staged_path(spark, "counts"), staged_path(spark, "cp"))


#: Events of every seventh day come a day later; sessions are all days but each ninth, from ten days before the first event to twenty days after the last one.
_SESSION_ROWS = "SELECT CAST(CASE WHEN day(ts) % 7 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS {stamp}) AS ts FROM {{events}}"


@query(f"""WITH e AS ({_SESSION_ROWS.format(stamp='TIMESTAMP')}), w AS (SELECT max(ts) - INTERVAL 1 DAY AS m FROM e), b AS (SELECT min(CAST(ts AS DATE)) - 10 AS a, max(CAST(ts AS DATE)) + 20 AS z FROM {{events}}),
s AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS date FROM b), se AS (SELECT date FROM s WHERE day(date) % 9 <> 0), g AS (SELECT CAST(ts AS DATE) AS date, count(*) AS rows FROM e GROUP BY 1)
SELECT date, coalesce(rows, 0) AS rows, CASE WHEN se.date IS NULL THEN 'EXTRA' WHEN rows IS NULL THEN 'MISSING' ELSE 'PRESENT' END AS status FROM g FULL JOIN se USING (date), w WHERE date + 1 <= m""")
def i3_session_status(spark: SparkSession, d: str) -> DataFrame:
    """Days that the watermark has passed, against the sessions."""
    events = spark.sql(_SESSION_ROWS.format(stamp="TIMESTAMP").replace("{{", "{").replace("}}", "}"), events=table(spark, d, "events"))
    bounds = table(spark, d, "events").agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("z"))
    sessions = bounds.select(F.explode(F.sequence(F.date_sub("a", 10), F.date_add("z", 20))).alias("date")).where("day(date) % 9 <> 0")
    streams = []
    for rows, label in ((events, "rows"), (sessions, "sessions")):
        path = staged_path(spark, label)
        rows.write.parquet(path)
        streams.append(spark.readStream.schema(rows.schema).parquet(path))
    return ingest.run_to_table(ingest.stream_session_status(*streams), staged_path(spark, "status"), staged_path(spark, "cp"))


@query('SELECT event_id, \'NON_POSITIVE_PRICE\' AS "check" FROM {events} WHERE value - 3 <= 0 OR (user_id % 9 = 0 AND value - 3.5 <= 0) UNION ALL SELECT event_id, \'LOW_ABOVE_HIGH\' FROM {events} WHERE user_id % 9 = 0 UNION ALL SELECT event_id, \'OPEN_ABOVE_HIGH\' FROM {events} WHERE user_id % 9 = 0 UNION ALL SELECT event_id, \'CLOSE_ABOVE_HIGH\' FROM {events} WHERE user_id % 9 = 0')
def i2_stream_findings(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("value") - 3
    s = _event_stream(spark, d).withColumns({"open": x, "low": x, "close": x, "high": F.when(F.col("user_id") % 9 == 0, x - 0.5).otherwise(x), "volume": F.lit(1)})
    twice = s.unionByName(s)  # every key comes twice and counts once
    return ingest.run_to_table(ingest.stream_findings(twice, ["event_id"]).select("event_id", "check"), staged_path(spark, "findings"), staged_path(spark, "cp"))


# store ------------------------------------------------------------------------------------------


def _store(spark: SparkSession, d: str) -> PanelStore:
    return PanelStore(spark, tables={"daily_prices_raw": table(spark, d, "panel"), "trading_calendar": table(spark, d, "calendar"), "security_master": table(spark, d, "master")}, start="1995-01-01", end="2001-12-31")


@query("SELECT security_id, date, raw_close, volume FROM {panel} WHERE security_id = 'S7' AND date BETWEEN date '1996-01-01' AND date '1998-12-31'")
def h50_history(spark: SparkSession, d: str) -> DataFrame:
    return _store(spark, d).history("S7", "1996-01-01", "1998-12-31").select("security_id", "date", "raw_close", "volume")


@query("SELECT date FROM {calendar} WHERE date BETWEEN date '1996-01-01' AND date '1998-12-31'")
def h50_sessions_between(spark: SparkSession, d: str) -> DataFrame:
    return _store(spark, d).sessions_between("1996-01-01", "1998-12-31").select("date")
