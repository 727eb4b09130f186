"""Scans and sinks: market files, JSON lines, immutable Parquet, manifests and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitmill.functions.fields import parse_int, parse_number

#: Header names of the two file eras, the first that a file has counts.
ALIASES = {
    "symbol": ["SYMBOL", "TCKRSYMB"], "series": ["SERIES", "SCTYSRS"], "open": ["OPEN", "OPEN_PRICE", "OPNPRIC"], "high": ["HIGH", "HIGH_PRICE", "HGHPRIC"],
    "low": ["LOW", "LOW_PRICE", "LWPRIC"], "close": ["CLOSE", "CLOSE_PRICE", "CLSPRIC"], "volume": ["VOLUME", "TOTTRDQTY", "TTLTRADGVOL"],
    "traded_value": ["NET_TURNOV", "TOTTRDVAL", "TTLTRFVAL"], "isin": ["ISIN"], "company_name": ["NAME", "FININSTRMNM"],
}
NUMBERS, COUNTS = ("open", "high", "low", "close", "traded_value"), ("volume",)


def file_date(path: Column) -> Column:
    """The ISO date in a file's name; null where it has none or no real one."""
    return F.try_to_timestamp(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"(\d\d\d\d-\d\d-\d\d)", 1), F.lit("yyyy-MM-dd")).cast("date")


def _era(spark: SparkSession, paths: list[str]) -> DataFrame:
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(paths)
    names = [c.strip().upper().replace(" ", "_") for c in raw.columns]
    raw = raw.select("*", F.col("_metadata.file_path").alias("source_file")).toDF(*names, "source_file")

    def col(field: str) -> Column:
        found = next((F.trim(F.col(a)) for a in ALIASES[field] if a in names), F.lit(None).cast("string"))
        return (parse_number(found) if field in NUMBERS else parse_int(found) if field in COUNTS else F.nullif(found, F.lit(""))).alias(field)

    return raw.select("source_file", file_date(F.col("source_file")).alias("date"), *[col(f) for f in ALIASES])


#: Names of the traded-value column in the header eras.
VALUE_COLUMNS = ("NET_TURNOV", "TOTTRDVAL", "TOTAL_TRADED_VALUE", "TTLTRFVAL")


def read_daily_observations(spark: SparkSession, eras: list[list[str]], series: tuple[str, ...] = ("EQ", "BE")) -> DataFrame:
    """Observations of daily market files; each list of paths is read as one header era.

    Rows of other series and rows without a symbol are dropped; the date is that of the file's name.
    """
    out = None
    for paths in eras:
        part = _era(spark, paths)
        out = part if out is None else out.unionByName(part)
    return out.where(F.col("series").isin(*series) & F.col("symbol").isNotNull()).withColumn("exchange", F.lit("NSE"))


def select_source_files(files: DataFrame, start=None, end=None, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """(files dated within [start, end], findings INVALID_SOURCE_DATE)."""
    dated = files.withColumn("source_date", file_date(F.col(path)))
    good = dated.where("source_date is not null")
    good = good if start is None else good.where(F.col("source_date") >= F.lit(start).cast("date"))
    good = good if end is None else good.where(F.col("source_date") <= F.lit(end).cast("date"))
    return good, dated.where("source_date is null").select(path, F.lit("INVALID_SOURCE_DATE").alias("finding"))


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines with a fixed schema; blank lines are skipped, a line that is no JSON object is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines; an existing target is an error."""
    df.write.mode("errorifexists").json(path)


def write_table(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Zstandard Parquet; an existing target is an error unless ``overwrite``."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd").parquet(path)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema``, in its order and types; missing ones as typed nulls."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def publish(df: DataFrame, schema: StructType, path: str) -> None:
    write_table(conform(df, schema), path)


def scan(df: DataFrame, columns: list[str] | None = None, **equals) -> DataFrame:
    """Rows with the given values; a pair is an inclusive range. Filters reach the Parquet reader."""
    for name, v in equals.items():
        df = df.where(F.col(name).between(*v) if isinstance(v, tuple) else F.col(name).isin(v) if isinstance(v, list) else F.col(name).eqNullSafe(F.lit(v)))
    return df.select(*columns) if columns else df


def write_year_partitioned(df: DataFrame, path: str, date_col: str = "date") -> DataFrame:
    """Write by year and compare: ``(partition_year, expected, written, status)``."""
    rows = df.withColumn("partition_year", F.year(date_col))
    rows.repartition("partition_year", F.pmod(F.xxhash64(*df.columns), F.lit(16))).write.mode("errorifexists").option("compression", "zstd").partitionBy("partition_year").parquet(path)
    back = df.sparkSession.read.parquet(path).groupBy("partition_year").agg(F.count("*").alias("written"))
    want = rows.groupBy("partition_year").agg(F.count("*").alias("expected"))
    return want.join(back, "partition_year", "full").na.fill(0, ["expected", "written"]).withColumn("status", F.when(F.col("expected") == F.col("written"), "PASS").otherwise("FAIL"))


def file_manifest(spark: SparkSession, glob: str) -> DataFrame:
    """``(path, bytes, sha256, source_date)`` of every file."""
    return spark.read.format("binaryFile").load(glob).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), file_date(F.col("path")).alias("source_date"))


def verify_manifest(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Every path of either side with its status: OK, MISSING, UNMANIFESTED, SIZE_MISMATCH, HASH_MISMATCH or DUPLICATE."""
    side = lambda df, s: df.groupBy("path").agg(F.count("*").alias(f"n_{s}"), F.max("bytes").alias(f"bytes_{s}"), F.max("sha256").alias(f"sha_{s}"))
    x = side(expected, "e").join(side(actual, "a"), "path", "full")
    status = (
        F.when(F.col("n_a").isNull(), "MISSING").when(F.col("n_e").isNull(), "UNMANIFESTED").when((F.col("n_e") > 1) | (F.col("n_a") > 1), "DUPLICATE")
        .when(F.col("bytes_e") != F.col("bytes_a"), "SIZE_MISMATCH").when(F.col("sha_e") != F.col("sha_a"), "HASH_MISMATCH").otherwise("OK")
    )
    return x.select("path", status.alias("status"))


def verify_year_manifests(manifests: DataFrame, listed: DataFrame, actual: DataFrame, suffix: str = ".zip") -> DataFrame:
    """``(year, path, failure)`` of archives kept by year; none, if all is as the manifests say. Failures of a year as a whole have no path.

    ``manifests``: year, file_count, total_bytes, known_missing_dates (array of ISO dates). ``listed``: year, path, bytes, sha256 as the manifests list them.
    ``actual``: path, bytes, sha256 of what is there. A listed name must be a plain one of its own year (UNSAFE_OR_CROSS_YEAR), be listed once (DUPLICATE), be there
    (MISSING) and have its size and hash; what is there for a year with a manifest must be listed (UNMANIFESTED); the year's counts and bytes must add up, and
    its known missing dates lie in it.
    """
    name = lambda year: F.concat(F.lpad(F.col(year).cast("string"), 4, "0"), F.lit("-"))
    e = listed.groupBy("year", "path").agg(F.count("*").alias("n_"), F.max("bytes").alias("eb_"), F.max("sha256").alias("eh_"))
    there = actual.where(F.col("path").endswith(suffix) & F.col("path").rlike("^[0-9]{4}-")).select(F.substring("path", 1, 4).cast("int").alias("year"), "path", F.col("bytes").alias("ab_"), F.col("sha256").alias("ah_")).join(manifests.select("year").distinct(), "year", "left_semi")
    both = e.join(there, ["year", "path"], "full")
    unsafe = F.contains("path", F.lit("/")) | ~F.startswith("path", name("year")) | ~F.endswith("path", F.lit(suffix))
    have = F.col("n_").isNotNull()
    code = (
        F.when(~have, "UNMANIFESTED").when(F.coalesce(unsafe, F.lit(True)), "UNSAFE_OR_CROSS_YEAR").when(F.col("n_") > 1, "DUPLICATE").when(F.col("ab_").isNull(), "MISSING")
        .when(~F.col("ab_").eqNullSafe(F.col("eb_")), "SIZE_MISMATCH").when(~F.col("ah_").eqNullSafe(F.col("eh_")), "HASH_MISMATCH")
    )
    rows = both.select("year", "path", code.alias("failure")).where("failure is not null")
    totals = both.where(have).groupBy("year").agg(F.count("*").alias("names_"), F.coalesce(F.sum("ab_"), F.lit(0)).alias("sum_"))
    m = manifests.join(totals, "year", "left")
    other = F.exists(F.coalesce("known_missing_dates", F.array().cast("array<string>")), lambda x: ~F.coalesce(F.startswith(x, name("year")), F.lit(False)))
    whole = F.array_compact(F.array(
        F.when(~F.col("file_count").eqNullSafe(F.coalesce("names_", F.lit(0))), "FILE_COUNT_MISMATCH"), F.when(~F.col("total_bytes").eqNullSafe(F.coalesce("sum_", F.lit(0))), "TOTAL_BYTES_MISMATCH"), F.when(other, "CROSS_YEAR_MISSING_DATE")))
    return rows.unionByName(m.select("year", F.lit(None).cast("string").alias("path"), F.explode(whole).alias("failure")))


def audit_input_files(spark: SparkSession, glob: str, required: list[str]) -> DataFrame:
    """``(path, reason)``: EMPTY_FILE, MISSING_COLUMN or OK by each file's first line; files are read as lines, their contents never whole."""
    listed = spark.read.format("binaryFile").load(glob).select(F.col("path"), "length")  # lengths only: the contents are not read
    head = _headers(spark, glob).select(F.col("source_file").alias("path"), "columns")
    missing = F.array_except(F.array(*[F.lit(r) for r in required]), F.coalesce("columns", F.array().cast("array<string>")))
    return listed.join(head, "path", "left").select("path", F.when(F.col("length") == 0, "EMPTY_FILE").when(F.size(missing) > 0, "MISSING_COLUMN").otherwise("OK").alias("reason"))


def _lines(spark: SparkSession, glob: str) -> DataFrame:
    """``(source_file, block, line)`` of every line of the files; ``block`` is where the part of the file begins that a task read."""
    return spark.read.text(glob).select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("nth"))


def _normal_header(line: F.Column) -> F.Column:
    """Column names of a header line: trimmed, upper case, spaces as underscores, without a byte-order mark; unnamed ones go."""
    return F.filter(F.transform(F.split(F.ltrim(F.rtrim(line, F.lit("\r")), F.lit("\ufeff")), ","), lambda c: F.replace(F.upper(F.trim(c)), F.lit(" "), F.lit("_"))), lambda c: c != "")


def _headers(spark: SparkSession, glob: str) -> DataFrame:
    """``(source_file, columns)``: the first line of each file, the least numbered one of the part that begins it."""
    first = _lines(spark, glob).where("block = 0").groupBy("source_file").agg(F.min_by("line", "nth").alias("line"))
    return first.select("source_file", _normal_header(F.col("line")).alias("columns"))


def profile_source_schema(spark: SparkSession, glob: str) -> DataFrame:
    """A row a file: its columns, whether it has EQ rows, ISINs and traded values, EQ rows and all rows (0 where it has no symbol or series column)."""
    head = _headers(spark, glob)
    series = F.when(F.array_contains("columns", "SERIES"), F.array_position("columns", "SERIES")).otherwise(F.array_position("columns", "SCTYSRS"))
    known = head.withColumn("at", F.when(F.array_contains("columns", "SYMBOL") | F.array_contains("columns", "TCKRSYMB"), series).otherwise(0))
    held = _lines(spark, glob).where("line <> ''").join(known, "source_file").where("at > 0").withColumn("value", F.upper(F.trim(F.get(F.split("line", ","), F.col("at").cast("int") - 1))))
    counts = held.groupBy("source_file").agg(F.count_if(F.col("value") == "EQ").alias("eq_rows"), (F.count("*") - 1).alias("total_rows"))
    value = F.arrays_overlap("columns", F.array(*[F.lit(c) for c in VALUE_COLUMNS]))
    out = head.join(counts, "source_file", "left").na.fill(0, ["eq_rows", "total_rows"])
    return out.select("source_file", "columns", (F.col("eq_rows") > 0).alias("has_eq_series"), F.array_contains("columns", "ISIN").alias("has_isin"), value.alias("has_traded_value"), "eq_rows", "total_rows")


def trading_status_daily(active: DataFrame) -> DataFrame:
    """Daily status rows of an active universe; a row without a status was trading."""
    status = F.coalesce("trading_status", F.lit("ACTIVE_TRADING")) if "trading_status" in active.columns else F.lit("ACTIVE_TRADING")
    return active.select("date", "security_id", "listing_episode_id", F.col("symbol_at_date").alias("symbol"), status.alias("trading_status"), F.lit("OBSERVED_TRADING_RECORD").alias("status_quality"), "source_file_id")


def unadjusted_baseline(prices: DataFrame) -> DataFrame:
    """Raw closes in the shape of adjusted prices, with factors of one and no events."""
    close, one = F.col("raw_close"), F.lit(1.0)
    return prices.select(
        "date", "security_id", "listing_episode_id", "symbol_at_date", "raw_close", close.alias("research_adjusted_close"), one.alias("research_adjustment_factor"), close.alias("price_return_adjusted_close"), one.alias("price_return_adjustment_factor"),
        F.lit("NO_ADJUSTMENT_REQUIRED").alias("adjustment_quality"), F.array().cast("array<string>").alias("source_event_ids"))


def merge_event_feeds(feeds: list[DataFrame], required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(distinct complete events, rows without a required field with the field's name)."""
    rows = feeds[0]
    for f in feeds[1:]:
        rows = rows.unionByName(f, allowMissingColumns=True)
    rows = rows.dropDuplicates()
    lacks = F.array_compact(F.array(*[F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), c) for c in required]))
    return rows.where(F.size(lacks) == 0), rows.select("*", F.explode(lacks).alias("missing_field"))


def check_one_to_one(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys that don't have exactly one row on each side, with the counts."""
    e, a = (df.groupBy(key).agg(F.count("*").alias(n)) for df, n in ((expected, "expected"), (actual, "actual")))
    return e.join(a, key, "full").na.fill(0, ["expected", "actual"]).where("expected <> 1 or actual <> 1")
