import tempfile
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pitmill.sources import files
from pitmill.streaming import ingest


def fresh() -> Path:
    return Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def test_two_eras_and_series(spark):
    d = fresh()
    (d / "cm-2020-01-01.csv").write_text("SYMBOL,SERIES,OPEN,HIGH,LOW,CLOSE,TOTTRDQTY,TOTTRDVAL,ISIN\nA ,EQ,1,2,1,2,\"1,000\",-,I1\nB,GB,1,1,1,1,1,1,I2\n")
    (d / "cm-2020-01-02.csv").write_text("TckrSymb,SctySrs,OpnPric,HghPric,LwPric,ClsPric,TtlTradgVol,TtlTrfVal,ISIN\nA,BE,1,2,1,3,5,7,I1\n")
    rows = files.read_daily_observations(spark, [[str(d / "cm-2020-01-01.csv")], [str(d / "cm-2020-01-02.csv")]]).orderBy("date").collect()
    assert [(str(r.date), r.symbol, r.series, r.close, r.volume, r.traded_value) for r in rows] == [("2020-01-01", "A", "EQ", 2.0, 1000, None), ("2020-01-02", "A", "BE", 3.0, 5, 7.0)]
    reasons = {Path(r.path).name: r.reason for r in files.audit_input_files(spark, str(d), ["SYMBOL"]).collect()}
    assert reasons == {"cm-2020-01-01.csv": "OK", "cm-2020-01-02.csv": "MISSING_COLUMN"}


def test_manifest_finds_tampering(spark):
    d = fresh()
    for k in "abc":
        (d / f"{k}-2020-01-01.csv").write_text(k)
    before = files.file_manifest(spark, str(d)).collect()
    before = spark.createDataFrame(before, "path string, bytes long, sha256 string, source_date date")
    (d / "a-2020-01-01.csv").write_text("x")
    (d / "d-2020-01-01.csv").write_text("new")
    got = {Path(r.path).name[0]: r.status for r in files.verify_manifest(before, files.file_manifest(spark, str(d))).collect()}
    assert got == {"a": "HASH_MISMATCH", "b": "OK", "c": "OK", "d": "UNMANIFESTED"}


def test_sinks_refuse_to_overwrite(spark):
    d = str(fresh() / "t")
    files.write_table(spark.range(3), d)
    with pytest.raises(AnalysisException):
        files.write_table(spark.range(3), d)
    empty = str(fresh() / "e")
    files.publish(spark.range(0), spark.range(1).schema, empty)
    assert spark.read.parquet(empty).columns == ["id"]


def test_file_selection(spark):
    df = spark.createDataFrame([("x/cm-2020-01-01.csv",), ("x/cm-2020-13-01.csv",), ("x/cm.csv",), ("x/cm-2020-02-01.csv",)], "path string")
    good, bad = files.select_source_files(df, "2020-01-15", None)
    assert [r.path for r in good.collect()] == ["x/cm-2020-02-01.csv"] and bad.count() == 2


def test_ingest_once_and_reject_changes(spark):
    src, target, cp = fresh(), str(fresh() / "days"), str(fresh())
    (src / "cm-2020-01-01.csv").write_text("one")
    ingest.ingest_days(spark, str(src), target, cp)
    (src / "again-2020-01-01.csv").write_text("one")
    (src / "cm-2020-01-02.csv").write_text("two")
    ingest.ingest_days(spark, str(src), target, cp)
    assert sorted(str(r.source_date) for r in spark.read.parquet(target).select("source_date").collect()) == ["2020-01-01", "2020-01-02"]
    (src / "other-2020-01-02.csv").write_text("changed")
    with pytest.raises(Exception, match="other content"):
        ingest.ingest_days(spark, str(src), target, cp)
    assert spark.read.parquet(target).count() == 2


def test_coverage_status(spark):
    days = lambda *x: spark.createDataFrame([(date.fromisoformat(v),) for v in x], "date date")
    got = {str(r.date): r.status for r in ingest.coverage_status(days("2020-01-01", "2020-01-04"), days("2020-01-01", "2020-01-02")).collect()}
    assert got == {"2020-01-01": "PRESENT", "2020-01-02": "MISSING", "2020-01-04": "EXTRA"}
    assert files.file_date(F.lit("x")) is not None


def test_a_malformed_line_is_an_error(spark, tmp_path):
    import pytest

    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert files.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int").count() == 2
    (tmp_path / "y.jsonl").write_text('{"a": 1}\nnot json\n')
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_jsonl(spark, str(tmp_path / "y.jsonl"), "a int").collect()


def test_late_rows_are_counted(spark, tmp_path):
    from pitmill.streaming import ingest

    cols = "k long, ts timestamp, open double, high double, low double, close double, volume long"
    rows = lambda *days: spark.sql(" UNION ALL ".join(f"SELECT {k}L AS k, timestamp '2020-01-{d:02d} 00:00:00' AS ts, 5D AS open, 4D AS high, 3D AS low, 4D AS close, 1L AS volume" for k, d in days))
    found, late = None, 0
    for days in (((1, 10), (2, 11)), ((3, 20),), ((4, 12), (5, 20))):
        rows(*days).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = ingest.stream_findings(spark.readStream.schema(cols).parquet(f"{tmp_path}/in"), ["k"], "ts", "2 days")
        found, n = ingest.run_counted(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
        late += n
    assert late == 1 and sorted(r.k for r in found.collect()) == [1, 2, 3, 5]


def test_files_of_a_year_are_several_tasks_work(spark):
    """No task writes a whole year, and what is said of a year covers all of its files."""
    from pyspark.sql import functions as F

    from pitmill.catalog import flows
    from pitmill.catalog.inputs import table

    d, off = "/root/testdata/sf0.001", "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(off, "false")
    try:
        path = flows._year_files(spark, d)
        files = spark.read.format("binaryFile").load(f"{path}/*/year=*").select(F.regexp_extract("path", r"year=(\d+)", 1).alias("year"))
        assert files.groupBy("year").count().agg(F.min("count")).first()[0] > 1
        got = {r.year: (r.eq_rows, r.total_rows) for r in flows.a13_source_profile(spark, d).collect()}
    finally:
        spark.conf.unset(off)
    want = table(spark, d, "panel").groupBy(F.year("date").alias("year")).agg(F.count_if(F.col("series") == "EQ").alias("e"), F.count("*").alias("n")).collect()
    assert got == {r.year: (r.e, r.n) for r in want}
    assert flows.a12_input_files(spark, d).count() == len(want)
