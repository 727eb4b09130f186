"""Inputs of the registered queries keep all of the given tables."""

from pitmill.catalog.inputs import table


def test_notices_hold_whole_texts(spark, tmp_path):
    text = "".join(chr(97 + k % 26) for k in range(3000)) + " Late Gear Limited w.e.f. May 4, 2002"
    spark.createDataFrame([(k, text) for k in range(6)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.sql("SELECT id AS p_partkey, 'late gear' AS p_name FROM range(3, 5)").write.parquet(f"{tmp_path}/part.parquet")
    rows = table(spark, str(tmp_path), "notices").collect()
    assert len(rows) == 6 and all(r.body.startswith(text[:200]) and r.body.endswith(text[200:]) for r in rows)


def test_event_inputs_hold_all_orders_and_parts(spark, tmp_path):
    spark.sql("SELECT id AS o_orderkey, id % 7 AS o_custkey, date '1996-01-01' AS o_orderdate FROM range(1, 301)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT id AS l_partkey, date '1996-01-01' AS l_shipdate FROM range(201, 501)").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert {table(spark, str(tmp_path), x).count() for x in ("raw_actions", "events_in", "suspensions")} == {300}
    assert table(spark, str(tmp_path), "discovered").select("symbol").distinct().count() == 60
