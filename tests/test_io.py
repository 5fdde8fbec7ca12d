import pytest
from pyspark.sql import functions as F

from tessera.sources import landing, sinks
from tessera.streaming.ingest import ingest, ingest_rescued


def test_land_skips_known_content(spark, tmp_path):
    df = spark.range(3)
    name = landing.land(df, str(tmp_path), "chunks")
    assert landing.parse_landed(name)[0] == "chunks" and landing.land(df.orderBy(F.desc("id")), str(tmp_path), "chunks") is None
    assert landing.parse_landed("x_zzzzzzzz.parquet") is None and landing.parse_landed("a_b_0123abcd.parquet") == ("a_b", "0123abcd")


def test_ingest_is_exactly_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    assert ingest(spark, src, out, cp) == 0
    spark.range(3).write.parquet(f"{src}/a_00000001.parquet")
    assert ingest(spark, src, out, cp) == 3 and ingest(spark, src, out, cp) == 3
    spark.range(2).write.parquet(f"{src}/b_00000001.parquet")
    assert ingest(spark, src, out, cp) == 5
    assert {"_source_file", "_ingested_at"} <= set(spark.read.parquet(out).columns)


def test_ingest_rescues_other_schemas(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    spark.range(2).select(F.col("id").alias("a"), F.lit("e").alias("extra")).write.parquet(f"{src}/a")
    assert ingest_rescued(spark, src, out, cp, ["a", "b"]) == 2 and ingest_rescued(spark, src, out, cp, ["a", "b"]) == 2
    r = spark.read.parquet(out).orderBy("a").first()
    assert (r.a, r.b, r._rescued_data) == ("0", None, '{"extra":"e"}')


def test_partition_replacement_is_idempotent(spark, tmp_path):
    p = str(tmp_path / "t")
    sinks.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "x int, month string"), p)
    for _ in range(2):
        sinks.replace_partitions(spark.createDataFrame([(3, "b")], "x int, month string"), p)
    assert sorted(r.x for r in spark.read.parquet(p).collect()) == [1, 3]


def test_tables_and_versions(spark, tmp_path):
    sinks.create_table(spark, "t_eval", {"a": ("double", "it's"), "b": ("boolean", "")}, "c")
    sinks.insert_row(spark, "t_eval", {"a": 1.5, "b": True})
    sinks.append(spark.createDataFrame([(2.5, False)], "a double, b boolean"), "t_eval")
    assert spark.table("t_eval").count() == 2
    sinks.rebuild(spark.range(9), "t_range", ["id"])
    assert spark.table("t_range").count() == 9
    v = sinks.Versions(spark, str(tmp_path / "v"))
    assert (v.write(spark.range(1)), v.write(spark.range(2))) == (1, 2) and v.read().count() == 2 and v.read(1).count() == 1


def test_csv_keeps_blanks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,\n"",z\n')
    rows = {(r.x, r.y) for r in landing.read_csv_strings(spark, str(tmp_path), ["x", "y"]).collect()}
    assert rows == {("1", ""), ("", "z")}


@pytest.mark.parametrize("name", ["monthly_mart_orders", "quality_summary", "ir_metrics", "forecast_backtest"])
def test_query_equals_sql(spark, name):
    import os

    import duckdb

    from tessera.plans.catalogue import oracle_sql, queries

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test data")
    con = duckdb.connect()
    for f in os.listdir(d):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{d}/{f}'")
    df = queries()[name](spark, d)
    cols = sorted(df.columns)
    want = sorted(map(str, con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({oracle_sql()[name]})").fetchall()))
    assert sorted(map(str, (tuple(r) for r in df.select(*cols).collect()))) == want
