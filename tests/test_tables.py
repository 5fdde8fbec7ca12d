"""Change feeds, incremental marts, merging sinks, published versions, clustering and bucketed state."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from tessera.operators import changes, marts
from tessera.operators.bucketed import BucketedState
from tessera.operators.quality import CheckFailed
from tessera.operators.versions import reconcile
from tessera.sources import landing
from tessera.sources import versioned
from tessera.sources.versioned import VersionedTable, audit, interleaved
from tessera.streaming import merging
from tessera.streaming.incremental import IncrementalMart


def bag(df):
    return Counter(map(tuple, df.collect()))


# Changes


def test_changes_name_kinds_and_copies(spark):
    ddl = "k int, v string, at timestamp"
    at, later = "2024-01-01 00:00:00.000001", "2024-01-01 00:00:00.000002"
    make = lambda rows: spark.createDataFrame(rows, "k int, v string, at string").select("k", "v", F.col("at").cast("timestamp"))
    old = make([(1, "a", at), (1, "a", at), (2, "b", at), (None, "n", at), (3, None, at), (4, "same", at), (5, "t", at)])
    new = make([(1, "a", at), (None, "n", at), (None, "m", at), (3, "", at), (4, "same", at), (6, "x", at), (6, "x", at), (5, "t", later)])
    got = Counter((r.k, r.v, r._change) for r in changes.changes(old, new, ["k"]).collect())
    assert got == Counter({
        (1, "a", "delete"): 1, (2, "b", "delete"): 1, (None, "m", "insert"): 1, (3, None, "update_before"): 1, (3, "", "update_after"): 1,
        (6, "x", "insert"): 2, (5, "t", "update_before"): 1, (5, "t", "update_after"): 1,
    })
    assert bag(changes.replay(old, changes.changes(old, new, ["k"]))) == bag(new)
    assert changes.changes(new, new, ["k"]).count() == 0 and old.schema == spark.createDataFrame([], ddl).schema


@pytest.mark.parametrize("narrow", [64, -1])
def test_changes_of_narrow_and_wide_rows_are_the_same(spark, monkeypatch, narrow):
    """Signs of zero, NaN, NULL and repeats count either way; narrow rows go through one exchange each, without digests."""
    monkeypatch.setattr(changes, "NARROW", narrow)
    nan, ddl = float("nan"), "k int, v string, x double, y float"
    old = spark.createDataFrame([(1, "a", 0.0, 0.0), (2, "b", nan, None), (3, "c", -0.0, -0.0), (3, "c", -0.0, -0.0), (None, None, None, 1.5)], ddl)
    new = spark.createDataFrame([(1, "a", -0.0, 0.0), (2, "b", nan, None), (3, "c", -0.0, -0.0), (4, "c", -0.0, 0.0), (None, None, 0.0, 1.5)], ddl)
    feed = changes.changes(old, new, ["k"])
    said = lambda rows: Counter(tuple(map(repr, r)) for r in rows.collect())
    row = lambda *r: tuple(map(repr, r))
    assert said(feed) == Counter([
        row(1, "a", 0.0, 0.0, "update_before"), row(1, "a", -0.0, 0.0, "update_after"), row(3, "c", -0.0, -0.0, "delete"), row(4, "c", -0.0, 0.0, "insert"),
        row(None, None, None, 1.5, "update_before"), row(None, None, 0.0, 1.5, "update_after"),
    ])
    again = changes.replay(old, feed)
    assert said(again) == said(new)
    if narrow > 0:
        assert not any("sha2" in df._jdf.queryExecution().optimizedPlan().toString() for df in (feed, again))


def test_log_replays_to_each_version(spark, tmp_path):
    rng = random.Random(1)
    log = changes.ChangeLog(spark, str(tmp_path), ["k"])
    shots, rows = [], []
    for _ in range(4):
        rows = [r for r in rows if rng.random() > 0.3] + [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), ["x", None]) for _ in range(20)]
        shots.append(Counter((k, v, tuple(n)) for k, v, n in rows))
        log.commit(spark.createDataFrame(rows, "k int, v string, n array<string>"))
    for v, want in enumerate(shots, 1):
        assert Counter((r.k, r.v, tuple(r.n)) for r in log.as_of(v).collect()) == want
    assert {r._version for r in log.read(2, 3).select("_version").distinct().collect()} == {2, 3}
    assert log.read(1, 1).where("_change <> 'insert'").count() == 0 and log.read(9).count() == 0
    # A commit that broke off before its snapshot was complete is overwritten.
    (tmp_path / "snapshots" / "v=4" / "_SUCCESS").unlink()
    assert log.commit(spark.createDataFrame([(1, "z", [])], "k int, v string, n array<string>")) == 4
    assert [tuple(r) for r in log.as_of(4).collect()] == [(1, "z", [])]


# Incremental marts


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("part-*.parquet")}


def test_only_touched_months_are_built_again(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    ddl = "day date, kind string, total double"
    make = lambda rows: spark.createDataFrame(rows, "day string, kind string, total double").select(F.col("day").cast("date"), "kind", "total")
    build = lambda df: marts.legs(df, ("month", "kind"), "total", "total", "n")
    mart = IncrementalMart(spark, root, F.date_format("day", "yyyy-MM"), build)
    assert mart.run(source).files == []
    first = [("2024-01-05", "a", 1.0), ("2024-02-01", "a", 5.0)], [("2024-02-07", "b", 2.0), (None, "b", 2.5)], [("2024-03-01", "b", 3.0)]
    for n, rows in enumerate(first):
        landing.land(make(rows), source, f"2024-0{n + 1}")
    make([("2024-01-01", "x", 9.0)]).write.parquet(f"{source}/foreign.parquet")
    done = mart.run(source)
    assert (len(done.files), done.labels, done.months) == (3, {"2024-01", "2024-02", "2024-03"}, {"2024-01", "2024-02", "2024-03", "none"})
    assert bag(mart.mart().select("month", "kind", "total", "n")) == bag(mart.rebuild().select("month", "kind", "total", "n")) != {}
    before = files_of(f"{root}/mart")
    # A corrected file: February's label loses its month-less row and moves the other one to April.
    landing.land(make([("2024-04-07", "b", 2.0)]), source, "2024-02")
    done = mart.run(source)
    assert (done.labels, done.months) == ({"2024-02"}, {"2024-02", "2024-04", "none"})
    after = files_of(f"{root}/mart")
    same = {p for p in before if before[p] == after.get(p)}
    assert {p for p in before if "month=2024-01" in p or "month=2024-03" in p} == same and not any("month=none" in p for p in after)
    got = bag(mart.mart().select("month", "kind", "total", "n"))
    assert got == bag(mart.rebuild().select("month", "kind", "total", "n")) == Counter({("2024-01", "a", 1.0, 1): 1, ("2024-02", "a", 5.0, 1): 1, ("2024-03", "b", 3.0, 1): 1, ("2024-04", "b", 2.0, 1): 1})
    assert mart.run(source).files == [] and files_of(f"{root}/mart") == after
    # A corrected file without rows takes its label's rows away.
    spark.createDataFrame([], ddl).write.parquet(f"{source}/2024-03_00000000.parquet")
    assert mart.run(source).months == {"2024-03"}
    assert bag(mart.mart().select("month")) == Counter({("2024-01",): 1, ("2024-02",): 1, ("2024-04",): 1})


def test_a_batch_that_broke_off_is_replayed_whole(spark, tmp_path, monkeypatch):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    make = lambda rows: spark.createDataFrame(rows, "month string, total double")
    mart = IncrementalMart(spark, root, F.col("month"), lambda df: marts.legs(df, ("month",), "total", "total", "n"))
    landing.land(make([("2024-01", 1.0), ("2024-02", 2.0)]), source, "x")
    mart.run(source)
    landing.land(make([("2024-02", 2.0)]), source, "x")
    own = IncrementalMart._replace

    def broken(self, rows, table, by, values):
        if table == "mart":
            raise RuntimeError("lost")
        own(self, rows, table, by, values)

    monkeypatch.setattr(IncrementalMart, "_replace", broken)
    with pytest.raises(Exception, match="lost"):
        mart.run(source)
    monkeypatch.setattr(IncrementalMart, "_replace", own)
    # Silver has been replaced by then; January is known from the note alone.
    assert mart.run(source).months == {"2024-01", "2024-02"}
    assert bag(mart.mart().select("month", "n")) == Counter({("2024-02", 1): 1})


# Merging sinks


def test_lattice():
    i, lo, f, d, s = IntegerType(), LongType(), FloatType(), DoubleType(), StringType()
    order = [i, lo, d, s]
    for n, a in enumerate(order):
        for b in order[n:]:
            assert merging.wider(a, b) == merging.wider(b, a) == b
    assert merging.wider(i, f) == d and merging.wider(lo, f) == d and merging.wider(f, d) == d and merging.wider(TimestampType(), i) == s
    inner = lambda *fs: StructType([StructField(n, t) for n, t in fs])
    assert merging.merged(inner(("a", i), ("B", inner(("x", i)))), inner(("b", inner(("x", d), ("y", s))), ("c", s))) == inner(("a", i), ("B", inner(("x", d), ("y", s))), ("c", s))


def test_three_schemas_land_and_a_replay_adds_nothing(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.sql("SELECT 1 AS id, 7 AS v").write.parquet(f"{source}/sales/a_00000001.parquet")
    assert merging.ingest_entities(spark, source, target, ["sales", "rents"]) == {"sales": 1, "rents": 0}
    spark.sql("SELECT 3000000000L AS id, 2.5D AS v, named_struct('p', 1) AS n").write.parquet(f"{source}/sales/b_00000001.parquet")
    assert merging.ingest_entities(spark, source, target, ["sales", "rents"])["sales"] == 2
    spark.sql("SELECT 4 AS id, 'many' AS v, named_struct('p', 2, 'q', 'z') AS n, true AS more").write.parquet(f"{source}/sales/c_00000001.parquet")
    assert merging.ingest_entities(spark, source, target, ["sales", "rents"]) == {"sales": 3, "rents": 0} == merging.ingest_entities(spark, source, target, ["sales", "rents"])
    table = merging.MergedTable(spark, f"{target}/sales")
    assert table.versions() == [1, 2, 3] and table.schema(1).simpleString() == "struct<id:int,v:int>"
    got = {r.id: (r.v, r.n and (r.n.p, r.n.q), r.more) for r in table.read().collect()}
    assert got == {1: ("7", None, None), 3000000000: ("2.5", (1, None), None), 4: ("many", (2, "z"), True)}
    # The batch again, as after a crash between its data and the checkpoint: no row, no schema more.
    path = f"{source}/sales/c_00000001.parquet"
    assert table.write_batch("v1-2", [path]) == 3 and table.count() == 3 and table.versions() == [1, 2, 3]
    # A broken off batch: the schema is there, the data not.
    spark.sql("SELECT 5 AS id, 1 AS late").write.parquet(f"{source}/sales/d_00000001.parquet")
    wide = merging.merged(table.schema(), spark.read.parquet(f"{source}/sales/d_00000001.parquet").schema)
    from tessera.sources.scratch import write_json

    write_json(spark, f"{target}/sales/_schemas/4.json", wide.jsonValue())
    assert table.count() == 3 and merging.ingest_entities(spark, source, target, ["sales"]) == {"sales": 4} and table.versions() == [1, 2, 3, 4]


# Versions


def test_a_breaking_write_is_not_visible(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    with pytest.raises(LookupError):
        t.read()
    good = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    rules = {"not_null": ["v"], "key": ["k"], "checks": {"short": F.length("v") < 3}}
    assert t.write(good, **rules) == 1
    bad = spark.createDataFrame([(1, "a"), (1, "b"), (None, None), (None, "long one"), (None, "x")], "k int, v string")
    assert audit(bad, **rules) == {"rows": 5, "not_null:v": 1, "check:short": 2, "key:k": 3}
    with pytest.raises(CheckFailed, match="check:short: 2 rows; key:k: 3 rows; not_null:v: 1 rows"):
        t.write(bad, **rules)
    assert t.versions() == [1] and bag(t.read()) == bag(good) and t.refused()[0]["audit"]["key:k"] == 3
    assert len(list((tmp_path / "data").iterdir())) == 1  # what was staged is gone
    assert t.write(good.limit(0), **rules) == 2 and t.read().count() == 0 and t.read(1).count() == 3
    assert [tuple(r)[:4] for r in t.history().orderBy("version").collect()] == [(1, "WRITE", 3, t.entry(1)["files"]), (2, "WRITE", 0, t.entry(2)["files"])]
    assert t.vacuum(1) == [1] and t.versions() == [2]


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path))
    t.write(spark.range(1))
    monkeypatch.setattr(VersionedTable, "versions", lambda self: [])  # another writer has looked before
    with pytest.raises(Exception, match="(?i)exist"):
        t.write(spark.range(2))
    monkeypatch.undo()
    assert t.versions() == [1] and t.read().count() == 1 and len(list((tmp_path / "data").iterdir())) == 1


def test_either_clustered_column_skips_files(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    n = 40_000
    df = spark.range(n).select(F.col("id"), (F.hash("id") % 1000).alias("a"), F.when(F.col("id") % 3 == 0, 77).otherwise(F.pmod(F.hash(F.col("id") + n), F.lit(5000))).alias("b"), F.lit("é").alias("c"))
    df = df.withColumn("a", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("a")))
    t.write(df)
    assert t.cluster(["a", "b"], 64) == 2 and bag(t.read()) == bag(df)
    _, _, total = t.scan({})
    for ranges in ({"a": (100, 105)}, {"b": (4000, 4020)}, {"a": (100, 300), "b": (4000, 4500)}):
        rows, read, _ = t.scan(ranges)
        kept = df
        for c, (low, high) in ranges.items():
            kept = kept.where(F.col(c).between(low, high))
        assert bag(rows) == bag(kept) and read <= total / 5, (ranges, read, total)
    rows, read, _ = t.scan({"b": (77, 77)})
    assert rows.count() == df.where("b = 77").count() and read < total  # a third of all rows
    assert t.scan({"a": (10**6, None)})[1] == 0 and t.scan({"a": (10**6, None)})[0].count() == 0
    assert t.scan({"a": (None, None)})[0].count() == df.where("a IS NOT NULL").count()


def test_compaction_packs_small_files(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    df = spark.range(5000).withColumn("x", F.sha2(F.col("id").cast("string"), 256))
    t.write(df.repartition(20))
    size = t.entry()["bytes"]
    assert t.compact(size // 4) == 2
    assert t.entry()["operation"] == "COMPACT" and 4 <= t.entry()["files"] <= 6 and bag(t.read()) == bag(df)
    big = {p.name for p in (tmp_path / t.entry()["data"]).glob("*.parquet") if p.stat().st_size >= size // 8}
    assert t.compact(size // 8) is None or big <= {p.name for p in (tmp_path / t.entry()["data"]).glob("*.parquet")}
    assert t.compact(1) is None


def test_interleaving_keeps_order_of_each_column(spark):
    df = spark.range(64).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"))
    z = {(r.a, r.b): r.z for r in df.withColumn("z", interleaved(df, ["a", "b"])).collect()}
    assert all(z[a, b] < z[a + 1, b] and z[b, a] < z[b, a + 1] for a in range(7) for b in range(8)) and len(set(z.values())) == 64
    assert interleaved(df.limit(0), ["a"]) is not None
    with pytest.raises(ValueError, match="one to 5 columns"):
        interleaved(df, ["a", "b"] * 3)


def test_ranks_are_searched_by_halves(spark):
    """A row is compared with ten bounds, not with each of a thousand; the rank is the plain count."""
    nan = float("nan")
    for bounds in ([float(3 * i) for i in range(1023)], [1.0, 2.5, nan], [0.0]):
        df = spark.createDataFrame([(x,) for x in (None, -1.0, 0.0, 1.0, 2.5, 3.0, 1534.5, 3066.0, 9999.0, float("inf"), nan)], "x double")
        rank = versioned._rank(F.col("x"), F.array(*map(F.lit, bounds)))
        got = df.select("x", rank.alias("r"), F.lit(1).alias("one")).collect()
        # NaN is the largest and equals itself.
        low = lambda b, x: x != x or (b == b and b <= x)
        assert [r.r for r in got] == [0 if r.x is None else 1 + sum(low(b, r.x) for b in bounds) for r in got]
        assert "filter(" not in df.select(rank)._jdf.queryExecution().optimizedPlan().toString()


# Buckets


def test_bucketed_merge_equals_reconcile(spark, tmp_path):
    state = BucketedState(spark, str(tmp_path), ["a", "b"], ["v"], buckets=16)
    at = lambda n: F.to_timestamp(F.lit(f"2026-0{n}-01"))
    ddl = "a int, b string, v double, extra int"
    one = spark.createDataFrame([(i, "x", float(i), 0) for i in range(200)] + [(None, None, 1.0, 0), (None, "y", None, 0)], ddl)
    assert state.merge(one, at(1)) == list(range(16)) and state.merge(one, at(2)) == []
    before = files_of(tmp_path)
    whole = state.read()
    two = one.where("a IS NULL OR a NOT IN (3, 4)").withColumn("v", F.when(F.col("a") == 7, 70.0).otherwise(F.col("v"))).unionByName(spark.createDataFrame([(999, None, 2.0, 0)], ddl))
    want = bag(reconcile(whole, two, ["a", "b"], ["v"], at(3)).select("a", "b", "v", "is_current"))
    hit = state.merge(two, at(3))
    assert 1 <= len(hit) <= 4 and bag(state.read().select("a", "b", "v", "is_current")) == want
    after = files_of(tmp_path)
    assert all(after.get(p) == t for p, t in before.items() if int(p.split("bucket=")[1].split("/")[0]) not in hit)
    assert state.read().where("a = 3").select("is_current", F.month("_synced_at")).first()[:] == (False, 1)
    assert len(state.retire(spark.createDataFrame([(None, None), (12345, "q")], "a int, b string"))) <= 2
    assert state.read().where("a IS NULL AND b IS NULL AND NOT is_current").count() == 1
    assert state.purge(at(2)) and state.read().where("NOT is_current").count() == 0
    assert state.merge(one, at(4)) and state.read().where("is_current").count() == 202
    assert BucketedState(spark, str(tmp_path / "none"), ["a"], ["v"]).retire(one.select("a")) == []


def test_tables_on_the_command_line(spark, tmp_path, capsys):
    from tessera import cli

    run = lambda *args: (cli.main([str(a) for a in args], spark), capsys.readouterr().out)
    good, bad, table = tmp_path / "good", tmp_path / "bad", tmp_path / "t"
    spark.range(100).selectExpr("id", "id % 7 AS b").repartition(5).write.parquet(str(good))
    spark.sql("SELECT 1L AS id, 2L AS b UNION ALL SELECT 1L, NULL").write.parquet(str(bad))
    assert run("publish", good, table, "--not-null", "b", "--key", "id") == (0, "version 1\n")
    code, said = run("publish", bad, table, "--not-null", "b", "--key", "id")
    assert code == 1 and "key:id: 1 rows; not_null:b: 1 rows" in said
    assert run("cluster", table, "--by", "id,b", "--files", 3)[1] == "version 2\n" and run("compact", table)[1] == "version 3\n" and run("compact", table)[1] == "version as it was\n"
    assert "CLUSTER BY id, b" in run("history", table)[1] and run("vacuum", table, "--keep", 1)[1] == "deleted: 1 2\n"
    spark.range(3).write.parquet(str(tmp_path / "in" / "sales" / "a_00000001.parquet"))
    assert run("ingest", tmp_path / "in", tmp_path / "out", "sales", "rents") == (0, "sales 3\nrents 0\n")
