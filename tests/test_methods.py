"""Pruned search, exact medians, the forecast table function, boosted trees, and the judge's ledger, against plain computations."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import boosted, evaluate, forecast_table, marts, medians, model, pruned, retrieval

# Pruned search


def clustered(n, groups, width, seed, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dims))
    x = centres[rng.integers(0, groups, n)] + width * rng.standard_normal((n, dims))
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("width", [0.05, 2.0])
def test_pruned_search_equals_a_full_one(spark, monkeypatch, width):
    monkeypatch.setattr(pruned, "BLOCK", 32)
    monkeypatch.setattr(pruned, "CENTROIDS", 64)
    rows = clustered(900, 30, width, 1) + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16)]
    rows += [(2000 + i, rows[0][1]) for i in range(12)]  # ties go by id
    df = spark.createDataFrame(rows, "vid long, e array<double>")
    asked = df.where("vid % 20 = 0").select(F.col("vid").alias("qid"), "e")
    got, skipped = pruned.top_k(asked, pruned.group(df, "vid", "e"), 10, "qid", "vid", exclude_self=True, embedding="e")
    want = retrieval.top_k(asked.where("qid <> 1000"), df.where("vid NOT IN (1000, 1001, 1002)"), 10, "qid", "vid", exclude_self=True, embedding="e")
    key = lambda d: sorted((r.qid, r["rank"], r.vid, round(r.score, 9)) for r in d.collect())
    assert key(got) == key(want)
    assert skipped > 0.7 if width < 1 else 0 <= skipped < 1, skipped


def test_pruned_search_of_few_and_no_vectors(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "vid string, e array<double>")
    asked = df.select(F.col("vid").alias("qid"), "e")
    got, _ = pruned.top_k(asked, pruned.group(df, "vid", "e"), 5, "qid", "vid", exclude_self=True, embedding="e")
    assert sorted((r.qid, r.vid) for r in got.collect()) == [("a", "b"), ("b", "a")]
    none, skipped = pruned.top_k(asked, pruned.group(df.limit(0), "vid", "e"), 5, "qid", "vid", embedding="e")
    assert none.count() == 0 and skipped == 0.0


# Medians


@pytest.mark.parametrize("bins", [4, 1024])
def test_medians_equal_percentiles(spark, monkeypatch, bins):
    monkeypatch.setattr(medians, "BINS", bins)
    rng = random.Random(7)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([1, None]), rng.choice([None, 0, -5, 3, rng.randint(-(10**9), 10**9)])) for _ in range(600)]
    rows += [("hot", 1, rng.choice([7, 7, 7, rng.randint(0, 10**6)])) for _ in range(901)] + [("null", 1, None), ("one", 1, 4), ("two", 1, 4), ("two", 1, 7)]
    rows += [("far", 1, -(2**63)), ("far", 1, 2**63 - 1), ("far", 1, 5)]
    df = spark.createDataFrame(rows, "k string, j int, v long")
    got = {(r.k, r.j): (r.n, r.median) for r in medians.medians(df, ["k", "j"], "v").collect()}
    values = {}
    for k, j, v in rows:
        values.setdefault((k, j), []).extend([] if v is None else [v])
    assert got.keys() == values.keys()
    for k, vs in values.items():
        vs.sort()
        want = (vs[(len(vs) - 1) // 2] + vs[len(vs) // 2]) / 2 if vs else None
        assert got[k][0] == len(vs) and (got[k][1] is None if want is None else math.isclose(got[k][1], want, rel_tol=1e-12)), k
    exact = {(r.k, r.j): r.m for r in df.where("k <> 'far'").groupBy("k", "j").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert all(got[k][1] == m for k, m in exact.items())
    assert medians.medians(df.limit(0), ["k", "j"], "v").count() == 0


def test_spread_mart_equals_the_plain_one(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["hot", "hot", None, "b"]), rng.choice([1, 2]), rng.choice([None, 10.0, 12.5, round(rng.uniform(0, 900), 2)])) for _ in range(700)] + [("none", 1, None)]
    df = spark.createDataFrame(rows, "k string, month int, v double")
    plain, spread = (marts.monthly_mart(df, ("k", "month"), "v", "price", "total", "n", 3, spread=s) for s in (False, True))
    assert plain.columns == spread.columns and sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, spread.collect()), key=repr)


# Forecasts


def months(n, start=2015):
    return [datetime.date(start + i // 12, i % 12 + 1, 1) for i in range(n)]


def forecast_plainly(values, horizon, coverage):
    """By month offsets; None is a month without a value. The whole history is gone through again for each origin."""
    def smooth(upto):
        level = trend = 0.0
        seen = 0
        for v in values[: upto + 1]:
            if v is None:
                continue
            before = level
            level = 0.4 * v + 0.6 * (level + 0.9 * trend) if seen else v
            trend = 0.2 * (level - before) + 0.8 * 0.9 * trend if seen else 0.0
            seen += 1
        return level, trend, seen

    def ahead(upto, h):
        level, trend, _ = smooth(upto)
        return level + sum(0.9**i for i in range(1, h + 1)) * trend

    out = []
    for h in range(1, horizon + 1):
        errors = sorted(values[t + h] - ahead(t, h) for t in range(len(values) - h) if values[t] is not None and values[t + h] is not None and smooth(t)[2] >= 12)
        last = max(i for i, v in enumerate(values) if v is not None)
        y = ahead(last, h)
        ends = [float(np.quantile(errors, q)) for q in ((1 - coverage) / 2, (1 + coverage) / 2)] if len(errors) >= 8 else [None, None]
        out.append((h, y, *[None if e is None else y + e for e in ends], len(errors)))
    return out


def test_table_function_equals_a_plain_computation(spark):
    rng = random.Random(2)
    series = {("a", 1): [100 + i + rng.gauss(0, 5) for i in range(50)], ("a", None): [None if i % 9 == 4 else rng.uniform(0, 10) for i in range(40)], (None, 2): [5.0] * 20, ("short", 3): [1.0] * 11}
    rows = [(k, j, m, v) for (k, j), vs in series.items() for m, v in zip(months(len(vs)), vs, strict=True) if v is not None or m.month % 2]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "k string, j int, month date, y double").createOrReplaceTempView("history_t")
    forecast_table.register(spark)
    got = {}
    for r in spark.sql("SELECT * FROM forecast_months(TABLE(history_t) PARTITION BY (k, j) ORDER BY (month), 3, 0.8D)").collect():
        got.setdefault((r.k, r.j), []).append((r.horizon, r.yhat, r.low, r.high, r.errors, r.month))
    assert got.keys() == {("a", 1), ("a", None), (None, 2)}
    for k, made in got.items():
        want = forecast_plainly(series[k], 3, 0.8)
        for (h, y, low, high, n, month), (wh, wy, wlow, whigh, wn) in zip(sorted(made), want, strict=True):
            assert (h, n) == (wh, wn) and math.isclose(y, wy) and (low is None) == (wlow is None)
            assert low is None or math.isclose(low, wlow) and math.isclose(high, whigh)
            last = max(i for i, v in enumerate(series[k]) if v is not None)
            assert month == months(last + h + 1)[-1]
    spark.catalog.dropTempView("history_t")
    # A level series without noise: intervals of no width.
    assert sorted(got[None, 2])[0][1:4] == (5.0, 5.0, 5.0)


def test_intervals_cover_in_a_backtest(spark):
    rng = random.Random(3)
    rows = [(s, m, 50 + rng.gauss(0, 4)) for s in range(60) for m in months(72)]
    df = spark.createDataFrame(rows, "s int, month date, y double")
    past, cut = df.where("month < '2020-07-01'"), months(72)[66]
    assert str(cut) == "2020-07-01"
    forecast_table.register(spark)
    made = spark.sql("SELECT * FROM forecast_months(TABLE(SELECT * FROM {h}) PARTITION BY s ORDER BY (month), 6, 0.8D)", h=past)
    got = {r.horizon: (r.n, r.covered) for r in forecast_table.coverage(made, df, ["s"], "month", "y").collect()}
    assert got.keys() == set(range(1, 7)) and all(n == 60 for n, _ in got.values()) and 0.68 <= sum(c for _, c in got.values()) / 6 <= 0.9


# Trees


def tree_plainly(rows, features, depth, least):
    """(leaf value by row) of the best tree on (bins, residual), by trying every split of every node."""
    out = [0.0] * len(rows)

    def grow(ids, level):
        g = sum(rows[i][1] for i in ids)
        best = None
        for f in range(features) if level < depth else ():
            for b in sorted({rows[i][0][f] for i in ids} - {-1}):
                for missing_left in (True, False):
                    left = [i for i in ids if (rows[i][0][f] == -1 and missing_left) or -1 < rows[i][0][f] <= b]
                    n, total = len(left), sum(rows[i][1] for i in left)
                    if n < least or len(ids) - n < least:
                        continue
                    gain = round(total**2 / n + (g - total) ** 2 / (len(ids) - n) - g * g / len(ids), 7)
                    if gain > 1e-7 and (best is None or gain > best[0] + 1e-9):
                        best = gain, left
        if best is None:
            for i in ids:
                out[i] = g / len(ids)
        else:
            inside = set(best[1])
            grow(best[1], level + 1)
            grow([i for i in ids if i not in inside], level + 1)

    grow(list(range(len(rows))), 0)
    return out


def test_trees_equal_a_plain_computation(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        x, c, z = rng.choice([None, float("nan"), *map(float, range(8))]), rng.choice(["p", "q", "r", None]), rng.choice([None, 1.0, 2.0])
        rows.append((i, x, c, z, round((5 if x is None or x != x else x) + {"p": 3, "q": -2}.get(c, 0) + (2 if z is None else 0) + rng.random(), 3)))
    df = spark.createDataFrame(rows, "id int, x double, c string, z double, y double")
    made = boosted.fit(df, ["c"], ["x", "z"], "y", rounds=3, depth=3, rate=0.5, least=15)
    bins = {r.id: list(r["_b"]) for r in made.binned(df).collect()}
    pred = {r.id: r.predicted for r in made.predict(df).collect()}
    plain = [sum(r[4] for r in rows) / len(rows)] * len(rows)
    for _ in range(3):
        step = tree_plainly([(bins[i], rows[i][4] - plain[i]) for i in range(300)], 3, 3, 15)
        plain = [p + 0.5 * s for p, s in zip(plain, step, strict=True)]
    assert max(abs(pred[i] - plain[i]) for i in range(300)) < 1e-4
    assert {b[0] for i, b in bins.items() if rows[i][1] is None or rows[i][1] != rows[i][1]} == {-1}
    assert math.isclose(sum(boosted.importance(made).values()), 1.0)


def test_missing_values_go_to_the_better_side(spark):
    rows = [(None if i % 4 == 0 else float(i % 50), "k", 90.0 if i % 4 == 0 or i % 50 > 40 else 10.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "x double, c string, y double")
    made = boosted.fit(df, ["c"], ["x"], "y", rounds=12, rate=0.5)
    root = made.trees[0]
    assert root.feature == 0 and not root.missing_left and boosted.importance(made)["x"] == 1.0
    new = spark.createDataFrame([(None, "unseen"), (3.0, None), (49.0, "k")], "x double, c string")
    assert [round(r.predicted) for r in made.predict(new).collect()] == [90, 10, 90]
    lag = df.withColumn("lag", F.lit(50.0))
    assert model.evaluate(made.predict(lag), "predicted", "y").first().mae < model.naive_mae(lag, "y", "lag").first().mae
    assert boosted.fit(df.limit(0), ["c"], ["x"], "y", rounds=1).predict(new).where("predicted = 0").count() == 3


# Judge


def answers_of(spark, n, extra=""):
    return spark.createDataFrame([(str(i), f"q{i}{extra}", "a", ["c"]) for i in range(n)], "question_id string, question string, answer string, context_texts array<string>")


def test_failed_calls_are_rows_and_are_asked_again(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def judge(broken):
        def ask(prompt, said):
            who = said.split("\n")[0]
            (log / f"{who}-{prompt}-{random.random()}").touch()
            if who in broken:
                raise TimeoutError("slow")
            return '{"score": 0.5, "relevance": 1, "correctness": 1, "insight": 0.2, "specificity": 0.2, "coverage": 0.2, "breadth": 0.2, "calibration": 0.2}'

        return ask

    calls = lambda: len(list(log.iterdir()))
    ledger = evaluate.JudgeLedger(spark, str(tmp_path / "ledger"))
    ten = answers_of(spark, 10)
    assert ledger.scores(ten).count() == 0
    assert ledger.run(ten, judge({"q3", "q7"})) == {"asked": 30, "answered": 24, "failed": 6} and calls() == 30
    assert ledger.scores(ten).select("question_id").distinct().count() == 8 and ledger.scores(ten).count() == 64
    assert {(r.question_id, r.error) for r in ledger.failures().collect()} == {("3", "TimeoutError: slow"), ("7", "TimeoutError: slow")}
    # A run that broke off has no effect.
    (tmp_path / "ledger" / "run=2").mkdir()
    assert ledger.run(ten, judge({"q7"}), tries=2) == {"asked": 6, "answered": 3, "failed": 3} and calls() == 30 + 3 + 6
    assert ledger.scores(ten).count() == 72 and ledger.run(ten, judge(set())) == {"asked": 3, "answered": 3, "failed": 0}
    assert ledger.run(ten, judge(set()))["asked"] == 0 and ledger.failures().count() == 0 and ledger.scores(ten).count() == 80
    # Another text is another question; its old scores no longer count.
    other = answers_of(spark, 1, "!")
    assert ledger.scores(other).count() == 0 and ledger.run(other, judge({"q0!"}), tries=3)["failed"] == 3
    assert ledger.run(other, judge({"q0!"}), tries=3)["asked"] == 3 and ledger.run(other, judge(set()))["asked"] == 0  # more than MOST


def test_latest_run_of_null_variants(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (None, 2, "c"), ("v", 5, "d"), ("w", None, "e")], "v string, run_at int, x string")
    assert sorted(r.x for r in evaluate.latest_run(df, ["v"]).collect()) == ["b", "c", "d"]


def test_store_registry(spark, tmp_path, monkeypatch):
    r = model.StoreRegistry(spark, str(tmp_path / "models"))
    assert r.aliases() == {} and r.register("a", 10.0) == (1, True) and r.register("b", 9.9) == (2, False) and r.register("c", 9.0) == (3, True)
    assert r.aliases() == {"challenger": 3, "champion": 3} and [v["name"] for v in r.versions()] == ["a", "b", "c"]
    own, seen = model.StoreRegistry.versions, []

    def late(self):  # another driver registers in between, once
        out = own(self)
        if not seen:
            seen.append(1)
            return out[:-1]
        return out

    monkeypatch.setattr(model.StoreRegistry, "versions", late)
    assert r.register("d", 9.5) == (4, False)


def test_pruned_search_broadcasts_neither_blocks_nor_queries(spark, monkeypatch):
    """Vectors that repeat fill small files; what is joined must not go through the driver by their size."""
    df = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(300)], "vid long, e array<double>")
    plans, own = [], pruned.written

    def watched(rows, tag):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return own(rows, tag)

    monkeypatch.setattr(pruned, "CENTROIDS", 16)
    monkeypatch.setattr(pruned, "written", watched)
    asked = df.where("vid % 20 = 0").select(F.col("vid").alias("qid"), "e")
    hits, _ = pruned.top_k(asked, pruned.group(df, "vid", "e"), 5, "qid", "vid", embedding="e")
    assert hits.count() == 75
    assert any("Join" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)


def test_fit_computes_its_rows_once(spark):
    """What lies behind the training rows, such as medians and lags, is not computed again for each pass."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    df = spark.range(60).select((F.col("id") % 3).cast("string").alias("c"), F.col("id").cast("double").alias("x"), counted(F.col("id").cast("double")).alias("y"))
    model.fit(df, ["c"], ["x"], "y", rounds=1, depth=1)
    print("computed", seen.value)
    assert seen.value <= 2 * 60  # the filter on the target may compute it once more
