import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import corpus, evaluate, features, forecast, marts, model, monitor, quality, retrieval, versions
from tessera.plans import agents, sqlrun
from tessera.plans.pipeline import Datasets

ts = lambda s: dt.datetime.fromisoformat(s)


def test_flags_keep_rows_and_null_does_not_flag(spark):
    df = spark.createDataFrame([(1, None), (2, "COMMERCIAL"), (3, "RESIDENCE")], "id int, purpose string")
    out = quality.flag(df, [quality.Rule("not_residence", F.col("purpose") != "RESIDENCE")])
    assert {r.id: r._is_valid for r in out.collect()} == {1: True, 2: False, 3: True}
    total = quality.summary(out.withColumn("m", F.lit("x")), "m").agg(F.sum("rows")).first()[0]
    assert total == 3


def test_checks_raise_once_with_all_names(spark):
    df = spark.range(3)
    with pytest.raises(quality.CheckFailed, match="a: 3 rows; c: 1 rows"):
        quality.run_checks({"a": df, "b": df.where("id > 9"), "c": df.where("id = 1")})
    kept, counts = quality.expect(df, {"small": F.col("id") < 2}, "drop")
    assert counts == {"small": 1} and kept.count() == 2


def test_versions_ties_and_foreign_files(spark):
    rows = [("/a/m=1_0000000a.parquet", ts("2026-01-01"), "old"), ("/a/m=1_0000000b.parquet", ts("2026-01-01"), "new"), ("/a/m=1_0000000b.parquet", ts("2026-01-01"), "new2"), ("/a/other.csv", ts("2027-01-01"), "csv")]
    df = spark.createDataFrame(rows, "_source_file string, _ingested_at timestamp, marker string")
    assert {r.marker for r in versions.resolve_versions(df).collect()} == {"new", "new2"}


def test_reconcile_null_keys_and_comeback(spark):
    state = spark.createDataFrame([(None, "a", False, ts("2026-01-01")), (1, "b", True, ts("2026-01-01"))], "k int, v string, is_current boolean, _synced_at timestamp")
    snap = spark.createDataFrame([(None, "c")], "k int, v string")
    got = {r.k: (r.v, r.is_current, r._synced_at.day) for r in versions.reconcile(state, snap, ["k"], ["v"], F.to_timestamp(F.lit("2026-01-02"))).collect()}
    assert got == {None: ("c", True, 2), 1: ("b", False, 1)}
    again = versions.reconcile(versions.reconcile(state, snap, ["k"], ["v"], F.lit(None).cast("timestamp")), snap, ["k"], ["v"], F.lit(None).cast("timestamp"))
    assert again.count() == 2


def test_yield_ratio_and_floor(spark):
    k = ("p", "t", "m")
    s = spark.createDataFrame([("2000", "house", "6", 6_000_000.0, 6), ("2327", "house", "6", 2_000_000.0, 2)], "p string, t string, m string, v double, n long")
    r = spark.createDataFrame([("2000", "house", "6", 6000.0, 6), ("2327", "house", "6", 2000.0, 2)], "p string, t string, m string, w double, c long")
    out = marts.ratio_mart(s, r, k, ("w", "c"), ("v", "n"), "y", 5200.0, 5).collect()
    assert [(x.p, x.y, x.v, x.n) for x in out] == [("2000", 5.2, 6_000_000.0, 6)]


def month(i):
    return dt.date(2020 + i // 12, i % 12 + 1, 1)


def test_lags_need_calendar_neighbours(spark):
    df = spark.createDataFrame([("a", month(0), 1.0), ("a", month(2), 2.0), ("a", month(3), 3.0)], "k string, month date, y double")
    got = {r.month: r.y_lag_1 for r in features.calendar_lags(df, ["k"], "month", "y", [1], "y").collect()}
    assert got == {month(0): None, month(2): None, month(3): 2.0}


def test_features_do_not_see_their_own_month(spark):
    def build(last):
        rent = [("1", "h", month(i), 500.0 + i, 500.0 + i, 10) for i in range(7)] + [("1", "h", month(7), last, last, 10)]
        sale = [("1", "h", month(i), 1e6, 2) for i in range(8)]
        r = spark.createDataFrame(rent, "p string, t string, month date, avg_weekly_rent double, median_weekly_rent double, n_rented long")
        s = spark.createDataFrame(sale, "p string, t string, month date, total_sale_value double, n_sold long")
        return [x.asDict() for x in features.build(r, s, ["p", "t"], ["t"]).where(F.col("month") == month(7)).drop("median_weekly_rent").collect()]

    assert build(520.0) == build(999.0) and len(build(1.0)) == 1


def test_forecast_recovers_a_clean_signal(spark):
    rows = [("a", month(i), 100 + 0.5 * i + (i % 12)) for i in range(60)] + [("b", month(i), 1.0) for i in range(10)]
    df = spark.createDataFrame([(k, m, float(y)) for k, m, y in rows], "k string, month date, y double")
    out = {r.month: r.yhat for r in forecast.trend_seasonal(df, ["k"], "month", "y", 12).collect()}
    assert len(out) == 12 and all(abs(out[month(60 + h)] - (100 + 0.5 * (60 + h) + h)) < 1e-6 for h in range(12))
    naive = {r.month: r.yhat for r in forecast.seasonal_naive(df, ["k"], "month", "y", 3).collect()}
    assert naive[month(60)] == 100 + 0.5 * 48
    best = forecast.best_method(forecast.backtest(df, ["k"], "month", "y", 6)).first()
    assert best.method == "trend_seasonal"
    assert forecast.damped_holt(df, ["k"], "month", "y", 3, "k string, month date, yhat double").count() == 3


def test_psi(spark):
    a = spark.range(100).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("gone"), F.lit(1.0).alias("one"))
    b = a.withColumn("x", F.col("x") + 200)
    same = {r.feature: (r.psi, r.status) for r in monitor.psi(a, a, ["x", "gone", "one"]).collect()}
    assert same["x"] == (0.0, "stable") and same["gone"][1] == "unmonitorable" and same["one"][0] == 0.0
    assert monitor.psi(a, b, ["x"]).first().status == "shifted"
    assert monitor.max_monitorable(monitor.psi(a, a, ["gone"])).first().max_psi == 0.0


def test_model_beats_naive_and_survives_unseen(spark):
    rows = spark.range(400).select((F.col("id") % 3).cast("string").alias("c"), F.when(F.col("id") % 10 != 0, F.rand(1) * 100).alias("lag"), F.rand(2).alias("z"))
    rows = rows.withColumn("y", 3 * F.coalesce("lag", F.lit(50.0)) + 20)
    fitted = model.fit(rows, ["c"], ["lag", "z"], "y", rounds=5)
    scored = model.score(fitted, rows.withColumn("c", F.lit("new")), ["lag", "z"])
    assert model.evaluate(scored, "predicted", "y").first().mae < model.naive_mae(rows, "y", "lag").first().mae
    assert model.challenger_wins(1.0, None) and not model.challenger_wins(0.98, 1.0) and model.challenger_wins(0.979, 1.0)


def test_registry(tmp_path):
    r = model.Registry(str(tmp_path / "r.json"))
    assert [r.register("a", 10.0), r.register("b", 9.9), r.register("c", 5.0)] == [(1, True), (2, False), (3, True)]


def test_corpus_parsers(spark):
    doc = json.dumps({"segments": [{"text": "a", "offset_ms": 1, "start_seconds": 0.5}, "junk", {"text": "b"}], "description": "", "tags": ["t", None]})
    df = spark.createDataFrame([("v", doc, "meta"), ("w", "not json", None)], "video_id string, document string, description string")
    assert [(r.segment_index, r.text) for r in corpus.segment_rows(df).orderBy("segment_index").collect()] == [(0, "a"), (2, "b")]
    t = {r.video_id: (r.description, r.tags, r.n_segments) for r in corpus.transcript_rows(df).collect()}
    assert t["w"] == ("", [], 0) and t["v"][0] == "meta"
    g = corpus.graph_rows(spark.createDataFrame([("s", '{"entities":[{"name":"n"}],"relations":[],"claims":[{"text":"c","entity":"e"}]}')], "chunk_sha string, extraction string"))
    assert g["graph_entities"].first().aliases == [] and g["graph_claims"].first().subject == "e" and g["graph_relations"].count() == 0
    th = corpus.theme_rows(spark.createDataFrame([('{"themes":[{"id":"1"}]}',), ('[{"id":"2"}]',)], "payload string"))
    assert {r.theme_id for r in th.collect()} == {"1", "2"}


def test_frame_sha_ignores_order(spark):
    a = spark.createDataFrame([(1, "x", [1.5]), (2, None, None)], "i int, s string, v array<double>")
    sha = corpus.frame_sha(a).first().sha
    assert corpus.frame_sha(a.orderBy(F.desc("i")).select("v", "s", "i")).first().sha == sha
    assert corpus.frame_sha(a.union(a)).first().sha != sha and corpus.frame_sha(a.limit(0)).first().sha == "empty000"


def test_retrieval(spark):
    vec = spark.createDataFrame([(i, [float(i == j) for j in range(3)]) for i in range(3)] + [(3, [0.0, 0.0, 0.0])], "id long, embedding array<float>")
    top = retrieval.top_k(vec.select(F.col("id").alias("q"), "embedding").where("q = 0"), vec, 2, "q", "id").collect()
    assert [(r.id, r.rank) for r in sorted(top, key=lambda r: r["rank"])] == [(0, 1), (1, 2)]
    c = spark.createDataFrame([("a", ["x", "x", "y"], ["y"]), ("b", ["x"], []), ("c", ["p", "q"], ["q", "z"])], "case_id string, ranked array<string>, relevant array<string>")
    got = {r.case_id: (r.recall, r.mrr, round(r.ndcg, 3)) for r in retrieval.ir_metrics(c, 10).collect()}
    assert got["a"] == (1.0, 0.5, 0.631) and got["b"] == (0.0, 0.0, 0.0) and got["c"][:2] == (0.5, 0.5)
    state = spark.createDataFrame([("i", "video's-chunk-0", "s"), ("j", "k", "s")], "index_name string, chunk_key string, text_sha string")
    chunks = spark.createDataFrame([("k", True)], "chunk_key string, is_current boolean")
    assert [r.chunk_key for r in retrieval.stale(state, chunks, "i").collect()] == ["video's-chunk-0"]
    assert [r.index_name for r in retrieval.retire(state, chunks, "i").collect()] == ["j"]
    e = spark.createDataFrame([("k", "s", "a b")], "chunk_key string, text_sha string, embedding_text string")
    assert len(retrieval.embed(e, retrieval.hash_embedder(8)).first().embedding) == 8


def test_gate(spark):
    ddl = "category string, hops int, composite double"
    good = spark.createDataFrame([("broad", 8, 0.8), ("broad", 6, 0.7), ("narrow", 5, 0.6)], ddl)
    assert evaluate.verdict(good, good, None).first().passed
    assert not evaluate.verdict(good, good.limit(0), None).first().passed
    assert not evaluate.verdict(good.withColumn("hops", F.lit(1)), good, good).first().passed


def scripted(*replies):
    it = iter(replies)
    return lambda *a: next(it)


def test_sql_agent_retries_once_and_is_honest(spark):
    run, guard = agents.spark_runner(spark)
    out = agents.ask_sql("q", scripted("SQL", "select nope", "```sql\nselect 1 as x;\n```", "one"), run, guard)
    assert (out.text, out.rows) == ("one", [{"x": 1}])
    bad = agents.ask_sql("q", scripted("SQL", "drop table x", "delete from x"), run, guard)
    assert "could not be run" in bad.text and not bad.rows
    assert agents.ask_sql("q", scripted("ANSWER", "hi"), run, guard).text == "hi"


def test_corpus_agents():
    hits = lambda q, k: [{"chunk_key": q, "score": 0.5, "text": "t"}]
    assert agents.ask_corpus("q", scripted("a"), hits).hops == 1
    assert agents.ask_corpus("q", scripted("- a\n- b\n- c\n- d", "x"), hits, "multi").hops == 3
    again = json.dumps({"action": "search", "query": "q"})
    assert agents.ask_corpus("q", scripted(again, "x"), hits, "agentic", "v2").hops == 1
    assert agents.ask_corpus("q", scripted("nonsense", "answer", "x"), hits, "agentic", "v3").hops == 1
    many = [json.dumps({"action": "search", "query": f"q{i}"}) for i in range(9)]
    assert agents.ask_corpus("q", scripted(*many[:2], "x"), hits, "agentic", "v1").hops == 3
    call = {"content": "", "calls": [{"arguments": '{"query": "z"}'}, {"arguments": "bad"}]}
    out = agents.ask_react("q", lambda m, allowed: call if allowed else {"content": "done"}, hits)
    assert out.text == "done" and out.hops == 8 and {c["chunk_key"] for c in out.chunks} == {"z", "q"}


def test_sql_files_and_guard(spark):
    assert sqlrun.statements("-- c\nselect 1;\n-- only\n;\nselect ';' as x;\n") == ["-- c\nselect 1", "select ';' as x"]
    for bad in ("insert into t select 1", "select 1; select 2", "select 'drop'", "show tables"):
        with pytest.raises(ValueError):
            sqlrun.select_only(spark, bad)


def test_datasets_run_in_order(spark):
    d = Datasets()

    @d.dataset()
    def gold(silver):
        return silver.agg(F.sum("id").alias("s"))

    @d.dataset(expectations=lambda: {"small": F.col("id") < 3}, mode="drop")
    def silver(bronze):
        return bronze

    made, broken = d.run(spark, {"bronze": spark.range(5)})
    assert d.order() == ["silver", "gold"] and made["gold"].first().s == 3 and broken == {"silver": {"small": 2}}


def test_benchmark_rows_and_case_loader(spark, tmp_path):
    from tessera.sources.landing import load_cases

    def boom(q):
        raise RuntimeError("no")

    rows = agents.benchmark(spark, [{"id": "1", "question": "q"}], {"bad": boom, "ok": lambda q: agents.Answer("a")}).collect()
    assert {r.contender: (r.answer, r.error) for r in rows} == {"bad": ("", "no"), "ok": ("a", "")}
    (tmp_path / "c.json").write_text('[{"id": "x", "question": "q"}]')
    with pytest.raises(ValueError, match="case x: missing kind"):
        load_cases(str(tmp_path / "c.json"))


def test_judge_scores(spark):
    replies = {"groundedness": 'fine {"score": 0.9}', "relevance_correctness": '{"relevance": 2, "correctness": "x"}', "depth": "no object"}
    a = spark.createDataFrame([("1", "q", "a", ["c"])], "question_id string, question string, answer string, context_texts array<string>")
    got = {r.name: r.score for r in evaluate.judge(a, lambda prompt, said: replies[prompt]).collect()}
    assert len(got) == 8 and got["groundedness"] == 0.9 and got["relevance"] == 1.0 and got["correctness"] is None and got["insight"] is None


def test_reanchor_covers_all_documents(spark, tmp_path):
    from tessera.plans import catalogue

    rows = [(5, "a"), (8, "b"), (12, "a"), (100, "c"), (150, "b"), (998, "d"), (1000, "d"), (20000, "b"), (30001, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.case_id: r.chunk_key for r in catalogue.queries()["reanchor_chunks"](spark, str(tmp_path)).collect()}
    assert got == {5: None, 8: "k20000", 12: "k12", 100: "k100", 150: "k20000", 998: "k1000", 1000: "k1000", 20000: "k20000", 30001: None}


def test_contexts_and_boosting_use_the_defaults(spark, tmp_path, monkeypatch):
    import os

    from tessera.operators import model
    from tessera.plans import catalogue

    rows = [(1, t, "user", f"t{t}") for t in range(20)] + [(2, t, "user", f"u{t}") for t in range(5)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r.contexts for r in catalogue.queries()["context_collect"](spark, str(tmp_path)).collect()}
    assert got == {1: "|".join(f"t{t}" for t in range(16)), 2: "u0|u1|u2|u3|u4"}
    if os.path.isdir(sf := "/root/testdata/sf0.001"):
        seen = []
        monkeypatch.setattr(model, "fit", lambda *a, **k: seen.append((len(a), k)))
        monkeypatch.setattr(model, "score", lambda fitted, test, *a: test.select("postcode", "property_type", "month", "median_weekly_rent").withColumn("predicted_weekly_rent", F.lit(0.0)))
        catalogue.queries()["gbt_score"](spark, sf)
        assert seen == [(4, {})]


def test_top_k_equals_brute_force(spark, monkeypatch):
    import math
    import random

    rng = random.Random(3)
    monkeypatch.setattr(retrieval, "BLOCK", 7)
    monkeypatch.setattr(retrieval, "ASKED", 3)
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0, 0.5]) for _ in range(4)]) for i in range(40)] + [(40, None), (41, [0.0] * 4), (42, [1.0, 2.0]), (43, [1.0, None, 0.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = v.where("vec_id % 5 = 0").select(F.col("vec_id").alias("qid"), "embedding")

    def cos(a, b):
        size = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return round(sum(x * y for x, y in zip(a, b, strict=True)) / size, 12) if size else None

    good = [(i, x) for i, x in rows if x and None not in x and any(x)]
    want = {}
    for i, x in good:
        if i % 5 == 0:
            want[i] = [j for _, j in sorted((-cos(x, y), j) for j, y in good if j != i and len(y) == len(x))[:3]]
    for most in (10**9, 0):
        monkeypatch.setattr(retrieval, "MAX_NUMBERS", most)
        got = {}
        for r in sorted(retrieval.top_k(q, v, 3, "qid", "vec_id", exclude_self=True).collect(), key=lambda r: r["rank"]):
            got.setdefault(r.qid, []).append(r.vec_id)
        assert got == {k: x for k, x in want.items() if x}
    plan = lambda n: retrieval.top_k(v.limit(n).select(F.col("vec_id").alias("qid"), "embedding"), v, 3, "qid", "vec_id")._jdf.queryExecution().analyzed().toString().count("Join")
    assert plan(1) == plan(40) == 1


def test_ir_scores_equal_those_of_arrays(spark):
    ranked = spark.createDataFrame([(1, [5, 6, 7], [6, 9]), (2, [1], [2]), (3, [4], [])], "case_id long, ranked array<long>, relevant array<long>")
    hits = ranked.select("case_id", "relevant", F.posexplode("ranked").alias("p", "x")).select("case_id", (F.col("p") + 1).alias("rank"), F.array_contains("relevant", F.col("x")).alias("relevant"))
    a = {r.case_id: (r.recall, r.mrr, r.ndcg) for r in retrieval.ir_metrics(ranked, 2).collect()}
    b = {r.case_id: (r.recall, r.mrr, r.ndcg) for r in retrieval.ir_scores(hits, ranked.select("case_id", F.size("relevant").alias("n")), 2).collect()}
    assert a == b and a[1][0] == 0.5


def test_push_sends_once_and_raises_on_refused_keys(spark, tmp_path):
    v = spark.createDataFrame([(f"k{i}", "s") for i in range(5)], "chunk_key string, text_sha string")
    state = spark.createDataFrame([("idx", "k0", "s"), ("other", "k1", "s")], "index_name string, chunk_key string, text_sha string")
    with pytest.raises(retrieval.PushFailed, match="1 keys, among them k3"):
        retrieval.push(v, state, "idx", lambda rows: [r["chunk_key"] for r in rows if r["chunk_key"] == "k3"], str(tmp_path / "a"), 2)
    new = retrieval.push(v, state, "idx", lambda rows: [] if len(rows) <= 2 else ["too many"], str(tmp_path / "b"), 2)
    assert new.where("index_name = 'idx'").count() == 5 and spark.read.parquet(str(tmp_path / "b")).count() == 4
    assert retrieval.to_sync(v, new, "idx").count() == 0


def test_embed_pending_adds_what_is_missing(spark):
    chunks = spark.createDataFrame([("a", "1", "x"), ("b", "1", "y"), ("b", "2", "z")], "chunk_key string, text_sha string, embedding_text string")
    cache = spark.createDataFrame([("a", "1", [1.0])], "chunk_key string, text_sha string, embedding array<float>")
    out = {(r.chunk_key, r.text_sha): r.embedding for r in retrieval.embed_pending(chunks, cache, retrieval.hash_embedder(1)).collect()}
    assert len(out) == 3 and out["a", "1"] == [1.0]


def test_best_copy_breaks_ties(spark):
    hits = spark.createDataFrame([("a", 0.5, "z"), ("a", 0.5, "b"), ("c", None, "q")], "k string, score double, t string")
    assert [(r.k, r.t) for r in retrieval.best_copy(hits, "k").collect()] == [("a", "b"), ("c", "q")]


def test_batch_score_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(m, float(i), 2.0 * i) for m in ("2020-01-01", "2020-02-01") for i in range(30)], "month string, x double, y double").withColumn("month", F.to_date("month"))
    fitted = model.fit(df, [], ["x"], "y", rounds=2)
    for _ in range(2):
        model.batch_score(fitted, df, ["x"], "month", 3, F.lit("2026-01-01").cast("timestamp"), str(tmp_path / "p"))
    out = spark.read.parquet(str(tmp_path / "p"))
    assert out.count() == 30 and {(r.month.month, r.model_version) for r in out.collect()} == {(2, 3)}


def test_tables_from_queries(spark):
    from tessera.sources import sinks

    sinks.create_table(spark, "tq", {"a": ("INT", "it's a"), "b": ("STRING", "")}, "c")
    sinks.insert_select(spark, "tq", "SELECT 'x' AS b, 1 AS a", ["b", "a"])
    sinks.insert_select(spark, "tq", "SELECT 2, 'y'")
    sinks.comment(spark, "tq", "it's new")
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED tq").collect()}
    assert sorted(map(tuple, spark.table("tq").collect())) == [(1, "x"), (2, "y")] and info["Comment"] == "it's new"
    for n in (3, 4):
        sinks.create_as(spark, "tq2", f"SELECT a + {n} AS a FROM tq")
    assert sorted(r.a for r in spark.table("tq2").collect()) == [5, 6] and "Scan" in sqlrun.explain(spark, "SELECT * FROM tq2")
    spark.sql("DROP TABLE tq")
    spark.sql("DROP TABLE tq2")


def test_recent_dates(spark):
    from tessera.functions.metrics import recent

    df = spark.createDataFrame([(dt.date(2026, 1, 1),), (dt.date(2025, 1, 1),)], "d date")
    assert [r.d.year for r in df.where(recent(F.col("d"), 365, F.lit("2026-01-02").cast("date"))).collect()] == [2026]


def test_command_line(spark, tmp_path, capsys):
    from tessera import cli

    assert cli.main(["list"]) == 0 and "monthly_mart_orders" in capsys.readouterr().out
    assert cli.main(["run", "no_such", "x"]) == 2
    with pytest.raises(SystemExit) as e:
        cli.main(["parity"])
    assert e.value.code == 2
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(5).selectExpr("id", "id * 2 AS v").write.parquet(a)
    spark.range(5).selectExpr("id", "id * 2 + int(id = 3) AS v").write.parquet(b)
    assert cli.main(["parity", a, a, "--keys", "id", "--columns", "v"], spark) == 0
    assert cli.main(["parity", a, b, "--keys", "id", "--columns", "v"], spark) == 1
    f = tmp_path / "q.sql"
    f.write_text("SELECT 1 AS a;\n-- a comment\n;\nSELECT 'x', 2;\n")
    capsys.readouterr()
    assert cli.main(["sql", str(f)], spark) == 0 and capsys.readouterr().out.split() == ["1", "x", "2"]


def test_question_set(spark):
    from tessera.plans.questions import question_set

    assert question_set(spark).groupBy("tier").count().where("count = 6").count() == 2 and question_set(spark, "narrow").count() == 6


def test_warnings_are_counted_without_a_job(spark):
    d = Datasets()

    @d.dataset(expectations=lambda: {"small": F.col("id") < 3})
    def silver(bronze):
        return bronze

    made, broken = d.run(spark, {"bronze": spark.range(5)})
    assert made["silver"].count() == 5 and broken["silver"].get == {"small": 2}


def test_registry_takes_one_driver_at_a_time(tmp_path):
    (tmp_path / "r.lock").touch()
    with pytest.raises(FileExistsError):
        model.Registry(str(tmp_path / "r.json")).register("a", 1.0)


def test_row_filter_leaves_no_view(spark):
    from tessera.sources.sinks import row_filter

    out = row_filter(spark, "tessera_small", "id", "bigint", "x < 2", spark.range(5))
    assert out.count() == 2 and not [t for t in spark.catalog.listTables() if "filtered" in t.name]


def test_top_k_holds_scores_of_few_queries_at_once(spark, monkeypatch):
    """A pair of blocks is scored PART queries at a time, with the same rows."""
    v = spark.range(1, 41).select(F.col("id").alias("vec_id"), F.array(*[F.sin(F.col("id") * i) for i in (1, 2, 3)]).alias("embedding"))
    q = v.select(F.col("vec_id").alias("qid"), "embedding")
    find = lambda: sorted(map(tuple, retrieval.top_k(q, v, 3, "qid", "vec_id", exclude_self=True).collect()))
    whole = find()
    monkeypatch.setattr(retrieval, "PART", 7)
    assert find() == whole and len(whole) == 120
