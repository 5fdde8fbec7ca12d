"""Values of any kind in JSON records."""

import json

from pyspark.sql import functions as F

from tessera.functions import permissive as p
from tessera.operators import corpus


def read(spark, records, how, *more):
    rows = spark.createDataFrame(list(enumerate(records)), "i int, r string").withColumn("v", p.as_object(F.col("r")))
    return [r.x for r in rows.select("i", how(F.col("v"), "$.x", *more).alias("x")).orderBy("i").collect()]


def test_scalars(spark):
    said = [json.dumps({"x": x}) for x in (3, "3", " 4 ", 3.7, "3.7", True, None, "", "a", [1], {"y": 1}, -2.9)] + ["{}", "no json", "[1]", None, '"x"']
    nothing = [None] * 5
    assert read(spark, said, p.as_int) == [3, 3, 4, 3, None, 1, None, None, None, None, None, -2] + nothing
    assert read(spark, said, p.as_int, 0)[6:9] == [0, 0, 0]
    assert read(spark, said, p.as_float) == [3.0, 3.0, 4.0, 3.7, 3.7, 1.0, None, None, None, None, None, -2.9] + nothing
    assert read(spark, said, p.as_flag) == [True] * 6 + [False, False, True, True, True, True] + [False] * 5
    assert read(spark, [json.dumps({"x": x}) for x in (0, 0.0, False, [], {}, "0")], p.as_flag) == [False] * 5 + [True]
    assert read(spark, said[:2] + said[6:9], p.as_text) == ["3", "3", None, None, "a"] and read(spark, said[6:8], p.as_text, "") == ["", ""]


def test_lists_and_vectors(spark):
    said = [json.dumps({"x": x}) for x in (["a", None, 1, {"b": 2}], [], "s", 5, None, [1, 2.5], ["1"], [1, None], {"k": 1})] + ["{}", "broken"]
    assert read(spark, said, p.as_strings) == [["a", "1", '{"b":2}'], [], ["s"], ["5"], [], ["1", "2.5"], ["1"], ["1"], ['{"k":1}'], [], []]
    assert read(spark, said, p.as_vector) == [None, [], None, None, None, [1.0, 2.5], None, None, None, None, None]
    assert read(spark, said[:3] + said[4:5], p.as_json_list) == ['["a",null,1,{"b":2}]', "[]", '"s"', "[]"]


def test_all_fields_of_answers(spark):
    full = {"question_id": 7, "question": "q", "answer": "a", "contexts": [{"t": "é"}], "queries": [], "iterations": "4", "scores": {"coverage": 0.5, "calibration": "x"}, "composite": "0.25", "cap_applied": 1, "judge_error": None}
    df = spark.createDataFrame([(json.dumps(full, ensure_ascii=False),), ("{}",), ("[]",), (None,)], "record string")
    one, empty = corpus.golden_answer_table(df, "bench").orderBy(F.col("question_id").isNull()).collect()
    assert len(one) == 31 and set(one.asDict()) == {n for fs in corpus.ANSWER_FIELDS.values() for n, _ in fs} | {"source"}
    assert (one.question_id, one.answer_md, one.contexts_json, one.queries_json, one.iterations, one.coverage, one.calibration, one.faithfulness, one.composite, one.cap_applied) == ("7", "a", '[{"t":"é"}]', "[]", 4, 0.5, None, None, 0.25, True)
    assert (empty.question_id, empty.answer_md, empty.chunk_ids_json, empty.llm_calls, empty.composite, empty.cap_applied, empty.judge_error, empty.source) == (None, "", "[]", 0, None, False, "", "bench")


def test_eval_runs_with_nested_payloads(spark):
    nested = {"z": [{"b": 1, "a": {"d": None, "c": "é"}}], "kind": "matrix", "entries": [1, 2], "entry_count": 0, "run_id": ""}
    df = spark.createDataFrame([("out/judge-1.json", json.dumps(nested)), ("eval_x.json", '{"run_id": "r", "entries": 3, "created_at": "t"}'), ("a-b.json", "broken")], "file_name string, payload string")
    got = {r.source_file: r for r in corpus.eval_run_table(df).collect()}
    j, e, b = got["out/judge-1.json"], got["eval_x.json"], got["a-b.json"]
    assert (j.run_id, j.kind, j.entry_count, j.payload_json) == ("out/judge-1.json", "matrix", None, json.dumps(nested, sort_keys=True, separators=(",", ":"), ensure_ascii=False))
    assert (e.run_id, e.kind, e.created_at, e.entry_count) == ("r", "eval_x", "t", 3) and (b.run_id, b.kind, b.payload_json) == ("a-b.json", "a", "{}")
