import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import repair, text


def col(spark, values, f, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r.y for r in df.select(f(F.col("x")).alias("y")).collect()]


def test_safe_double_refuses_what_is_no_number(spark):
    got = col(spark, ["1", " 2.5 ", ".5", "1e3", "NaN", "Infinity", "1d", "", None, "x"], repair.safe_double)
    assert got == [1.0, 2.5, 0.5, 1000.0, None, None, None, None, None, None]


def test_digits_from_floatish(spark):
    assert col(spark, ["20150416", "20150416.0", "2.0150416E7", "2.7", "-1", "1e300", None], repair.digits_from_floatish) == ["20150416"] * 3 + ["2", "-1", None, None]


def test_dates(spark):
    assert col(spark, ["20150416.0", "20159999", "170823.0", "not-a-date"], repair.compact_date) == [dt.date(2015, 4, 16), None, None, None]
    assert col(spark, ["2026-03-15T00:00", "9999-99-99", "junk", None], repair.iso_date) == [dt.date(2026, 3, 15), None, None, None]


def test_bands_and_titles(spark):
    assert col(spark, [-1.0, 399.9, 400.0, 700.0, 1000.0, 5000.0, None], repair.area_band, "double") == ["<400", "<400", "400-700", "700-1000", "1000-5000", "5000+", None]
    assert col(spark, [0, 3, 5, 9, None], repair.count_band, "int") == ["0", "3", "5+", "5+", "unknown"]
    assert col(spark, [" BRIGHTON-LE-SANDS "], repair.title_by_space) == ["Brighton-le-sands"]
    assert col(spark, [" BRIGHTON-LE-SANDS "], repair.title_by_run) == ["Brighton-Le-Sands"]
    assert col(spark, ["61.9", "x", None, "6000"], repair.clock) == ["01:01", "00:00", "00:00", "100:00"]


def test_graders(spark):
    assert col(spark, ["$1,350.50 a week", "none"], lambda c: text.value_grade(c, F.lit(1350.0))) == [True, False]
    assert col(spark, ["2063, 2026", "20634"], lambda c: text.topk_grade(c, F.array(F.lit("2063"), F.lit("2026")), 1)) == [True, False]
    assert col(spark, ["I do NOT HAVE that", "42", None], text.refusal_grade) == [True, False, False]
    assert col(spark, [1.5, -1.0, float("nan"), None], text.clamp_score, "double") == [1.0, 0.0, None, None]
    got = col(spark, ['so {"score": 0.5} ok', "no"], lambda c: text.verdict_json(c, "score double")["score"])
    assert got == [0.5, None]


def test_formatting(spark):
    df = spark.createDataFrame([(["a", " ", None, "b"], ["across 3 calls", "search: x", "retrieve: y", "z"])], "c array<string>, l array<string>")
    r = df.select(text.format_contexts(F.col("c")).alias("c"), text.hops(F.col("l")).alias("h"), text.format_contexts(F.array().cast("array<string>")).alias("e")).first()
    assert (r.c, r.h, r.e) == ("[1] a\n\n---\n\n[2] b", 5, "(none)")
    assert col(spark, ["- a\n\n• b\nc\nd", ""], lambda c: text.sub_questions(c, F.lit("q"))) == [["a", "b", "c"], ["q"]]
    assert col(spark, ["plain", '[{"type":"reasoning","text":"r"},{"type":"text","text":"t"}]', None], text.message_text) == ["plain", "t", ""]
