"""Judge composites, strata means, gates and latest runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.repair import safe_double
from tessera.functions.text import clamp_score, format_contexts, verdict_json

#: Weights of the composite.
WEIGHTS = {"groundedness": 0.25, "relevance": 0.15, "insight": 0.20, "specificity": 0.10, "coverage": 0.10, "breadth": 0.15, "calibration": 0.05}
FLOOR, MIN_HOPS, COMPOSITE_TOLERANCE, NARROW_TOLERANCE = 0.6, 3.0, 0.05, 0.05


def composite() -> Column:
    """The weighted sum of the scores, NULL as 0, to four digits."""
    out = F.lit(0.0)
    for name, w in WEIGHTS.items():
        out = out + F.lit(w) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return F.round(out, 4)


def with_composite(scores: DataFrame) -> DataFrame:
    return scores.withColumn("composite", composite()).withColumn("floor_breach", F.coalesce("groundedness", F.lit(0.0)) < FLOOR)


def strata_means(rows: DataFrame, by: Sequence[str], columns: Sequence[str], digits: int | None = 4) -> DataFrame:
    """Means over what is a number; NULL if nothing is. n counts all rows."""
    mean = lambda c: F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[(F.round(mean(c), digits) if digits is not None else mean(c)).alias(f"mean_{c}") for c in columns])


def behaviour_gate(answers: DataFrame) -> DataFrame:
    """One row over all answers (tier, passed, error, hops): broad failures, mean broad hops, and the verdict."""
    broad = F.col("tier") == "broad"
    failures = F.count_if(broad & (F.coalesce("error", F.lit("")) != ""))
    hops = F.avg(F.when(broad, F.col("hops").cast("double")))
    return answers.agg(failures.alias("broad_failures"), hops.alias("broad_hops"), (F.coalesce(hops, F.lit(0.0)) > 1.5).alias("_h")).select("broad_failures", "broad_hops", ((F.col("broad_failures") == 0) & F.col("_h")).alias("passed"))


def verdict(candidate: DataFrame, goldens: DataFrame, baseline: DataFrame | None) -> DataFrame:
    """One row of the gate's checks and passed, from (category, hops, composite) rows.

    Broad hops >= 3; broad composite >= 95 % of the goldens'; narrow composite >= the
    baseline's less 0.05. No goldens fail; without a baseline, or an unjudged one, narrow
    is not held against the candidate.
    """
    mean = lambda cat, c: F.avg(F.when(F.col("category") == cat, F.col(c).cast("double")))
    row = candidate.agg(mean("broad", "hops").alias("hops"), mean("broad", "composite").alias("broad"), mean("narrow", "composite").alias("narrow"))
    row = row.join(goldens.agg(mean("broad", "composite").alias("golden")))  # one row each
    base = baseline.agg(mean("narrow", "composite").alias("base")) if baseline is not None else goldens.limit(1).agg(F.lit(None).cast("double").alias("base"))
    row = row.join(base)
    no = F.lit(False)
    hops_ok = F.coalesce(F.col("hops") >= MIN_HOPS, no)
    broad_ok = F.coalesce(F.col("broad") >= F.col("golden") * (1 - COMPOSITE_TOLERANCE), no)
    narrow_ok = F.col("base").isNull() | F.coalesce(F.col("narrow") >= F.col("base") - NARROW_TOLERANCE, no)
    return row.select("hops", "broad", "golden", "narrow", "base", hops_ok.alias("hops_ok"), broad_ok.alias("broad_ok"), narrow_ok.alias("narrow_ok"), (hops_ok & broad_ok & narrow_ok).alias("passed"))


def latest_run(rows: DataFrame, by: Sequence[str], at: str = "run_at") -> DataFrame:
    """All rows of each variant's last run: a partial maximum and a semi-join, so that few variants are not few tasks."""
    top = rows.groupBy(*by).agg(F.max(at).alias("_top")).select(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(by)], "_top")
    on = rows[at] == top["_top"]
    for i, c in enumerate(by):
        on = on & rows[c].eqNullSafe(top[f"_v{i}"])
    return rows.join(top, on, "left_semi")


def benchmark_summary(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cases, pass rate in percent and errors."""
    return rows.groupBy(*by).agg(F.count("*").alias("cases"), F.avg(F.when(F.col("passed"), 100.0).otherwise(0.0)).alias("pass_pct"), F.sum(F.when(F.coalesce("error", F.lit("")) != "", 1).otherwise(0)).alias("errors"))


def unjudged(answers: DataFrame, judged: DataFrame, key: str = "question_id") -> DataFrame:
    """Answers that have no score yet: what a resumed judge run takes."""
    return answers.join(judged.select(key).distinct(), key, "left_anti")


#: The three prompts' feedback fields.
JUDGED = {"groundedness": ("score",), "relevance_correctness": ("relevance", "correctness"), "depth": ("insight", "specificity", "coverage", "breadth", "calibration")}


def _said() -> Column:
    return F.concat_ws("\n\n", F.col("question"), F.col("answer"), format_contexts(F.col("context_texts")))


def scores(replies: DataFrame) -> DataFrame:
    """(question_id, name, score) from (question_id, prompt, reply); a score that is no number is NULL, and so is that of a NULL reply."""
    fields = sorted({f for fs in JUDGED.values() for f in fs})
    parsed = replies.withColumn("v", verdict_json(F.col("reply"), ", ".join(f"{f} string" for f in fields)))
    wanted = F.create_map(*[x for p, fs in JUDGED.items() for x in (F.lit(p), F.array(*map(F.lit, fs)))])
    one = parsed.select("question_id", "prompt", "v", F.explode(F.element_at(wanted, F.col("prompt"))).alias("field"))
    raw = F.coalesce(*[F.when(F.col("field") == f, F.col(f"v.{f}")) for f in fields])
    name = F.when(F.col("field") == "score", F.col("prompt")).otherwise(F.col("field"))
    return one.select("question_id", name.alias("name"), clamp_score(safe_double(raw)).alias("score"))


def judge(answers: DataFrame, ask: Callable[[str, str], str]) -> DataFrame:
    """(question_id, name, score): eight scores by a given judge, ask(prompt name, text) -> reply.

    Answers have question_id, question, answer and context_texts. A reply without an
    object, a score that is no number, or a call that fails, leaves that score NULL; the
    others stand.
    """
    asked = answers.select(F.col("question_id").cast("string").alias("question_id"), _said().alias("said"), F.explode(F.array(*map(F.lit, JUDGED))).alias("prompt"))
    return scores(_asked(asked, ask, 1))


def _asked(due: DataFrame, ask: Callable[[str, str], str], tries: int) -> DataFrame:
    """(question_id, prompt, text_sha, reply, error, tries): a call that fails is a row with its error, never a failed task."""

    def go(parts):
        for pdf in parts:
            out = []
            for q, prompt, said in zip(pdf["question_id"], pdf["prompt"], pdf["said"], strict=True):
                for n in range(1, tries + 1):
                    try:
                        out.append((q, prompt, said, ask(prompt, said), None, n))
                        break
                    except Exception as e:  # whatever the judge raises
                        failed = (q, prompt, said, None, f"{type(e).__name__}: {e}"[:500], n)
                else:
                    out.append(failed)
            yield pd.DataFrame(out, columns=["question_id", "prompt", "said", "reply", "error", "tries"])

    made = due.select("question_id", "prompt", "said").mapInPandas(go, "question_id string, prompt string, said string, reply string, error string, tries int")
    return made.select("question_id", "prompt", F.sha2("said", 256).alias("text_sha"), "reply", "error", "tries")


class JudgeLedger:
    """Judge calls by record, prompt and text, kept under ``run=<n>``, so that a run that broke off or failed in part is taken up where it was.

    A record that is asked about again with another text is due again. Calls that failed
    are due until MOST of them have been recorded in all runs.
    """

    MOST = 5

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def attempts(self) -> DataFrame | None:
        """All recorded calls, with the number of their run; runs that are not complete have none."""
        from tessera.sources.landing import exists, names

        runs = [n for n in names(self.spark, self.root) if n.startswith("run=") and exists(self.spark, f"{self.root}/{n}/_SUCCESS")]
        return self.spark.read.option("basePath", self.root).parquet(*[f"{self.root}/{n}" for n in runs]) if runs else None

    def due(self, answers: DataFrame) -> DataFrame:
        """(question_id, prompt, said) of what has no reply yet."""
        asked = answers.select(F.col("question_id").cast("string").alias("question_id"), _said().alias("said"), F.explode(F.array(*map(F.lit, JUDGED))).alias("prompt"))
        known = self.attempts()
        if known is None:
            return asked
        key = ["question_id", "prompt", "text_sha"]
        over = known.groupBy(*key).agg(F.max(F.col("error").isNull()).alias("done"), F.sum("tries").alias("tries")).where(F.col("done") | (F.col("tries") >= self.MOST))
        return asked.withColumn("text_sha", F.sha2("said", 256)).join(over, key, "left_anti").drop("text_sha")

    def run(self, answers: DataFrame, ask: Callable[[str, str], str], tries: int = 1) -> dict[str, int]:
        """Asks for what is due and records it: calls asked, answered and failed. Each call is made once a run, unless its task is lost."""
        from tessera.sources.landing import names

        number = max([int(n[4:]) for n in names(self.spark, self.root) if n.startswith("run=")], default=0) + 1
        path = f"{self.root}/run={number}"
        _asked(self.due(answers), ask, tries).write.parquet(path)
        row = self.spark.read.parquet(path).agg(F.count("*").alias("asked"), F.count_if(F.col("error").isNull()).alias("answered"), F.count_if(F.col("error").isNotNull()).alias("failed")).first()
        return row.asDict()

    def scores(self, answers: DataFrame) -> DataFrame:
        """(question_id, name, score) of the answers as they are now, from the last reply to each; records without one have none."""
        known = self.attempts()
        asked = answers.select(F.col("question_id").cast("string").alias("question_id"), F.sha2(_said(), 256).alias("text_sha")).distinct()
        if known is None:
            known = self.spark.createDataFrame([], "question_id string, prompt string, text_sha string, reply string, error string, tries int, run int")
        last = known.where("error IS NULL").join(asked, ["question_id", "text_sha"], "left_semi").groupBy("question_id", "prompt").agg(F.max_by("reply", "run").alias("reply"))
        return scores(last)

    def failures(self) -> DataFrame:
        """(question_id, prompt, error, tries) of calls that no run has had an answer to."""
        known = self.attempts()
        by = known.groupBy("question_id", "prompt", "text_sha").agg(F.max(F.col("error").isNull()).alias("done"), F.max_by("error", "run").alias("error"), F.sum("tries").alias("tries"))
        return by.where("NOT done").select("question_id", "prompt", "error", "tries")
