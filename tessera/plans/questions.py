"""A question set for agents over a corpus: broad ones need several searches, narrow ones a single one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUESTIONS = [
    ("broad-1", "broad", "Which views on house prices recur across the talks, and where do the speakers disagree?"),
    ("broad-2", "broad", "How has the advice to first-time buyers changed over the years?"),
    ("broad-3", "broad", "Compare what is said of renting and of owning, with the reasons given for each."),
    ("broad-4", "broad", "Which causes of high rents are named, and which of them by more than one speaker?"),
    ("broad-5", "broad", "What risks for investors come up, and how do the speakers suggest to meet them?"),
    ("broad-6", "broad", "Summarise the measures that governments are asked to take, by theme."),
    ("narrow-1", "narrow", "What deposit is recommended before buying a flat?"),
    ("narrow-2", "narrow", "Who explains how a bond is lodged, and in which talk?"),
    ("narrow-3", "narrow", "What is meant by gross yield?"),
    ("narrow-4", "narrow", "Which suburb is given as an example of falling prices?"),
    ("narrow-5", "narrow", "How long does a settlement usually take?"),
    ("narrow-6", "narrow", "What does a strata fee pay for?"),
]


def question_set(spark: SparkSession, tier: str | None = None) -> DataFrame:
    """(question_id, tier, question), of one tier if one is given."""
    rows = [q for q in QUESTIONS if tier in (None, q[1])]
    return spark.createDataFrame(rows, "question_id string, tier string, question string")
