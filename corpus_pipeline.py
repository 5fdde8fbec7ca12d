"""Corpus pipeline: toxicity, exact copies, near copies, benchmark leaks, then token ids.

Each stage reads whole texts of all rows that the one before kept, and returns the columns
of documents, whatever their names; the last one has digests instead of the text.

Defined results: a null text is like an empty one and is not toxic; of equal texts the
largest doc_id stays, of near copies the least, null last; of rows that are wholly alike
one stays; texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, decontamination, exact_dedup, simhash, toxicity
from tessera.llm.queries import vocabulary
from tessera.llm.shared import discard, materialise, read

#: Nothing here has SQL for the learnt toxicity model.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar does not call toxic; it learns from documents and labels of the folder."""
    model = toxicity.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of op7's links (SimHash, BK-trees) and of near copies beyond them (five-word shingles, 0.8 or more): the least doc_id."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, without the text."""
    return bpe.digests(docs, vocabulary()).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again in the shared folder; a table goes once the next one is written."""
    docs, used = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        if used is not None:
            discard(used)
        used = docs
    return STAGES[-1][1](spark, docs, sf_dir)
