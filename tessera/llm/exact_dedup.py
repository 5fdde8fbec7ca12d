"""Exact deduplication by distributed MSD radix partitioning.

Documents are split by successive stretches of their normalised text. A group is the set
of documents that have agreed so far and has a number; each round splits every group by
the members' next stretch (FIRST characters, then GROWTH times as many), and the parts
get numbers of their own. So the key of a round is the group's number and the next
stretch alone: what was compared before is not moved or compared again. A part of one
document is done; so is a part whose texts ended within the stretch, and its members
are equal, stretch by stretch: no digest decides. Only what is left enters the next round.

Counts are partial sums before the shuffle, so a group with a third of all rows costs
one row for each task. The counted parts are written first, so that the join of documents
to them is one of two plain exchanges, which AQE can split where it is hot.

Defined results: null text equals the empty text; null doc_ids are never preferred to
others and a group of nulls only keeps one of them; of repeated rows that hold the
largest doc_id, one stays; an empty table gives no rows. Carried columns may have any
names: they travel in a struct.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import ascii_lower, discard, materialise, whole_text

FIRST = 256
GROWTH = 16


def radix_groups(docs: DataFrame, carry: list[str], with_text: bool) -> DataFrame:
    """One row per document: the carried columns in a struct row, text if asked for, keep_id, group_size, kept, text_sha256.

    The rest of a text is moved once in each round; with_text moves it whole.
    """
    whole = ascii_lower(whole_text())
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("doc_id").alias("id"), F.sha2(whole, 256).alias("sha"),
        F.lit(0).cast("long").alias("g"), (F.col("text").cast("string") if with_text else whole).alias("rest"), F.monotonically_increasing_id().alias("no"),
    )
    done, at, width, turn = [], 0, FIRST, 0
    while True:
        # Without with_text the stretches before this one are gone from rest.
        begin = at if with_text else 0
        low = ascii_lower(F.coalesce("rest", F.lit(""))) if with_text else F.col("rest")
        keyed = rows.select("*", F.substring(low, begin + 1, width).alias("stretch"))
        parts = keyed.groupBy("g", "stretch").agg(F.count("*").alias("n"), F.max("id").alias("keep")).where("n > 1")
        parts = materialise(parts.withColumn("part", F.monotonically_increasing_id()), "radix-parts")
        split = keyed.join(parts, ["g", "stretch"], "left")
        ended = F.col("n").isNull() | (F.char_length("stretch") < width)
        left = F.col("rest") if with_text else F.when(~ended, F.substring("rest", width + 1, 1 << 30))
        split = split.select("row", "id", "sha", "no", "n", "keep", F.col("part").alias("g"), F.lit(turn).alias("turn"), left.alias("rest"), ended.alias("ended"))
        split = materialise(split, "radix-split")
        discard(parts)
        done.append(split.where("ended").drop("ended"))
        rows = split.where("NOT ended").select("row", "id", "sha", "g", "rest", "no")
        if rows.isEmpty():
            break
        at, width, turn = at + width, width * GROWTH, turn + 1
    return _decide(reduce(DataFrame.unionByName, done), with_text)


def _decide(done: DataFrame, with_text: bool) -> DataFrame:
    size, stays = F.coalesce("n", F.lit(1)).cast("long"), F.col("id").eqNullSafe(F.col("keep"))
    out = lambda df, keep, kept: df.select(
        "row", *([F.col("rest").alias("text")] if with_text else []), keep.alias("keep_id"), size.alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256")
    )
    alone, many = done.where(size == 1), done.where(size > 1)
    # Usually one row a group; of repeated rows, that with the least number stays.
    first = many.where(stays).groupBy("turn", "g").agg(F.min("no").alias("first"))
    top = many.where(stays).join(first, ["turn", "g"])
    keep = F.col("keep")
    return out(alone, F.col("id"), F.lit(True)).unionByName(out(many.where(~stays), keep, F.lit(False))).unionByName(out(top, keep, F.col("no") == F.col("first")))


def exact_groups(docs: DataFrame) -> DataFrame:
    """The rows of the op6 query."""
    return radix_groups(docs, ["doc_id"], False).select("row.*", "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """docs without the copies: all of its columns, one row of each group."""
    out = radix_groups(docs, [c for c in docs.columns if c != "text"], True).where("kept")
    return out.select(*[F.col("text" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns])
