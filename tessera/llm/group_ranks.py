"""Ranking within groups, ties included: salted local pruning, then positions by range partition.

``top_places`` returns the rows of each group whose place, 1 plus the number of distinct
earlier ranks, is at most ``limit``: with their position in the group and the number of
group rows of equal rank. No group has to fit into a task:

1. Groups fall into BUCKETS buckets, whose rows are counted. Groups of a bucket with more
   rows than a fair part are salted: at most BUCKETS / 4 buckets are, at any size, so
   their number of salts goes out by broadcast. A salt depends on the row and on the
   partition that it is read from, so that equal rows spread too.
2. Rows of a (group, salt) whose local place is beyond the limit go: among more rows the
   place is no less.
3. What is left is sorted by range partition. A row's number there, less that of the
   first row of equal group and rank in its partition, is its position among its equals
   in that partition.
4. Counts for each (partition, group, rank), the partition being the salt, add up to
   ``tied``; their sums over earlier partitions and over earlier ranks of the group are
   the carries that complete position and place.

Nothing that grows with the rows meets in one task: the windows of step 4 see one row for
each rank that some salt has kept, and one for each partition that a rank lies in.

Defined results: a null in a group, rank or order column is a value like others; nulls
come last and are equal; equal rows have positions one after the other and are all
returned; an empty table gives no rows; further columns of any name are carried, but for
pos, place and tied, which are replaced. Rows equal in everything, the partition they are read from too, are
not split by salts; range partitions keep them together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import discard, materialise

BUCKETS = 65_536
#: Rows of a group that stay together, unless a fair part of all rows is more.
TOGETHER = 2_048

Direction = Callable[[str], Column]


def salted(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """rows with _salt, so that no (group, _salt) holds much more than TOGETHER rows or 4 / BUCKETS of all."""
    bucket = F.pmod(F.xxhash64(*group), F.lit(BUCKETS)).alias("_bucket")
    sizes = materialise(rows.groupBy(bucket).agg(F.count("*").alias("n")), "bucket-sizes")
    total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    most = max(TOGETHER, 4 * total // BUCKETS)
    salts = sizes.where(F.col("n") > most).select("_bucket", F.ceil(F.col("n") / most).alias("_salts"))
    spread = F.pmod(F.xxhash64(*[c for c in rows.columns if c != "rest"]) + F.spark_partition_id(), F.coalesce("_salts", F.lit(1)))
    out = rows.withColumn("_bucket", bucket).join(F.broadcast(salts), "_bucket", "left")
    return out.withColumn("_salt", spread.cast("int")).drop("_bucket", "_salts")


def top_places(rows: DataFrame, group: Sequence[str], rank: Sequence[tuple[str, Direction]], ties: Sequence[str], limit: int) -> DataFrame:
    """rows of place ``limit`` or better, with pos, place and tied (long).

    rank: columns that make the rank, each with its direction, as ("a", F.desc_nulls_last);
    ties: columns that order rows of equal rank, ascending.
    """
    names = [c for c in rows.columns if c not in ("pos", "place", "tied")]
    used = list(dict.fromkeys([*group, *[c for c, _ in rank], *ties]))
    rest = [c for c in names if c not in used]
    own = {c: f"c{i}" for i, c in enumerate(used)}
    rows = rows.select(*[F.col(f"`{c}`").alias(x) for c, x in own.items()], *([F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest")] if rest else []))
    group, rank, ties = [own[c] for c in group], [(own[c], way) for c, way in rank], [own[c] for c in ties]
    by_rank = [way(c) for c, way in rank]
    by_all = [*group, *by_rank, *[F.asc_nulls_last(c) for c in ties]]
    local = Window.partitionBy(*group, "_salt").orderBy(*by_rank)
    kept = salted(rows, group).withColumn("_local", F.dense_rank().over(local)).where(F.col("_local") <= limit).drop("_local")
    kept = materialise(kept, "local-places")
    # One more key than asked for, so that equal rows of several salts may part.
    ranged = kept.repartitionByRange(*by_all, "_salt").sortWithinPartitions(*by_all).drop("_salt")
    ranged = materialise(ranged.select("*", F.monotonically_increasing_id().alias("_id")), "ranged")
    discard(kept)
    # Structs of nulls are equal.
    ranged = ranged.select("*", F.shiftright("_id", 33).alias("_part"), F.struct(*group, *[c for c, _ in rank]).alias("_key"))

    runs = materialise(ranged.groupBy("_part", "_key").agg(F.count("*").alias("n"), F.min("_id").alias("first")), "runs")
    ranks = runs.groupBy("_key").agg(F.sum("n").alias("tied"))
    in_group = Window.partitionBy(*[F.col(f"_key.{g}") for g in group]).orderBy(*[way(f"_key.{c}") for c, way in rank])
    ranks = ranks.withColumn("place", F.row_number().over(in_group)).withColumn("before", F.sum("tied").over(in_group) - F.col("tied"))
    in_rank = Window.partitionBy("_key").orderBy("_part")
    carries = runs.withColumn("carry", F.sum("n").over(in_rank) - F.col("n")).join(ranks.where(F.col("place") <= limit), "_key")
    shift = (F.col("before") + F.col("carry") - F.col("first") + 1).alias("_shift")
    out = ranged.join(carries.select("_part", "_key", shift, F.col("place").cast("long").alias("place"), "tied"), ["_part", "_key"])
    back = [F.col(own[c]).alias(c) if c in own else F.col(f"rest.`{c}`") for c in names]
    return out.select(*back, (F.col("_id") + F.col("_shift")).alias("pos"), "place", "tied")
