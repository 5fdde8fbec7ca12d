"""Exact medians of groups of any size, by refining ranges.

Rows are first counted by group and value. Then each group's two middle ranks are looked
for in BINS bins between its least and greatest value: counts by bin tell which bin holds
the rank, and that bin is cut again, until it is one value. What a task sees of a group
are counts of bins; a group's values are never gathered, and a hot one is spread by value.
Whole 64-bit values take seven rounds at most, money in cents three or four.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.scratch import written

BINS = 1_024


def medians(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, n, median): the mean of the two middle values of an integer column, NULLs left out; NULL keys are a group.

    A group without a value has n = 0 and a NULL median.
    """
    key = F.struct(*keys).alias("_g")
    counted = written(df.select(key, F.col(value).cast("long").alias("v")).groupBy("_g", "v").agg(F.count("*").alias("c")), "values")
    some = counted.where("v IS NOT NULL")
    groups = written(counted.groupBy("_g").agg(F.sum(F.when(F.col("v").isNotNull(), F.col("c")).otherwise(0)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "medians")
    ranks = F.explode(F.array_distinct(F.array(F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1))).alias("rank")
    # at: the rank within lo..hi; rank: that within the group, which tells the two apart.
    open_ranges = groups.where("n > 0").select("_g", "lo", "hi", ranks).withColumn("at", F.col("rank"))
    done = None
    while True:
        found = open_ranges.where("lo = hi").select("_g", "rank", F.col("lo").alias("v"))
        done = found if done is None else done.unionByName(found)
        todo = written(open_ranges.where("lo < hi"), "ranges")
        if todo.isEmpty():
            break
        # As decimals, since hi - lo may exceed a bigint.
        span = F.col("hi").cast("decimal(20,0)") - F.col("lo").cast("decimal(20,0)") + 1
        todo = todo.withColumn("w", F.ceil(span / BINS).cast("decimal(20,0)"))
        spot = F.floor((F.col("v").cast("decimal(20,0)") - F.col("lo").cast("decimal(20,0)")) / F.col("w")).cast("int")
        inside = some.join(todo, "_g").where("v BETWEEN lo AND hi").select("_g", "rank", "at", "lo", "hi", "w", spot.alias("bin"), "c")
        bins = inside.groupBy("_g", "rank", "at", "lo", "hi", "w", "bin").agg(F.sum("c").alias("c"))
        order = Window.partitionBy("_g", "rank").orderBy("bin")  # BINS rows at most
        bins = bins.withColumn("upto", F.sum("c").over(order)).where((F.col("upto") >= F.col("at")) & (F.col("upto") - F.col("c") < F.col("at")))
        low = F.col("lo").cast("decimal(20,0)") + F.col("bin") * F.col("w")
        high = F.least(F.col("hi").cast("decimal(20,0)"), low + F.col("w") - 1)
        open_ranges = written(bins.select("_g", low.cast("long").alias("lo"), high.cast("long").alias("hi"), "rank", (F.col("at") - F.col("upto") + F.col("c")).alias("at")), "ranges")
    middle = done.groupBy("_g").agg((F.sum(F.col("v").cast("decimal(20,0)")) / F.count("*")).cast("double").alias("median"))
    return groups.select("_g", "n").join(middle, "_g", "left").select("_g.*", "n", "median")
