"""Connected components of a link table, by least labels and pointer jumping.

Each round every vertex takes the least label among its neighbours (a partial minimum
before the shuffle, so hubs do not gather their links in one task), then the label of
its label. Rounds are written to the shared folder; only a count comes to the driver.

Defined results: links with a null end are left out; loops and repeated links do no harm;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import materialise


def components(links: DataFrame) -> DataFrame:
    """(v, label) for each vertex of links (a, b); label is the least vertex of its component.

    Loops and repeated links do no harm; an empty table gives no rows.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.where("a <> b").distinct(), "links")
    now = materialise(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = both.join(now.select(F.col("v").alias("b"), "label"), "b").select(F.col("a").alias("v"), "label")
        least = near.unionByName(now).groupBy("v").agg(F.min("label").alias("label"))
        least = materialise(least, "labels")
        up = least.select(F.col("v").alias("label"), F.col("label").alias("up"))
        jumped = least.join(up, "label").select("v", F.col("up").alias("label"))
        new = materialise(jumped, "labels")
        if new.join(now, ["v", "label"], "left_anti").isEmpty():
            return new
        now = new
