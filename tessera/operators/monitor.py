"""Drift (population stability index) and accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS, DRIFTING, SHIFTED, FLOOR = 10, 0.1, 0.25, 1e-4
#: Features that differ by the calendar alone.
CYCLICAL = ("month_of_year",)


def status(psi: Column) -> Column:
    """NaN and NULL first: NaN is greater than any number in Spark."""
    return F.when(psi.isNull() | F.isnan(psi), "unmonitorable").when(psi > SHIFTED, "shifted").when(psi > DRIFTING, "drifting").otherwise("stable")


def psi(reference: DataFrame, current: DataFrame, features: Sequence[str], edge_digits: int | None = None) -> DataFrame:
    """(feature, psi, status): reference-quantile bins, closed below; shares of at least 1e-4.

    Fewer than three distinct edges give 0, an empty side NaN. One pass for the edges,
    one for the counts; nothing but the shares per bin is shuffled.
    """
    probs = F.array(*[F.lit(i / BINS) for i in range(BINS + 1)])
    tidy = lambda q: F.transform(q, lambda x: F.round(x, edge_digits)) if edge_digits is not None else q
    edges = reference.agg(*[F.array_distinct(tidy(F.percentile(F.col(f).cast("double"), probs))).alias(f) for f in features])
    edges = edges.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("edges")) for f in features])).alias("e")).select("e.*")
    long = lambda df, side: df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])).alias("x")).select("x.*", F.lit(side).alias("side"))
    rows = long(reference, 0).unionByName(long(current, 1)).where("v IS NOT NULL AND NOT isnan(v)")
    inner = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    binned = rows.join(F.broadcast(edges), "feature").withColumn("bin", F.size(F.filter(inner, lambda e: e <= F.col("v"))))  # one row a feature
    counts = binned.groupBy("feature", "bin").agg(F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("c"))
    totals = counts.groupBy("feature").agg(F.collect_list(F.struct("r", "c")).alias("b"), F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    # Bins without rows on either side have the floor's share on both, and add nothing.
    part = lambda x, n: F.greatest(x.cast("double") / F.col(n), F.lit(FLOOR))
    value = F.aggregate(F.array_sort("b"), F.lit(0.0), lambda a, x: a + (part(x["c"], "nc") - part(x["r"], "nr")) * F.log(part(x["c"], "nc") / part(x["r"], "nr")))
    out = edges.join(totals, "feature", "left")
    empty = F.coalesce(F.col("nr") * F.col("nc"), F.lit(0)) == 0
    out = out.select("feature", F.when(empty, float("nan")).when(F.size("edges") < 3, 0.0).otherwise(value).alias("psi"))
    return out.withColumn("status", status(F.col("psi")))


def max_monitorable(drift: DataFrame) -> DataFrame:
    """One row: the largest psi of monitorable features, 0 if there is none."""
    good = ~F.isnan("psi") & F.col("psi").isNotNull() & ~F.col("feature").isin(*CYCLICAL)
    return drift.agg(F.coalesce(F.max(F.when(good, F.col("psi"))), F.lit(0.0)).alias("max_psi"))


def reference_window(df: DataFrame, month: str, months: int = 24) -> tuple[DataFrame, DataFrame]:
    """The months before the last one, and the last one."""
    top = F.broadcast(df.agg(F.max(month).alias("_to")).withColumn("_from", F.add_months("_to", -months)))  # one row
    past = (F.col(month) >= F.col("_from")) & (F.col(month) < F.col("_to"))
    return df.join(top, past, "left_semi"), df.join(top, F.col(month) == F.col("_to"), "left_semi")


def accuracy(scored: DataFrame, by: Sequence[str], predicted: str, actual: str, digits: int | None = 2) -> DataFrame:
    """Rows scored and mean absolute error."""
    mae = F.avg(F.abs(F.col(predicted) - F.col(actual)))
    return scored.where(F.col(predicted).isNotNull() & F.col(actual).isNotNull()).groupBy(*by).agg(F.count("*").alias("n_scored"), (F.round(mae, digits) if digits is not None else mae).alias("mae"))


