"""Calendar-lag features over a month grain, and time splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_index(c: str) -> Column:
    """Months since year 0, so that calendar distance is a difference of integers."""
    return F.year(c) * 12 + F.month(c)


def calendar_lags(df: DataFrame, keys: Sequence[str], month: str, value: str, lags: Sequence[int], prefix: str) -> DataFrame:
    """value exactly k calendar months ago for each k; NULL across a gap. One window, no self-join; (keys, month) must be unique."""
    w = Window.partitionBy(*keys).orderBy("_mi")
    out = df.withColumn("_mi", month_index(month))
    return out.select("*", *[F.max(value).over(w.rangeBetween(-k, -k)).alias(f"{prefix}_lag_{k}") for k in lags]).drop("_mi")


def trailing_means(df: DataFrame, keys: Sequence[str], month: str, columns: dict[str, str], rows: int = 3) -> DataFrame:
    """The mean of the rows before the current one, by row offset; NULL on a series' first row."""
    w = Window.partitionBy(*keys).orderBy(month).rowsBetween(-rows, -1)
    return df.select("*", *[F.avg(c).over(w).alias(name) for name, c in columns.items()])


def signal(df: DataFrame, keys: Sequence[str], month: str, total: str, n: str, name: str) -> DataFrame:
    """A leg-weighted average on a coarser key: sum(total) / sum(n)."""
    return df.groupBy(*keys, month).agg((F.sum(F.col(total).cast("decimal(28,2)")).cast("double") / F.sum(n).cast("double")).alias(name))


def build(rent: DataFrame, sales: DataFrame, keys: Sequence[str], coarse: Sequence[str], target: str = "median_weekly_rent") -> DataFrame:
    """Rent features without same-month leakage: lags 1, 3, 12, trailing means, last month's sale signal, month of year.

    Rows without a value one calendar month earlier are dropped.
    """
    out = calendar_lags(rent, keys, "month", target, (1, 3, 12), "rent")
    out = trailing_means(out, keys, "month", {"rent_mean_3": "avg_weekly_rent", "volume_mean_3": "n_rented"})
    last = signal(sales, coarse, "month", "total_sale_value", "n_sold", "price_lag_1").withColumn("month", F.add_months("month", 1))
    out = out.join(last, [*coarse, "month"], "left").where("rent_lag_1 IS NOT NULL")
    return out.select(*keys, "month", "rent_lag_1", "rent_lag_3", "rent_lag_12", "rent_mean_3", "volume_mean_3", "price_lag_1", F.month("month").alias("month_of_year"), target)


def split_by_month(df: DataFrame, month: str, holdout: int) -> tuple[DataFrame, DataFrame]:
    """Rows up to, and after, the last month less the holdout."""
    cut = F.broadcast(df.agg(F.add_months(F.max(month), -holdout).alias("_cut")))  # one row
    return df.join(cut, F.col(month) <= F.col("_cut"), "left_semi"), df.join(cut, F.col(month) > F.col("_cut"), "left_semi")
