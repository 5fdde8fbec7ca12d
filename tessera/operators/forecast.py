"""Per-series forecasts in closed form, and their backtest; all of it Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.features import month_index

MIN_TREND, MIN_NAIVE = 36, 12
#: January 2010, as months since year 0.
ORIGIN = 2010 * 12 + 1


def _future(history: DataFrame, keys: Sequence[str], month: str, horizon: int, least: int) -> DataFrame:
    """(keys, month, mi): the months after each eligible series' own last one."""
    ends = history.groupBy(*keys).agg(F.max(month).alias("_last"), F.count("*").alias("_n")).where(F.col("_n") >= least)
    steps = F.explode(F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda h: F.add_months("_last", h)))
    return ends.select(*keys, steps.alias("month")).withColumn("mi", month_index("month"))


def trend_seasonal(history: DataFrame, keys: Sequence[str], month: str, value: str, horizon: int) -> DataFrame:
    """(keys, month, yhat): least squares on a linear trend and twelve month dummies.

    Demeaning by month of year gives the slope, sum(t*y) / sum(t*t), and the season is the
    mean of y - slope * t. A month of year that a series never had takes the series' own
    mean level. Series with fewer than 36 rows have no forecast.
    """
    # Months count from a fixed one near the data, so that squares of t lose no digits.
    near = month_index(month) - ORIGIN
    rows = history.select(*keys, near.alias("t"), F.month(month).alias("moy"), F.col(value).cast("double").alias("y")).where("y IS NOT NULL")
    cell = rows.groupBy(*keys, "moy").agg(F.count("*").alias("n"), F.avg("t").alias("mt"), F.avg("y").alias("my"), F.sum(F.col("t").cast("double") * F.col("t")).alias("tt"), F.sum(F.col("t") * F.col("y")).alias("ty"))
    fit = cell.groupBy(*keys).agg(
        (F.sum(F.col("ty") - F.col("n") * F.col("mt") * F.col("my")) / F.nullif(F.sum(F.col("tt") - F.col("n") * F.col("mt") * F.col("mt")), F.lit(0.0))).alias("slope"),
        (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("level"), (F.sum(F.col("n") * F.col("mt")) / F.sum("n")).alias("at"),
    )
    out = _future(history, keys, month, horizon, MIN_TREND).withColumn("moy", F.month("month")).join(fit, list(keys)).join(cell.select(*keys, "moy", "mt", "my"), [*keys, "moy"], "left")
    slope = F.coalesce("slope", F.lit(0.0))
    season = F.coalesce(F.col("my") - slope * F.col("mt"), F.col("level") - slope * F.col("at"))
    return out.select(*keys, "month", (season + slope * (F.col("mi") - ORIGIN)).alias("yhat"))


def seasonal_naive(history: DataFrame, keys: Sequence[str], month: str, value: str, horizon: int) -> DataFrame:
    """(keys, month, yhat): the value twelve calendar months earlier, NULL if there is none."""
    past = history.select(*keys, (month_index(month) + 12).alias("mi"), F.col(value).cast("double").alias("yhat"))
    return _future(history, keys, month, horizon, MIN_NAIVE).join(past, [*keys, "mi"], "left").select(*keys, "month", "yhat")


def backtest(series: DataFrame, keys: Sequence[str], month: str, value: str, months: int) -> DataFrame:
    """(method, horizon, n, mae): both methods on the history before the last months, against what came."""
    cut = F.broadcast(series.agg(F.add_months(F.max(month), -months).alias("_cut")))  # one row
    history = series.join(cut, F.col(month) <= F.col("_cut"), "left_semi")
    enough = history.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= MIN_TREND).select(*keys)
    history = history.join(enough, list(keys), "left_semi")
    made = trend_seasonal(history, keys, month, value, months).withColumn("method", F.lit("trend_seasonal"))
    made = made.unionByName(seasonal_naive(history, keys, month, value, months).withColumn("method", F.lit("seasonal_naive")))
    actual = series.select(*keys, F.col(month).alias("month"), F.col(value).cast("double").alias("y"))
    both = made.join(actual, [*keys, "month"]).join(cut, F.col("month") > F.col("_cut"))
    horizon = F.months_between("month", "_cut").cast("int")
    return both.groupBy("method", horizon.alias("horizon")).agg(F.count("*").alias("n"), F.avg(F.abs(F.col("yhat") - F.col("y"))).alias("mae"))


def best_method(tested: DataFrame) -> DataFrame:
    """One row: the method with the least mean of its horizons' errors."""
    by = tested.groupBy("method").agg(F.avg("mae").alias("avg_mae"))
    return by.agg(F.min_by("method", F.struct("avg_mae", "method")).alias("method"), F.min("avg_mae").alias("avg_mae"))


def damped_holt(history: DataFrame, keys: Sequence[str], month: str, value: str, horizon: int, schema: str) -> DataFrame:
    """A third method, one group of rows at a time in pandas: level and damped trend by exponential smoothing. Not any vendor's forecast."""
    import pandas as pd

    def one(pdf):
        pdf = pdf.sort_values(month)
        y = pdf[value].astype(float).tolist()
        names = [*keys, "month", "yhat"]
        if len(y) < MIN_NAIVE:
            return pdf.iloc[:0][[*keys, month]].set_axis(names[:-1], axis=1).assign(yhat=pd.Series(dtype="float64"))
        level, trend, phi = y[0], 0.0, 0.9
        for v in y[1:]:
            before = level
            level = 0.4 * v + 0.6 * (level + phi * trend)
            trend = 0.2 * (level - before) + 0.8 * phi * trend
        last, out, step = pd.Timestamp(pdf[month].iloc[-1]), [], 0.0
        for h in range(1, horizon + 1):
            step += phi**h
            out.append([*(pdf[k].iloc[0] for k in keys), (last + pd.DateOffset(months=h)).date(), level + step * trend])
        return pd.DataFrame(out, columns=names)

    return history.select(*keys, month, value).groupBy(*keys).applyInPandas(one, schema)
