"""Forecast with prediction intervals as a table function, for SQL.

    SELECT * FROM forecast_months(TABLE(history) PARTITION BY (suburb, kind) ORDER BY (month), 6, 0.8)

The table's last two columns are month and value, those before are the series' keys. Rows
of a series arrive in order, one by one; what is kept of them is the smoothed level and
trend, the forecasts that are still to be checked, and their errors by horizon. Before a
value is taken in, it is compared with what was forecast for it 1, 2, ... months before: so
the intervals are quantiles of errors that the method has really made on this series.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import DateType, DoubleType, IntegerType, StructType

ALPHA, BETA, DAMPED = 0.4, 0.2, 0.9
#: Values before forecasts are checked, and errors that an interval needs.
WARM, LEAST = 12, 8


def quantile(sorted_values: list[float], p: float) -> float:
    """By linear interpolation between order statistics."""
    at = p * (len(sorted_values) - 1)
    low = int(at)
    high = min(low + 1, len(sorted_values) - 1)
    return sorted_values[low] + (at - low) * (sorted_values[high] - sorted_values[low])


class Smoother:
    """Level and damped trend, and errors by horizon."""

    def __init__(self, horizon: int):
        self.horizon, self.n, self.level, self.trend = horizon, 0, 0.0, 0.0
        self.due: dict[int, list[tuple[int, float]]] = {}  # month number: (horizon, forecast)
        self.errors: list[list[float]] = [[] for _ in range(horizon)]

    def ahead(self) -> list[float]:
        out, step = [], 0.0
        for h in range(1, self.horizon + 1):
            step += DAMPED**h
            out.append(self.level + step * self.trend)
        return out

    def take(self, month: int, value: float) -> None:
        for gone in [m for m in self.due if m < month]:
            del self.due[gone]  # a month that the series lacks
        for h, forecast in self.due.pop(month, ()):
            self.errors[h - 1].append(value - forecast)
        before = self.level
        if self.n:
            self.level = ALPHA * value + (1 - ALPHA) * (self.level + DAMPED * self.trend)
            self.trend = BETA * (self.level - before) + (1 - BETA) * DAMPED * self.trend
        else:
            self.level = value
        self.n += 1
        if self.n >= WARM:
            for h, forecast in enumerate(self.ahead(), 1):
                self.due.setdefault(month + h, []).append((h, forecast))

    def intervals(self, coverage: float) -> list[tuple[float, float | None, float | None, int]]:
        """(forecast, low, high, errors) by horizon; no interval with fewer than LEAST errors."""
        out = []
        for forecast, errors in zip(self.ahead(), self.errors, strict=True):
            errors = sorted(errors)
            low, high = ((forecast + quantile(errors, (1 - coverage) / 2), forecast + quantile(errors, (1 + coverage) / 2)) if len(errors) >= LEAST else (None, None))
            out.append((forecast, low, high, len(errors)))
        return out


class ForecastMonths:
    """The table function; NULL values are months that the series lacks."""

    @staticmethod
    def analyze(table: AnalyzeArgument, horizon: AnalyzeArgument, coverage: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable or len(table.dataType.fields) < 2:
            raise ValueError("the first argument is a table whose last columns are month and value")
        if not horizon.value or horizon.value < 1 or not coverage.value or not 0 < coverage.value < 1:
            raise ValueError("the horizon is 1 or more and the coverage between 0 and 1")
        out = StructType(table.dataType.fields[:-2])
        out = out.add("month", DateType()).add("horizon", IntegerType()).add("yhat", DoubleType()).add("low", DoubleType()).add("high", DoubleType()).add("errors", IntegerType())
        return AnalyzeResult(schema=out)

    def __init__(self):
        self.state, self.keys, self.last, self.coverage = None, (), None, 0.0

    def eval(self, row: Row, horizon: int, coverage: float):
        *keys, month, value = row
        if self.state is None:
            self.state, self.keys, self.coverage = Smoother(horizon), keys, float(coverage)
        if month is not None and value is not None:
            self.last = month
            self.state.take(month.year * 12 + month.month - 1, float(value))

    def terminate(self):
        import datetime

        if self.last is None or self.state.n < WARM:
            return
        at = self.last.year * 12 + self.last.month - 1
        for h, (yhat, low, high, errors) in enumerate(self.state.intervals(self.coverage), 1):
            yield (*self.keys, datetime.date((at + h) // 12, (at + h) % 12 + 1, 1), h, yhat, low, high, errors)


def register(spark: SparkSession, name: str = "forecast_months") -> None:
    """Makes the function known to SQL."""
    spark.udtf.register(name, udtf(ForecastMonths))


def coverage(made: DataFrame, actual: DataFrame, keys: list[str], month: str, value: str) -> DataFrame:
    """(horizon, n, covered): the share of values that came within their intervals."""
    real = actual.select(*keys, F.col(month).alias("month"), F.col(value).cast("double").alias("_y"))
    both = made.where("low IS NOT NULL").join(real, [*keys, "month"]).where("_y IS NOT NULL")
    return both.groupBy("horizon").agg(F.count("*").alias("n"), F.avg(F.col("_y").between(F.col("low"), F.col("high")).cast("double")).alias("covered"))


# Sent to workers by value: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
