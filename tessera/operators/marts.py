"""Monthly marts of additive legs, and ratios that survive any roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.medians import medians


def monthly_mart(df: DataFrame, grain: Sequence[str], value: str, noun: str, total: str, n: str, digits: int | None = None, spread: bool = False) -> DataFrame:
    """Groups by grain: total and count (the legs), then average, exact median, minimum and maximum.

    Values are summed as exact decimals and medians taken over whole cents, so a result
    does not depend on the order of rows. digits rounds average and median. A median's
    state is a group's distinct values; spread takes several passes instead, in which no
    task sees a group's values, for groups that are a large part of all rows.
    """
    tidy = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    cents = F.round(F.col(value) * 100).cast("bigint")
    exact = F.sum(F.col(value).cast("decimal(18,2)")).cast("double")
    first = [exact.alias(total), F.count(value).alias(n), tidy(exact / F.count(value).cast("double")).alias(f"avg_{noun}")]
    ends = [F.min(value).alias(f"min_{noun}"), F.max(value).alias(f"max_{noun}")]
    if not spread:
        return df.groupBy(*grain).agg(*first, tidy(F.percentile(cents, 0.5) / 100.0).alias(f"median_{noun}"), *ends)
    key = F.struct(*grain).alias("_g")  # structs of nulls are equal
    middle = medians(df.withColumn("_cents", cents), grain, "_cents").select(key, tidy(F.col("median") / 100.0).alias(f"median_{noun}"))
    out = df.groupBy(*grain).agg(*first, *ends).withColumn("_g", key).join(middle, "_g")
    return out.select(*grain, total, n, f"avg_{noun}", f"median_{noun}", f"min_{noun}", f"max_{noun}")


def legs(df: DataFrame, grain: Sequence[str], value: str, total: str, n: str) -> DataFrame:
    return df.groupBy(*grain).agg(F.sum(F.col(value).cast("decimal(18,2)")).cast("double").alias(total), F.count(value).alias(n))


def ratio_mart(left: DataFrame, right: DataFrame, keys: Sequence[str], top: tuple[str, str], bottom: tuple[str, str], name: str, factor: float, floor: int, digits: int | None = 2) -> DataFrame:
    """Both sides, aggregated to keys, joined; factor * avg(right) / avg(left) where both have floor rows.

    top = (total, n) of the right side, bottom of the left. Legs are kept.
    """
    both = left.join(right, list(keys)).where((F.col(bottom[1]) >= floor) & (F.col(top[1]) >= floor))
    avg = lambda leg: F.col(leg[0]) / F.col(leg[1]).cast("double")
    value = factor * avg(top) / F.nullif(avg(bottom), F.lit(0.0))
    return both.withColumn(name, F.round(value, digits) if digits is not None else value)


def roll_up(mart: DataFrame, keys: Sequence[str], total: str, n: str) -> DataFrame:
    """Grain rows, count and total by fewer keys."""
    return mart.groupBy(*keys).agg(F.count("*").alias("grain_rows"), F.sum(n).alias(n), F.sum(F.col(total).cast("decimal(28,2)")).cast("double").alias(total))


def leaderboard(mart: DataFrame, keys: Sequence[str], measure: Column, name: str, floor: Column, k: int) -> DataFrame:
    """The k groups with the largest measure among those that pass the floor; ties by key."""
    return mart.groupBy(*keys).agg(measure.alias(name), floor.alias("_ok")).where("_ok").drop("_ok").orderBy(F.desc(name), *keys).limit(k)


def latest(df: DataFrame, month: str) -> DataFrame:
    """The rows of the last month."""
    top = df.agg(F.max(month).alias("_m"))
    return df.join(F.broadcast(top), F.col(month) == F.col("_m"), "left_semi")  # one row


def trailing(df: DataFrame, month: str, months: int) -> DataFrame:
    """The rows after the last month less so many months."""
    top = df.agg(F.add_months(F.max(month), -months).alias("_m"))
    return df.join(F.broadcast(top), F.col(month) > F.col("_m"), "left_semi")  # one row
