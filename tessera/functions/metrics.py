"""Named measures, recomputed from additive legs after any grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(total: str, n: str) -> Column:
    """sum(total) / sum(n); NULL where nothing is counted."""
    return F.sum(total).cast("double") / F.nullif(F.sum(n), F.lit(0)).cast("double")


def yield_pct(rent: str, rented: str, value: str, sold: str, weeks: int = 52) -> Column:
    """Annual rent over price in percent: a ratio of averages, never an average of ratios."""
    return weeks * 100 * ratio(rent, rented) / F.nullif(ratio(value, sold), F.lit(0.0))


def measures(value: str = "total_sale_value", sold: str = "n_sold", rent: str = "total_weekly_rent", rented: str = "n_rented") -> dict[str, Column]:
    return {
        "avg_price": ratio(value, sold),
        "sales": F.sum(sold),
        "avg_rent": ratio(rent, rented),
        "bonds": F.sum(rented),
        "gross_yield_pct": yield_pct(rent, rented, value, sold),
    }


def dashboard_filter(df: DataFrame, months: tuple[str | None, str | None] = (None, None), postcodes: Sequence[str] = (), property_type: str | None = None) -> DataFrame:
    """A dashboard's filters: a range of months (inclusive), several postcodes, one property type; what is not given does not filter."""
    if months[0]:
        df = df.where(F.col("month") >= F.lit(months[0]).cast("date"))
    if months[1]:
        df = df.where(F.col("month") <= F.lit(months[1]).cast("date"))
    if postcodes:
        df = df.where(F.col("postcode").isin(*postcodes))
    return df.where(F.col("property_type") == property_type) if property_type else df


def recent(c: Column, days: int = 365, today: Column | None = None) -> Column:
    """True for dates after today less so many days."""
    return c > F.date_sub(today if today is not None else F.current_date(), days)
