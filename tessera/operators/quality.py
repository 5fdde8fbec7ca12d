"""Row-level quality flags that keep every row, their summaries, and assertions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A reason, and the condition under which a row has it; NULL does not flag."""

    reason: str
    broken: Column


def flag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds _quality (reasons) and _is_valid; no row is dropped."""
    reasons = F.array_compact(F.array(*[F.when(r.broken, r.reason) for r in rules]))
    return df.withColumn("_quality", reasons).withColumn("_is_valid", F.size("_quality") == 0)


# The reasons below.


def sale_rules(year_from: int = 2010, floor: float = 10_000, cap: float = 8_000_000) -> list[Rule]:
    """Rules for sales with columns sale_date, sale_price, purpose, locality and postcode."""
    c = F.col
    return [
        Rule("unparseable_contract_date", c("sale_date").isNull()),
        Rule("pre_2010_sale", F.year("sale_date") < year_from),
        Rule("unparseable_price", c("sale_price").isNull()),
        Rule("non_arms_length_price", c("sale_price") < floor),
        Rule("price_above_cap", c("sale_price") > cap),
        Rule("not_residence", c("purpose") != "RESIDENCE"),
        Rule("blank_locality", F.trim(F.coalesce("locality", F.lit(""))) == ""),
        Rule("bad_postcode", c("postcode").isNull()),
    ]


def rent_rules(year_from: int = 2010) -> list[Rule]:
    """Rules for rents with columns rent_date, weekly_rent and postcode."""
    c = F.col
    return [
        Rule("unparseable_lodgement_date", c("rent_date").isNull()),
        Rule("pre_2010_lodgement", F.year("rent_date") < year_from),
        Rule("unparseable_rent", c("weekly_rent").isNull()),
        Rule("non_positive_rent", c("weekly_rent") <= 0),
        Rule("bad_postcode", c("postcode").isNull()),
    ]


def summary(df: DataFrame, month: str) -> DataFrame:
    """Rows by month and reason; a row without reasons counts as ok, one with two counts twice."""
    one = df.select(F.col(month).alias("month"), F.explode_outer("_quality").alias("reason"))
    return one.groupBy("month", F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("rows"))


def share(summarised: DataFrame) -> DataFrame:
    """Each reason's share of all summarised rows, in percent, without ok."""
    by = summarised.groupBy("reason").agg(F.sum("rows").alias("rows"))
    out = by.withColumn("pct", 100.0 * F.col("rows") / F.sum("rows").over(Window.partitionBy()))
    return out.where("reason <> 'ok'")


def profile(df: DataFrame) -> DataFrame:
    """Rows and percent by validity."""
    by = df.groupBy("_is_valid").agg(F.count("*").alias("rows"))
    return by.withColumn("pct", 100.0 * F.col("rows") / F.sum("rows").over(Window.partitionBy()))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, NULL keys among them."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def grain_report(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, duplicate_keys. A struct counts NULLs, unlike a distinct count of columns."""
    distinct = F.count_distinct(F.struct(*keys))
    return df.agg(F.lit(name).alias("check"), F.count("*").alias("rows"), (F.count("*") - distinct).alias("duplicate_keys"))


def coverage(df: DataFrame, column: str, floor: int) -> DataFrame:
    """One row: distinct values, the floor and the shortfall."""
    n = F.count_distinct(column)
    return df.agg(n.alias("n"), F.lit(floor).cast("long").alias("floor"), F.greatest(F.lit(0).cast("long"), floor - n).alias("shortfall"))


def out_of_band(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def wrong_shape(df: DataFrame, column: str, size: int) -> DataFrame:
    """Rows whose vector is missing or of another dimension."""
    return df.where(F.col(column).isNull() | (F.size(column) != size))


def blank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is missing or white."""
    return df.where(F.trim(F.coalesce(column, F.lit(""))) == "")


def too_few(df: DataFrame, floor: int) -> DataFrame:
    """One row if there are fewer rows than the floor, else none."""
    return df.agg(F.count("*").alias("rows")).where(F.col("rows") < floor)


class CheckFailed(AssertionError):
    """Raised once, with all failed checks."""


def run_checks(checks: dict[str, DataFrame]) -> dict[str, int]:
    """Runs all violation queries in one job and raises once with those that found rows."""
    counted = reduce(DataFrame.unionByName, [df.agg(F.lit(name).alias("check"), F.count("*").alias("n")) for name, df in checks.items()])
    found = {r["check"]: r["n"] for r in counted.collect()}
    if bad := [f"{k}: {n} rows" for k, n in found.items() if n]:
        raise CheckFailed("; ".join(sorted(bad)))
    return found


def watch(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """df and an observation that has, once some action has read all of df, the number of rows that do not meet each rule: no job of its own."""
    seen = Observation()
    return df.observe(seen, *[F.count_if(~F.coalesce(r, F.lit(False))).alias(k) for k, r in rules.items()]), seen


def expect(df: DataFrame, rules: dict[str, Column], mode: str = "warn") -> tuple[DataFrame, dict[str, int]]:
    """Counts rows that do not meet each rule, in one pass. warn keeps them, drop removes them, fail raises. NULL does not meet a rule."""
    if mode not in ("warn", "drop", "fail"):
        raise ValueError(f"mode {mode!r}")
    row = df.agg(*[F.count_if(~F.coalesce(r, F.lit(False))).alias(k) for k, r in rules.items()]).first()
    counts = {k: row[k] for k in rules}
    if mode == "fail" and any(counts.values()):
        raise CheckFailed("; ".join(f"{k}: {n} rows" for k, n in counts.items() if n))
    if mode == "drop":
        df = df.where(reduce(lambda a, b: a & b, [F.coalesce(r, F.lit(False)) for r in rules.values()], F.lit(True)))
    return df, counts


def parity(reference: DataFrame, actual: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """Keys on one side only, or columns that differ by more than max(tolerance * |reference|, 1e-6)."""
    r, a = reference.alias("r"), actual.alias("a")
    both = r.join(a, reduce(lambda x, y: x & y, [F.col(f"r.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]), "full_outer")
    out = None
    for c in columns:
        x, y = F.col(f"r.{c}").cast("double"), F.col(f"a.{c}").cast("double")
        kind = F.when(x.isNull() & y.isNotNull(), "only_actual").when(y.isNull() & x.isNotNull(), "only_reference").when(F.abs(x - y) > F.greatest(tolerance * F.abs(x), F.lit(1e-6)), "differs")
        one = both.select(*[F.coalesce(f"r.{k}", f"a.{k}").alias(k) for k in keys], F.lit(c).alias("column"), x.alias("reference"), y.alias("actual"), kind.alias("kind")).where("kind IS NOT NULL")
        out = one if out is None else out.unionByName(one)
    return out
