"""Change feed: what rows two snapshots differ by, a log of it by version, and its replay.

Snapshots are compared as bags of rows: a row counts +1 where it is new and -1 where it is
old, so what is equal on both sides cancels out. Narrow rows, of plain values with at most
NARROW bytes of strings on average, are counted as they are: a digest would be as long as
the row, and rows would have to be fetched by it. Of other rows only digests are shuffled
until it is known which ones changed, and whole rows are fetched for those.

Change kinds: ``insert``, ``update_before``, ``update_after`` and ``delete``. Rows of a key
that has both lost and gained rows are updates, all of them: no rows of a key are numbered
or gathered, so a key may repeat or be NULL, and may hold any share of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    MapType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tessera.sources.landing import exists
from tessera.sources.sinks import Versions

INSERT, BEFORE, AFTER, DELETE = "insert", "update_before", "update_after", "delete"
#: Bytes of strings in a row, on average, up to which rows are counted as they are.
NARROW = 64


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of a row's values by column, with full precision; NULL is not the empty string."""

    def said(c: str) -> Column:
        kind = df.schema[c].dataType
        at = F.col(f"`{c}`")
        if isinstance(kind, ArrayType | MapType | StructType):
            return F.to_json(at, {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
        return at if isinstance(kind, StringType) else F.hex(at) if kind.typeName() == "binary" else at.cast("string")

    return F.sha2(F.to_json(F.array(*[said(c) for c in columns]), {"ignoreNullFields": "false"}), 256)


def _narrow(df: DataFrame) -> bool:
    """Whether rows are plain values of a bounded size, so that they cost no more than their digests."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if not kinds or not all(isinstance(k, BooleanType | DateType | NumericType | StringType | TimestampNTZType | TimestampType) for k in kinds.values()):
        return False
    if sum(isinstance(k, DoubleType | FloatType) for k in kinds.values()) > 62:
        return False  # one bit each in _minus
    if any(isinstance(k, StringType) and k != StringType() for k in kinds.values()):
        return False  # a collation would make different strings equal
    strings = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, k in kinds.items() if isinstance(k, StringType)]
    if not strings:
        return True
    return (df.agg(F.avg(sum(strings[1:], strings[0])).alias("n")).first()["n"] or 0) <= NARROW


def _counted(df: DataFrame, sign: Column, names: Sequence[str]) -> DataFrame:
    """(names, _minus, _sign) of narrow rows; _minus has a bit for each column with -0.0, which grouping takes for 0.0."""
    minus = F.lit(0).cast("long")
    for i, c in enumerate(c for c in names if isinstance(df.schema[c].dataType, DoubleType | FloatType)):
        minus = minus.bitwiseOR(F.when(F.col(f"`{c}`").cast("string") == "-0.0", F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return df.select(*[F.col(f"`{c}`") for c in names], minus.alias("_minus"), sign.cast("long").alias("_sign"))


def _summed(both: DataFrame, names: Sequence[str]) -> DataFrame:
    """(names, _n): each different row with its sum of signs."""
    floats = [c for c in names if isinstance(both.schema[c].dataType, DoubleType | FloatType)]
    out = both.groupBy(*[F.col(f"`{c}`") for c in names], "_minus").agg(F.sum("_sign").alias("_n"))
    restored = {c: F.when(F.col("_minus").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(-0.0).cast(both.schema[c].dataType)).otherwise(F.col(f"`{c}`")) for i, c in enumerate(floats)}
    return out.select(*[restored.get(c, F.col(f"`{c}`")).alias(c) for c in names], "_n")


def _tagged(df: DataFrame, names: Sequence[str], keys: Sequence[str], sign: int) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")
    return df.select(F.struct(*keys).alias("_key"), row_digest(df, names).alias("_digest"), F.lit(sign).cast("long").alias("_sign"), row)


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows by which new differs from old, each as often as it does, with _change; columns of new, NULL where old lacks them."""
    names = new.columns
    old = old.select(*[(F.col(f"`{c}`") if c in old.columns else F.lit(None)).cast(new.schema[c].dataType).alias(c) for c in names])
    narrow = _narrow(new)
    if narrow:
        both = _counted(old, F.lit(-1), names).unionByName(_counted(new, F.lit(1), names))
        row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")
        moved = _summed(both, names).where("_n <> 0").select(F.struct(*keys).alias("_key"), row, "_n")
    else:
        both = _tagged(old, names, keys, -1).unionByName(_tagged(new, names, keys, 1))
        moved = both.groupBy("_key", "_digest").agg(F.sum("_sign").alias("_n")).where("_n <> 0")
    sides = moved.groupBy("_key").agg((F.max("_n") > 0).alias("_came"), (F.min("_n") < 0).alias("_went"))
    update = F.col("_came") & F.col("_went")
    kind = F.when(F.col("_n") > 0, F.when(update, AFTER).otherwise(INSERT)).otherwise(F.when(update, BEFORE).otherwise(DELETE))
    moved = moved.join(sides, "_key").select("_row" if narrow else "_digest", kind.alias("_change"), F.abs("_n").alias("_copies"))
    if not narrow:
        # One row for each digest, however many copies the snapshots have.
        rows = both.select("_digest", "_row").join(moved.select("_digest"), "_digest", "left_semi").groupBy("_digest").agg(F.any_value("_row").alias("_row"))
        moved = rows.join(moved, "_digest")
    return moved.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select("_row.*", "_change")


def replay(base: DataFrame, log: DataFrame) -> DataFrame:
    """base after all changes of log, as a bag of rows; wide rows that no change names are passed on as they are."""
    names = base.columns
    sign = F.when(F.col("_change").isin(INSERT, AFTER), 1).otherwise(-1).cast("long")
    again = lambda summed: summed.where("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
    if _narrow(base) and all(log.schema[c].dataType == base.schema[c].dataType for c in names):
        both = _counted(base, F.lit(1), names).unionByName(_counted(log, sign, names))
        return again(_summed(both, names)).select(*[F.col(f"`{c}`") for c in names])
    steps = log.select(row_digest(log, names).alias("_digest"), sign.alias("_sign"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    here = base.select(row_digest(base, names).alias("_digest"), F.lit(1).cast("long").alias("_sign"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    named = steps.select("_digest").distinct()
    apart = here.join(named, "_digest", "left_anti").select("_row.*")
    touched = here.join(named, "_digest", "left_semi").unionByName(steps).groupBy("_digest").agg(F.sum("_sign").alias("_n"), F.any_value("_row").alias("_row"))
    return apart.unionByName(again(touched).select("_row.*"))


class ChangeLog:
    """Snapshots of a table by version, and the changes that led to each.

    A version exists once its snapshot is complete; its changes are written first, so a
    commit that breaks off leaves nothing that a reader sees, and the next one overwrites it.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root, list(keys)
        self.snapshots = Versions(spark, f"{root}/snapshots")

    def commit(self, df: DataFrame) -> int:
        """Logs what df changes, then makes it the current version."""
        last = max(self.snapshots.all(), default=0)
        old = self.snapshots.read(last) if last else df.limit(0)
        # All rows of a first version are new; there is nothing to compare them with.
        moved = changes(old, df, self.keys) if last else df.withColumn("_change", F.lit(INSERT))
        moved.write.mode("overwrite").parquet(f"{self.root}/log/_version={last + 1}")
        return self.snapshots.write(df)

    def read(self, since: int = 1, until: int | None = None) -> DataFrame:
        """The changes of a range of versions, both ends among them, with _version; other versions' files are not listed."""
        known = [v for v in self.snapshots.all() if since <= v <= (until or v)]
        paths = [f"{self.root}/log/_version={v}" for v in known]
        if not all(exists(self.spark, p) for p in paths):
            raise ValueError("changes of some of these versions are gone")
        if not paths:
            return self.snapshots.read().limit(0).select("*", F.lit("").alias("_change"), F.lit(0).alias("_version"))
        return self.spark.read.option("basePath", f"{self.root}/log").option("mergeSchema", "true").parquet(*paths)

    def as_of(self, version: int, base: int = 1) -> DataFrame:
        """Version ``version`` made from snapshot ``base`` and the changes after it."""
        start = self.snapshots.read(base)
        return start if version == base else replay(start, self.read(base + 1, version))
