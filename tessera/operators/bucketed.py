"""State in hash buckets by natural key: a merge reads and rewrites the buckets that it touches.

``merge`` does what ``versions.reconcile`` does to a whole state, and gives the same rows.
A bucket is touched if its current rows, as a bag of digests, differ from those of the
snapshot; the sums of the digests are compared bucket by bucket, so a snapshot that
changes little rewrites little. Others keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.changes import row_digest
from tessera.operators.versions import reconcile
from tessera.sources.landing import names
from tessera.sources.scratch import remove, written


class BucketedState:
    """Rows (keys, columns, is_current, _synced_at) under ``bucket=<n>``.

    A table keeps its number of buckets; take one that makes a bucket a few hundred MB at
    the size expected. Keys match null-safe and are unique on either side.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], columns: Sequence[str], buckets: int = 256):
        self.spark, self.root, self.keys, self.columns, self.buckets = spark, root, list(keys), list(columns), buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.struct(*self.keys)), F.lit(self.buckets)).cast("int").alias("bucket")

    def _read(self, only: Sequence[int] | None = None) -> DataFrame | None:
        if not any(n.startswith("bucket=") for n in names(self.spark, self.root)):
            return None
        rows = self.spark.read.parquet(self.root)
        return rows if only is None else rows.where(F.col("bucket").isin(list(only)))

    def read(self) -> DataFrame | None:
        rows = self._read()
        return rows.drop("bucket") if rows is not None else None

    def _empty(self, snapshot: DataFrame) -> DataFrame:
        kinds = StructType([snapshot.schema[c] for c in (*self.keys, *self.columns)])
        return self.spark.createDataFrame([], kinds).withColumns({"is_current": F.lit(True), "_synced_at": F.lit(None).cast("timestamp")})

    def touched(self, snapshot: DataFrame) -> list[int]:
        """Numbers of the buckets whose current rows are not those of the snapshot; at most the number of buckets."""
        fields = [*self.keys, *self.columns]

        def sums(df: DataFrame, name: str) -> DataFrame:
            digest = row_digest(df, fields)
            parts = [F.sum(F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).alias(f"{name}{i}") for i in range(4)]
            return df.groupBy(self._bucket()).agg(F.count("*").alias(f"{name}n"), *parts)

        state = self._read()
        new = sums(snapshot.select(*fields), "n")
        if state is None:
            return sorted(r.bucket for r in new.select("bucket").collect())
        old = sums(state.where("is_current").select(*fields), "o")
        both = old.join(new, "bucket", "full_outer")
        same = F.col("on").eqNullSafe(F.col("nn"))
        for i in range(4):
            same = same & F.col(f"o{i}").eqNullSafe(F.col(f"n{i}"))
        return sorted(r.bucket for r in both.where(~same).select("bucket").collect())

    def merge(self, snapshot: DataFrame, synced_at: Column) -> list[int]:
        """Makes the snapshot the current state; returns the buckets that were rewritten.

        Rows of untouched buckets keep their _synced_at, as nothing about them is new.
        """
        some = self.touched(snapshot)
        if some:
            old = self._read(some)
            old = old.drop("bucket") if old is not None else self._empty(snapshot)
            new = snapshot.where(self._bucket().isin(some))
            self._replace(reconcile(old, new, self.keys, self.columns, synced_at))
        return some

    def retire(self, gone: DataFrame) -> list[int]:
        """Rows whose key is in ``gone`` stay as not current; returns the buckets that were rewritten."""
        keys = gone.select(*self.keys).distinct()
        some = sorted(r.bucket for r in keys.select(self._bucket()).distinct().collect())
        old = self._read(some) if some else None
        if old is None:
            return []
        on = [F.col(f"s.{k}").eqNullSafe(F.col(f"g.{k}")) for k in self.keys]
        hit = old.alias("s").join(keys.withColumn("_gone", F.lit(True)).alias("g"), on, "left")
        self._replace(hit.select(*[f"s.{c}" for c in old.columns if c not in ("bucket", "is_current")], (F.col("s.is_current") & F.col("g._gone").isNull()).alias("is_current")))
        return some

    def purge(self, before: Column) -> list[int]:
        """Drops rows that are not current and were synced before a time, bucket by bucket."""
        old = self._read()
        stale = ~F.col("is_current") & (F.col("_synced_at") < before)
        some = sorted(r.bucket for r in old.where(stale).select("bucket").distinct().collect()) if old is not None else []
        if some:
            rest = self._read(some).where(~F.coalesce(stale, F.lit(False))).drop("bucket")
            kept = self._replace(rest)
            for b in set(some) - kept:
                remove(self.spark, f"{self.root}/bucket={b}")
        return some

    def _replace(self, rows: DataFrame) -> set[int]:
        """Writes whole buckets. The rows are written aside first, as they are read from what is overwritten."""
        rows = written(rows.withColumn("bucket", self._bucket()), "buckets")
        rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.root)
        return {r.bucket for r in rows.select("bucket").distinct().collect()}
