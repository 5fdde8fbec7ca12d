"""Tables of versions on plain Parquet: write-audit-publish, history, clustering, compaction.

A version is an entry ``_log/<n>.json`` that names its data folder. The entry is created by
the store, which refuses one that is there: publishing is atomic, and of two writers of the
same version one fails. What is staged is read by nobody before; a write whose audit fails
never gets an entry, so the version before stays the current one.

An entry has the operation, rows, files, bytes, the audit's counts and, where asked for, a
table of each file's least and greatest values, by which ``scan`` leaves files out.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.quality import CheckFailed
from tessera.sources.landing import names
from tessera.sources.scratch import file_system, read_json, remove, write_json

#: Ranges of a column that clustering tells apart, and bits of their number.
RANKS, BITS = 1_024, 10
#: Least size of a file that compaction leaves alone.
SMALL = 128 << 20


def audit(df: DataFrame, not_null: Sequence[str] = (), key: Sequence[str] = (), checks: dict[str, Column] | None = None) -> dict[str, int]:
    """Violations by constraint and ``rows``, all counted in one pass.

    A key is violated by each row beyond the first of equal key, NULL being a value; a
    check by each row where it does not hold or is NULL. Rows are first counted by key,
    which is what a task sends on, so a key of any number of rows is no burden.
    """
    each = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    each |= {f"check:{n}": ~F.coalesce(c, F.lit(False)) for n, c in (checks or {}).items()}
    counts = [F.count_if(c).alias(n) for n, c in each.items()]
    by_key = df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)]) if key else df
    one = by_key.agg(F.count("*").alias("rows"), *counts)
    total = lambda c: F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c)
    more = [F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("key:" + ",".join(key))] if key else []
    return one.agg(total("rows"), *[total(n) for n in each], *more).first().asDict()


def interleaved(df: DataFrame, by: Sequence[str], error: float = 0.0005) -> Column:
    """Z-order number of a row: the bits of its ranks in each column in turn. NULL comes first.

    Ranks are positions among RANKS - 1 bounds that a mergeable sketch finds of each column;
    the bounds are all that comes to the driver. Bounds that are equal, as of a value that a
    third of all rows have, give that value one rank.
    """
    if not 0 < len(by) * (BITS + 1) < 64:
        raise ValueError(f"one to {63 // (BITS + 1)} columns")
    spots = [i / RANKS for i in range(1, RANKS)]
    accuracy = F.lit(int(1 / error))
    row = df.agg(*[F.percentile_approx(F.col(c), F.array(*[F.lit(s) for s in spots]), accuracy).alias(c) for c in by]).first()
    ranks = []
    for c in by:
        # As Spark orders them, NaN last.
        bounds = sorted({b for b in row[c] or () if b == b}) + [b for b in row[c] or () if b != b][:1]
        ranks.append(_rank(F.col(c), F.array(*[F.lit(b).cast(df.schema[c].dataType) for b in bounds])) if bounds else F.lit(0))
    bits = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long"), b * len(ranks) + i) for i, r in enumerate(ranks) for b in range(BITS + 1)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _rank(value: Column, bounds: Column) -> Column:
    """1 and the number of bounds that are no greater; 0 for NULL. The bounds are ascending, fewer than RANKS, and searched by halves."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(BITS))])
    # Beyond the last bound there is NULL, which is no lower than any value.
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= value, at + step).otherwise(at))
    return F.when(value.isNull(), 0).otherwise(1 + below)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    # Versions

    def versions(self) -> list[int]:
        return sorted(int(n[: -len(".json")]) for n in names(self.spark, f"{self.root}/_log") if n.endswith(".json") and n[: -len(".json")].isdigit())

    def entry(self, version: int | None = None) -> dict:
        """The entry of a version, or of the current one."""
        known = self.versions()
        if not known or version is not None and version not in known:
            raise LookupError(f"no version {version or ''} of {self.root}")
        return read_json(self.spark, f"{self.root}/_log/{version or known[-1]}.json")

    def history(self) -> DataFrame:
        """One row for each version: version, operation, rows, files, bytes, at."""
        entries = [self.entry(v) for v in self.versions()]
        return self.spark.createDataFrame([(e["version"], e["operation"], e["rows"], e["files"], e["bytes"], e["at"]) for e in entries], "version int, operation string, rows long, files int, bytes long, at double")

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self.entry(version)['data']}")

    # Writing

    def write(self, df: DataFrame, not_null: Sequence[str] = (), key: Sequence[str] = (), checks: dict[str, Column] | None = None, operation: str = "WRITE", stats: Sequence[str] = ()) -> int:
        """Stages df, audits what was staged, and publishes it if nothing is violated; else raises CheckFailed with the counts."""
        data = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{data}")
        return self._publish(data, operation, not_null, key, checks, stats)

    def _publish(self, data: str, operation: str, not_null=(), key=(), checks=None, stats=()) -> int:
        staged = self.spark.read.parquet(f"{self.root}/{data}")
        found = audit(staged, not_null, key, checks)
        version = max(self.versions(), default=0) + 1
        if bad := {k: n for k, n in found.items() if k != "rows" and n}:
            write_json(self.spark, f"{self.root}/_refused/{uuid.uuid4().hex}.json", {"version": version, "operation": operation, "audit": found, "at": time.time()})
            remove(self.spark, f"{self.root}/{data}")
            raise CheckFailed("; ".join(f"{k}: {n} rows" for k, n in sorted(bad.items())))
        sizes = self._sizes(data)
        entry = {"version": version, "operation": operation, "data": data, "rows": found["rows"], "files": len(sizes), "bytes": sum(sizes.values()), "audit": found, "stats": None, "at": time.time()}
        if stats:
            entry["stats"] = f"_stats/{data.rpartition('/')[2]}"
            ends = [f(c).alias(f"{side}_{i}") for i, c in enumerate(stats) for side, f in (("low", F.min), ("high", F.max))]
            per_file = staged.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"), *ends)
            per_file.write.parquet(f"{self.root}/{entry['stats']}")
            entry["columns"] = list(stats)
        try:
            write_json(self.spark, f"{self.root}/_log/{version}.json", entry)
        except Exception:
            remove(self.spark, f"{self.root}/{data}")  # another writer was faster
            raise
        return version

    def refused(self) -> list[dict]:
        """The audits of writes that were not published, oldest first."""
        found = [read_json(self.spark, f"{self.root}/_refused/{n}") for n in names(self.spark, f"{self.root}/_refused") if n.endswith(".json")]
        return sorted(found, key=lambda r: r["at"])

    def _sizes(self, data: str) -> dict[str, int]:
        fs, at = file_system(self.spark, f"{self.root}/{data}")
        return {s.getPath().getName(): s.getLen() for s in fs.listStatus(at) if s.getPath().getName().endswith(".parquet")}

    # Layout

    def cluster(self, by: Sequence[str], files: int) -> int:
        """A new version of the same rows, ordered by a Z curve over the columns and cut into about so many files."""
        rows = self.read()
        z = rows.withColumn("_z", interleaved(rows, by))
        # Rows of equal number may part, so that a value of a third of all rows fills many files.
        spread = z.withColumn("_s", F.xxhash64(*rows.columns))
        out = spread.repartitionByRange(files, "_z", "_s").sortWithinPartitions("_z", *by).drop("_z", "_s")
        return self.write(out, operation=f"CLUSTER BY {', '.join(by)}", stats=by)

    def compact(self, target: int = SMALL) -> int | None:
        """A new version in which files below the target are packed; larger ones are kept as they are, by copy. None if there is nothing to pack."""
        entry = self.entry()
        sizes = self._sizes(entry["data"])
        small = sorted(n for n, size in sizes.items() if size < target)
        packed = max(1, -(-sum(sizes[n] for n in small) // target))
        if len(small) <= packed:
            return None
        old, data = f"{self.root}/{entry['data']}", f"data/{uuid.uuid4().hex}"
        rows = self.spark.read.parquet(*[f"{old}/{n}" for n in small])
        rows.coalesce(packed).write.parquet(f"{self.root}/{data}")
        fs, _ = file_system(self.spark, self.root)
        jvm = self.spark.sparkContext._jvm
        path, conf = jvm.org.apache.hadoop.fs.Path, self.spark.sparkContext._jsc.hadoopConfiguration()
        for n in sizes.keys() - set(small):
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, path(f"{old}/{n}"), fs, path(f"{self.root}/{data}/{n}"), False, conf)
        return self._publish(data, "COMPACT", stats=entry.get("columns", ()))

    def vacuum(self, keep: int) -> list[int]:
        """Deletes all but the newest versions, entry first; returns those that went."""
        gone = self.versions()[:-keep] if keep > 0 else []
        for v in gone:
            entry = self.entry(v)
            remove(self.spark, f"{self.root}/_log/{v}.json")
            remove(self.spark, f"{self.root}/{entry['data']}")
            if entry["stats"]:
                remove(self.spark, f"{self.root}/{entry['stats']}")
        return gone

    def scan(self, ranges: dict[str, tuple[object, object]]) -> tuple[DataFrame, int, int]:
        """(the rows whose columns lie between these ends, files read, files there are); an end that is None is open."""
        entry = self.entry()
        kept = F.lit(True)
        for c, (low, high) in ranges.items():
            kept = kept & (F.col(c) >= low if low is not None else F.lit(True)) & (F.col(c) <= high if high is not None else F.col(c).isNotNull())
        if not entry["stats"]:
            return self.read().where(kept), entry["files"], entry["files"]
        files = self.spark.read.parquet(f"{self.root}/{entry['stats']}")
        for i, c in enumerate(entry["columns"]):
            if c in ranges:
                low, high = ranges[c]
                files = files.where((F.col(f"high_{i}") >= low) if low is not None else F.lit(True)).where((F.col(f"low_{i}") <= high) if high is not None else F.lit(True))
        hit = [f"{self.root}/{entry['data']}/{r.file}" for r in files.select("file").collect()]  # the paths of a scan
        rows = self.spark.read.schema(self.read().schema).parquet(*hit) if hit else self.read().limit(0)
        return rows.where(kept), len(hit), entry["files"]
