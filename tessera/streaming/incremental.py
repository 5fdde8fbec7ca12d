"""Incremental marts: new files to affected keys to replaced partitions.

A landed file ``<label>_<sha>.parquet`` is a version of its label's rows. When files arrive,
only their labels are resolved again, and only the months that those labels had before or
have now are built again; all other partitions keep their files.

Each step overwrites partitions of its own, so a batch that is replayed, after a crash at
any point, ends in the same tables. The months of a batch are noted before the old rows
are replaced, as they could not be told afterwards.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators.versions import resolve_versions
from tessera.sources.landing import exists, landed_name, names, parse_landed
from tessera.sources.scratch import read_json, remove, write_json, written
from tessera.sources.sinks import replace_partitions
from tessera.streaming.ingest import file_stream

NO_MONTH = "none"


@dataclass
class Progress:
    """What a run has done: files read, labels resolved and months built again."""

    files: list[str] = field(default_factory=list)
    labels: set[str] = field(default_factory=set)
    months: set[str] = field(default_factory=set)


class IncrementalMart:
    """Tables ``raw`` (by file), ``silver`` (rows of winning files, by label) and ``mart`` (by month) below root.

    month gives a row's month as a date or text; build makes mart rows of silver rows and
    has to keep the column ``month`` and never to mix months. Rows without a month belong
    to the month ``none``. Labels and months come to the driver: the file names of a batch
    and the months that they touch.
    """

    def __init__(self, spark: SparkSession, root: str, month: Column, build: Callable[[DataFrame], DataFrame]):
        self.spark, self.root, self.build = spark, root, build
        self.month = F.coalesce(month.cast("string"), F.lit(NO_MONTH))

    def _read(self, table: str) -> DataFrame | None:
        path = f"{self.root}/{table}"
        if not any("=" in n for n in names(self.spark, path)):
            return None
        found = self.spark.read.option("mergeSchema", "true").parquet(path).schema
        # Folder names stay text, whatever they look like.
        kinds = [StructField(f.name, StringType() if f.name in ("_label", "_file", "month") else f.dataType) for f in found]
        return self.spark.read.schema(StructType(kinds)).parquet(path)

    def run(self, source: str) -> Progress:
        """Takes in what is new in the folder, then stops."""
        done = Progress()
        if exists(self.spark, source):
            def batch(df: DataFrame, number: int) -> None:
                self._apply(sorted({r.path for r in df.select("path").collect()}), number, done)  # file names, MAX_FILES at most

            query = file_stream(self.spark, source).writeStream.foreachBatch(batch)
            query.option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        return done

    def _apply(self, paths: list[str], number: int, done: Progress) -> None:
        """One batch. A landed folder is read whole whenever a part of it shows up."""
        landed = sorted({n for p in paths if (n := landed_name(p))})
        if not landed:
            return
        for name in landed:
            self._take(next(p[: p.index(name) + len(name)] for p in paths if landed_name(p) == name), name)
        labels = sorted({parse_landed(n)[0] for n in landed})
        files = self._read("files").where(F.col("_label").isin(labels))
        winners = resolve_versions(files, ("_file_time", "_source_file")).select(F.col("_source_file").alias("_file"))
        after = self._read("raw").where(F.col("_label").isin(labels)).join(winners, "_file", "left_semi").drop("_file", "_file_time")
        months = self._touched(number, labels, after)
        self._replace(after, "silver", "_label", labels)
        silver = self._read("silver")
        if silver is not None:
            rows = self.build(silver.where(F.col("month").isin(months)).drop("_label"))
            self._replace(written(rows, "mart"), "mart", "month", months)
        remove(self.spark, f"{self.root}/pending/{number}.json")
        done.files += landed
        done.labels |= set(labels)
        done.months |= set(months)

    def _take(self, path: str, name: str) -> None:
        """A file's rows and its entry in the list of files, which has files without rows too."""
        label = parse_landed(name)[0]
        rows = self.spark.read.parquet(path)
        rows = rows.select("*", self.month.alias("month")) if "month" not in rows.columns else rows.withColumn("month", self.month)
        rows.write.mode("overwrite").parquet(f"{self.root}/raw/_label={label}/_file={name}")
        seen = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
        entry = seen.agg(F.max("modificationTime").alias("_file_time")).select(F.lit(name).alias("_source_file"), "_file_time")
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/files/_label={label}/_file={name}")

    def _touched(self, number: int, labels: list[str], after: DataFrame) -> list[str]:
        """Months of the labels' rows before and now; noted, so that a replay knows those of before."""
        note = f"{self.root}/pending/{number}.json"
        silver = self._read("silver")
        both = after.select("month")
        if silver is not None:
            both = both.unionByName(silver.where(F.col("_label").isin(labels)).select("month"))
        months = {r.month for r in both.distinct().collect()}  # of the calendar
        if exists(self.spark, note):
            months |= set(read_json(self.spark, note))
        write_json(self.spark, note, sorted(months), overwrite=True)
        return sorted(months)

    def _replace(self, rows: DataFrame, table: str, by: str, values: list[str]) -> None:
        """Replaces these partitions; those that have no rows any more go."""
        path = f"{self.root}/{table}"
        replace_partitions(rows, path, by)
        kept = {r[by] for r in rows.select(F.col(by).cast("string")).distinct().collect()}
        for v in values:
            if v not in kept:
                remove(self.spark, f"{path}/{by}={v}")

    def rebuild(self) -> DataFrame:
        """The mart made of all files, without any of the tables that runs keep up."""
        winners = resolve_versions(self._read("files"), ("_file_time", "_source_file")).select(F.col("_source_file").alias("_file"))
        return self.build(self._read("raw").join(winners, "_file", "left_semi").drop("_file", "_label"))

    def mart(self) -> DataFrame:
        return self._read("mart")
