"""A streaming sink for files whose schemas differ and grow, and ingest of a list of entities.

The schema of a table is the least one that holds all of its files: columns of all, each of
the narrowest type of the lattice ``int < long < double < string`` that every file's values
fit; kinds beside those chains meet in string. It is kept in numbered files; a batch is
written under the schema that it led to, and readers cast older batches up, so no data is
ever rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType, ShortType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from tessera.sources.landing import exists, names
from tessera.sources.scratch import read_json, write_json
from tessera.streaming.ingest import file_stream

LINEAGE = ("_source_file", "_ingested_at")
_NUMBERS: list[type[DataType]] = [ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType]
_TIMES: list[type[DataType]] = [DateType, TimestampNTZType, TimestampType]


def wider(a: DataType, b: DataType) -> DataType:
    """The least type that both fit into; a long and a float meet in double."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return DecimalType(digits, scale) if digits <= 38 else StringType()
    for chain in (_NUMBERS, _TIMES):
        if type(a) in chain and type(b) in chain:
            low, high = sorted((chain.index(type(a)), chain.index(type(b))))
            exact = not (chain[high] is FloatType and chain[low] in (IntegerType, LongType))
            return chain[high]() if exact else DoubleType()
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged(a, b)
    return StringType()


def merged(a: StructType, b: StructType) -> StructType:
    """Columns of both, those of a first, nullable; names that differ in case alone are one column."""
    mine = {f.name.lower(): f for f in a}
    theirs = {f.name.lower(): f for f in b}
    out = [StructField(f.name, wider(f.dataType, theirs[k].dataType) if k in theirs else f.dataType) for k, f in mine.items()]
    return StructType(out + [StructField(f.name, f.dataType) for k, f in theirs.items() if k not in mine])


def fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """df with the columns of schema, NULL where it has none; nested values become JSON where text is asked for."""
    have = {f.name.lower(): f for f in df.schema}

    def column(f: StructField):
        own = have.get(f.name.lower())
        if own is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        at = F.col(f"`{own.name}`")
        if isinstance(f.dataType, StringType) and own.dataType.typeName() in ("struct", "array", "map"):
            return F.to_json(at).alias(f.name)
        if isinstance(f.dataType, StructType) and isinstance(own.dataType, StructType) and f.dataType != own.dataType:
            return F.from_json(F.to_json(at), f.dataType).alias(f.name)
        return at.cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema])


class MergedTable:
    """Batches under ``schema=<n>/batch=<id>``, schemas in ``_schemas/<n>.json``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def versions(self) -> list[int]:
        return sorted(int(n[: -len(".json")]) for n in names(self.spark, f"{self.root}/_schemas") if n.endswith(".json") and n[: -len(".json")].isdigit())

    def schema(self, version: int | None = None) -> StructType:
        known = self.versions()
        return StructType.fromJson(read_json(self.spark, f"{self.root}/_schemas/{version or known[-1]}.json")) if known else StructType([])

    def write_batch(self, batch: str, paths: Sequence[str]) -> int:
        """Adds files as one batch; the same batch again replaces itself. Returns the schema's version.

        The least common schema of a table and files that it has already is its own, so a
        replay finds the version that it made and writes the same folder.
        """
        by_schema: dict[str, tuple[StructType, list[str]]] = {}
        for p in paths:  # files of one micro-batch; footers only
            found = self.spark.read.parquet(p).schema
            by_schema.setdefault(found.json(), (found, []))[1].append(p)
        known, now = self.versions(), self.schema()
        target = reduce(merged, [f for f, _ in by_schema.values()], now)
        version = known[-1] if known else 0
        if target != now or not known:
            version += 1
            write_json(self.spark, f"{self.root}/_schemas/{version}.json", target.jsonValue())
        parts = []
        for found, some in by_schema.values():
            rows = self.spark.read.schema(found).parquet(*some).select("*", F.col("_metadata.file_path").alias(LINEAGE[0]), F.current_timestamp().alias(LINEAGE[1]))
            full = StructType([*target, *[f for f in rows.schema if f.name in LINEAGE]])
            parts.append(fitted(rows, full))
        reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(f"{self.root}/schema={version}/batch={batch}")
        return version

    def read(self) -> DataFrame | None:
        """All rows under the newest schema, with _batch; None before the first batch."""
        out = []
        for v in self.versions():
            path = f"{self.root}/schema={v}"
            # A batch that broke off after its schema was noted was written again under it.
            if exists(self.spark, path) and names(self.spark, path):
                rows = self.spark.read.option("basePath", path).parquet(path)
                full = StructType([*self.schema(), *[f for f in rows.schema if f.name in LINEAGE]])
                out.append(fitted(rows, StructType([*full, StructField("batch", StringType())])).withColumnRenamed("batch", "_batch"))
        return reduce(DataFrame.unionByName, out) if out else None

    def count(self) -> int:
        rows = self.read()
        return rows.count() if rows is not None else 0


def ingest_merged(spark: SparkSession, source: str, table: MergedTable, checkpoints: str, version: str = "v1") -> int:
    """Streams the files that are new in a folder into the table, then stops; returns the table's rows, 0 for a missing folder."""
    if not exists(spark, source):
        return 0

    def write(batch: DataFrame, number: int) -> None:
        if paths := sorted(r.path for r in batch.select("path").collect()):  # MAX_FILES at most
            table.write_batch(f"{version}-{number}", paths)

    file_stream(spark, source).writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoints}_{version}").trigger(availableNow=True).start().awaitTermination()
    return table.count()


def ingest_entities(spark: SparkSession, source: str, target: str, entities: Sequence[str], version: str = "v1") -> dict[str, int]:
    """One table for each entity's subfolder: the rows of each, 0 where a folder is missing."""
    out = {}
    for e in entities:
        out[e] = ingest_merged(spark, f"{source}/{e}", MergedTable(spark, f"{target}/{e}"), f"{target}/_checkpoints/{e}", version)
    return out
