"""Exactly-once file ingest with lineage, schema rescue and versioned checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.landing import exists

#: Files of one micro-batch, each with a schema of its own.
MAX_FILES = 200


def ingest(spark: SparkSession, source: str, target: str, checkpoints: str, ddl: str | None = None, version: str = "v1") -> int:
    """Appends new files of a folder to a Parquet table, then stops; returns the rows of the table.

    Each file is read once, by the checkpoint. Without ddl the schema is that of the files
    there; a folder that is missing adds nothing. A new version starts over.
    """
    if not exists(spark, source):
        return 0
    schema = ddl or spark.read.option("recursiveFileLookup", "true").parquet(source).schema
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
    rows = rows.select("*", F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_modification_time").alias("_file_time"), F.current_timestamp().alias("_ingested_at"))
    query = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", f"{checkpoints}_{version}").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(target).count() if exists(spark, target) else 0


def file_stream(spark: SparkSession, source: str) -> DataFrame:
    """A stream of the paths of Parquet files, MAX_FILES at most in a batch."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return files.option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", MAX_FILES).option("recursiveFileLookup", "true").load(source).select("path")


def rescue(df: DataFrame, columns: list[str]) -> DataFrame:
    """Declared columns as strings, NULL for those missing, and the rest as JSON in _rescued_data (NULL if there is none)."""
    extra = [c for c in df.columns if c not in columns and not c.startswith("_")]
    picked = [(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in columns]
    saved = F.nullif(F.to_json(F.struct(*extra)), F.lit("{}")) if extra else F.lit(None).cast("string")
    return df.select(*picked, saved.alias("_rescued_data"), *[c for c in df.columns if c.startswith("_") and c != "_rescued_data"])


def ingest_rescued(spark: SparkSession, source: str, target: str, checkpoints: str, columns: list[str], version: str = "v1") -> int:
    """Like ingest, for files whose schemas differ: streams the list of files, reads each batch's, and writes folder batch=<id>.

    A batch that is replayed overwrites its own folder, so rows are added once.
    """
    if not exists(spark, source):
        return 0

    def write(batch: DataFrame, number: int) -> None:
        paths = [r.path for r in batch.select("path").collect()]  # file names of one micro-batch, MAX_FILES at most
        out = None
        for p in paths:
            one = spark.read.parquet(p).select("*", F.col("_metadata.file_path").alias("_source_file"))
            one = rescue(one.withColumn("_ingested_at", F.current_timestamp()), columns)
            out = one if out is None else out.unionByName(one)
        if out is not None:
            out.write.mode("overwrite").parquet(f"{target}/batch={number}")

    files = file_stream(spark, source)
    files.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoints}_{version}").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target).count() if exists(spark, target) else 0
