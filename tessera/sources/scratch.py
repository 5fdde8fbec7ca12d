"""Folders of the running application, in the place that driver and executors share."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder where it is unset, in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def file_system(spark: SparkSession, path: str):
    """(the path's file system, the path) as Hadoop has them."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def folder(spark: SparkSession, tag: str) -> str:
    """A new folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/tessera-{spark.sparkContext.applicationId}-core"
    if path not in _made:
        _made.add(path)
        fs, at = file_system(spark, path)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
    return f"{path}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in such a folder: it cuts the lineage and survives lost executors."""
    path = folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def write_json(spark: SparkSession, path: str, value: object, overwrite: bool = False) -> None:
    """A small file in any store; one that is there is an error, found by the store itself."""
    fs, at = file_system(spark, path)
    out = fs.create(at, overwrite)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> object:
    fs, at = file_system(spark, path)
    size = fs.getFileStatus(at).getLen()
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readNBytes(int(size))).decode())
    finally:
        stream.close()
