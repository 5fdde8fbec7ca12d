"""Helpers that the operators of this package share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tessera

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Rows in an Arrow batch: with whole texts the default of 10,000 could be gigabytes.
BATCH_ROWS = 256

_folders: set[str] = set()
_shipped: set[str] = set()


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def whole_text(name: str = "text") -> Column:
    """The text column, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def prepare_workers(spark: SparkSession) -> None:
    """Ship this package to Python workers, and keep Arrow batches of whole texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        root = Path(tessera.__file__).parent.parent
        archive = Path(tempfile.mkdtemp(prefix="tessera-code-")) / "tessera.zip"
        atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted((root / "tessera").rglob("*.py")):
                z.write(f, f.relative_to(root))
        spark.sparkContext.addPyFile(str(archive))  # the driver serves it to executors


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _path(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    It cuts the lineage and survives lost executors. The folder goes when the driver's JVM
    ends, by its own shutdown hook: after ``spark.stop()`` too, and when Python is killed.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/tessera-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        fs, at = _path(spark, folder)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
    path = f"{folder}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what materialise wrote, where nothing will read it any more."""
    fs, at = _path(df.sparkSession, df._tessera_path)
    fs.delete(at, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
