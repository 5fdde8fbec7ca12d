"""Landing files named by content, and other readers."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.corpus import frame_sha

_NAME = re.compile(r"^(.+)_([0-9a-f]{8})\.parquet$")


def landing_name(label: str, sha: str) -> str:
    return f"{label}_{sha}.parquet"


def parse_landed(name: str) -> tuple[str, str] | None:
    """(label, sha) of a landed file's name, or None."""
    m = _NAME.match(name.rsplit("/", 1)[-1])
    return (m[1], m[2]) if m else None


def landed_name(path: str) -> str | None:
    """The landed file or folder that a path leads to or into, or None."""
    return next((part for part in reversed(path.split("/")) if _NAME.match(part)), None)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any store; empty if it is not there."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def land(df: DataFrame, folder: str, label: str) -> str | None:
    """Writes a snapshot under its content's name; None if that content has landed before."""
    spark = df.sparkSession
    name = landing_name(label, frame_sha(df).first().sha)
    if name in names(spark, folder):
        return None
    df.write.parquet(f"{folder}/{name}")
    return name


def read_csv_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header, all columns as strings, blanks kept as empty strings."""
    ddl = ", ".join(f"`{c}` string" for c in columns)
    df = spark.read.csv(path, schema=ddl, header=True, nullValue="\x00", emptyValue="", recursiveFileLookup=True)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def load_cases(path: str, required: tuple[str, ...] = ("id", "question", "kind")) -> list[dict]:
    """Golden cases from a JSON list, or YAML where a parser is installed; a missing field is an error that names the case."""
    text = Path(path).read_text()
    if path.endswith((".yaml", ".yml")):
        import yaml

        data = yaml.safe_load(text)
    else:
        import json

        data = json.loads(text)
    cases = data["cases"] if isinstance(data, dict) else data
    for i, case in enumerate(cases):
        if gone := [f for f in required if case.get(f) in (None, "")]:
            raise ValueError(f"case {case.get('id', i)}: missing {', '.join(gone)}")
    return cases
