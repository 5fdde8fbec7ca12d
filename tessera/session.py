"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tessera", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with ANSI mode and AQE on; other settings by keyword, dots as double underscores."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
