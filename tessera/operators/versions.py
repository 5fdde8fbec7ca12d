"""Version resolution of landed files, surrogate keys, and snapshot reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANDED = r"([^/]+)_[0-9a-f]{8}\.parquet$"


def landed_label(source_file: Column) -> Column:
    """The partition label of a landed file's name; NULL if it is not one."""
    return F.nullif(F.regexp_extract(source_file, LANDED, 1), F.lit(""))


def resolve_versions(df: DataFrame, order: Sequence[str] = ("_ingested_at", "_source_file")) -> DataFrame:
    """All rows of the newest file of each label; rows of other files are dropped.

    The winners are found from the few distinct files, so rows are not sorted: a partial
    maximum per label, then a semi-join on the file.
    """
    labelled = df.withColumn("_label", landed_label(F.col("_source_file"))).where("_label IS NOT NULL")
    newest = labelled.groupBy("_label").agg(F.max(F.struct(*order)).alias("_w")).select("_label", *[F.col(f"_w.{c}").alias(f"_w_{c}") for c in order])
    on = labelled["_label"] == newest["_label"]
    for c in order:
        on = on & labelled[c].eqNullSafe(newest[f"_w_{c}"])
    return labelled.join(newest, on, "left_semi").drop("_label")


def numbered_keys(df: DataFrame, key: Column, order: Sequence[str], name: str) -> DataFrame:
    """key-n: rows with the same business hash are numbered in a fixed order."""
    w = Window.partitionBy("_key").orderBy(*order)
    out = df.withColumn("_key", key).withColumn("_n", F.row_number().over(w))
    return out.withColumn(name, F.concat_ws("-", "_key", "_n")).drop("_key", "_n")


def newest_snapshot(df: DataFrame) -> DataFrame:
    """The rows of the newest landing; one scalar maximum rather than an unpartitioned window."""
    top = df.agg(F.max(F.struct("_ingested_at", "_source_file")).alias("_w")).select("_w._ingested_at", "_w._source_file")
    top = top.toDF("_w_at", "_w_file")
    on = df["_ingested_at"].eqNullSafe(top["_w_at"]) & df["_source_file"].eqNullSafe(top["_w_file"])
    return df.join(F.broadcast(top), on, "left_semi")  # one row


def reconcile(state: DataFrame, snapshot: DataFrame, keys: Sequence[str], columns: Sequence[str], synced_at: Column) -> DataFrame:
    """The new state: snapshot rows are current, state rows without one stay as not current.

    Keys match null-safe and must be unique on either side (see quality.duplicate_keys).
    Retired rows keep their old _synced_at; a key that comes back is current again.
    """
    old, new = state.alias("o"), snapshot.withColumn("_here", F.lit(True)).alias("n")
    on = None
    for k in keys:
        same = F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
        on = same if on is None else on & same
    both = old.join(new, on, "full_outer")
    here = F.coalesce(F.col("n._here"), F.lit(False))
    pick = [F.when(here, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in (*keys, *columns)]
    return both.select(*pick, here.alias("is_current"), F.when(here, synced_at).otherwise(F.col("o._synced_at")).alias("_synced_at"))
