"""Table sinks that work on plain Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def rebuild(df: DataFrame, table: str, cluster_by: Sequence[str] = ()) -> None:
    """Overwrites a table, schema and all; range-clusters rows by the given columns so that footers prune."""
    out = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by) if cluster_by else df
    out.write.mode("overwrite").saveAsTable(table)


def create_as(spark: SparkSession, table: str, query: str) -> None:
    """CREATE OR REPLACE TABLE ... AS SELECT, for a catalog that cannot replace: the old table goes once the query has been analysed."""
    spark.sql(query).write.mode("overwrite").format("parquet").saveAsTable(table)


def insert_select(spark: SparkSession, table: str, query: str, columns: Sequence[str] = ()) -> None:
    """INSERT INTO ... SELECT, by name where columns are given."""
    names = f" ({', '.join(columns)})" if columns else ""
    spark.sql(f"INSERT INTO {table}{names} {query}")


def comment(spark: SparkSession, table: str, text: str) -> None:
    """COMMENT ON TABLE."""
    spark.sql(f"COMMENT ON TABLE {table} IS " + "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'")


def replace_partitions(df: DataFrame, path: str, by: str = "month") -> None:
    """Replaces just the partitions that df has; the same call twice leaves the same data."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def insert_row(spark: SparkSession, table: str, values: dict[str, object]) -> None:
    """INSERT ... VALUES with named parameters."""
    names = ", ".join(values)
    spark.sql(f"INSERT INTO {table} ({names}) VALUES ({', '.join(':' + n for n in values)})", args=values)


def create_table(spark: SparkSession, table: str, columns: dict[str, tuple[str, str]], comment: str = "") -> None:
    """CREATE TABLE IF NOT EXISTS; columns: name to (type, comment)."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    cols = ", ".join(f"`{n}` {t} COMMENT {quote(c)}" for n, (t, c) in columns.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet COMMENT {quote(comment)}")


def row_filter(spark: SparkSession, name: str, column: str, kind: str, condition: str, df: DataFrame) -> DataFrame:
    """Rows for which a SQL function of one column holds; the function stays registered under its name."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x {kind}) RETURNS BOOLEAN RETURN {condition}")
    return spark.sql(f"SELECT * FROM {{rows}} WHERE {name}({column})", rows=df)


class Versions:
    """Snapshots of a table in folders v=1, v=2, ...; the last complete one is current."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def all(self) -> list[int]:
        from tessera.sources.landing import exists, names

        found = [int(n[2:]) for n in names(self.spark, self.root) if n.startswith("v=") and n[2:].isdigit()]
        return sorted(v for v in found if exists(self.spark, f"{self.root}/v={v}/_SUCCESS"))

    def write(self, df: DataFrame) -> int:
        v = max(self.all(), default=0) + 1
        df.write.mode("overwrite").parquet(f"{self.root}/v={v}")
        return v

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/v={version or max(self.all())}")
