"""SQL files, and a guard that lets only queries through."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ROWS = 50
#: Words that write.
WRITES = "insert update delete merge drop alter create grant revoke truncate".split()
_WRITES = re.compile(r"\b(" + "|".join(WRITES) + r")\b", re.I)


def statements(text: str) -> list[str]:
    """The statements of a file: cut at a semicolon that ends a line; fragments of comments alone are dropped."""
    out = []
    for part in re.split(r";[ \t]*(?:\r?\n|\Z)", text):
        code = [line for line in part.splitlines() if line.strip() and not line.strip().startswith("--")]
        if code:
            out.append(part.strip())
    return out


def run_file(spark: SparkSession, text: str) -> list[list]:
    """The first rows of each statement's result."""
    return [spark.sql(s).limit(ROWS).collect() for s in statements(text)]


def select_only(spark: SparkSession, sql: str) -> str:
    """The bare query, or ValueError. Words that write are refused wherever they stand; then the parser must see a query."""
    bare = re.sub(r"^\s*```(?:sql)?\s*|\s*```\s*$", "", sql.strip(), flags=re.I).strip().rstrip(";").strip()
    if not re.match(r"(select|with)\b", bare, re.I):
        raise ValueError("only SELECT is allowed")
    if ";" in bare:
        raise ValueError("one statement only")
    if m := _WRITES.search(bare):
        raise ValueError(f"{m[1]} is not allowed")
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(bare).getClass().getSimpleName()
    if re.search("Insert|Create|Drop|Delete|Update|Merge|Command|Replace|Alter", plan):
        raise ValueError(f"{plan} is not a query")
    return bare


def query(spark: SparkSession, sql: str) -> DataFrame:
    """A guarded query, at most ROWS rows."""
    return spark.sql(select_only(spark, sql)).limit(ROWS)


def explain(spark: SparkSession, sql: str) -> str:
    """EXPLAIN FORMATTED of a guarded query."""
    return spark.sql("EXPLAIN FORMATTED " + select_only(spark, sql)).first()[0]
