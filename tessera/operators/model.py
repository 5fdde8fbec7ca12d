"""A gradient-boosted regression, its evaluation, the promotion gate and a JSON registry."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.scratch import written

MARGIN = 0.02


def with_missing_flags(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("double") for c in numeric} | {c: F.col(c).cast("double") for c in numeric})


def fit(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str], target: str, seed: int = 7, rounds: int = 20, depth: int = 4) -> PipelineModel:
    """Trees over indexed categories (unseen ones have an index of their own), imputed numbers and missing flags."""
    # Written once: categories, medians and trees each read the rows, and lags or medians behind them are not computed again.
    ready = written(with_missing_flags(train, numeric).where(F.col(target).isNotNull()), "training")
    most = max([32, *(r + 2 for r in ready.agg(*[F.count_distinct(c).alias(c) for c in categorical]).first())]) if categorical else 32
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c in categorical]
    stages.append(Imputer(inputCols=list(numeric), outputCols=[f"{c}_f" for c in numeric], strategy="median"))
    inputs = [f"{c}_i" for c in categorical] + [f"{c}_f" for c in numeric] + [f"{c}_missing" for c in numeric]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    stages.append(GBTRegressor(labelCol=target, featuresCol="features", predictionCol="predicted", maxIter=rounds, maxDepth=depth, maxBins=most, seed=seed))
    return Pipeline(stages=stages).fit(ready)


def score(model: PipelineModel, df: DataFrame, numeric: Sequence[str], name: str = "predicted") -> DataFrame:
    """df with the prediction; columns made on the way are dropped."""
    out = model.transform(with_missing_flags(df, numeric))
    return out.select(*df.columns, F.col("predicted").alias(name))


def batch_score(model: PipelineModel, df: DataFrame, numeric: Sequence[str], month: str, version: int, scored_at: Column, path: str, name: str = "predicted") -> DataFrame:
    """Scores the last month, stamps version and time, and replaces just that month's partition of a Parquet table; the same call twice leaves the same rows."""
    from tessera.operators.marts import latest
    from tessera.sources.sinks import replace_partitions

    out = score(model, latest(df, month), numeric, name).withColumns({"model_version": F.lit(version), "scored_at": scored_at})
    replace_partitions(out, path, month)
    return out


def evaluate(scored: DataFrame, predicted: str, actual: str) -> DataFrame:
    """One row: n, mae, r2. NULLs on either side are left out."""
    good = scored.where(F.col(predicted).isNotNull() & F.col(actual).isNotNull())
    error = F.col(predicted) - F.col(actual)
    r2 = 1 - F.sum(error * error) / F.nullif(F.var_pop(actual) * F.count("*"), F.lit(0.0))
    return good.agg(F.count("*").alias("n"), F.avg(F.abs(error)).alias("mae"), r2.alias("r2"))


def naive_mae(df: DataFrame, target: str, lag: str) -> DataFrame:
    """One row: the error of predicting last month's value, rows without one left out."""
    return evaluate(df, lag, target).select("n", "mae")


def challenger_wins(challenger: float, champion: float | None, margin: float = MARGIN) -> bool:
    """True without a champion, else only if strictly better by the margin."""
    return champion is None or challenger < champion * (1 - margin)


class Registry:
    """Versions and their errors in a JSON file of the driver, with a champion and a challenger alias.

    One driver at a time registers: a lock file stands beside it, and a second one fails.
    """

    def __init__(self, path: str):
        self.path = Path(path)

    def read(self) -> dict:
        return json.loads(self.path.read_text()) if self.path.exists() else {"versions": [], "aliases": {}}

    def register(self, name: str, mae: float) -> tuple[int, bool]:
        """The new version's number, and whether it became champion."""
        lock = self.path.with_suffix(".lock")
        lock.open("x").close()
        try:
            return self._add(name, mae)
        finally:
            lock.unlink()

    def _add(self, name: str, mae: float) -> tuple[int, bool]:
        data = self.read()
        version = len(data["versions"]) + 1
        data["versions"].append({"version": version, "name": name, "mae": mae})
        data["aliases"]["challenger"] = version
        champion = data["aliases"].get("champion")
        wins = challenger_wins(mae, data["versions"][champion - 1]["mae"] if champion else None)
        if wins:
            data["aliases"]["champion"] = version
        fresh = self.path.with_suffix(".tmp")
        fresh.write_text(json.dumps(data, indent=1))
        fresh.replace(self.path)
        return version, wins


class StoreRegistry:
    """Versions and their errors as files ``<n>.json`` of any store, one for each version.

    The store refuses a file that is there, so two drivers cannot take one number and no
    lock is left behind by a crash. Aliases follow from the versions: the challenger is the
    last, the champion the last one that beat the champion before it by the margin.
    """

    def __init__(self, spark: SparkSession, root: str, margin: float = MARGIN):
        self.spark, self.root, self.margin = spark, root, margin

    def versions(self) -> list[dict]:
        from tessera.sources.landing import names
        from tessera.sources.scratch import read_json

        numbers = sorted(int(n.removesuffix(".json")) for n in names(self.spark, self.root) if n.removesuffix(".json").isdigit())
        return [read_json(self.spark, f"{self.root}/{n}.json") for n in numbers]

    def aliases(self) -> dict[str, int]:
        out: dict[str, int] = {}
        best = None
        for v in self.versions():
            out["challenger"] = v["version"]
            if challenger_wins(v["mae"], best, self.margin):
                best, out["champion"] = v["mae"], v["version"]
        return out

    def register(self, name: str, mae: float, tries: int = 10) -> tuple[int, bool]:
        """The new version's number, and whether it became champion; another number is tried where a second driver was faster."""
        from tessera.sources.scratch import write_json

        for n in range(tries):
            version = len(self.versions()) + 1
            try:
                write_json(self.spark, f"{self.root}/{version}.json", {"version": version, "name": name, "mae": mae})
            except Exception as e:
                if "AlreadyExists" not in str(e) or n == tries - 1:
                    raise
                continue
            return version, self.aliases()["champion"] == version
        raise RuntimeError("no number was free")
