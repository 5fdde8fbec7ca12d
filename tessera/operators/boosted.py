"""Gradient-boosted trees that take missing values as they are.

Squared error on histograms, as Spark aggregates: for each level of a tree the gradients
and rows are summed by node, feature and bin, where a missing number has a bin of its own
and so has a category that the model has not seen. For every split both ways for missing
rows are weighed and the better one is kept in the tree, so no value is imputed and no
flag column is made. Only histograms come to the driver: nodes times features times bins.

Numbers are cut at BINS - 1 quantiles of a mergeable sketch; of a category's values the
BINS - 1 most frequent have bins, ordered by their mean target, the others share the bin
of unseen ones. Predictions are nested CASE expressions and stay in generated code.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import written

BINS = 64
#: The bin of missing numbers, unseen and NULL categories.
MISSING = -1


@dataclass
class Split:
    """feature is an index; bins up to ``upto`` go left, missing ones if ``missing_left``; leaf is the value of a node without split."""

    feature: int = -1
    upto: int = 0
    missing_left: bool = True
    gain: float = 0.0
    leaf: float = 0.0
    left: Split | None = None
    right: Split | None = None


@dataclass
class Boosted:
    numeric: list[str]
    categorical: list[str]
    cuts: dict[str, list[float]]
    ranks: dict[str, dict[str, int]]
    base: float
    rate: float
    trees: list[Split] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def bin(self, name: str) -> Column:
        """A feature's bin: how many cuts lie below a number, the rank of a category."""
        if name in self.cuts:
            x = F.col(name).cast("double")
            cuts = self.cuts[name]
            at = _below(F.array(*map(F.lit, cuts)), x) if cuts else F.lit(0)
            return F.when(x.isNull() | F.isnan(x), MISSING).otherwise(at)
        known = self.ranks[name]
        if not known:
            return F.lit(MISSING)
        pairs = [F.lit(v) for item in known.items() for v in item]
        return F.coalesce(F.element_at(F.create_map(*pairs), F.col(name).cast("string")), F.lit(MISSING))

    def binned(self, df: DataFrame) -> DataFrame:
        """df with _b, the bins of all features."""
        return df.withColumn("_b", F.array(*[self.bin(f).cast("int") for f in self.features]))

    def tree(self, node: Split) -> Column:
        if node.left is None:
            return F.lit(float(node.leaf))
        b = F.element_at("_b", node.feature + 1)
        left = (b == MISSING) if node.missing_left else F.lit(False)
        return F.when(left | ((b != MISSING) & (b <= node.upto)), self.tree(node.left)).otherwise(self.tree(node.right))

    def predict(self, df: DataFrame, name: str = "predicted") -> DataFrame:
        """df with the prediction."""
        total = reduce(lambda a, t: a + F.lit(self.rate) * self.tree(t), self.trees, F.lit(self.base))
        return self.binned(df).withColumn(name, total).drop("_b")


def _below(cuts: Column, x: Column) -> Column:
    return F.size(F.filter(cuts, lambda c: c < x))


def _bins(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str) -> tuple[dict, dict]:
    spots = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    cuts: dict[str, list[float]] = {}
    if numeric:
        clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numeric}
        row = df.agg(*[F.percentile_approx(x, spots, F.lit(10_000)).alias(c) for c, x in clean.items()]).first()
        cuts = {c: sorted(set(row[c] or ())) for c in numeric}
    ranks: dict[str, dict[str, int]] = {}
    for c in categorical:
        by = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).agg(F.count("*").alias("n"), F.avg(target).alias("m"))
        top = by.orderBy(F.desc("n"), "v").limit(BINS - 1).collect()
        ranks[c] = {r.v: i for i, r in enumerate(sorted(top, key=lambda r: (r.m, r.v)))}
    return cuts, ranks


def best_split(hist: dict[int, tuple[float, int]], least: int) -> tuple[float, int, bool] | None:
    """(gain, last bin on the left, missing left) of one feature's histogram bin -> (gradient sum, rows); ties go to the first."""
    total_g, total_n = sum(g for g, _ in hist.values()), sum(n for _, n in hist.values())
    miss_g, miss_n = hist.get(MISSING, (0.0, 0))
    best, g, n = None, 0.0, 0
    own = sorted(b for b in hist if b != MISSING)
    for b in own:
        g, n = g + hist[b][0], n + hist[b][1]
        for missing_left in (True, False):
            lg, ln = (g + miss_g, n + miss_n) if missing_left else (g, n)
            rn = total_n - ln
            if ln < least or rn < least:
                continue
            gain = lg * lg / ln + (total_g - lg) ** 2 / rn - total_g * total_g / total_n
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = gain, b, missing_left
    return best


def fit(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str], target: str, rounds: int = 20, depth: int = 4, rate: float = 0.1, least: int = 20) -> Boosted:
    """Trees on the rows that have a target. Binned rows are written once; each level of a tree is one pass over them."""
    rows = train.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double"))).withColumn("_y", F.col(target).cast("double"))
    cuts, ranks = _bins(rows, numeric, categorical, "_y")
    model = Boosted(list(numeric), list(categorical), cuts, ranks, float(rows.agg(F.avg("_y")).first()[0] or 0.0), rate)
    rows = written(model.binned(rows).select("_b", "_y").withColumn("_p", F.lit(model.base)), "binned")
    for _ in range(rounds):
        tree = Split()
        leaves = {1: tree}  # by number: the children of n are 2n and 2n + 1
        for level in range(depth + 1):
            found = _histograms(rows, tree, leaves)
            grown: dict[int, Split] = {}
            for number, node in leaves.items():
                hists = found.get(number, {})
                some = next(iter(hists.values()), {})
                n = sum(c for _, c in some.values())
                node.leaf = sum(g for g, _ in some.values()) / n if n else 0.0
                options = [(s, f) for f in sorted(hists) if (s := best_split(hists[f], least))] if level < depth else []
                if options:
                    (node.gain, node.upto, node.missing_left), node.feature = max(options, key=lambda o: (round(o[0][0], 9), -o[1]))
                    node.left, node.right = Split(), Split()
                    grown |= {2 * number: node.left, 2 * number + 1: node.right}
            leaves = grown
            if not leaves:
                break
        model.trees.append(tree)
        rows = written(rows.withColumn("_p", F.col("_p") + F.lit(rate) * model.tree(tree)), "boosted")
    return model


def _node(tree: Split, number: int = 1) -> Column:
    """The number of the leaf that a row falls into."""
    if tree.left is None:
        return F.lit(number)
    b = F.element_at("_b", tree.feature + 1)
    left = (b == MISSING) if tree.missing_left else F.lit(False)
    return F.when(left | ((b != MISSING) & (b <= tree.upto)), _node(tree.left, 2 * number)).otherwise(_node(tree.right, 2 * number + 1))


def _histograms(rows: DataFrame, tree: Split, leaves: dict[int, Split]) -> dict[int, dict[int, dict[int, tuple[float, int]]]]:
    """node -> feature -> bin -> (sum of residuals, rows); sums are of whole millionths, so they do not depend on the order of rows."""
    small = F.round((F.col("_y") - F.col("_p")) * 1e6).cast("decimal(38,0)")
    at = rows.select(_node(tree).alias("node"), small.alias("g"), F.posexplode("_b").alias("f", "b")).where(F.col("node").isin(list(leaves)))
    out: dict[int, dict[int, dict[int, tuple[float, int]]]] = {}
    for r in at.groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.count("*").alias("n")).collect():
        out.setdefault(r.node, {}).setdefault(r.f, {})[r.b] = (float(r.g) / 1e6, r.n)
    return out


def importance(model: Boosted) -> dict[str, float]:
    """Each feature's share of all gains."""
    gains = dict.fromkeys(model.features, 0.0)

    def walk(node: Split) -> None:
        if node.left is not None:
            gains[model.features[node.feature]] += node.gain
            walk(node.left)
            walk(node.right)

    for t in model.trees:
        walk(t)
    total = math.fsum(gains.values())
    return {f: g / total if total else 0.0 for f, g in gains.items()}
