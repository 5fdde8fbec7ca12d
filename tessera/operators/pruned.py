"""Exact nearest neighbours that leave out groups of vectors which cannot hold any.

Vectors of length one are grouped by the nearest of at most CENTROIDS centroids, which are
a sample fitted once; a group has a radius, the largest distance of a member from its
centroid. By the triangle inequality no member is nearer to a query than the centroid less
the radius. Each query visits groups in the order of that bound, four times as many in
each round, until none is left whose bound is below the distance of the k-th found so far. So
the result is that of a full comparison, whatever the centroids are.

Centroids and radii are all that comes to the driver. Groups are kept as blocks, so a group
of any size is many rows; queries meet them in blocks too, one product of matrices each.
Joins are told to shuffle: a query's vector goes to each group that it visits, and a file in
which vectors repeat is so small that Spark would take them for something to broadcast.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.scratch import written

#: Centroids at most, and rounds that move them to their members' mean.
CENTROIDS, ROUNDS = 256, 3
#: Vectors in a block, queries in a block, and groups of the first round.
BLOCK, ASKED, FIRST = 512, 256, 2
#: What rounding may add to a distance.
SLACK = 1e-6


@dataclass
class Groups:
    """blocks: (grp, n, ids, m); centroids and radii by group number."""

    blocks: DataFrame
    centroids: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray


def _unit(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): vectors of length one; those without a length are left out."""
    square = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    good = df.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.sqrt(square).alias("s")).where("s > 0 AND NOT isnan(s) AND s < double('infinity')")
    return good.select("id", F.transform("v", lambda x: x.cast("double") / F.col("s")).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _nearest(centroids: np.ndarray):
    """Rows (id, v) to (id, v, grp, d): the nearest centroid and its distance."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("v")) if len(b) else np.empty((0, centroids.shape[1]))
            dot = x @ centroids.T
            far = np.maximum(0, 1 + (centroids**2).sum(1) - 2 * dot)
            grp = far.argmin(1) if len(x) else np.empty(0, np.int64)
            d = np.sqrt(((x - centroids[grp]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(grp.astype(np.int32)), pa.array(d)], ["id", "v", "grp", "d"])

    return go


def _packed(most: int, *extra: str):
    """Rows sorted by group to blocks (grp, ids, m[, extra]) of ``most`` rows."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grp, held, names = None, [], ["grp", "ids", "m", *extra]

        def block() -> pa.RecordBatch:
            ids = pa.array([[h[0] for h in held]], pa.list_(kind))
            more = [pa.array([[h[2 + i] for h in held]], pa.list_(pa.float64())) for i in range(len(extra))]
            return pa.RecordBatch.from_arrays([pa.array([grp], pa.int32()), ids, pa.array([np.array([h[1] for h in held]).tobytes()], pa.binary()), *more], names)

        kind = pa.int64()
        for b in batches:
            kind = b.schema.field("id").type
            for g, *row in zip(*(b.column(c).to_pylist() for c in ("grp", "id", "v", *extra)), strict=True):
                if held and (g != grp or len(held) == most):
                    yield block()
                    held = []
                grp = g
                held.append(row)
        if held:
            yield block()

    return go


def group(vectors: DataFrame, key: str, vector: str) -> Groups:
    """Groups of the vectors, all of one dimension."""
    unit = written(_unit(vectors, key, vector), "unit")
    few = unit.orderBy(F.xxhash64("id")).limit(CENTROIDS).collect()  # a sample
    if not few:
        return Groups(unit.sparkSession.createDataFrame([], "grp int, ids array<long>, m binary"), np.empty((0, 1)), np.empty(0), np.empty(0))
    centroids = np.array([r.v for r in few])
    kind = unit.schema["id"].dataType.simpleString()
    for _ in range(ROUNDS):
        near = unit.mapInArrow(_nearest(centroids), f"id {kind}, v array<double>, grp int, d double")
        means = near.select("grp", F.posexplode("v").alias("p", "x")).groupBy("grp", "p").agg(F.avg("x").alias("x"))
        for r in means.collect():  # CENTROIDS times the dimension
            centroids[r.grp, r.p] = r.x
    near = written(unit.mapInArrow(_nearest(centroids), f"id {kind}, v array<double>, grp int, d double"), "grouped")
    radii, sizes = np.zeros(len(centroids)), np.zeros(len(centroids), np.int64)
    for r in near.groupBy("grp").agg(F.max("d").alias("r"), F.count("*").alias("n")).collect():
        radii[r.grp], sizes[r.grp] = r.r, r.n
    # Dealt by group and a digest, so that no group is one task's; sorted, so that blocks are full.
    dealt = near.repartition("grp", F.pmod(F.xxhash64("id"), F.lit(64))).sortWithinPartitions("grp")
    blocks = written(dealt.mapInArrow(_packed(BLOCK), f"grp int, ids array<{kind}>, m binary"), "group-blocks")
    return Groups(blocks, centroids, radii, sizes)


def top_k(queries: DataFrame, groups: Groups, k: int, query_id: str, vector_id: str, exclude_self: bool = False, embedding: str = "embedding") -> tuple[DataFrame, float]:
    """((query_id, vector_id, score, rank) as retrieval.top_k has them, the share of groups that queries left out)."""
    asked = written(_unit(queries, query_id, embedding), "asked")
    centroids, radii, sizes = groups.centroids, groups.radii, groups.sizes
    here = np.flatnonzero(sizes)
    kinds = asked.schema["id"].dataType.simpleString(), groups.blocks.schema["ids"].dataType.elementType.simpleString()

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x = _matrix(b.column("v"))
            d = np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + (centroids[here] ** 2).sum(1) - 2 * (x @ centroids[here].T)))
            low = np.maximum(0, d - radii[here] - SLACK)
            order = np.lexsort((d, low))
            lists = lambda m, t: pa.array([row.tolist() for row in m], pa.list_(t))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), lists(here[order], pa.int32()), lists(np.take_along_axis(low, order, 1), pa.float64())], ["id", "v", "order", "low"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for qi, qm, vi, vm in zip(*(b.column(c).to_pylist() for c in ("q_ids", "q_m", "ids", "m")), strict=True):
                by_id = np.argsort(np.array(vi))
                ids = np.array(vi)[by_id]
                score = np.round(np.frombuffer(qm).reshape(len(qi), -1) @ np.frombuffer(vm).reshape(len(vi), -1)[by_id].T, 12)
                if exclude_self:
                    score[np.array(qi)[:, None] == ids[None, :]] = -np.inf
                best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                found = np.take_along_axis(score, best, 1)
                keep = np.isfinite(found)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(qi), keep.sum(1))), pa.array(ids[best[keep]]), pa.array(found[keep])], [query_id, vector_id, "score"])

    shape = f"{query_id} {kinds[0]}, {vector_id} {kinds[1]}, score double"
    spark = queries.sparkSession
    found, seen, visited = spark.createDataFrame([], shape), 0, 0
    if not len(here):
        return found.withColumn("rank", F.lit(1)), 0.0
    ways = written(asked.mapInArrow(bounds, f"id {kinds[0]}, v array<double>, order array<int>, low array<double>"), "bounds")
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), vector_id)
    step = FIRST
    while seen < len(here):
        reach = ways
        if seen:
            # The k-th score so far as a distance of unit vectors; without k of them nothing is ruled out.
            kth = found.where(F.col("rank") == k).select(F.col(query_id).alias("id"), F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))).alias("far"))
            reach = ways.hint("merge").join(kth, "id", "left").where(F.col("far").isNull() | (F.element_at("low", seen + 1) <= F.col("far") + SLACK))
        else:
            reach = ways.withColumn("far", F.lit(None).cast("double"))
        some = F.slice(F.arrays_zip("order", "low"), seen + 1, step)
        due = reach.select("id", "v", "far", F.explode(some).alias("g")).where(F.col("far").isNull() | (F.col("g.low") <= F.col("far") + SLACK))
        due = written(due.select("id", "v", F.col("g.order").alias("grp")), "due")
        n = due.count()
        if not n:
            break
        visited += n
        packs = due.repartition("grp", F.pmod(F.xxhash64("id"), F.lit(16))).sortWithinPartitions("grp").mapInArrow(_packed(ASKED), f"grp int, ids array<{kinds[0]}>, m binary")
        pairs = packs.select("grp", F.col("ids").alias("q_ids"), F.col("m").alias("q_m")).hint("merge").join(groups.blocks, "grp")
        more = pairs.select("q_ids", "q_m", "ids", "m").mapInArrow(meet, shape)
        both = found.select(query_id, vector_id, "score").unionByName(more)
        found = written(both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k), "found")
        seen += step
        step *= 4
    total = asked.count() * len(here)
    return found, 1 - visited / total if total else 0.0


# Sent to workers by value: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
