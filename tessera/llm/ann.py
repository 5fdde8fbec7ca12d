"""Approximate nearest neighbours by cross-polytope hashing, reranked exactly.

Nearness is the inner product in double precision. Vectors that are equal are one point,
of which the k + 1 least ids are kept: no others can be among the k nearest of anything.

1. A cell of more than SPLIT points is hashed: in each of TABLES tables the unit vector
   goes through a pseudo-rotation, three rounds of random signs and fast Hadamard
   transform, and to the nearest of the signed axes. That is its cell; one still larger
   than SPLIT is hashed again about its mean, with other rotations, and so on for DEPTH
   levels. Cells that are larger even then are read in chunks. A table of at most SPLIT
   points is one cell, so its result is exact.
2. A query probes the cells of each table in the order of how far it is from going there:
   the sum of squared gaps between its largest coordinate and that of the axis.
3. How many cells it probes is fitted once: the PROBED queries of least hash are searched
   exactly, and a share TARGET of what they find has to be found by the tables.
4. Points and queries meet by cell; a cell's points are one matrix. Each query keeps its
   best k + 1 of a cell with exact scores, then the best of all cells. A query that has
   found fewer than it could is searched exactly, in chunks.

Vectors of other norms are compared as directions of one more coordinate, which leaves
the order of inner products as it is (only if norms differ by more than a thousandth).

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and null ids, take no part; vectors of different lengths are never compared;
rows with one id count once, with the least of its vectors; ties go to the smaller id; an
empty table gives no rows; columns besides id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import materialise, prepare_workers

TABLES = 6
SPLIT = 1_024
DEPTH = 6
PROBED = 64
TARGET = 0.97
#: Probes of one query in one table, at most: more than a level has axes.
MANY = 1_024
SEED = 42

_CELL = "rep long, dim int, t int, leaf long"
_PROBE = _CELL + ", gap double"


@lru_cache(512)
def _signs(table: int, level: int, width: int) -> np.ndarray:
    return np.random.default_rng((SEED, table, level)).choice(np.array([-1.0, 1.0], np.float32), (3, width))


def rotate(x: np.ndarray, table: int, level: int) -> np.ndarray:
    """Pseudo-rotation of the rows of x, padded to a power of two."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, width - x.shape[1]))).astype(np.float32)
    for signs in _signs(table, level, width):
        x = x * signs
        half = 1
        while half < width:
            x = x.reshape(len(x), -1, 2, half)
            x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), 2).reshape(len(x), width)
            half *= 2
        x /= np.sqrt(width)
    return x


def directions(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n == 0, 1, n)


def child(leaf: np.ndarray, table: int, axis: np.ndarray) -> np.ndarray:
    """Numbers of the cells below cells."""
    h = leaf.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(table * 0x10001 + 1)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + axis.astype(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(32))).astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows."""
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _runs(*keys: np.ndarray) -> Iterator[slice]:
    """Slices of equal neighbours."""
    n = len(keys[0])
    cut = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1 if n else []
    edges = [0, *cut, n] if n else []
    yield from (slice(a, b) for a, b in zip(edges, edges[1:], strict=False))


def _down(level: int, probing: int):
    """Rows (rep, dim, t, leaf, vec, mean[, gap]) to the cells below: the own one, or the ``probing`` nearest."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rep, dim, t, leaf = (b.column(c).to_numpy() for c in ("rep", "dim", "t", "leaf"))
            order = np.lexsort((dim, t))
            for part in _runs(t[order], dim[order]):
                at = order[part]
                some = b.take(pa.array(at))
                x = _matrix(some.column("vec"))
                if level:
                    x = x - _matrix(some.column("mean"))
                y = rotate(directions(x), int(t[at[0]]), level)
                axis = np.abs(y).argmax(1)
                best = np.abs(y)[np.arange(len(y)), axis]
                if not probing:
                    signed = 2 * axis + (y[np.arange(len(y)), axis] < 0)
                    out = [rep[at], dim[at], t[at], child(leaf[at], int(t[at[0]]), signed)]
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in out], ["rep", "dim", "t", "leaf"])
                    continue
                gaps = (best[:, None] - np.stack((y, -y), 2).reshape(len(y), -1)) ** 2
                n = min(probing, gaps.shape[1])
                pick = np.argpartition(gaps, n - 1, axis=1)[:, :n]
                gap = np.take_along_axis(gaps, pick, 1) + some.column("gap").to_numpy()[:, None]
                wide = lambda v: np.repeat(v, n)
                out = [wide(rep[at]), wide(dim[at]), wide(t[at]), child(wide(leaf[at]), int(t[at[0]]), pick.ravel()), gap.ravel().astype(np.float64)]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in out], ["rep", "dim", "t", "leaf", "gap"])

    return go


def _best(k: int):
    """Rows of cells, points before queries, to (q, rep, score): the best k points of each cell for each of its queries."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reps, points = None, [], []
        for b in batches:
            leaf, chunk, dim, kind, rep = (b.column(c).to_numpy() for c in ("leaf", "chunk", "dim", "kind", "rep"))
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for part in _runs(leaf, chunk, dim, kind):
                key = leaf[part][0], chunk[part][0], dim[part][0]
                if key != now:
                    now, reps, points = key, [], []
                x = _matrix(b.column("vec")[part.start : part.stop])
                if kind[part][0] == 0:
                    reps.append(rep[part])
                    points.append(x)
                elif points:
                    if len(points) > 1:
                        reps, points = [np.concatenate(reps)], [np.concatenate(points)]
                    near = x @ points[0].T
                    n = min(k, near.shape[1])
                    pick = np.argpartition(-near, n - 1, axis=1)[:, :n]
                    # A product of matrices rounds by its shape; this sum does not.
                    score = (x[:, None, :] * points[0][pick]).sum(-1)
                    found.append((np.repeat(rep[part], n), reps[0][pick].ravel(), score.ravel()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in zip(*found, strict=True)], ["q", "rep", "score"])

    return go


def points_of(rows: DataFrame, queries: Column, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (rep, dim, vec, ids), and the queries (query_id, rep): rep is the least id of equal vectors, ids their first k + 1."""
    plain = F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.select(F.col("vec_id").cast("long"), F.col("vec").cast("array<double>")).where(F.col("vec_id").isNotNull() & plain & F.exists("vec", lambda x: x != 0))
    # 0.0 + x has no negative zero, so equal vectors have equal bits.
    rows = materialise(rows.groupBy("vec_id").agg(F.min(F.transform("vec", lambda x: x + F.lit(0.0))).alias("vec")).withColumn("asks", queries), "vectors")
    least = Window.partitionBy("vec").orderBy("vec_id")
    members = rows.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    points = members.select(F.col("ids")[0].alias("rep"), F.size("vec").alias("dim"), "vec", "ids")
    asked = rows.where("asks").join(points, "vec").select(F.col("vec_id").alias("query_id"), "rep")
    return materialise(points, "points"), materialise(asked, "queries")


def hashed_as(points: DataFrame) -> DataFrame:
    """points with ``way``, what is hashed for a point, and ``ask``, what is for a query."""
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    top = points.agg(F.max(square).alias("hi"), F.min(square).alias("lo")).first()
    if not top["hi"] or top["lo"] >= 0.998 * top["hi"]:
        return points.select("*", F.col("vec").alias("way"), F.col("vec").alias("ask"))
    last = F.sqrt(F.greatest(F.lit(0.0), F.lit(top["hi"]) - square))
    scale = F.sqrt(F.lit(top["hi"]) / square)
    return points.select("*", F.concat("vec", F.array(last)).alias("way"), F.concat(F.transform("vec", lambda x: x * scale), F.array(F.lit(0.0))).alias("ask"))


def index(points: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(rep, dim, t, leaf) of each point in each table, and for each level the cells (leaf, mean) that are hashed there."""
    cells = points.select("rep", "dim", F.lit(0).alias("t"), (-F.col("dim")).cast("long").alias("leaf"))
    levels: list[DataFrame] = []
    for level in range(DEPTH):
        hot = materialise(cells.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT).select("leaf"), "large-cells")
        if hot.isEmpty():
            break
        inside = cells.join(hot, "leaf", "left_semi").join(points.select("rep", F.col("way").alias("vec")), "rep")
        if level:
            means = inside.select("leaf", F.posexplode("vec").alias("p", "x")).groupBy("leaf", "p").agg(F.avg("x").alias("x"))
            means = means.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("p", "x"))).alias("m")).select("leaf", F.col("m.x").alias("mean"))
        else:
            means = hot.withColumn("mean", F.array().cast("array<double>"))
            inside = inside.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1))))
        levels.append(materialise(means, "means"))
        below = inside.join(levels[-1], "leaf").select("rep", "dim", "t", "leaf", "vec", "mean").mapInArrow(_down(level, 0), _CELL)
        cells = materialise(cells.join(hot, "leaf", "left_anti").select("rep", "dim", "t", "leaf").unionByName(below), "cells")
    return cells, levels


def probes(asking: DataFrame, levels: list[DataFrame], most: int) -> DataFrame:
    """(rep, dim, t, leaf, turn): the first ``most`` cells that each query looks into, in each table."""
    out = asking.select("rep", "dim", F.lit(0).alias("t"), (-F.col("dim")).cast("long").alias("leaf"), F.lit(0.0).alias("gap"))
    first = Window.partitionBy("rep", "t").orderBy("gap", "leaf")
    for level, means in enumerate(levels):
        inside = out.join(means, "leaf").join(asking.select("rep", F.col("ask").alias("vec")), "rep")
        if not level:
            inside = inside.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1))))
        below = inside.select("rep", "dim", "t", "leaf", "vec", "mean", "gap").mapInArrow(_down(level, most), _PROBE)
        out = out.join(means, "leaf", "left_anti").select("rep", "dim", "t", "leaf", "gap").unionByName(below)
        if level:
            out = out.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= most).drop("turn")
        out = materialise(out, "probes")
    return out.withColumn("turn", F.row_number().over(first))


def _met(cells: DataFrame, probed: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(q, rep, score) of points (leaf, chunk, rep) and queries (leaf, chunk, rep) that share a cell."""
    vectors = points.select("rep", "dim", "vec")
    both = cells.select("leaf", "chunk", "rep", F.lit(0).alias("kind")).unionByName(probed.select("leaf", "chunk", "rep", F.lit(1).alias("kind")))
    rows = both.join(vectors, "rep").repartition("leaf", "chunk").sortWithinPartitions("leaf", "chunk", "dim", "kind")
    return rows.select("leaf", "chunk", "dim", "kind", "rep", "vec").mapInArrow(_best(k), "q long, rep long, score double")


def exact(asking: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(q, rep, score): the best k points of each chunk for each query, chunk by chunk."""
    chunks = max(1, -(-points.count() // SPLIT))
    here = points.select(F.lit(0).cast("long").alias("leaf"), F.pmod(F.xxhash64("rep"), F.lit(chunks)).cast("int").alias("chunk"), "rep")
    every = asking.select(F.lit(0).cast("long").alias("leaf"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "rep")
    return _met(here, every, points, k)


def _first(found: DataFrame, key: str, point: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("score"), point)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fit_probes(asking: DataFrame, points: DataFrame, cells: DataFrame, levels: list[DataFrame], k: int) -> int:
    """How many cells of each table to look into, from PROBED queries searched exactly."""
    if not levels:
        return 1
    sample = materialise(asking.orderBy(F.xxhash64("rep"), "rep").limit(PROBED), "sample")
    truth = materialise(_first(exact(sample, points, k), "q", "rep", k).select("q", "rep"), "truth")
    ways = probes(sample, levels, MANY).select(F.col("rep").alias("q"), "t", "leaf", "turn")
    seen = truth.join(cells, "rep").join(ways, ["q", "t", "leaf"]).groupBy("q", "rep").agg(F.min("turn").alias("turn"))
    turns = [r.turn for r in truth.join(seen, ["q", "rep"], "left").select("turn").collect()]  # PROBED * k numbers at most
    turns = sorted(MANY if t is None else t for t in turns)
    return turns[min(len(turns) - 1, int(TARGET * len(turns)))] if turns else 1


def nearest(rows: DataFrame, queries: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows (vec_id, vec) of each row for which ``queries`` holds."""
    prepare_workers(rows.sparkSession)
    points, asked = points_of(rows, queries, k)
    points = materialise(hashed_as(points), "hashed-points")
    asking = materialise(points.join(asked.select("rep").distinct(), "rep", "left_semi"), "asking")
    cells, levels = index(points)
    most = fit_probes(asking, points, cells, levels, k + 1)
    ways = probes(asking, levels, most).where(F.col("turn") <= most)
    # Cells that no level has split are read in chunks.
    large = cells.groupBy("leaf").agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("chunks")).where("chunks > 1")
    large = materialise(large, "chunks")
    if large.isEmpty():
        here, there = cells.withColumn("chunk", F.lit(0)), ways.withColumn("chunk", F.lit(0))
    else:
        n = F.coalesce("chunks", F.lit(1))
        here = cells.join(large, "leaf", "left").withColumn("chunk", F.pmod(F.xxhash64("rep"), n).cast("int"))
        there = ways.join(large, "leaf", "left").withColumn("chunk", F.explode(F.sequence(F.lit(0), n - 1)))
    found = _met(here, there, points, k + 1).groupBy("q", "rep").agg(F.max("score").alias("score"))
    found = materialise(_first(found, "q", "rep", k + 1), "found")
    sizes = points.groupBy("dim").agg(F.count("*").alias("all"))
    had = found.groupBy("q").agg(F.count("*").alias("n")).withColumnRenamed("q", "rep")
    short = asking.join(had, "rep", "left").join(sizes, "dim").where(F.coalesce("n", F.lit(0)) < F.least(F.col("all"), F.lit(k + 1))).select("rep", "dim", "vec")
    short = materialise(short, "short")
    if not short.isEmpty():
        more = _first(exact(short, points, k + 1), "q", "rep", k + 1)
        found = found.join(short.select(F.col("rep").alias("q")), "q", "left_anti").unionByName(more)
    ids = found.join(points.select("rep", "ids"), "rep").select("q", F.explode("ids").alias("vec_id"), "score")
    ids = _first(ids, "q", "vec_id", k + 1).drop("rank")
    out = asked.withColumnRenamed("rep", "q").join(ids, "q").where(F.col("vec_id") != F.col("query_id"))
    return _first(out, "query_id", "vec_id", k).select("query_id", "rank", "vec_id", "score")
