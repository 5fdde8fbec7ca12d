"""Incremental embedding, index state, exact top-k, and retrieval metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a block, and queries in one.
BLOCK, ASKED = 2048, 512
#: Queries whose scores against a block are held at once.
PART = 128
#: Blocks of queries are broadcast while all queries together are at most so many numbers (64 MB).
MAX_NUMBERS = 8_000_000
#: Parts that larger sets of queries are dealt to.
SPREAD = 32


def pending(chunks: DataFrame, cache: DataFrame) -> DataFrame:
    """Current chunks whose content is not in the cache."""
    return chunks.join(cache.select("chunk_key", "text_sha"), ["chunk_key", "text_sha"], "left_anti")


def embed(chunks: DataFrame, embedder: Callable[[list[str]], list[list[float]]], keys: Sequence[str] = ("chunk_key", "text_sha"), batch: int = 200) -> DataFrame:
    """(keys, embedding): the given embedder over batches of embedding_text."""
    import pandas as pd

    def go(parts):
        for pdf in parts:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                yield pd.DataFrame({**{k: part[k] for k in keys}, "embedding": embedder(part["embedding_text"].tolist())})

    return chunks.select(*keys, "embedding_text").mapInPandas(go, ", ".join(f"{k} string" for k in keys) + ", embedding array<float>")


def embed_pending(chunks: DataFrame, cache: DataFrame, embedder: Callable[[list[str]], list[list[float]]], batch: int = 200) -> DataFrame:
    """The cache with what was missing: only chunks whose content it lacks are embedded."""
    return cache.unionByName(embed(pending(chunks, cache), embedder, batch=batch).select(*cache.columns))


def hash_embedder(dims: int = 16) -> Callable[[list[str]], list[list[float]]]:
    """A deterministic stand-in for a model, for tests: signed counts of hashed words."""
    import hashlib

    def go(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = [0.0] * dims
            for w in t.lower().split():
                h = int.from_bytes(hashlib.sha256(w.encode()).digest()[:8], "big")
                v[h % dims] += 1.0 if h >> 63 else -1.0
            out.append(v)
        return out

    return go


def to_sync(vectors: DataFrame, state: DataFrame, index_name: str) -> DataFrame:
    """Vectors that an index does not hold yet; one state row per key and index, so a content that comes back counts as new."""
    held = state.where(F.col("index_name") == index_name).select("chunk_key", "text_sha")
    return vectors.join(held, ["chunk_key", "text_sha"], "left_anti")


def after_sync(state: DataFrame, pushed: DataFrame, index_name: str) -> DataFrame:
    """The state after a push: rows of pushed keys are replaced."""
    own = F.col("index_name") == index_name
    kept = state.where(~own).unionByName(state.where(own).join(pushed.select("chunk_key").distinct(), "chunk_key", "left_anti").select(*state.columns))
    return kept.unionByName(pushed.select(F.lit(index_name).alias("index_name"), "chunk_key", "text_sha"))


class PushFailed(RuntimeError):
    """Raised when an index refuses keys; the state is not changed then, and the push may be repeated."""


def push(vectors: DataFrame, state: DataFrame, index_name: str, upsert: Callable[[list[dict]], list[str]], log: str, batch: int = 200) -> DataFrame:
    """Sends vectors that an index lacks in batches and returns the state after it.

    ``upsert(rows)`` runs on the workers and returns the keys that it could not write. What
    happened is written to the folder ``log`` once, so nothing is sent again when the state is read.
    """
    import pandas as pd

    def go(parts):
        for pdf in parts:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                bad = set(upsert(part.to_dict("records")))
                yield pd.DataFrame({"chunk_key": part["chunk_key"], "text_sha": part["text_sha"], "ok": [k not in bad for k in part["chunk_key"]]})

    spark = vectors.sparkSession
    to_sync(vectors, state, index_name).mapInPandas(go, "chunk_key string, text_sha string, ok boolean").write.mode("overwrite").parquet(log)
    done = spark.read.schema("chunk_key string, text_sha string, ok boolean").parquet(log)
    failed = done.where("NOT ok")
    if n := failed.count():
        raise PushFailed(f"{n} keys, among them {', '.join(sorted(r.chunk_key for r in failed.orderBy('chunk_key').limit(10).collect()))}")
    return after_sync(state, done.select("chunk_key", "text_sha"), index_name)


def stale(state: DataFrame, chunks: DataFrame, index_name: str) -> DataFrame:
    """Keys that an index holds but that no current chunk has."""
    return state.where(F.col("index_name") == index_name).select("chunk_key").distinct().join(chunks.where("is_current"), "chunk_key", "left_anti")


def retire(state: DataFrame, chunks: DataFrame, index_name: str) -> DataFrame:
    """The state without the stale rows of this index; other indexes keep theirs."""
    own = F.col("index_name") == index_name
    return state.where(own).join(chunks.where("is_current").select("chunk_key"), "chunk_key", "left_semi").select(*state.columns).unionByName(state.where(~own))


def cosine(a: str, b: str) -> Column:
    """The cosine of two arrays; NULL if one has no length."""
    dot = lambda x, y: f"aggregate(zip_with({x}, {y}, (x, y) -> cast(x AS double) * cast(y AS double)), 0D, (s, v) -> s + v)"
    return F.expr(f"{dot(a, b)} / nullif(sqrt({dot(a, a)}) * sqrt({dot(b, b)}), 0D)")


def _blocks(df: DataFrame, key: str, vector: str, most: int, name: str) -> DataFrame:
    """Blocks of vectors of length one and the same dimension: (<name>_ids, <name>_n, <name>_m). Vectors without a length are left out."""
    import numpy as np
    import pyarrow as pa

    kind = df.schema[key].dataType

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, tuple[list, list]] = {}

        def made(ids: list, rows: list) -> pa.RecordBatch:
            columns = [pa.array([ids], pa.list_(id_type)), pa.array([len(rows[0])], pa.int32()), pa.array([np.array(rows).tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, [f"{name}_ids", f"{name}_n", f"{name}_m"])

        id_type = pa.int64()
        for b in batches:
            id_type = b.schema.field(0).type
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.array([np.nan] if v is None else v, np.float64)
                size = np.sqrt(x @ x)
                if not size > 0:  # nor NaN
                    continue
                ids, rows = open_blocks.setdefault(len(x), ([], []))
                ids.append(i)
                rows.append(x / size)
                if len(ids) == most:
                    yield made(*open_blocks.pop(len(x)))
        for ids, rows in open_blocks.values():
            yield made(ids, rows)

    return df.select(key, vector).mapInArrow(go, f"{name}_ids array<{kind.simpleString()}>, {name}_n int, {name}_m binary")


def top_k(queries: DataFrame, vectors: DataFrame, k: int, query_id: str, vector_id: str, exclude_self: bool = False, embedding: str = "embedding") -> DataFrame:
    """(query_id, vector_id, score, rank): the k nearest vectors of each query by cosine, ties by id.

    A stated set of queries goes against all vectors. Both are normalised once and packed
    into blocks; each pair of blocks is one product of matrices, which keeps its own k
    best of each query. Whatever the number of queries, the plan has one join of blocks.
    """
    import numpy as np
    import pyarrow as pa

    dims = queries.agg(F.sum(F.size(embedding)).alias("n")).first()["n"] or 0
    asked = _blocks(queries, query_id, embedding, ASKED, "q")
    blocks = _blocks(vectors, vector_id, embedding, BLOCK, "v")
    if dims <= MAX_NUMBERS:
        pairs = blocks.join(F.broadcast(asked), F.col("v_n") == F.col("q_n"))
    else:
        # Each block of vectors goes to SPREAD parts, each block of queries to one, so the join has more keys than dimensions.
        asked = asked.withColumn("q_p", F.pmod(F.xxhash64("q_ids"), F.lit(SPREAD)))
        blocks = blocks.withColumn("v_p", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
        pairs = blocks.join(asked, (F.col("v_n") == F.col("q_n")) & (F.col("v_p") == F.col("q_p")))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(len(b)):
                # One pair of blocks at a time, its matrices where Arrow has them; scores of PART queries at a time.
                qi, vi, n = (b.column(c)[row].as_py() for c in ("q_ids", "v_ids", "q_n"))
                q, v = (np.frombuffer(b.column(c)[row].as_buffer()).reshape(-1, n) for c in ("q_m", "v_m"))
                by_id = np.argsort(np.array(vi))
                ids, asking, v = np.array(vi)[by_id], np.array(qi), v[by_id]
                for at in range(0, len(qi), PART):
                    own = asking[at : at + PART]
                    # Equal vectors have equal scores wherever they stand in a block.
                    score = np.round(q[at : at + PART] @ v.T, 12)
                    if exclude_self:
                        score[own[:, None] == ids[None, :]] = -np.inf
                    best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                    found = np.take_along_axis(score, best, 1)
                    keep = np.isfinite(found)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, keep.sum(1))), pa.array(ids[best[keep]]), pa.array(found[keep])], [query_id, vector_id, "score"])

    kinds = (queries.schema[query_id].dataType.simpleString(), vectors.schema[vector_id].dataType.simpleString())
    scored = pairs.select("q_ids", "q_m", "v_ids", "v_m", "q_n").mapInArrow(go, f"{query_id} {kinds[0]}, {vector_id} {kinds[1]}, score double")
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), vector_id)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def best_copy(hits: DataFrame, key: str) -> DataFrame:
    """One row per key, the best-scoring one, NULL scores as 0, in descending order of score; ties by what the row holds."""
    w = Window.partitionBy(key).orderBy(F.desc(F.coalesce("score", F.lit(0.0))), *[c for c in hits.columns if c not in (key, "score")])
    return hits.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").orderBy(F.desc(F.coalesce("score", F.lit(0.0))), key)


def ir_metrics(ranked: DataFrame, k: int) -> DataFrame:
    """(case_id, recall, mrr, ndcg) from (case_id, ranked array, relevant array).

    Repeats are dropped before the cut; mrr looks at the whole list; without relevant items all are 0.
    """
    out = ranked.select("case_id", F.array_distinct("ranked").alias("r"), F.array_distinct("relevant").alias("rel"))
    out = out.withColumn("n", F.size("rel")).withColumn("top", F.slice("r", 1, k))
    hit = F.size(F.array_intersect("top", "rel"))
    first = F.array_min(F.filter(F.transform("rel", lambda x: F.array_position("r", x)), lambda p: p > 0))
    gain = F.aggregate(F.transform("top", lambda x, i: F.when(F.array_contains("rel", x), 1 / F.log2(i + 2)).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x)
    ideal = F.aggregate(F.sequence(F.lit(1), F.least("n", F.lit(k))), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
    some = F.col("n") > 0
    return out.select(
        "case_id", F.when(some, hit / F.col("n")).otherwise(0.0).alias("recall"), F.when(some & first.isNotNull(), 1 / first).otherwise(0.0).alias("mrr"), F.when(some, gain / ideal).otherwise(0.0).alias("ndcg"),
    )


def ir_scores(hits: DataFrame, totals: DataFrame, k: int) -> DataFrame:
    """(case_id, recall, mrr, ndcg) from hits (case_id, rank, relevant) without repeats and totals (case_id, n) of relevant items.

    Nothing but ranks is gathered, however many items are relevant. A case without hits scores 0.
    """
    good = F.col("relevant") & F.col("rank").isNotNull()
    top = good & (F.col("rank") <= k)
    by = hits.groupBy("case_id").agg(
        F.count_if(top).alias("found"), F.min(F.when(good, F.col("rank"))).alias("first"), F.sum(F.when(top, 1 / F.log2(F.col("rank") + 1))).alias("gain"),
    )
    ideal = F.aggregate(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
    some, zero = F.col("n") > 0, F.lit(0.0)
    out = totals.select("case_id", "n").join(by, "case_id", "left")
    return out.select(
        "case_id", F.when(some, F.coalesce(F.col("found") / F.col("n"), zero)).otherwise(zero).alias("recall"),
        F.when(some, F.coalesce(1 / F.col("first"), zero)).otherwise(zero).alias("mrr"), F.when(some, F.coalesce(F.col("gain") / ideal, zero)).otherwise(zero).alias("ndcg"),
    )


def contenders(queries: DataFrame, indexes: dict[str, tuple[DataFrame, str]], relevant: Callable[[DataFrame], DataFrame], totals: DataFrame, k: int, query_id: str, vector_id: str) -> DataFrame:
    """(contender, n, recall, mrr, ndcg): means over the cases of each index, given as (vectors, vector column).

    ``relevant`` turns hits (query_id, vector_id, rank) into (case_id, rank, relevant).
    """
    out = None
    for name, (vectors, column) in indexes.items():
        hits = relevant(top_k(queries, vectors, k, query_id, vector_id, exclude_self=True, embedding=column))
        one = mean_missing_zero(ir_scores(hits, totals, k), ("recall", "mrr", "ndcg")).withColumn("contender", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def mean_missing_zero(scored: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Means in which a missing score counts as 0."""
    return scored.groupBy(*by).agg(F.count("*").alias("n"), *[(F.sum(F.coalesce(c, F.lit(0.0))) / F.count("*")).alias(c) for c in columns])


def reanchor(ids: DataFrame, landed: DataFrame, current: DataFrame) -> DataFrame:
    """(case_id, chunk_id, chunk_key): old ids to today's keys by content; NULL where nothing is found. Of several keys the largest counts."""
    sha = landed.groupBy("chunk_id").agg(F.max("text_sha").alias("text_sha"))
    key = current.groupBy("text_sha").agg(F.max("chunk_key").alias("chunk_key"))
    return ids.join(sha, "chunk_id", "left").join(key, "text_sha", "left").select("case_id", "chunk_id", "chunk_key")


def collect_context(refs: DataFrame, chunks: DataFrame, by: Sequence[str], most: int = 16) -> DataFrame:
    """The first texts of each list of chunk keys, in the list's order."""
    one = refs.select(*by, F.posexplode_outer("chunk_keys").alias("pos", "chunk_key")).join(chunks.select("chunk_key", "text"), "chunk_key", "left")
    listed = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("pos", "text"))))
    return one.groupBy(*by).agg(F.slice(F.transform(listed, lambda x: x["text"]), 1, most).alias("context_texts"))
