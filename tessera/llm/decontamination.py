"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks.

For an item with k shingles of five words (the item itself where it is shorter), windows
of a document with k shingles are fingerprinted like the item. The index holds the items'
fingerprints in BLOCKS blocks, each under its value and all values within NEAR bits of
it. Fingerprints within RADIUS < BLOCKS * (NEAR + 1) bits agree to NEAR bits in at least
one block, so a join on (item, block, value) finds all of them. A window is held against
the items whose shingles it begins with, so texts that share nothing with an item never
meet it. The pairs found are verified
by the exact similarity of the shingles weighted by how often they occur,
I / (2k - I) >= 0.8 with I the sum of the lesser weights, which is 9 I >= 8 k.

Only windows that begin at a hit, a shingle that some item has too, are fingerprinted;
moving any other window right to its first hit loses nothing. Of a row of hits the first
is enough unless the item has a shingle twice: moving left within a row gains a hit and
loses one at most. A window that would run over the end of a text ends there.

At 0.8 a fingerprint differs in 10 of 64 bits on average, with a deviation of 3; RADIUS
is 20. All of it is DataFrame code. No broadcast is asked for; Spark chooses by size.

Defined results: words are cut at the six ASCII white characters and lowered; null or
empty items and texts match nothing; repeated rows and items give a match each way but
pairs are distinct; a null doc_id is kept as such; empty tables give no rows; other
columns are not read, and drop_leaks carries them in a struct, so their names may be any.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import materialise, whole_text

SHINGLE = 5
RADIUS = 20
BLOCKS, NEAR = 7, 2
#: Bits of all blocks but the last, which has the rest.
WIDE = 64 // BLOCKS


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def shingles(cut: Column, length: int) -> Column:
    """Hashes of the runs of ``length`` words, in order; empty where there are fewer."""
    starts = F.when(F.size(cut) >= length, F.sequence(F.lit(1), F.size(cut) - (length - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(cut, i, length)))


def simhash(hashes: str) -> Column:
    """The majority vote of an array column of hashes. A lane of 32 bits counts a bit: j and j + 32 share a long."""
    lanes = f"""aggregate({hashes}, array_repeat(0L, 32), (acc, h) ->
        zip_with(acc, sequence(0, 31), (a, j) -> a + (shiftrightunsigned(h, j) & 4294967297L)))"""
    return F.expr(f"""
        aggregate(zip_with({lanes}, sequence(0, 31), (lane, j) ->
            IF(2 * (lane & 4294967295L) > size({hashes}), shiftleft(1L, j), 0L)
            | IF(2 * shiftrightunsigned(lane, 32) > size({hashes}), shiftleft(1L, j + 32), 0L)), 0L, (f, x) -> f | x)""")


def blocks(fp: str) -> Column:
    """The values of the fingerprint's blocks."""
    return F.expr(f"transform(sequence(0, {BLOCKS - 1}), i -> shiftrightunsigned({fp}, {WIDE} * i) & IF(i = {BLOCKS - 1}, {(1 << (64 - WIDE * (BLOCKS - 1))) - 1}L, {(1 << WIDE) - 1}L))")


def near_values(v: Column, i: Column) -> Column:
    """A block's value and all values within NEAR bits of it."""
    def masks(bits: int) -> Column:
        return F.array(*[F.lit(sum(1 << b for b in some)).cast("long") for n in range(NEAR + 1) for some in combinations(range(bits), n)])

    both = F.when(i == BLOCKS - 1, masks(64 - WIDE * (BLOCKS - 1))).otherwise(masks(WIDE))
    return F.transform(both, lambda m: v.bitwiseXOR(m))


def common(a: str, b: str) -> Column:
    """The sum of the lesser weights of two arrays of shingles."""
    return F.expr(f"""CASE WHEN size(array_distinct({a})) = size({a}) OR size(array_distinct({b})) = size({b})
        THEN size(array_intersect({a}, {b}))
        ELSE aggregate(array_intersect({a}, {b}), 0, (n, x) -> n + least(size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x)))) END""")


def item_index(benchmark: DataFrame) -> DataFrame:
    """(item_id, len, k, item, ifp): items with their shingles and fingerprint."""
    cut = benchmark.select("item_id", words(whole_text()).alias("w")).where(F.size("w") > 0).distinct()
    sized = cut.withColumn("len", F.least(F.size("w"), F.lit(SHINGLE)))
    item = F.coalesce(*[F.when(F.col("len") == n, shingles(F.col("w"), n)) for n in range(1, SHINGLE + 1)])
    out = sized.select("item_id", "len", item.alias("item")).withColumn("k", F.size("item"))
    return materialise(out.withColumn("ifp", simhash("item")), "items")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, start): the best window of each pair, start in words from 0."""
    items = item_index(benchmark)
    lengths = sorted(r.len for r in items.select("len").distinct().collect())  # five at most
    # Structs of nulls are equal, so no id stands for null.
    base = docs.select(F.struct("doc_id").alias("_id"), F.xxhash64(whole_text()).alias("text_hash"), whole_text().alias("text"))
    hits = None
    for n in lengths:
        plain = (F.size(F.array_distinct("item")) == F.col("k")).alias("plain")
        known = items.where(F.col("len") == n).select("item_id", "k", plain, F.explode(F.array_distinct("item")).alias("h"))
        # Words in a projection of their own: within the lambda they would be cut again for each shingle.
        found = base.select("_id", "text_hash", words(F.col("text")).alias("w"))
        every = shingles(F.col("w"), n)
        # A shorter item is one shingle, whose first place is enough. No column holds the shingles: a filter on it would cut words again.
        first = F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: F.struct(i.alias("pos"), F.xxhash64(F.slice("w", i + 1, n)).alias("h")))
        seen = F.posexplode(every).alias("pos", "h") if n == SHINGLE else F.explode(F.when(F.size("w") >= n, first)).alias("x")
        found = found.select("_id", "text_hash", (F.size("w") - (n - 1)).alias("m"), seen)
        if n < SHINGLE:
            found = found.select("_id", "text_hash", "m", "x.*")
        found = found.join(known, "h").select("_id", "text_hash", "item_id", "k", "plain", F.lit(n).alias("len"), "m", "pos")
        if n < SHINGLE:
            found = found.groupBy(*[c for c in found.columns if c != "pos"]).agg(F.min("pos").alias("pos"))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return docs.select("doc_id", F.xxhash64(whole_text()).alias("text_hash"), F.lit(None).cast("long").alias("item_id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("start")).limit(0)
    # The hits of one item in one text: as many as the text has words, at most.
    lined = hits.where("m >= k").groupBy("_id", "text_hash", "item_id", "len", "k", "m", "plain").agg(F.array_sort(F.collect_set("pos")).alias("p"))
    first = F.expr("IF(plain, filter(p, (x, i) -> i = 0 OR p[i - 1] < x - 1), p)")
    starts = F.transform(first, lambda x: F.least(x, F.col("m") - F.col("k")))
    # A window is fingerprinted once, and goes with the items whose hits it begins at.
    seen = lined.select("_id", "text_hash", F.struct("item_id").alias("_item"), "len", "k", F.explode(F.array_distinct(starts)).alias("start"))
    seen = seen.groupBy("_id", "text_hash", "len", "k", "start").agg(F.collect_set("_item").alias("items"))
    seen = materialise(seen.groupBy("_id", "text_hash").agg(F.collect_list(F.struct("len", "k", "start", "items")).alias("c")), "windows")
    text = base.join(seen, ["_id", "text_hash"]).dropDuplicates(["_id", "text_hash"])
    cut = text.select("_id", "text_hash", "c", words(F.col("text")).alias("w"))
    for n in lengths:
        cut = cut.withColumn(f"s{n}", shingles(F.col("w"), n))
    window = F.coalesce(*[F.expr(f"CASE WHEN x.len = {n} AND x.start + x.k <= size(s{n}) THEN slice(s{n}, x.start + 1, x.k) END") for n in lengths])
    wins = cut.withColumn("x", F.explode("c")).select("_id", "text_hash", "x.len", "x.k", "x.start", "x.items", window.alias("win")).where("win IS NOT NULL")
    wins = wins.withColumn("fp", simhash("win")).select("*", F.explode("items").alias("_item")).drop("items")
    wins = wins.select("*", F.posexplode(blocks("fp")).alias("i", "v"))
    parts = items.select("item_id", "len", "k", "item", "ifp", F.posexplode(blocks("ifp")).alias("i", "b"))
    parts = parts.select("item_id", F.struct("item_id").alias("_item"), "len", "k", "item", "ifp", "i", F.explode(near_values(F.col("b"), F.col("i"))).alias("v"))
    pairs = wins.join(parts, ["_item", "len", "k", "i", "v"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS)
    # A pair agrees in several blocks; it counts at the first of them.
    agree = F.transform(blocks("(fp ^ ifp)"), lambda v: (F.bit_count(v) <= NEAR).cast("int"))
    pairs = pairs.where(F.array_position(agree, 1) == F.col("i") + 1)
    good = pairs.withColumn("both", common("win", "item")).where("9 * both >= 8 * k")
    best = good.groupBy("_id", "text_hash", "item_id").agg(F.max(F.struct((F.col("both") / (2 * F.col("k") - F.col("both"))).alias("similarity"), (-F.col("start")).alias("back"))).alias("b"))
    return best.select(
        "_id.doc_id", "text_hash", "item_id",
        F.round("b.similarity", 6).alias("similarity"), (-F.col("b.back")).alias("start"),
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of the op10 query: (doc_id, item_id, similarity, start)."""
    return matches(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", "start")).alias("m")).select("doc_id", "item_id", "m.similarity", "m.start")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that hold an item: all of its columns."""
    bad = matches(docs, benchmark).select(F.struct("doc_id").alias("_id"), F.col("text_hash").alias("_h")).distinct()
    keyed = docs.select(F.struct("*").alias("_row"), F.struct("doc_id").alias("_id"), F.xxhash64(whole_text()).alias("_h"))
    return keyed.join(bad, ["_id", "_h"], "left_anti").select("_row.*")
