"""Near copies of whole texts: equal shares of five-word shingles, MinHash bands, exact check.

Two texts are near copies if the sets of their shingles of SHINGLE words have a Jaccard
similarity of 0.8 or more; a text with fewer words is one shingle. Words are cut and
lowered as by simhash.fingerprint. Texts with the same set are one entry. An entry is
put into BANDS shards, each keyed by ROWS minima of its hashed shingles. A pair at
exactly 0.8 shares no shard with probability (1 - 0.8**ROWS)**BANDS, 3 in a million;
pairs with more in common hardly ever. Within a shard every pair is compared by the
sets themselves until all entries are one component, so a shard of copies of one text
takes time in proportion to its size. Shards with the same entries are compared once.

Entries that have little but a page's frame in common can meet in a shard by the thousand,
and comparing all of them would take time by the square. Shards of more than SPLIT entries
are therefore dealt anew, and exactly: with the shingles of all their entries in one order,
the rarest first, two sets of 0.8 or more share one of the first fifth (and one) of either.
Shingles that are nobody else's come first and match nothing, so what meets by the others
has rare shingles in common. What is left as quadratic are entries that share about
four fifths of their shingles with thousands of others and yet are not near copies.

Shards give links, and components of the links are the groups. Only texts that share a
shard are read again for their sets.

Defined results: a text without words is like any other such text and like no text with
words; null texts are empty; of a component the least doc_id stays, null last; repeated
rows are one entry, of which one row stays; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.shared import discard, materialise, prepare_workers, whole_text

SHINGLE = 5
BANDS = 24
ROWS = 4
SEED = 42
#: Entries of a shard that are compared as they are.
SPLIT = 1_000

_mix = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS, 1), np.uint64)


def shingle_set(text: str) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted; none without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    n = min(SHINGLE, len(words))
    runs = {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}
    return np.unique(np.array([xxhash.xxh64_intdigest(r, SEED) for r in runs], np.uint64))


def bands(hashes: np.ndarray) -> list[int]:
    """The BANDS shard keys of a set, signed."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 2048):
        least = np.minimum(least, ((hashes[at : at + 2048] ^ _mix[0]) * (2 * _mix[1] + 1)).min(1))
    least = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), k) - (1 << 63) for k, row in enumerate(least)]


def shard_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (positions) with the components of all pairs of at least 0.8, which is 9 I >= 4 (a + b)."""
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    label, left, out = np.arange(len(sets)), len(sets) - 1, []
    for i in range(len(sets)):
        if not left:
            break
        own = np.zeros(len(values), bool)
        own[ids[starts[i] : starts[i] + sizes[i]]] = True
        both = np.add.reduceat(own[ids], starts, dtype=np.int64)
        for j in np.flatnonzero((9 * both >= 4 * (sizes + sizes[i])) & (label != label[i])):
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((i, int(j)))
                left -= 1
    return out


def _prints(fingerprint: Callable[[str], int] | None):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            sets = [shingle_set(t) for t in texts]
            keys = [xxhash.xxh64_intdigest(s.tobytes(), SEED) - (1 << 63) for s in sets]
            fps = np.array([fingerprint(t) if fingerprint else 0 for t in texts], np.uint64).view(np.int64)
            columns = [b.column("doc_id"), b.column("_h"), pa.array(keys, pa.int64()), pa.array([bands(s) for s in sets], pa.list_(pa.int64())), pa.array(fps)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_h", "entry", "bands", "fp"])

    return go


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = pa.array([shingle_set(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("entry"), sets], ["entry", "hashes"])


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (entry, hashes) to rows (entry, most, token): each shingle, and how many of the first ones in order count."""
    for b in batches:
        for entry, raw in zip(b.column("entry").to_pylist(), b.column("hashes").to_pylist(), strict=True):
            tokens = np.frombuffer(raw, np.int64)
            n = len(tokens)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, entry)), pa.array(np.full(n, n - (4 * n + 4) // 5 + 1)), pa.array(tokens)], ["entry", "most", "token"])


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards arrive one after the other, sorted."""

    def made(entries: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        pairs = shard_links(sets)
        return pa.RecordBatch.from_arrays([pa.array([entries[p[k]] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

    shard, entries, sets = None, [], []
    for batch in batches:
        for key, entry, raw in zip(*(batch.column(c).to_pylist() for c in ("shard", "entry", "hashes")), strict=True):
            if key != shard:
                if len(entries) > 1:
                    yield made(entries, sets)
                shard, entries, sets = key, [], []
            entries.append(entry)
            sets.append(np.frombuffer(raw, np.uint64))
    if len(entries) > 1:
        yield made(entries, sets)


def shared_once(keyed: DataFrame) -> DataFrame:
    """(shard, n) of shards (shard, entry) with two entries or more; of shards with the same entries one."""
    shards = keyed.groupBy("shard").agg(F.count("*").alias("n"), F.bit_xor("entry").alias("x"), F.min("entry").alias("lo"), F.max("entry").alias("hi")).where("n > 1")
    return shards.groupBy("n", "x", "lo", "hi").agg(F.min("shard").alias("shard")).select("shard", "n")


def by_rare_shingles(large: DataFrame, sets: DataFrame) -> DataFrame:
    """(shard, entry): the entries of large shards dealt by the rarest shingles of each, so that all near copies among them still meet."""
    tokens = materialise(large.select("entry").distinct().join(sets, "entry").mapInArrow(_shingles, "entry long, most long, token long"), "tokens")
    often = tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    order = Window.partitionBy("entry").orderBy("c", "token")  # the shingles of one text
    first = tokens.join(often, "token", "left").withColumn("c", F.coalesce("c", F.lit(1))).withColumn("k", F.row_number().over(order))
    dealt = materialise(first.where("k <= most AND c > 1").select(F.col("token").alias("shard"), "entry"), "rare-shingles")
    discard(tokens)
    return dealt.join(shared_once(dealt), "shard").select("shard", "entry")


def links(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """(a, b) links of entries that have the components of all pairs of near copies."""
    least = F.min(F.struct(F.struct("doc_id").alias("_k"), "_h")).alias("o")
    entries = materialise(prints.groupBy("entry").agg(least, F.first("bands").alias("bands")), "entries")
    keyed = entries.select("entry", F.explode("bands").alias("shard"))
    keyed = materialise(keyed.join(shared_once(keyed), "shard"), "shards")
    wanted = entries.join(keyed.select("entry"), "entry", "left_semi").select("entry", "o._k", "o._h")
    texts = docs.select(F.struct("doc_id").alias("_k"), F.xxhash64(whole_text()).alias("_h"), whole_text().alias("text"))
    sets = texts.join(wanted, ["_k", "_h"]).select("entry", "text").mapInArrow(_sets, "entry long, hashes binary")
    sets = materialise(sets.dropDuplicates(["entry"]), "shingle-sets")
    discard(entries)
    dealt = keyed.where(F.col("n") <= SPLIT).select("shard", "entry")
    large = keyed.where(F.col("n") > SPLIT)
    if not large.isEmpty():
        dealt = dealt.unionByName(by_rare_shingles(large, sets))
    found = dealt.join(sets, "entry").repartition("shard").sortWithinPartitions("shard", "entry").mapInArrow(_link, "a long, b long")
    found = materialise(found, "near-links")
    discard(keyed)
    discard(sets)
    return found


def fingerprint_links(prints: DataFrame, link: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b) links of entries with equal fingerprints, and of those whose fingerprints ``link`` links."""
    prints = prints.select("entry", "fp").distinct()
    first = materialise(prints.groupBy("fp").agg(F.min("entry").alias("first")), "fingerprints")
    same = prints.join(first, "fp").where("entry <> first").select(F.col("entry").alias("a"), F.col("first").alias("b"))
    ends = [first.select(F.col("fp").alias(f"fp_{c}"), F.col("first").alias(c)) for c in ("a", "b")]
    near = link(first.select("fp")).select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b"))
    return same.unionByName(near.join(ends[0], "fp_a").join(ends[1], "fp_b").select("a", "b"))


def keep_one(docs: DataFrame, fingerprint: Callable[[str], int] | None = None, link: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """docs with one row of each component: the least doc_id, then the least hash of the text; all columns.

    With ``fingerprint`` of a text and ``link`` from distinct ones (fp) to links (a, b), these links count too.
    """
    prepare_workers(docs.sparkSession)
    hashed = docs.select("doc_id", F.xxhash64(whole_text()).alias("_h"), whole_text().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    prints = materialise(hashed.mapInArrow(_prints(fingerprint), f"doc_id {kind}, _h long, entry long, bands array<long>, fp long"), "prints")
    found = links(docs, prints)
    if fingerprint and link:
        found = found.unionByName(fingerprint_links(prints, link))
    labels = components(found)
    rows = prints.select("doc_id", "_h", "entry").join(labels, F.col("entry") == F.col("v"), "left")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_h")
    # By the label, not the least doc_id: one id on two texts does not make their components one.
    first = rows.groupBy(F.coalesce("label", "entry").alias("label")).agg(F.min(order).alias("_o"))
    keep = first.select(F.struct("_o.doc_id").alias("_k"), F.col("_o._h").alias("_h")).distinct()
    # Structs of nulls are equal, so no id stands for null.
    out = docs.select(F.struct("*").alias("_row"), F.xxhash64(whole_text()).alias("_h"), F.struct("doc_id").alias("_k"))
    # Repeated rows have the same key, by which the join has dealt them; one of them stays.
    same = Window.partitionBy("_k", "_h").orderBy("_k")
    out = out.join(keep, ["_k", "_h"], "left_semi").withColumn("_n", F.row_number().over(same))
    return out.where("_n = 1").select("_row.*")
