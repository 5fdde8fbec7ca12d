"""SimHash near-duplicates: BK-trees over shards of fingerprints.

A text's fingerprint is the majority vote of the XXH64 hashes of its shingles. Equal
fingerprints are one entry. Two fingerprints at most RADIUS = 2 bits apart agree in at
least two of their four 16-bit blocks, so the shards (two blocks and their values)
hold every such pair; a shard is a BK-tree, children keyed by their Hamming distance
to the parent, and a search follows only the edges within the radius. A shard with
more than SHARD entries is split by the same rule: its other 32 bits in four blocks of
8, two of which must agree, which leaves 16 free bits and so 65,536 entries at most.

A shard's tree is built in the task that holds the shard, rather than broadcast, as all
trees together grow with the data. Shards give the links of a spanning forest, not all
pairs; components of these links are the components of all links.

Defined results: a text without words has fingerprint zero, linked like any other; null
texts are empty; a null doc_id has a component like others, named by the least doc_id
that is not null; repeated rows are one entry; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import near_copies
from tessera.llm.components import components
from tessera.llm.shared import materialise, prepare_workers, whole_text

SHINGLE = 3
SEED = 42
RADIUS = 2
SHARD = 4096


def fingerprint(text: str) -> int:
    """The 64-bit fingerprint, unsigned. bytes.lower() lowers A-Z, bytes.split() cuts at the six white bytes."""
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(x) for x in zip(words, words[1:], words[2:])] or [b" ".join(words)]
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield pd.Series(np.array([fingerprint(t) for t in s], np.uint64).view(np.int64))


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    prepare_workers(docs.sparkSession)
    return docs.withColumn(name, F.pandas_udf(_fingerprints, "long")(whole_text()))


class BkTree:
    """A BK-tree of integers under the Hamming distance."""

    def __init__(self):
        self.root: list | None = None  # [value, {distance: child}]

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            own, children = todo.pop()
            d = (own ^ value).bit_count()
            if d <= radius:
                found.append(own)
            todo += [children[e] for e in range(d - radius, d + radius + 1) if e in children]
        return found

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while d := (node[0] ^ value).bit_count():
            nxt = node[1].get(d)
            if nxt is None:
                node[1][d] = [value, {}]
                return
            node = nxt


def shard_links(values: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, each to the least of its tree."""
    tree, parent = BkTree(), {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for v in values:
        parent[v] = v
        for near in tree.within(v, RADIUS):
            a, b = find(v), find(near)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(v)
    return [(v, r) for v in values if (r := find(v)) != v]


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards arrive one after the other, sorted; each has a bounded number of entries."""

    def made(values: list[int]) -> pa.RecordBatch:
        # Signed values differ in the same bits; the sign bit counts as one of 64.
        links = shard_links([v & 0xFFFFFFFFFFFFFFFF for v in values])
        a, b = (np.array([x[i] for x in links], np.uint64).view(np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    shard, values = None, []
    for batch in batches:
        for key, fp in zip(batch.column("shard").to_pylist(), batch.column("fp").to_pylist(), strict=True):
            if key != shard:
                if len(values) > 1:
                    yield made(values)
                shard, values = key, []
            values.append(fp)
    if len(values) > 1:
        yield made(values)


def _parts(fp: Column, blocks: list[tuple[int, int]]) -> Column:
    """An array of keys: each pair of blocks (shift, bits), with its number."""
    cut = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << n) - 1)) for s, n in blocks]
    return F.array(*[F.concat_ws(".", F.lit(str(k)), a, b) for k, (a, b) in enumerate(combinations(cut, 2))])


def link_fingerprints(distinct: DataFrame) -> DataFrame:
    """(a, b) links that have the components of all links, from distinct fingerprints fp."""
    keyed = distinct.select("fp", F.explode(_parts(F.col("fp"), [(0, 16), (16, 16), (32, 16), (48, 16)])).alias("shard"))
    prepare_workers(distinct.sparkSession)
    keyed = materialise(keyed, "shards")
    sizes = materialise(keyed.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"), "shard-sizes")
    keyed = keyed.join(sizes, "shard")
    small = keyed.where(F.col("n") <= SHARD).select("shard", "fp")
    finer = F.lit(None).cast("array<string>")
    for k, fixed in enumerate(combinations(range(4), 2)):
        rest = [(16 * b + s, 8) for b in range(4) if b not in fixed for s in (0, 8)]
        finer = F.when(F.substring_index("shard", ".", 1) == str(k), _parts(F.col("fp"), rest)).otherwise(finer)
    large = keyed.where(F.col("n") > SHARD).select("shard", "fp", F.explode(finer).alias("_fine"))
    large = large.select(F.concat_ws("/", "shard", "_fine").alias("shard"), "fp")
    shards = small.unionByName(large).repartition("shard").sortWithinPartitions("shard", "fp")
    return shards.mapInArrow(_link, "a long, b long")


def group_fingerprints(rows: DataFrame) -> DataFrame:
    """(fp, component_id) from rows (doc_id, fp), by the links of their distinct fingerprints."""
    least = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprints")
    labels = components(link_fingerprints(least.select("fp")))
    named = least.join(labels, least.fp == labels.v, "left").select("fp", "doc_id", F.coalesce("label", "fp").alias("label"))
    named = materialise(named, "labelled")
    ids = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return materialise(named.join(ids, "label").select("fp", "component_id"), "fingerprint-groups")


def near_groups(docs: DataFrame) -> DataFrame:
    """The rows of the op7 query."""
    rows = materialise(with_fingerprint(docs.select("doc_id", "text"), "fp").select("doc_id", "fp"), "prints")
    out = rows.join(group_fingerprints(rows), "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row, the least doc_id, of each component of fingerprints within RADIUS bits and of near copies, together."""
    return near_copies.keep_one(docs, fingerprint, link_fingerprints)
