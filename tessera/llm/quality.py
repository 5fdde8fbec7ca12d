"""Quality by an interpolated modified Kneser-Ney n-gram model of characters.

The model counts the ORDER-grams of whole characters, none folded into another, of every
trusted document (label quality 1). Neither it nor a count table is ever on one machine:

1. Documents are read in blocks of about BLOCK characters, or DISTINCT different n-grams
   if that is less, so that what a task holds of a block is bounded. A block asks for each n-gram
   it holds once, with how often its trusted documents have it.
2. The rows (block, n-gram, count) are sharded by n-gram. Their sums are the counts;
   joins of sharded tables, level by level, turn them into discounted and interpolated
   probabilities of all n-grams that some block asks for, seen or not.
3. The answers go back to the blocks by a join on n-gram, then on block, and each block's
   documents are scored: perplexity, compared with the QUANTILE of trusted documents in
   the same language.

A block's number is a hash of its ids and texts. It is read twice; if rows come in another
order the second time, its answers are missing and the query fails rather than errs.
Labels go out by broadcast while they are at most MAX_TRUSTED ids; beyond that documents
are joined with them and written first.

Defined results: a null or empty text has the uniform perplexity and is not kept once a
threshold exists; a null language is a language of its own; languages without trusted
documents take the threshold of all; without any trusted document all are kept, with
null perplexity and threshold; repeated rows are scored one by one; repeated labels of a
document count once; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import discard, materialise, prepare_workers, whole_text

ORDER = 5
QUANTILE = 0.995
BLOCK = 64_000_000
#: Different n-grams after which a block ends, as estimated from one in SAMPLED of their hashes; a text is never split.
DISTINCT, SAMPLED = 2_000_000, 64
#: Characters in a piece of a block, and positions looked at together.
PIECE = 1_000_000
MAX_TRUSTED = 2_000_000
#: Stands before each text.
PAD = "\x02" * (ORDER - 1)
#: How hard blocks are compressed: those that stay in their task, and those that are moved.
STAYS, MOVES = 1, 9
#: Answers that a task holds before it passes them on.
HELD = 2_000_000
PACKED = "block long, ids array<long>, langs array<string>, trusted array<boolean>, sizes array<array<int>>, pieces array<binary>"


def pack(batches: Iterator[pa.RecordBatch], level: int = MOVES) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, lang, text, trusted) as blocks, one row each: columns as arrays, texts in compressed pieces."""
    squeeze = zstandard.ZstdCompressor(level=level)
    fresh = lambda: ([], [], [], [], [], xxhash.xxh64(), np.empty(0, np.uint32))
    ids, langs, trusted, sizes, pieces, name, seen = fresh()
    open_texts, held, total = [], 0, 0

    def shut() -> None:
        nonlocal open_texts, held, seen
        if open_texts:
            sizes.append([len(t) for t in open_texts])
            whole = "".join(open_texts)
            seen = _different(np.concatenate([seen, _sampled(whole)]))
            raw = whole.encode("utf-8", "replace")
            name.update(raw)
            pieces.append(squeeze.compress(raw))
            open_texts, held = [], 0

    def block() -> pa.RecordBatch:
        shut()
        name.update(repr(ids).encode())
        key = name.intdigest() - (1 << 63)
        columns = zip(([key], [ids], [langs], [trusted], [sizes], [pieces]), PACK_TYPES, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns], PACK_NAMES)

    for b in batches:
        for i, la, t, known in zip(*(b.column(c).to_pylist() for c in ("doc_id", "lang", "text", "trusted")), strict=True):
            ids.append(i)
            langs.append(la)
            trusted.append(known)
            open_texts.append(t)
            held, total = held + len(t), total + len(t)
            if held >= PIECE:
                shut()
            if total >= BLOCK or SAMPLED * len(seen) >= DISTINCT:
                yield block()
                ids, langs, trusted, sizes, pieces, name, seen = fresh()
                total = 0
    if ids:
        yield block()


PACK_NAMES = [c.split()[0] for c in PACKED.split(", ")]
PACK_TYPES = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.list_(pa.int32())), pa.list_(pa.binary())]


def _different(values: np.ndarray) -> np.ndarray:
    """The different values, ascending; by a sort, which is faster here than unique's table."""
    values = np.sort(values)
    return values[np.flatnonzero(np.diff(values, prepend=~values[:1]))]


def _sampled(text: str) -> np.ndarray:
    """One in SAMPLED of the different hashes of a text's n-grams, by the hash: cheap ones, 32 bits wide."""
    cps = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    n = len(cps) - ORDER + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    h = cps[:n].copy()
    for k in range(1, ORDER):
        h = h * np.uint32(0x9E3779B1) + cps[k : k + n]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return _different(h[h >> np.uint32(16) & np.uint32(SAMPLED - 1) == 0])


def _mixed(cps: np.ndarray) -> np.ndarray:
    x = (cps.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _fold(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for x in columns:
        h = h * np.uint64(0x9E3779B97F4A7C15) + x
    return h


def hashed(grams: list[str]) -> np.ndarray:
    """The hashes that positions() gives to these n-grams."""
    x = _mixed(np.frombuffer("".join(grams).encode("utf-32-le"), "<u4")).reshape(-1, ORDER)
    return _fold([x[:, k] for k in range(ORDER)])


def positions(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, text numbers, starts, code points) of the n-grams that end at each character, PIECE at most at a time."""
    joined = "".join(PAD + t for t in texts)
    cps = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    starts = np.arange(len(owner)) + owner * len(PAD)
    for at in range(0, len(owner), PIECE):
        start = starts[at : at + PIECE]
        x = _mixed(cps[start[0] : start[-1] + ORDER])
        n = len(x) - ORDER + 1
        yield _fold([x[k : k + n] for k in range(ORDER)])[start - start[0]], owner[at : at + PIECE], start, cps


def _texts(sizes: list[int], piece: bytes) -> list[str]:
    whole, at, out = zstandard.ZstdDecompressor().decompress(piece).decode("utf-8"), 0, []
    for n in sizes:
        out.append(whole[at : at + n])
        at += n
    return out


def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to rows (block, g, c): the n-grams of each block, and how often its trusted documents have them."""
    for b in pack(batches, STAYS):
        for key, trusted, sizes, pieces in zip(*(b.column(c).to_pylist() for c in ("block", "trusted", "sizes", "pieces")), strict=True):
            # Code points, not strings: 36 bytes for each n-gram.
            known, grams, counts, at = np.empty(0, np.uint64), np.empty((0, ORDER), np.uint32), np.empty(0, np.int64), 0
            for size, piece in zip(sizes, pieces, strict=True):
                flags = np.array(trusted[at : at + len(size)], bool)
                at += len(size)
                for h, owner, start, cps in positions(_texts(size, piece)):
                    # Sorted first, so that each different n-gram is looked up once and next to the one before.
                    order = np.argsort(h)
                    own, good = h[order], flags[owner]
                    heads = np.flatnonzero(np.diff(own, prepend=~own[:1]))
                    own = own[heads]
                    j = np.searchsorted(known, own)
                    new = np.flatnonzero(known[np.minimum(j, len(known) - 1)] != own) if len(known) else np.arange(len(own))
                    if len(new):
                        text = cps[start[order[heads[new]]][:, None] + np.arange(ORDER)]
                        known, grams, counts = np.insert(known, j[new], own[new]), np.insert(grams, j[new], text, axis=0), np.insert(counts, j[new], 0)
                    if good.any():
                        counts[np.searchsorted(known, own)] += np.add.reduceat(good[order].astype(np.int64), heads)
            for lo in range(0, len(known), 65536):
                part = slice(lo, lo + 65536)
                n, whole = len(known[part]), grams[part].astype("<u4").tobytes().decode("utf-32-le")
                strings = [whole[k : k + ORDER] for k in range(0, ORDER * n, ORDER)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, key)), pa.array(strings, pa.string()), pa.array(counts[part])], ["block", "g", "c"])


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, g, p) to rows (block, h, p) of many answers each, as bytes; at most HELD are held."""
    def passed(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        block, h, p = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((h, block))
        block, h, p = block[order], h[order], p[order]
        cut = np.flatnonzero(np.diff(block, prepend=block[0] ^ 1))
        parts = lambda x: pa.array([y.tobytes() for y in np.split(x, cut[1:])], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(block[cut]), parts(h), parts(p)], ["block", "h", "p"])

    found, held = [], 0
    for b in batches:
        if len(b):
            found.append((b.column("block").to_numpy(), hashed(b.column("g").to_pylist()), b.column("p").to_numpy()))
            held += len(b)
        if held >= HELD:
            yield passed(found)
            found, held = [], 0
    if found:
        yield passed(found)


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their answers to rows (doc_id, lang, trusted, score): the mean log probability, null without text."""
    for b in batches:
        for row in b.to_pylist():
            h = np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(a["h"], np.uint64) for a in row["answers"])])
            p = np.concatenate([np.empty(0, np.float32), *(np.frombuffer(a["p"], np.float32) for a in row["answers"])]).astype(np.float64)
            order = np.argsort(h)
            h, p = h[order], p[order]
            places = Places(h) if len(h) else None
            score: list[float | None] = []
            for size, piece in zip(row["sizes"], row["pieces"], strict=True):
                total = np.zeros(len(size))
                for own, owner, _, _ in positions(_texts(size, piece)):
                    total += np.bincount(owner, p[places.of(own)], len(size))
                score += [t / n if n else None for t, n in zip(total.tolist(), size, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(row["langs"], pa.string()), pa.array(row["trusted"], pa.bool_()), pa.array(score, pa.float64())], ["doc_id", "lang", "trusted", "score"]
            )


class Places:
    """Where values stand in an ascending array of hashes: a table by their first bits, then a few steps on."""

    def __init__(self, known: np.ndarray):
        self.known = known
        bits = max(1, int(len(known)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def of(self, h: np.ndarray) -> np.ndarray:
        """As searchsorted finds them; every value of h must be known."""
        at = self.first[(h >> self.shift).astype(np.int64)]
        late = np.flatnonzero(self.known[at] < h)
        while len(late):
            at[late] += 1
            late = late[self.known[at[late]] < h[late]]
        return at


def _ctx(n: int) -> Column:
    return F.substring("g", 1, n - 1)


def probabilities(asked: DataFrame) -> tuple[DataFrame, int]:
    """(g, p) for each n-gram asked for, from rows (g, c) with its count in trusted text, 0 if it is not there; and the size of the alphabet.

    An n-gram's own level comes first; where its beginning is unknown the shorter one counts.
    """
    levels = {ORDER: asked}
    for n in range(ORDER - 1, 0, -1):
        # Continuation counts: how many different characters stand before, in trusted text. 0 where it is asked for only.
        levels[n] = materialise(levels[n + 1].groupBy(F.expr("substring(g, 2)").alias("g")).agg(F.count_if(F.col("c") > 0).alias("c")), "grams")
    sizes = [levels[n].agg(F.lit(n).alias("n"), F.count_if(F.col("c") > 0).alias("all"), *[F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]) for n in levels]
    sizes = {r["n"]: r for r in reduce(DataFrame.unionByName, sizes).collect()}
    alphabet, lower = sizes[1]["all"] + 1, None
    for n in range(1, ORDER + 1):
        n1, n2, n3, n4 = (max(1, sizes[n][f"n{k}"]) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [min(k, max(0.1, k - (k + 1) * y * a / b)) for k, a, b in ((1, n2, n1), (2, n3, n2), (3, n4, n3))]
        less = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).when(F.col("c") > 2, d[2])
        rows = levels[n].select("g", "c", less.alias("d"), _ctx(n).alias("ctx"), F.expr("substring(g, 2)").alias("s"))
        ctx = rows.where("c > 0").groupBy("ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("mass"))
        rows = rows.join(ctx, "ctx", "left")
        rows = rows.withColumn("q", F.lit(1.0 / alphabet)) if lower is None else rows.join(lower.select(F.col("g").alias("s"), F.col("p").alias("q")), "s")
        own = F.coalesce((F.col("c") - F.col("d")) / F.col("total"), F.lit(0.0)) + F.col("mass") / F.col("total") * F.col("q")
        below, lower = lower, materialise(rows.select("g", F.coalesce(own, "q").alias("p")), "probabilities")
        for used in (below, levels[n] if n < ORDER else None):
            if used is not None:
                discard(used)
    return lower, alphabet


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the op9 query: doc_id, lang, perplexity, threshold, kept."""
    prepare_workers(docs.sparkSession)
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long")).distinct().withColumn("trusted", F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), whole_text().alias("text"))
    few = trusted.count() <= MAX_TRUSTED
    rows = rows.join(F.broadcast(trusted) if few else trusted, "doc_id", "left").select("doc_id", "lang", "text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    if not few:
        rows = materialise(rows, "flagged")
    grams = materialise(rows.mapInArrow(ask, "block long, g string, c long"), "grams")
    asked = materialise(grams.groupBy("g").agg(F.sum("c").alias("c")), "asked")
    if asked.where("c > 0").isEmpty():
        return docs.select("doc_id", "lang", F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("kept"))
    known, alphabet = probabilities(asked)
    answers = grams.join(known, "g").select("block", "g", F.log("p").cast("float").alias("p")).mapInArrow(_by_block, "block long, h binary, p binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("h", "p")).alias("answers"))
    blocks = rows.mapInArrow(pack, PACKED).join(answers, "block", "left")
    # A block without text asks for nothing.
    lost = F.col("answers").isNull() & F.exists("sizes", lambda s: F.exists(s, lambda n: n > 0))
    blocks = blocks.withColumn("answers", F.when(lost, F.raise_error(F.lit("rows came in another order: write the documents to a table first"))).otherwise(F.coalesce("answers", F.expr("array()").cast("array<struct<h:binary,p:binary>>"))))
    scored = materialise(blocks.mapInArrow(_answered, "doc_id long, lang string, trusted boolean, score double").select("doc_id", "lang", "trusted", F.coalesce(F.exp(-F.col("score")), F.lit(float(alphabet))).alias("perplexity")), "perplexities")
    for used in (grams, asked, known):
        discard(used)
    cut = F.percentile_approx("perplexity", F.lit(QUANTILE), F.lit(10_000))
    by_lang = materialise(scored.where("trusted").groupBy("lang").agg(cut.alias("threshold")), "thresholds")
    overall = scored.where("trusted").agg(cut.alias("t")).first()["t"]
    out = scored.join(by_lang.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    out = out.withColumn("threshold", F.coalesce("threshold", F.lit(overall)))
    return out.select("doc_id", "lang", "perplexity", "threshold", (F.col("perplexity") <= F.col("threshold")).alias("kept"))
