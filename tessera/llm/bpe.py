"""BPE encoding and decoding; a segment tree over adjacent pair ranks picks the merges.

The leaves of the tree hold the merge rank of each adjacent pair (or none) and each
node its least child, the left one on a tie, so the root yields the leftmost pair of
the lowest rank. A merge changes at most three leaves; each is a logarithmic update.
``RankTree`` is the tree of one long word; ``merge_many`` keeps the trees of many short
words as the rows of one array and makes one merge in each of them at a time.

Text is cut at added tokens, then at white space; a stretch without white space has the
same ids wherever it stands, so a worker keeps those it has seen, up to CACHE of them.
The vocabulary (a file of fixed size) is read by the driver and broadcast.

Which characters are letters, numbers or white, and what lower-casing and composing do to
them, depends on a version of Unicode. Below PLAIN all versions agree, and Python's own
functions are used; stretches with other characters go through the normaliser and the
pre-tokenizer that the library makes of the same file, so its own classes count.

Defined results: null and empty texts have no ids and decode to the empty text; texts
of any length and runs without white space are encoded whole; repeated rows are encoded
one by one; extra columns stay, those that have the name of a result are replaced by it;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.shared import prepare_workers, whole_text

CACHE = 500_000
#: Longer words and stretches are not kept; longer words (in bytes) have a tree of their own.
LONGEST_KEPT = 64
NONE = sys.maxsize
NO_RANK = 2**31 - 1
#: Latin letters, whose classes are the same in all versions of Unicode.
PLAIN = re.compile("[\x00-\u024f]*")
# Python's split() also cuts at these, which are not white space in Unicode.
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_letters() -> dict[int, str]:
    """The printable letter for each byte: itself where it prints, else 256 and up in order."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in prints}
    return out | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in out)}


class RankTree:
    """Least rank over positions 0..n-1, leftmost on ties."""

    def __init__(self, ranks: list[int]):
        self.base = 1 << max(0, (len(ranks) - 1)).bit_length()
        self.least = [NONE] * self.base + ranks + [NONE] * (self.base - len(ranks))
        for i in range(self.base - 1, 0, -1):
            a, b = self.least[2 * i], self.least[2 * i + 1]
            self.least[i] = a if a <= b else b

    def update(self, at: int, rank: int) -> None:
        least, i = self.least, at + self.base
        least[i] = rank
        while i > 1:
            i >>= 1
            a, b = least[2 * i], least[2 * i + 1]
            now = a if a <= b else b
            if least[i] == now:
                break
            least[i] = now

    def root(self) -> tuple[int, int]:
        """(rank, position) of the leftmost least, or (NONE, -1)."""
        least, i = self.least, 1
        rank = least[1]
        if rank == NONE:
            return NONE, -1
        while i < self.base:
            i *= 2
            if least[i] != rank:
                i += 1
        return rank, i - self.base


class PairTable:
    """Merge ranks by pair of ids: open addressing in two arrays, looked up many at a time."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]]):
        self.bits = max(4, (len(merges) * 8).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NO_RANK, np.int32)
        for (a, b), (rank, _) in merges.items():
            key = (a << 32) | b
            at = int(self._slots(np.array([key], np.int64))[0])
            while self.keys[at] != -1:
                at = (at + 1) & (len(self.keys) - 1)
            self.keys[at], self.ranks[at] = key, rank

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a.astype(np.int64) << 32) | b
        at = self._slots(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.ranks[at], NO_RANK)
        left = np.flatnonzero((there != keys) & (there != -1))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            there = self.keys[at[left]]
            hit = there == keys[left]
            out[left[hit]] = self.ranks[at[left[hit]]]
            left = left[~hit & (there != -1)]
        return out


class Bpe:
    """A tokenizer read from the JSON of a tokenizer file."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.tokens = [""] * (max([*self.vocab.values(), *(t["id"] for t in data["added_tokens"])]) + 1)
        for t, i in self.vocab.items():
            self.tokens[i] = t
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        for t, i in self.added.items():
            self.tokens[i] = t
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        self.suffix = model["end_of_word_suffix"] or ""
        split = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        spaced = [(t + " ").encode() for t in self.tokens]
        self.letters_flat = np.frombuffer(b"".join(spaced), np.uint8)
        self.letters_sizes = np.array([len(t) for t in spaced], np.int64)
        self.words = regex.compile(split["pattern"]["Regex"])
        self.letters = byte_letters()
        self.bytes = {c: b for b, c in self.letters.items()}
        library = Tokenizer.from_str(spec)
        self.normalise, self.pre_tokenise = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.white = regex.compile(r"\p{White_Space}+")
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pairs = PairTable(self.merges)
        self.merged = np.zeros(len(model["merges"]) + 1, np.int32)
        for rank, got in self.merges.values():
            self.merged[rank] = got
        self.first = np.array([self.vocab.get(self.letters[b], -1) for b in range(256)], np.int32)
        self.last = np.array([self.vocab.get(self.letters[b] + self.suffix, -1) for b in range(256)], np.int32)
        self.marks = {" " + t: i.to_bytes(4, "little") for t, i in self.added.items()}
        self.stretches: dict[str, bytes] = dict(self.marks)
        self.known: dict[bytes, bytes] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Merges until no pair can be merged: always the leftmost of the lowest rank."""
        merges, n = self.merges, len(ids)
        if n < 2:
            return ids
        ids = ids[:]
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        rank = lambda i, j: merges.get((ids[i], ids[j]), (NONE, 0))[0]
        tree = RankTree([rank(i, i + 1) for i in range(n - 1)])
        while True:
            _, i = tree.root()
            if i < 0:
                break
            j = after[i]
            ids[i] = merges[ids[i], ids[j]][1]
            ids[j] = -1
            k = after[i] = after[j]
            if j < n - 1:
                tree.update(j, NONE)
            if k >= 0:
                before[k] = i
                tree.update(i, rank(i, k))
            else:
                tree.update(i, NONE)
            if (p := before[i]) >= 0:
                tree.update(p, rank(p, i))
        return [x for x in ids if x >= 0]

    def word(self, word: bytes) -> list[int]:
        """The ids of a pre-token, by a tree of its own."""
        first = [int(self.first[b]) for b in word[:-1]]
        return self.merge([*first, int(self.last[word[-1]])])

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of words of LONGEST_KEPT bytes at most."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words])
        for low, high in ((0, 8), (8, 16), (16, 32), (32, LONGEST_KEPT)):
            at = np.flatnonzero((sizes > low) & (sizes <= high))
            for part in np.array_split(at, max(1, len(at) // 8192)) if len(at) else []:
                flat, ends = self._forest([words[i] for i in part], sizes[part], high)
                packed, start = flat.astype("<u4").tobytes(), 0
                for i, end in zip(part.tolist(), (ends * 4).tolist(), strict=True):
                    out[i] = packed[start:end]
                    start = end
        return out

    def _forest(self, words: list[bytes], sizes: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
        """One tree a row, the root in column 1, leaf i in column leaves + i. The ids in a row, and where each word's end."""
        n, letters = len(words), np.frombuffer(b"".join(words), np.uint8)
        inside = np.arange(leaves) < sizes[:, None]
        ids = np.full((n, leaves + 1), -1, np.int32)
        ids[:, :leaves][inside] = self.first[letters]
        ends = np.cumsum(sizes) - 1
        rows = np.arange(n)
        ids[rows, sizes - 1] = self.last[letters[ends]]
        tree = np.full((n, 2 * leaves), NO_RANK, np.int32)
        paired = inside[:, 1:]
        r, c = np.nonzero(paired)
        tree[r, leaves + c] = self.pairs.find(ids[r, c], ids[r, c + 1])
        half = leaves // 2
        while half:
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
            half //= 2
        after = np.minimum(np.tile(np.arange(1, leaves + 2), (n, 1)), sizes[:, None])  # sizes: none follows
        before = np.tile(np.arange(-1, leaves), (n, 1))
        wide, flat_ids, flat_after, flat_before, flat = leaves + 1, ids.ravel(), after.ravel(), before.ravel(), tree.ravel()
        live = rows[tree[:, 1] != NO_RANK]
        while len(live):
            base, rank = live * (2 * leaves), flat[live * (2 * leaves) + 1]
            i = np.ones(len(live), np.int64)
            while i[0] < leaves:  # to the leftmost leaf that has the root's rank
                i *= 2
                i += flat[base + i] != rank
            i -= leaves
            row = live * wide
            j = flat_after[row + i]
            k = flat_after[row + j]
            flat_ids[row + i] = self.merged[rank]
            flat_ids[row + j] = -1
            flat_after[row + i] = k
            size = sizes[live]
            more = k < size
            flat_before[(row + k)[more]] = i[more]
            p = flat_before[row + i]
            now = np.full(len(live), NO_RANK, np.int32)
            now[more] = self.pairs.find(flat_ids[(row + i)[more]], flat_ids[(row + k)[more]])
            self._update(flat, base, j, np.int32(NO_RANK), leaves)
            self._update(flat, base, i, now, leaves)
            some = p >= 0
            if some.any():
                left = self.pairs.find(flat_ids[(row + p)[some]], flat_ids[(row + i)[some]])
                self._update(flat, base[some], p[some], left, leaves)
            live = live[flat[base + 1] != NO_RANK]
        there = ids >= 0
        return ids[there], np.cumsum(there.sum(1))

    @staticmethod
    def _update(flat: np.ndarray, base: np.ndarray, at: np.ndarray, rank, leaves: int) -> None:
        """Sets a leaf of each tree, then the nodes above it."""
        i = at + leaves
        flat[base + i] = rank
        while leaves > 1:
            i = i >> 1
            under = base + 2 * i
            flat[base + i] = np.minimum(flat[under], flat[under + 1])
            leaves //= 2

    def _words(self, stretch: str) -> tuple[bytes, ...]:
        """The pre-tokens of a stretch by the library's classes, in UTF-8."""
        return tuple(bytes(self.bytes[c] for c in piece) for piece, _ in self.pre_tokenise(self.normalise(stretch)))

    def _learn(self, stretches: list[str]) -> dict[str, bytes]:
        """The packed ids of stretches without white space."""
        if not stretches:
            return {}
        plain = [s for s in stretches if PLAIN.fullmatch(s)]
        # Each letter is lowered for itself: no final sigma.
        low = unicodedata.normalize("NFC", "\n".join(plain)).lower().split("\n") if plain else []
        cut = {s: (x.encode(),) if x.isalpha() else tuple(w.encode() for w in self.words.findall(x)) for s, x in zip(plain, low, strict=True)}
        cut |= {s: self._words(s) for s in stretches if s not in cut}
        if len(self.known) > CACHE:
            self.known.clear()
        known, new = self.known, list(set().union(*cut.values()) - self.known.keys())
        short = [w for w in new if len(w) <= LONGEST_KEPT]
        known.update(zip(short, self.merge_many(short), strict=True))
        long = [w for w in new if len(w) > LONGEST_KEPT]
        known.update((w, np.asarray(self.word(w), "<u4").tobytes()) for w in long)
        out = {s: known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws]) for s, ws in cut.items()}
        for w in long:
            del known[w]
        return out

    def _cut(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct stretches and added tokens; their numbers in the order of the texts; how many each text has."""
        if any(SEPARATORS.search(t) or self.cut and self.cut.search(t) for t in texts):
            lists = pa.array([self._pieces(t) for t in texts], pa.list_(pa.large_string()))
        else:
            lists = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
        flat = lists.flatten().dictionary_encode()
        return flat.dictionary.to_pylist(), flat.indices.to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        if not texts:
            return []
        parts, at, counts = self._cut(texts)
        kept = self.stretches
        if len(kept) > CACHE:
            kept.clear()
            kept.update(self.marks)
        kept[""] = b""  # what the split leaves at the ends
        new = self._learn([p for p in parts if p not in kept])
        kept.update(new)
        packed = [kept[p] for p in parts]
        for s in new:
            if len(s) > LONGEST_KEPT:
                del kept[s]
        sizes = np.array([len(p) // 4 for p in packed], np.int64)
        ids, ends = gather(np.frombuffer(b"".join(packed), "<u4"), sizes, at)
        return np.split(ids, ends[np.cumsum(counts)][:-1])

    def _pieces(self, text: str) -> list[str]:
        """Stretches without white space, and added tokens."""
        # A mark has a space before it, as no stretch has.
        parts = self.cut.split(text) if self.cut else [text]
        return [x for part in parts for x in ([" " + part] if part in self.added else self._stretches(part))]

    def _stretches(self, text: str) -> list[str]:
        return [x for x in self.white.split(text) if x]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: np.ndarray) -> bytes:
        """The text in UTF-8. The file names no decoder, so tokens are joined by spaces."""
        return gather(self.letters_flat, self.letters_sizes, ids)[0].tobytes()[:-1]


def gather(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``flat`` (of these sizes) numbered ``at``, in a row; and 0 with the end of each."""
    starts, long = np.concatenate([[0], np.cumsum(sizes)])[at], sizes[at]
    ends = np.concatenate([[0], np.cumsum(long)])
    return flat[np.repeat(starts - ends[:-1], long) + np.arange(ends[-1])], ends


def load(path: str) -> str:
    """The tokenizer file, read on the driver; such files have a fixed size of a few MB."""
    with open(path, encoding="utf-8") as f:
        return f.read()


_loaded: dict[str, Bpe] = {}


def loaded(spec: str) -> Bpe:
    """The tokenizer of this worker process, which later tasks find with its cache."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(spec)
    return _loaded[key]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """All columns of docs, with ids (array of int) and decoded."""
    return _apply(docs, path, "ids array<int>, decoded string", lambda t, ids: (ids.tolist(), t.decode(ids).decode()))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """All columns of docs, with n_tokens, ids_sha256 and decoded_sha256."""
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return _apply(docs, path, "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda t, ids: (len(ids), sha(ids.tobytes()), sha(t.decode(ids))))


def _apply(docs: DataFrame, path: str, schema: str, make) -> DataFrame:
    prepare_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    names = [x.split()[0] for x in schema.split(", ")]

    @F.pandas_udf(schema)
    def go(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = loaded(shared.value)
        for s in texts:
            yield pd.DataFrame([make(bpe, p) for p in bpe.encode_batch(s.tolist())], columns=names)

    rows = docs.select(F.struct("*").alias("_row"), go(whole_text()).alias("_bpe"))
    kept = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c.lower() not in names]
    return rows.select(*kept, *[F.col(f"_bpe.{n}").alias(n) for n in names])
