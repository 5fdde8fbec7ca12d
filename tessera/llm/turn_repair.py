"""Conversation repair: the cheapest edits that make the roles a dialogue.

The roles' initials have to become ``(s?(ua)+)?``: nothing, or an optional system turn and
then user and assistant in alternation. Keep costs 0, Rerole to user or assistant 1,
Delete 2, Insert of an empty user or assistant turn 5. A blank or duplicate row has to be
deleted; a truncated one that is not costs 5 more. Of edits of equal cost those whose
letters in order are the least in ASCII count.

The edits are a weighted automaton of four states (nothing yet, after s, after u, after
a). It is determinised as far as rows ask for it: the costs of going on from each state,
less the least of them, are a state of the new automaton (``Table``), cached with its
transitions. There are few, as any state reaches what another does for two inserts.

1. Rows are sorted by range partition, so that a conversation of any length is spread,
   and cut into segments of SEGMENT rows at most, one letter a row.
2. Each segment is scanned through the table from its last row to its first, once for
   each state after it: a matrix of costs.
3. Each conversation's matrices are applied from the last to the first, which gives every
   segment the costs of all that follows.
4. Each segment is scanned with these, and the tight arcs are followed from its first row:
   the edits, for each state before it; then the states are carried from segment to segment.

Steps 3 and 4 move one row a segment between tasks; texts are moved for sorting, and in
digests for the hash. That hash is of a whole conversation in order, so its rows pass
through one task, as a stream: SHA-256 cannot be split.

Defined results: null ids are one conversation and a null turn comes first; null roles and
texts are one space, which is neither s, u nor a, and blank; turns of equal number go by
role, then by a digest of the text, and repeated rows follow each other; long texts are
read whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from tessera.llm.shared import materialise, prepare_workers

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
SEGMENT_BITS = 12
SEGMENT = 1 << SEGMENT_BITS
INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5
NEVER = 1 << 20
#: States: nothing yet, after s, after u, after a. What user or assistant turn may follow.
STATES = range(4)
FOLLOWS = (2, 2, 3, 2)
NAMES = {2: "u", 3: "a"}
FINE, CUT, GONE = 0, 1, 2


def letter(initial: int, fault: int) -> str:
    """A row as a letter: initial 0 for s, 1 for u, 2 for a, 3 for others."""
    return chr(97 + 4 * fault + initial)


class Table:
    """The determinised automaton, read from the last row to the first."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        self.known: dict[tuple[int, ...], int] = {}
        self.steps: dict[tuple[int, str], tuple[int, int]] = {}
        self.arcs: dict[tuple[int, str, int], tuple[str, int]] = {}

    def state(self, costs: list[int]) -> tuple[int, int]:
        """(least cost, number of the normalised vector)."""
        least = min(costs)
        vector = tuple(min(c - least, NEVER) for c in costs)
        if vector not in self.known:
            self.known[vector] = len(self.vectors)
            self.vectors.append(vector)
        return least, self.known[vector]

    @staticmethod
    def closed(costs: list[int]) -> list[int]:
        """With what inserts make cheaper: two are enough."""
        for _ in range(2):
            costs = [min(c, INSERT + costs[FOLLOWS[p]]) for p, c in enumerate(costs)]
        return costs

    @staticmethod
    def choices(row: str, p: int) -> Iterator[tuple[str, int, int]]:
        """(edit, cost, state after) of the edits that use up a row, in ASCII order."""
        fault, initial = divmod(ord(row) - 97, 4)
        yield "D-", DELETE, p
        if fault != GONE:
            more = TRUNCATED * (fault == CUT)
            if initial == 0 and p == 0:
                yield "Ks", more, 1
            elif initial in (1, 2) and FOLLOWS[p] == initial + 1:
                yield "K" + NAMES[initial + 1], more, initial + 1
            yield "R" + NAMES[FOLLOWS[p]], REROLE + more, FOLLOWS[p]

    def step(self, after: int, row: str) -> tuple[int, int]:
        """(cost, vector) before a row from the vector after it."""
        key = after, row
        if key not in self.steps:
            v = self.vectors[after]
            self.steps[key] = self.state(self.closed([min(c + v[q] for _, c, q in self.choices(row, p)) for p in STATES]))
        return self.steps[key]

    def arc(self, after: int, row: str, p: int) -> tuple[str, int]:
        """(edits, state after) of the least tight arcs from state p before a row to behind it."""
        key = after, row, p
        if key not in self.arcs:
            cost, before = self.step(after, row)
            here, there, said, at = self.vectors[before], self.vectors[after], "", p
            while True:
                due = cost + here[at]
                own = next((x for x in self.choices(row, at) if x[1] + there[x[2]] == due), None)
                if due == cost + INSERT + here[FOLLOWS[at]] and (own is None or own[0] > "I"):
                    at = FOLLOWS[at]
                    said += "I" + NAMES[at]
                    continue
                self.arcs[key] = said + own[0], own[2]
                break
        return self.arcs[key]

    def scan(self, rows: str, costs: list[int]) -> tuple[list[int], list[int]]:
        """Costs before the rows, from those after them; the vectors behind each row."""
        total, now = self.state(costs)
        behind = []
        for row in reversed(rows):
            behind.append(now)
            cost, now = self.step(now, row)
            total += cost
        return [min(total + c, NEVER) for c in self.vectors[now]], behind[::-1]

    def trace(self, rows: str, behind: list[int], p: int) -> tuple[list[str], int]:
        """The edits for each row, and the state after them."""
        out = []
        for row, after in zip(rows, behind, strict=True):
            said, p = self.arc(after, row, p)
            out.append(said)
        return out, p


#: What is due after the last row.
END = Table.closed([0, NEVER, NEVER, 0])
_table = Table()


def trailing(p: int) -> str:
    """The inserts after the last row."""
    out = ""
    while END[p]:
        p = FOLLOWS[p]
        out += "I" + NAMES[p]
    return out


@F.pandas_udf(ArrayType(IntegerType()))
def _matrix(rows: pd.Series) -> pd.Series:
    units = [[0 if q == p else NEVER for q in STATES] for p in STATES]
    return pd.Series([[c for u in units for c in _table.scan(r, u)[0]] for r in rows], dtype=object)


@F.pandas_udf(ArrayType(IntegerType()))
def _exits(rows: pd.Series, ends: pd.Series) -> pd.Series:
    def one(r: str, end: list[int]) -> list[int]:
        _, behind = _table.scan(r, list(end))
        return [_table.trace(r, behind, p)[1] for p in STATES]

    return pd.Series([one(r, e) for r, e in zip(rows, ends, strict=True)], dtype=object)


@F.pandas_udf(ArrayType(StringType()))
def _edits(rows: pd.Series, ends: pd.Series, entries: pd.Series, last: pd.Series) -> pd.Series:
    def one(r: str, end: list[int], entry: int, is_last: bool) -> list[str]:
        _, behind = _table.scan(r, list(end))
        out, p = _table.trace(r, behind, entry)
        if is_last:
            out[-1] += trailing(p)
        return out

    return pd.Series([one(*x) for x in zip(rows, ends, entries, last, strict=True)], dtype=object)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each conversation, last first: (number, costs after it, least cost from its start, whether it is the last)."""
    now, costs = object(), []
    for b in batches:
        out = []
        for c, seg, m in zip(*(b.column(x).to_pylist() for x in ("_c", "seg", "matrix")), strict=True):
            last = c != now
            if last:
                now, costs = c, END
            after = costs
            costs = Table.closed([min(min(m[4 * q + p] + after[q] for q in STATES), NEVER) for p in STATES])
            out.append({"_c": c, "seg": seg, "after": after, "cost": costs[0], "last": last})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("_c", b.schema.field("_c").type), ("seg", pa.int64()), ("after", pa.list_(pa.int32())), ("cost", pa.int64()), ("last", pa.bool_())]))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each conversation in order: (number, state before it)."""
    now, p = object(), 0
    for b in batches:
        out = []
        for c, seg, exits in zip(*(b.column(x).to_pylist() for x in ("_c", "seg", "exits")), strict=True):
            if c != now:
                now, p = c, 0
            out.append({"_c": c, "seg": seg, "entry": p})
            p = exits[p]
        yield pa.RecordBatch.from_pylist(out, pa.schema([("_c", b.schema.field("_c").type), ("seg", pa.int64()), ("entry", pa.int32())]))


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by the CRC-32 of ``conv_id:turn`` modulo 20: 0 goes, 1 loses its text, 2 its ends of sentences, 3 is doubled, 4 becomes a user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("_kind")).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("_copy")


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def sorted_turns(rows: DataFrame) -> DataFrame:
    """Rows in order by _id, with _digest of role and text, and their first fault: blank, duplicate, truncated or null."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select(F.struct("conv_id").alias("_c"), F.col("turn").cast("long"), space("role"), space("text"))
    rows = rows.withColumn("_digest", F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    order = ["_c", F.asc_nulls_first("turn"), "role", "_digest"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(rows.withColumn("_id", F.monotonically_increasing_id()), "turns")


def faults(turns: DataFrame) -> DataFrame:
    """(_c, _id, initial, fault) of sorted turns; rows of one conversation with equal role and text are found by their digest."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    last = F.substring(trimmed, -1, 1)
    small = turns.select("_c", "_id", _initial(F.col("role")).alias("initial"), "_digest", (trimmed == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    small = materialise(small, "turn-faults")
    first = small.groupBy("_c", "_digest").agg(F.min("_id").alias("_id")).select("_id", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    return materialise(small.join(first, "_id", "left").select("_c", "_id", "initial", fault.alias("fault")), "turn-letters")


def edits(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(_id, edits) for each row, as pairs of an edit and the initial it leaves; and (_c, cost) for each conversation."""
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", CUT).otherwise(FINE)
    rows = marked.select("_c", F.shiftright("_id", SEGMENT_BITS).alias("seg"), "_id", F.char(97 + 4 * kind + initial).alias("row"))
    packed = F.array_sort(F.collect_list(F.struct("_id", "row")))  # at most SEGMENT letters
    segments = rows.groupBy("_c", "seg").agg(packed.alias("p"))
    segments = materialise(segments.select("_c", "seg", F.element_at("p", 1)["_id"].alias("first"), F.array_join(F.col("p.row"), "").alias("rows")), "segments")
    kind_of = segments.schema["_c"].dataType.simpleString()
    matrices = segments.select("_c", "seg", _matrix("rows").alias("matrix")).repartition("_c").sortWithinPartitions("_c", F.desc("seg"))
    ends = materialise(matrices.mapInArrow(_ends, f"_c {kind_of}, seg long, after array<int>, cost long, last boolean"), "segment-ends")
    both = segments.join(ends, ["_c", "seg"])
    exits = both.select("_c", "seg", _exits("rows", "after").alias("exits")).repartition("_c").sortWithinPartitions("_c", "seg")
    entries = exits.mapInArrow(_entries, f"_c {kind_of}, seg long, entry int")
    said = both.join(entries, ["_c", "seg"]).select("first", _edits("rows", "after", "entry", "last").alias("e"))
    said = said.select("first", F.posexplode("e").alias("k", "edits")).select((F.col("first") + F.col("k")).alias("_id"), "edits")
    start = ends.groupBy("_c").agg(F.min(F.struct("seg", "cost")).alias("s")).select("_c", F.col("s.cost").alias("cost"))
    return said, start


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired turns, and a report for each conversation.

    Turns: conv_id, turn, role and text of what stays or is inserted or deleted, edit (K,
    R, I or D), was (the initial that the row had, null for inserts), _id and _k (their
    order). Report: conv_id, gaps, blank, duplicate, truncated and cost.
    """
    prepare_workers(rows.sparkSession)
    turns = sorted_turns(rows)
    marked = faults(turns)
    said, cost = edits(marked)
    pair = F.transform(F.sequence(F.lit(0), (F.length("edits") / 2).cast("int") - 1), lambda i: F.struct(F.substring("edits", 2 * i + 1, F.lit(1)).alias("edit"), F.substring("edits", 2 * i + 2, F.lit(1)).alias("who")))
    out = turns.join(said, "_id").select("_id", "_c", "turn", "role", "text", F.posexplode(pair).alias("_k", "e"))
    new, ins = F.col("e.edit").isin("I", "R"), F.col("e.edit") == "I"
    role = F.when(new & (F.col("e.who") == "u"), "user").when(new, "assistant").otherwise(F.col("role"))
    out = out.select("_c", "_id", "_k", "turn", role.alias("to"), F.when(ins, "").otherwise(F.col("text")).alias("text"), F.col("e.edit").alias("edit"), F.when(~ins, _initial(F.col("role"))).alias("was"))
    gaps = turns.groupBy("_c").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    counts = marked.groupBy("_c").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    report = gaps.join(counts, "_c").join(cost, "_c")
    return out.withColumnRenamed("to", "role").select("_c.*", "_id", "_k", "turn", "role", "text", "edit", "was"), report.select("_c.*", "gaps", "blank", "duplicate", "truncated", "cost")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of conversations, in order, to (conv_id, illegal, audit, repaired_sha256)."""
    now, held = None, False
    illegal, audit, sha, was, any_kept = 0, [], hashlib.sha256(), None, False

    def done() -> dict:
        return {"conv_id": now, "illegal": illegal, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}

    for b in batches:
        out = []
        for c, edit, initial, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "edit", "was", "role", "text")), strict=True):
            if not held or c != now:
                if held:
                    out.append(done())
                now, held = c, True
                illegal, audit, sha, was, any_kept = 0, [], hashlib.sha256(), None, False
            audit.append(edit)
            if edit != "I":
                illegal += was is not None and was + initial not in ("su", "ua", "au")
                was = initial
            if edit != "D":
                sha.update(f"{chr(10) if any_kept else ''}{role}:{text}".encode("utf-8", "replace"))
                any_kept = True
        yield pa.RecordBatch.from_pylist(out, _schema(b))
    if held:
        yield pa.RecordBatch.from_pylist([done()], _schema(b))


def _schema(b: pa.RecordBatch) -> pa.Schema:
    return pa.schema([("conv_id", b.schema.field("conv_id").type), ("illegal", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def digests(turns: DataFrame, report: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: the report, audit and digest of its repaired turns."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "_id", "_k").select("conv_id", "edit", "was", "role", "text")
    said = ordered.mapInArrow(_digests, f"conv_id {kind}, illegal long, audit string, repaired_sha256 string")
    key = F.struct("conv_id").alias("_c")
    out = conversations.select(key).distinct().join(said.select(key, "illegal", "audit", "repaired_sha256"), "_c", "left").join(report.select(key, "gaps", "blank", "duplicate", "truncated", "cost"), "_c", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("_c.conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
