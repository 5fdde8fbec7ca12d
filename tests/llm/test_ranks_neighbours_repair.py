"""Grouped ranks, nearest neighbours and conversation repair against brute force, with odd rows and hot keys."""

import hashlib
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, group_ranks, turn_repair

# 11

LINES = "g long, h string, a long, b long, t long, _key string, pos string"


def ranked_plainly(lines, limit):
    """(g, h, a, b, t, pos, place, tied) in plain Python: a descending, b ascending, nulls last."""
    last = lambda x, sign=1: (x is None, sign * (x or 0))
    groups = {}
    for r in lines:
        groups.setdefault(r[:2], []).append(r)
    out = []
    for rows in groups.values():
        rows.sort(key=lambda r: (last(r[2], -1), last(r[3]), last(r[4])))
        places = {k: n for n, k in enumerate(dict.fromkeys(r[2:4] for r in rows), 1)}
        out += [(*r[:5], n, places[r[2:4]], sum(x[2:4] == r[2:4] for x in rows)) for n, r in enumerate(rows, 1) if places[r[2:4]] <= limit]
    return sorted(out, key=repr)


@pytest.mark.parametrize("together", [8, 10_000])
def test_ranks_equal_plain_ones(spark, monkeypatch, together):
    monkeypatch.setattr(group_ranks, "TOGETHER", together)
    rng = random.Random(3)
    pick = lambda *xs: rng.choice(xs)
    lines = [(pick(None, -1, 1, 2) if i % 3 else 7, pick("x", None) if i % 3 else "hot", pick(None, 0, 1, 2, 3, 4, 5), pick(None, 0, 1), pick(None, 1, 2, 3), "k", "p") for i in range(1500)]
    lines += [(7, "hot", 5, 0, 1, "k", "p")] * 300 + [(9, "one", None, None, None, "k", "p")]
    df = spark.createDataFrame(lines, LINES).repartition(6)
    rank = [("a", F.desc_nulls_last), ("b", F.asc_nulls_last)]
    got = group_ranks.top_places(df.select("g", "h", "a", "b", "t"), ["g", "h"], rank, ["t"], 5)
    assert sorted(map(tuple, got.collect()), key=repr) == ranked_plainly(lines, 5)
    # Columns of any name are carried.
    assert group_ranks.top_places(df, ["g", "h"], rank, ["t"], 5).where("_key = 'k' AND tied > 0").count() == got.count()
    assert group_ranks.top_places(df.limit(0), ["g", "h"], rank, ["t"], 5).count() == 0


def test_hot_group_is_spread(spark, monkeypatch):
    monkeypatch.setattr(group_ranks, "TOGETHER", 50)
    df = spark.range(0, 4000, 1, 4).select(F.lit(1).alias("g"), F.lit("h").alias("h"), F.lit(1).alias("a"))
    most = group_ranks.salted(df, ["g", "h"]).groupBy("_salt").count().agg(F.max("count").alias("m"), F.count("*").alias("n")).first()
    assert most.m <= 1000 and most.n >= 4  # equal rows: a salt for each partition that they are read from
    df = df.withColumn("x", F.monotonically_increasing_id())
    assert group_ranks.salted(df, ["g", "h"]).groupBy("_salt").count().agg(F.max("count")).first()[0] <= 100


# 12


def found(df):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in df.collect()}


def nearest_plainly(vectors, k, asks):
    ids = [i for i, _ in vectors]
    x = np.array([v for _, v in vectors], float)
    out = {}
    for i, v in vectors:
        if asks(i):
            score = x @ np.array(v, float)
            order = sorted((n for n in range(len(ids)) if ids[n] != i), key=lambda n: (-round(score[n], 12), ids[n]))[:k]
            out |= {(i, rank): (ids[n], score[n]) for rank, n in enumerate(order, 1)}
    return out


def test_few_vectors_are_exact(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(x) for x in rng.standard_normal(5)]) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(60)]  # more equal vectors than asked for
    bad = [(200, None), (201, []), (202, [0.0] * 5), (203, [1.0, None, 0.0, 0.0, 0.0]), (204, [float("nan")] * 5), (205, [float("inf")] + [0.0] * 4), (None, [1.0] * 5), (206, [1.0, 2.0]), (0, [9.0] * 5)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in good + bad + good[3:5]], "vec_id long, vec array<double>, rep string, dim int")
    df = df.where("vec_id IS NULL OR vec_id <> 0 OR vec[0] < 5")
    got, want = found(ann.nearest(df, F.col("vec_id") % 20 == 0, 20)), nearest_plainly(good, 20, lambda i: i % 20 == 0)
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-12 for k in want)
    # The least of two vectors of one id counts; vectors of other lengths are not compared.
    assert found(ann.nearest(df.where("vec_id = 206"), F.lit(True), 3)) == {}
    assert ann.nearest(df.limit(0), F.lit(True), 3).count() == 0
    two = spark.createDataFrame([(1, [2.0, 0.0]), (1, [1.0, 0.0]), (2, [3.0, 1.0])], "vec_id long, vec array<double>")
    assert found(ann.nearest(two, F.lit(True), 3)) == {(1, 1): (2, 3.0), (2, 1): (1, 3.0)}


@pytest.mark.parametrize("norms", [False, True])
def test_recall_with_a_dense_third_and_other_norms(spark, monkeypatch, norms):
    monkeypatch.setattr(ann, "SPLIT", 64)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 32))
    x[::3] = x[0] + 0.05 * rng.standard_normal((500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms:
        x *= rng.uniform(0.2, 3.0, (1500, 1))
    vectors = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(x)]
    df = spark.createDataFrame(vectors, "vec_id long, vec array<float>")
    got, want = found(ann.nearest(df, F.col("vec_id") % 10 == 0, 10)), nearest_plainly(vectors, 10, lambda i: i % 10 == 0)
    assert got.keys() == want.keys()
    by = lambda d: {(q, v[0]) for (q, _), v in d.items()}
    assert len(by(got) & by(want)) >= 0.9 * len(by(want))
    assert all(abs(s - np.dot(vectors[q][1], vectors[v][1])) < 1e-9 for (q, _), (v, s) in got.items())


def test_queries_that_found_too_little_are_searched_exactly(spark, monkeypatch):
    monkeypatch.setattr(ann, "SPLIT", 32)
    monkeypatch.setattr(ann, "fit_probes", lambda *a: 1)
    monkeypatch.setattr(ann, "TABLES", 1)
    monkeypatch.setattr(ann, "DEPTH", 1)  # what is still large is read in chunks
    x = np.random.default_rng(4).standard_normal((200, 16))
    x[:100] = x[0] + 0.01 * x[:100]
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = ann.nearest(spark.createDataFrame(vectors, "vec_id long, vec array<double>"), F.lit(True), 20)
    assert got.groupBy("query_id").count().where("count = 20").count() == 200


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).standard_normal((20, 50)).astype(np.float32)
    y = ann.rotate(x, 0, 0)
    assert y.shape == (20, 64) and np.allclose(y @ y.T, x @ x.T, atol=1e-3) and not np.allclose(y, ann.rotate(x, 1, 0))


# 13

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, repaired) of rows (role, text, fault) by the least (cost, audit) for each last initial."""

    def inserted(best):
        for _ in range(3):
            for p, (cost, audit, turns) in list(best.items()):
                new = (cost + 5, audit + "I", (*turns, (FULL[NEXT[p]], "")))
                if NEXT[p] not in best or new[:2] < best[NEXT[p]][:2]:
                    best[NEXT[p]] = new
        return best

    best = inserted({"": (0, "", ())})
    for role, text, fault in rows:
        new = {}

        def put(p, found):
            if p not in new or found[:2] < new[p][:2]:
                new[p] = found

        for p, (cost, audit, turns) in best.items():
            put(p, (cost + 2, audit + "D", turns))
            if fault in (None, "truncated"):
                more = 5 * (fault == "truncated")
                if role[:1] == "s" and p == "" or role[:1] in ("u", "a") and role[:1] == NEXT[p]:
                    put(role[:1], (cost + more, audit + "K", (*turns, (role, text))))
                put(NEXT[p], (cost + more + 1, audit + "R", (*turns, (FULL[NEXT[p]], text))))
        best = inserted(new)
    return min((best[p] for p in ("", "a") if p in best), key=lambda x: x[:2])


def test_table_and_trace_equal_brute_force():
    table = turn_repair.Table()
    for n in range(5):
        for word in product(range(10), repeat=n):
            # s, u, a, other and u cut, s cut, a cut, other cut, u gone, a gone
            kinds = [((0, 0), (1, 0), (2, 0), (3, 0), (1, 1), (0, 1), (2, 1), (3, 1), (1, 2), (2, 2))[k] for k in word]
            rows = "".join(turn_repair.letter(*k) for k in kinds)
            before, behind = table.scan(rows, turn_repair.END)
            said, p = table.trace(rows, behind, 0)
            audit = ("".join(said) + turn_repair.trailing(p))[::2]
            want = cheapest([("sua "[i], "x", (None, "truncated", "blank")[f]) for i, f in kinds])
            assert (before[0], audit) == want[:2], (kinds, want)
    assert len(table.vectors) < 100


CONVERSATIONS = "conv_id long, turn long, role string, text string, _id string, edit int"


def repaired_plainly(rows):
    space = lambda x: " " if x is None else str(x)
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind, role, text = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20, space(role), space(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    for conv, kept in out.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, marked = set(), []
        for _, role, text in kept:
            bare = text.strip(turn_repair.WHITE)
            marked.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        cost, audit, turns = cheapest(marked)
        numbers = [t for t, _, _ in kept if t is not None]
        count = lambda f: sum(m[2] == f for m in marked)  # noqa: B023, E731
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, sha)
    return out


def reports(df):
    turns, report = turn_repair.repair(turn_repair.damage(df))
    fields = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[f] for f in fields) for r in turn_repair.digests(turns, report, df).collect()}


@pytest.mark.parametrize("bits", [2, 12])
def test_conversations_equal_brute_force(spark, monkeypatch, bits):
    """Segments of four rows too, and one conversation with a third of all rows."""
    monkeypatch.setattr(turn_repair, "SEGMENT_BITS", bits)
    rng = random.Random(5)
    texts = ["Yes.", "No", "Why? ", "", " \n", None, "A long one. " * 3, "ok!\t", "x" * 40_000, "é 😀."]
    rows = [(rng.choice([None, 1, 2, 3, 4]) if i % 3 else 9, rng.choice([None, i // 4, i]), rng.choice(["system", "user", "assistant", "user", "assistant", None, "tool", ""]), rng.choice(texts)) for i in range(400)]
    rows += [(50, 0, "user", "gone")] if zlib.crc32(b"50:0") % 20 == 0 else []
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "Hi."), rows[0], rows[1]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONVERSATIONS).repartition(3)
    got, want = reports(df), repaired_plainly(rows)
    assert got == want
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert reports(df.limit(0)) == {}


def test_repair_returns_turns(spark):
    df = spark.createDataFrame([(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Why?"), (1, 3, "user", "Cut off")], "conv_id long, turn long, role string, text string")
    turns, report = turn_repair.repair(df)
    got = [(r.edit, r.role, r.text) for r in turns.orderBy("_id", "_k").collect()]
    assert got == [("K", "system", "Be brief."), ("R", "user", "Hello."), ("R", "assistant", "Why?"), ("D", "user", "Cut off")]
    assert report.first().asDict() == {"conv_id": 1, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 1, "cost": 4}
