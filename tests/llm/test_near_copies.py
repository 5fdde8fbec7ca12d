"""Near copies against brute force, with shards of any size and frames that thousands of texts share."""

import random
import time

import pytest

from tessera.llm import near_copies

DDL = "doc_id long, text string, entry string, shard int"


def shingles(text):
    words = text.lower().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def kept_plainly(rows):
    """The least id of each component, by comparing all pairs."""
    sets = [shingles(t or "") for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    return sorted(min(rows[j][0] for j in range(len(rows)) if label[j] == k) for k in set(label))


def texts(rng, families, members, frame, own):
    """Families of edited copies below one frame: chains of near copies, and many that are not quite."""
    words = lambda n: [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(10**6)) for _ in range(n)]
    top, out = words(frame), []
    for _ in range(families):
        base = words(own)
        for _ in range(members):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                text[rng.randrange(len(text))] = words(1)[0]
            base = text if rng.random() < 0.5 else base
            out.append(" ".join(top + text))
    return out


@pytest.mark.parametrize(("split", "frame"), [(4, 0), (4, 60), (4, 200), (1000, 60)])
def test_near_copies_equal_brute_force(spark, monkeypatch, split, frame):
    monkeypatch.setattr(near_copies, "SPLIT", split)
    rng = random.Random(split + frame)
    rows = list(enumerate(texts(rng, 12, 9, frame, 60) + ["", " ", "one two", "one two", "ONE two"]))
    rows.append((500, None))
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DDL)
    got = near_copies.keep_one(df)
    assert sorted(r.doc_id for r in got.collect()) == kept_plainly(rows) and got.columns == df.columns
    assert near_copies.keep_one(df.limit(0)).count() == 0


def test_large_shards_are_dealt_by_rare_shingles(spark, monkeypatch):
    """Two thousand unlinked texts of one frame: nothing of them meets again, and no task compares them all."""
    rng = random.Random(9)
    made = texts(rng, 2000, 1, 60, 60)
    rows = list(enumerate(made + [made[5] + " end", made[7] + " end"]))
    seen = []
    own = near_copies.by_rare_shingles

    def dealt(large, sets):
        out = own(large, sets)
        seen.append((large.select("entry").distinct().count(), out.count()))
        return out

    monkeypatch.setattr(near_copies, "by_rare_shingles", dealt)
    monkeypatch.setattr(near_copies, "BANDS", 24)
    monkeypatch.setattr(near_copies, "SPLIT", 20)
    began = time.time()
    kept = sorted(r.doc_id for r in near_copies.keep_one(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DDL)).collect())
    assert kept == list(range(2000)) and time.time() - began < 300
    assert seen and seen[0][0] > 20 and seen[0][1] < 200


def test_ids_of_any_kind(spark):
    rows = [("b", "one two three four five six seven eight"), ("a", "one two three four five six seven eight"), (None, "one two three four five six seven EIGHT"), ("c", "else")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert sorted(r.doc_id for r in near_copies.keep_one(df).collect()) == ["a", "c"]
