import os

import pytest

import corpus_pipeline
from tessera.llm import simhash

SF = "/root/testdata/sf0.001"


def test_stages_on_a_folder(spark, tmp_path):
    tox = "you idiot moron scum stupid trash"
    base = [" ".join(f"{c}{i}{j}" for j in range(30)) for i, c in enumerate("abcdefgh")]
    rows = [(i, t) for i, t in enumerate(base)] + [(10, base[0].upper()), (11, base[1] + " " + tox), (12, "start " + base[7] + " end"), (13, None), (14, "")]
    bench = [(0, " ".join(base[7].split()[5:25]))]
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, d).collect()}
    # 11 toxic; 0 a copy of 10; of 13 and 14 the larger id stays; 7 and 12 hold the passage; near copies link none of the rest
    want = {i for i, t in rows} - {11, 0, 13, 7, 12}
    prints = {i: simhash.fingerprint(t or "") for i, t in rows if i in want}
    assert all((a ^ b).bit_count() > 2 for i, a in prints.items() for j, b in prints.items() if i != j)
    assert got == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()


def brute_pipeline(rows, items, toxic):
    """The kept ids by plain comparison of all pairs; ``toxic`` decides on a text. Ids are distinct here."""
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    rows = [(i, t) for i, t in rows if not toxic(t or "")]
    rows = [(i, t) for i, t in rows if i == max(j for j, u in rows if low(u) == low(t))]

    def shingles(t):
        w = low(t).split()
        n = min(5, len(w))
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()

    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    rows = [r for k, r in enumerate(rows) if r[0] == min(rows[j][0] for j in range(len(rows)) if label[j] == label[k])]

    def holds(t, item):
        d, w = low(t).split(), low(item).split()
        n = min(5, len(w))
        own = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)] if w else []
        for s in range(len(d) - len(w) + 1) if own else ():
            win = [tuple(d[s + k : s + k + n]) for k in range(len(own))]
            if 9 * sum(min(win.count(x), own.count(x)) for x in set(own)) >= 8 * len(own):
                return True
        return False

    return {i for i, t in rows if not any(holds(t, x) for x in items)}


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Copies, near copies, leaks, toxic, empty and very long texts, and columns with the results' names."""
    import random

    from tessera.llm import toxicity

    rng = random.Random(47)
    base = [[f"w{k}x{rng.randrange(60)}" for _ in range(rng.choice([3, 30, 120, 400]))] for k in range(20)]
    items = [" ".join(base[3][:40]), " ".join(base[7][5:25]), "", None]
    texts = [" ".join(b) for b in base] + [None, "", " ", "word " * 20_000, "a" * 50_000, "you are an idiot and scum. " * 3]
    for b in base * 3:
        w = list(b)
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            w[rng.randrange(len(w))] = "edit"
        texts.append(rng.choice([str.upper, str])(" ".join(w)) + rng.choice(["", " more", " you stupid idiot loser"]))
    rows = list(enumerate(texts))
    d = str(tmp_path)
    made = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1.0, 2, "x", "y", "z") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, tox_score double, n_tokens int, _row string, _h string, row string")
    made.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    model = toxicity.fit(made, spark.read.parquet(f"{d}/labels.parquet"))
    scorer = toxicity.Scorer(model.lexicon, model.worth)
    toxic = lambda t: (e := scorer.evidence(t)) / (e + model.half) >= toxicity.THRESHOLD
    out = corpus_pipeline.run(spark, d)
    assert {r.doc_id for r in out.collect()} == brute_pipeline(rows, [x or "" for x in items], toxic)
    assert len(set(out.columns)) == len(out.columns) and {"tox_score", "_row", "_h", "row", "n_tokens"} <= set(out.columns)


def test_stages_on_empty_and_repeated_rows(spark, tmp_path):
    d = str(tmp_path)
    docs = spark.createDataFrame([(1, "same text of seven words right here", "en")] * 3 + [(None, None, "en")] * 2, "doc_id long, text string, lang string")
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, d).count() == {"exact_dedup": 2, "near_copies": 2}.get(name, 5), name
        assert stage(spark, docs.limit(0), d).count() == 0


def test_near_copies_are_linked_by_fingerprints_too(spark, tmp_path):
    """Long texts that differ in a twentieth share their fingerprint, though hardly a shingle as a set: op7 links them."""
    base = "red green blue " * 250
    tail = lambda c: " ".join(f"{c}{i}" for i in range(40))
    texts = {1: base + tail("u"), 2: base + tail("v"), 3: tail("w"), 4: None}
    assert (simhash.fingerprint(texts[1]) ^ simhash.fingerprint(texts[2])).bit_count() <= simhash.RADIUS
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4] and out.columns == docs.columns
