"""op1's scores against a plain reading of the grammar: no trie, no transducers, no clause passed over."""

import os
import re
import zlib

import pytest

from tessera.llm import toxicity as t

SF = "/root/testdata/sf0.001"


def read_word(word, lexicon):
    for words, symbol in ((t.TARGETS, "U"), (t.NEGATIONS, "N"), (t.REPORTS, "R")):
        if word in words:
            return symbol, 1.0
    stem = max((s for s in {*lexicon, *t.THREATS} if word.startswith(s)), key=len, default=None)
    return ("O", 1.0) if stem is None else ("I", lexicon[stem]) if stem in lexicon else ("H", 1.0)


def near(symbols, at, triggers, reach):
    return any(symbols[i] in triggers for i in range(max(0, at - reach), at))


def clause_plainly(words, lexicon):
    """[(kind, weight)] of a clause by what stands before each word."""
    read = [read_word(w, lexicon) for w in words]
    first = [s for s, _ in read]
    weights = [w for _, w in read]
    threat = ["X" if s == "U" and near(first, i, "H", 3) else "O" if s == "H" else s for i, s in enumerate(first)]
    aimed = ["J" if s == "I" and near(threat, i, "U", 4) else s for i, s in enumerate(threat)]
    after = ["T" if s == "U" and near(aimed, i, "I", 3) else s for i, s in enumerate(aimed)]
    out = []
    for i, s in enumerate(after):
        if s in "IJTX":
            w = weights[i] * {"I": 1.0, "J": 1.5, "T": 0.5, "X": 1.5}[s]
            if near(after, i, "N", 2):
                s, w = "z", w * 0.2
            elif "R" in after[:i]:
                s, w = "q", w * 0.3
            out.append((s, w))
    return out


def score_plainly(text, model):
    e = 0.0
    for clause in re.split(r"[.!?;\n]", (text or "").lower()):
        e += sum(model.worth[k] * w for k, w in clause_plainly(t.WORD.findall(clause), model.lexicon))
    return e / (e + model.half)


CONTEXTS = [
    "You are an idiot.", "Idiot! You are not an idiot; she said you are a stupid fool", "I will kill you. I will kill time", "nobody kills; you", "never stupid never you stupid", "du Trottel, kein Trottel",
    "il dit que tu es un connard", "no eres imbécil. eres imbécil", "isn't stupid you don't stupid said stupid you", "stupid " * 40 + "you", "he wrote: you moron\nyou moron", None, "", "...", "don't kill you not", "IDIOT you u ur idiots stupidly",
]


def check(spark, docs, labels):
    model = t.fit(docs, labels)
    got = {r.doc_id: r for r in t.judge(spark, docs, labels).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        want = score_plainly(r.text, model)
        assert abs(got[r.doc_id].score - want) < 1e-9, r.text
        assert got[r.doc_id].predicted == (want >= 0.7) and got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    return model


def test_scores_of_contexts(spark):
    docs = spark.createDataFrame(list(enumerate(CONTEXTS)), "doc_id long, text string")
    check(spark, docs, spark.createDataFrame([], "doc_id long, toxic int"))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_scores_of_a_folder(spark):
    model = check(spark, spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert set(model.worth) == set(t.KINDS)
