"""Toxicity by a weighted finite-state pattern grammar.

The lexicon is a transducer from letters to symbols: a trie whose word ends write insult,
threat verb, target, negation, reporting verb or other, with a weight. Four transducers
over the symbols of a clause follow, each a few states large and with weights on its
arcs: threat (a verb and, soon after, a target), target (an insult near one), negation,
reported speech. They are composed into one machine, whose arcs multiply the weights; it
writes what each insult or threat of the clause amounts to. A clause sums its outputs
by kind, a document its clauses; ``score = e / (e + half)`` of the weighted sum e.

The insults are stems from labelled documents: a stem is kept if its rate in toxic
documents is far above that in others, whatever the language. What the kinds are worth
starts from the arcs' weights and is fitted to the same labels, so that where plain or
reported uses are not labelled toxic, they do not count. The fit reads at most MAX_TOXIC
and MAX_CLEAN labelled documents, chosen by a hash of their ids, one row of each id; near
copies among them count once. Scoring reads every text.

Defined results: a null or empty text has evidence 0 and so score 0; a null doc_id is
scored and not held out; repeated rows are scored one by one; without labels the seed
lexicon and the arcs' weights alone are used; an empty table gives no rows. Other columns
are carried in a struct, so their names may be any.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import prepare_workers, whole_text

MAX_TOXIC = 2000
MAX_CLEAN = 6000
THRESHOLD = 0.7
STEM_MIN, STEM_MAX = 3, 14

# Seed words of the grammar. Matching is on lower-case words; a seed insult or
# threat verb is a stem, the others are whole words.
SEED_INSULTS = (
    "idiot moron imbecile stupid loser scum trash pathetic worthless disgusting dumb jerk "
    "dummkopf trottel arschloch crétin salaud connard imbécile estúpido imbécil cabrón"
).split()
THREATS = "kill murder strangle stab töten umbringen tuer matar".split()
TARGETS = "you your yours yourself u ur du dich dir ihr euch sie tu toi te vous vos usted ustedes ti".split()
NEGATIONS = "not no never none neither nor isn't aren't don't nicht kein keine nie pas jamais nunca jamás".split()
REPORTS = "said says wrote writes called calls quoted quotes reported claimed sagte schrieb nannte dit écrit dijo escribió".split()

#: What the machine reads: other, insult, threat verb, target, negation, reporting verb.
SYMBOLS = "OIHUNR"
#: What it writes that counts: plain insult, insult at a target, target after an insult, threat, negated, reported.
KINDS = "IJTXzq"
PLAIN, AIMED, AFTER, THREAT, NEGATED, REPORTED = 1.0, 1.5, 0.5, 1.5, 0.2, 0.3
Arc = tuple[str, float, int]


@dataclass
class Transducer:
    """A sequential weighted transducer: arcs[state][symbol] = (output, weight, next state); state 0 starts.

    A symbol without an arc takes the state's ``*`` arc and is copied.
    """

    arcs: dict[int, dict[str, Arc]] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> Arc:
        row = self.arcs[state]
        return row[symbol] if symbol in row else (symbol, *row["*"][1:])

    def run(self, symbols: str) -> list[tuple[str, float]]:
        out, state = [], 0
        for s in symbols:
            o, w, state = self.step(state, s)
            out.append((o, w))
        return out


def compose(a: Transducer, b: Transducer, alphabet: str) -> Transducer:
    """The transducer that feeds a's output to b, weights multiplied, over the state pairs that can be reached."""
    number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        pair = todo.pop()
        row: dict[str, Arc] = {}
        for s in alphabet:
            mid, v, p = a.step(pair[0], s)
            out, w, q = b.step(pair[1], mid)
            if (p, q) not in number:
                number[p, q] = len(number)
                todo.append((p, q))
            row[s] = (out, v * w, number[p, q])
        arcs[number[pair]] = row
    return Transducer(arcs)


def _within(trigger: str, hits: dict[str, tuple[str, float]], reach: int, swallow: bool = False) -> Transducer:
    """Rewrites hits[x], with its weight, for x within ``reach`` symbols after a trigger; state k: k symbols are left."""
    arcs: dict[int, dict[str, Arc]] = {}
    for k in range(reach + 1):
        row = {"*": ("*", 1.0, max(0, k - 1)), trigger: ("O" if swallow else trigger, 1.0, reach)}
        if k:
            row |= {x: (y, w, k - 1) for x, (y, w) in hits.items()}
        arcs[k] = row
    return Transducer(arcs)


def grammar() -> Transducer:
    """Threat, target (before and after), negation and reported speech, composed in that order."""
    plain = Transducer({0: {"*": ("*", 1.0, 0), "I": ("I", PLAIN, 0)}})
    threat = _within("H", {"U": ("X", THREAT)}, 3, swallow=True)
    before = _within("U", {"I": ("J", AIMED / PLAIN)}, 4)
    after = _within("I", {"U": ("T", AFTER)}, 3)
    said = {k: (k.lower(), NEGATED) for k in "IJTX"}
    negation = _within("N", said, 2)
    # An insult right after a negation, and a target after that, stay negated to the end of the reach.
    reported = Transducer({0: {"*": ("*", 1.0, 0), "R": ("O", 1.0, 1)}, 1: {"*": ("*", 1.0, 1), **{k: ("q", REPORTED, 1) for k in "IJTX"}}})
    folded = Transducer({0: {"*": ("*", 1.0, 0), **{k: ("z", 1.0, 0) for k in "ijtx"}}})
    out = plain
    for part in (threat, before, after, negation, reported, folded):
        out = compose(out, part, SYMBOLS)
    return out


CLAUSE_END = re.compile(r"[.!?;\n]")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


class Lexicon:
    """The transducer from letters to a symbol and its weight: a trie; a stem's output holds for all words that begin with it."""

    def __init__(self, stems: dict[str, float]):
        self.next: list[dict[str, int]] = [{}]
        self.stem: list[tuple[str, float]] = [("O", 1.0)]
        self.word: list[tuple[str, float] | None] = [None]
        for s, w in stems.items():
            self.stem[self._node(s)] = ("I", w)
        for s in THREATS:
            if s not in stems:
                self.stem[self._node(s)] = ("H", 1.0)
        for words, symbol in ((TARGETS, "U"), (NEGATIONS, "N"), (REPORTS, "R")):
            for w in words:
                self.word[self._node(w)] = (symbol, 1.0)
        todo = [0]  # a node without an output of its own has its parent's
        for n in todo:
            for m in self.next[n].values():
                if self.stem[m][0] == "O":
                    self.stem[m] = self.stem[n]
                todo.append(m)

    def _node(self, letters: str) -> int:
        at = 0
        for c in letters:
            if c not in self.next[at]:
                self.next[at][c] = len(self.next)
                self.next.append({})
                self.stem.append(("O", 1.0))
                self.word.append(None)
            at = self.next[at][c]
        return at

    def run(self, word: str) -> tuple[str, float]:
        at = 0
        for c in word:
            to = self.next[at].get(c)
            if to is None:
                return self.stem[at]
            at = to
        return self.word[at] or self.stem[at]


class Scorer:
    """Reads texts with a lexicon {stem: weight from 0 to 1} and what each kind is worth."""

    def __init__(self, lexicon: dict[str, float], worth: dict[str, float] | None = None):
        self.worth = worth or dict.fromkeys(KINDS, 1.0)
        self.machine, self.letters = grammar(), Lexicon(lexicon)
        stems = sorted({*lexicon, *THREATS}, key=lambda s: (-len(s), s))
        # Clauses without a stem are worth nothing and are passed over.
        self.find = re.compile(r"(?<![^\W\d_])(?:" + "|".join(map(re.escape, stems)) + ")")

    def clause(self, clause: str) -> Counter:
        """The weights that the machine writes for a clause, by kind."""
        read, out = [self.letters.run(w) for w in WORD.findall(clause)], Counter()
        for (kind, w), (_, v) in zip(self.machine.run("".join(s for s, _ in read)), read, strict=True):
            if kind in KINDS:
                out[kind] += w * v
        return out

    def kinds(self, text: str) -> Counter:
        """The sum over the clauses of a text."""
        text, at, total = text.lower(), 0, Counter()
        while m := self.find.search(text, at):
            start = m.start()
            begin = max(text.rfind(c, at, start) for c in ".!?;\n") + 1 or at
            end = CLAUSE_END.search(text, m.end())
            at = end.start() if end else len(text)
            total.update(self.clause(text[begin:at]))
        return total

    def evidence(self, text: str) -> float:
        return sum(self.worth[k] * v for k, v in self.kinds(text).items())


def held_out(c="doc_id"):
    """True for rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(c).cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the bounded sample, the least text of a repeated id. The broadcast side has at most MAX_TOXIC + MAX_CLEAN rows."""
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    pick = lambda want, n: known.where(F.col("toxic") == want).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = pick(1, MAX_TOXIC).unionByName(pick(0, MAX_CLEAN))
    found = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))


def stem_counts(train: DataFrame) -> DataFrame:
    """(stem, t, c): toxic and clean documents' words with this stem; near copies count once."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    # Near copies share the least hash of their five-word shingles nearly always.
    sign = F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 4, F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, 5))))
    one = train.select("doc_id", "toxic", words.alias("w")).where(F.size("w") > 0).select("doc_id", "toxic", "w", sign.alias("sign")).groupBy("sign").agg(F.min_by(F.struct("toxic", "w"), "doc_id").alias("d"))
    word = one.select("d.toxic", F.explode(F.array_distinct("d.w")).alias("word")).where(F.length("word") >= STEM_MIN)
    word = word.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    return (
        word.select("t", "c", F.explode(F.sequence(F.lit(STEM_MIN), F.least(F.length("word"), F.lit(STEM_MAX)))).alias("n"), "word")
        .groupBy(F.substring("word", F.lit(1), F.col("n")).alias("stem"))
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    )


def choose_stems(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Walks the trie of stems: the first good stem of each path, made longer while one child keeps nearly all of its words.

    A stem that clean documents have too gives way to longer ones that keep most of its toxic words.
    A stem weighs its log odds, as a part of what they would be were it in no clean document.
    """

    def good(s: str) -> bool:
        t, c = counts[s]
        return t >= max(4, 0.01 * toxic) and (t - 2 * t**0.5) / toxic > 8 * (c + 1) / (clean + 1)

    children: dict[str, list[str]] = {}
    for s in counts:
        children.setdefault(s[:-1], []).append(s)

    def weight(s: str) -> float:
        t, c = counts[s]
        most = math.log((t + 0.5) / (toxic + 1)) - math.log(0.5 / (clean + 1))
        return max(0.05, 1 - math.log((c + 0.5) / 0.5) / most)

    def walk(s: str) -> dict[str, float]:
        if good(s):
            while longer := [x for x in children.get(s, []) if counts[x][0] >= 0.95 * counts[s][0]]:
                s = longer[0]
        below = {k: w for x in children.get(s, []) for k, w in walk(x).items()} if not good(s) or counts[s][1] else {}
        if good(s) and sum(counts[k][0] for k in below) < 0.6 * counts[s][0]:
            return {s: weight(s)}
        return below

    return {k: w for s in counts if len(s) == STEM_MIN for k, w in walk(s).items()}


@dataclass
class Model:
    lexicon: dict[str, float]
    worth: dict[str, float]
    half: float  # the evidence at which the score is 1/2


def _read(train: DataFrame, lexicon: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """The kinds' weights of each training document, MAX_TOXIC + MAX_CLEAN at most, and their labels."""
    shared = train.sparkSession.sparkContext.broadcast(lexicon)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            found = [scorer.kinds(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([[f[k] for k in KINDS] for f in found], pa.list_(pa.float64())), b.column("toxic")], ["x", "toxic"])

    rows = train.select("text", "toxic").mapInArrow(go, "x array<double>, toxic int").collect()
    return np.array([r.x for r in rows]), np.array([r.toxic for r in rows])


PRIOR, SCALE = 1.0, 4.0


def fit_worth(x: np.ndarray, y: np.ndarray) -> dict[str, float]:
    """What the kinds are worth: a logistic regression that is drawn to 1 for each, none below 0.

    SCALE turns evidence into log odds. A kind that the labels do not show keeps its 1.
    """
    inputs = np.hstack([x * SCALE, np.ones((len(x), 1))])
    start = np.append(np.ones(x.shape[1]), -SCALE / 2)
    w, pull = start.copy(), np.append(np.full(x.shape[1], PRIOR), 1e-3)
    for _ in range(50):  # Newton
        p = 1 / (1 + np.exp(-np.clip(inputs @ w, -30, 30)))
        slope = inputs.T @ (p - y) + pull * (w - start)
        step = np.linalg.solve((inputs * (p * (1 - p))[:, None]).T @ inputs + np.diag(pull), slope)
        w = w - np.clip(step, -1, 1)
        w[:-1] = np.maximum(w[:-1], 0.0)
        if abs(step).max() < 1e-6:
            break
    return dict(zip(KINDS, w[:-1].tolist(), strict=True))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns stems and the evidence that separates best, from the bounded sample."""
    prepare_workers(docs.sparkSession)
    train = training_rows(docs, labels)
    sizes = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = dict.fromkeys(SEED_INSULTS, 1.0)
    if not toxic or not clean:
        return Model(lexicon, dict.fromkeys(KINDS, 1.0), 3 / 7)
    # At most the sample's toxic words / 4 rows come back.
    rows = stem_counts(train).where(F.col("t") >= max(4, 0.01 * toxic)).where(F.col("t") / toxic > F.col("c") / clean).collect()
    lexicon |= choose_stems({r.stem: (r.t, r.c) for r in rows}, toxic, clean)
    x, y = _read(train, lexicon)
    worth = fit_worth(x, y)
    seen = sorted(zip((x @ np.array([worth[k] for k in KINDS])).tolist(), y.tolist(), strict=True))
    # The cut with the best F1, halfway between neighbours; scores reach 0.7 there.
    hits, marked, best, cut = 0, 0, -1.0, 1.0
    for i in range(len(seen) - 1, -1, -1):
        hits, marked = hits + seen[i][1], marked + 1
        below = seen[i - 1][0] if i else 0.0
        if seen[i][0] > below and (f1 := 2 * hits / (marked + toxic)) > best:
            best, cut = f1, (seen[i][0] + below) / 2
    return Model(lexicon, worth, max(cut, 0.05) * 3 / 7)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row, score, predicted): row is a struct of all columns of docs."""
    spark = docs.sparkSession
    prepare_workers(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def tox(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        scorer = Scorer(known.lexicon, known.worth)
        for s in texts:
            yield pd.Series([(e := scorer.evidence(t)) / (e + known.half) for t in s], dtype="float64")

    out = docs.select(F.struct("*").alias("row"), tox(whole_text()).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with all of their columns."""
    return score(docs, model).where("predicted = 0").select("row.*")


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the op1 query."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "score", "predicted")
