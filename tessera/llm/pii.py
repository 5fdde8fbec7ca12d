"""Personal data by weak supervision, in DataFrame code.

Base matches are fixed by their patterns and stay. Candidates for further spans are what
matches a base pattern but fails its test, looser shapes (an e-mail address with "(at)"
and "(dot)", a telephone number without its plus sign) and, as a fifth kind, secrets:
long runs of letters and digits. Four labelers vote for (1) or against (0) a candidate
or abstain: a regex labeler (the stated test, or the strict form of a loose shape), a
gazetteer (top-level domains, address blocks, card issuers, calling and area codes, names
of keys), a context labeler (telling words before it, and words that tell otherwise) and
a shape labeler.

For each source of candidates, expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is, drawn to ASSUMED; it may find them worse than
assumed, and then they are outvoted. Its posteriors train one logistic span classifier
on kind, votes and surface features, which decides which candidates become spans. Base
matches take part in both, so that a kind's labelers learn from them. The patterns are
counted over all documents and number PATTERNS at most, whatever the data, so the
driver's arithmetic is bounded; all else is Spark expressions.

Positions come from the pieces between matches: split() and regexp_extract_all() agree.
The patterns below match what the stated ones match, but begin only where a run begins
and repeat single characters only, so that no text makes them slow or deep.

Defined results: null or empty text has no spans (empty strings' digest, ""); kinds in
ties are ordered as listed, secrets last; repeated rows are searched one by one; n_* count
base spans, n_further the others; spans that would overlap a base span are not added; an
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import materialise, whole_text

KINDS = ("email", "ip", "card", "phone")
#: All kinds of spans; secrets have no base pattern.
SPANS = (*KINDS, "secret")
#: How much text before a candidate the context labeler sees.
BEFORE = 40
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Patterns.
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-](?:[A-Za-z0-9.-](?<!\.\.))*(?<!\.)",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[0-9\x20-](?<![\x20-][\x20-]))+(?<=[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A quick look that a text without it has no match.
NEEDS = {"email": "@", "phone": "+"}
# Lengths are those that addresses may have: 64, 63 and 127 labels.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[a-z0-9-]{1,63}(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?[a-z0-9-]{1,63}){1,126}",
    "phone": r"(?<![0-9+.-])(?<!\+[0-9]{1,3}[\x20-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{20,}+",
}
#: The strict form of a loose shape.
FORM = {
    "email": r"(?i)^[a-z0-9][a-z0-9._%+-]*\x20?[\[(]\x20?at\x20?[\])]\x20?[a-z0-9]",
    "phone": r"^(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}([\x20.-])(?=[0-9]{3}\1))[2-9][0-9]{2}",
    "secret": r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|A[KS]IA[0-9A-Z]{16}|gh[opsu]_[0-9A-Za-z]{36,}|sk[-_][0-9A-Za-z_-]{20,}|xox[abps]-[0-9A-Za-z-]{10,}|(?=[^0-9]*[0-9][^0-9]*[0-9][^0-9]*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]{24,})$",
}
SHAPE = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$|[\])]\x20?[A-Za-z]{2,10}$",
    "ip": r"^[1-9][0-9]{0,2}(\.(0|[1-9][0-9]{0,2})){3}$",
    "card": r"^([0-9]{4}[\x20-]?){3}[0-9]{4}$",
    "phone": r"^\+[0-9]{1,3}[\x20-]?\(?[0-9]{2,4}\)?[\x20-][0-9]{3,4}[\x20-]?[0-9]{2,4}$|^\(?[0-9]{3}\)?([\x20.-])[0-9]{3}[\x20.-][0-9]{4}$",
    "secret": r"^[^_-]+$|^[a-z]{2,4}[_-][0-9A-Za-z]+$",
}
# Top-level domains in wide use; calling codes; first digits of card issuers.
DOMAINS = "com org net edu gov mil int info biz name pro io ai app dev co me tv eu de at ch fr be nl lu es pt it gr uk ie us ca mx br ar cl pe ve au nz in cn jp kr tw hk sg id th vn ph my tr ru ua pl cz sk hu ro bg hr si rs fi se no dk is ee lv lt il sa ae eg za ng ke ma".split()
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98 212 351 352 353 358 372 380 420 421 852 886 971 972".split()
GAZETTEER = {
    "email": rf"(?i)(?:\.|dot\x20?[\])]\x20?)(?:{'|'.join(DOMAINS)})$",
    "ip": r"^(?:[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6(?:011|4|5|2))",
    "phone": rf"^\+(?:{'|'.join(CODES)})[^0-9]|^\(?[2-9](?!11)[0-8][0-9]",
}
CONTEXT = {
    "email": r"(?i)(?:mail|contact|write|reach|kontakt|schreib|correo|contacto|courriel|écri)[^\n]{0,16}$",
    "ip": r"(?i)(?:\bip\b|address|host|server|client|adresse|dirección)[^\n]{0,16}$",
    "card": r"(?i)(?:card|visa|credit|karte|carte|tarjeta|pay)[^\n]{0,16}$",
    "phone": r"(?i)(?:phone|tel\b|call|fax|mobile|cell|telefon|anruf|appel|téléphone|teléfono|llam)[^\n]{0,16}$",
    "secret": r"""(?i)(?:token|secret|passw(?:or)?d|api.?key|access.?key|private.?key|bearer|credential)\W{0,6}$""",
}
AGAINST = {
    "email": r"(?i)(?:example|beispiel|ejemplo|exemple)\W{0,3}$",
    "ip": r"(?i)(?:version|release|section|chapter|kapitel|v)\W{0,3}$",
    "card": r"(?i)(?:isbn|order|invoice|serial|account|ref|iban|bestellung|nr|no)\W{0,4}$",
    "phone": r"(?i)(?:isbn|order|invoice|serial|part|ref|item|nr|no)\W{0,4}$",
    "secret": r"(?i)(?:sha-?[0-9]{1,3}|md5|commit|revision|hash|digest|checksum|etag|uuid|isbn|id)\W{0,4}$",
}
VOTES = ("regex", "gazetteer", "context", "shape")
FEATURES = ("loose", "apart", "long")
#: How often each labeler is taken to be right, before counts say more, and the part of candidates that is personal data: base patterns, loose forms, secrets.
ASSUMED = {"base": ((0.95, 0.7, 0.75, 0.7), 0.5), "loose": ((0.75, 0.7, 0.9, 0.6), 0.5), "secret": ((0.6, 0.5, 0.97, 0.55), 0.3)}
#: The weight of what is assumed, as a multiple of a source's candidates.
TRUST = 2.0
#: Sources times all patterns of votes and features.
PATTERNS = (len(KINDS) + len(LOOSE)) * 2 * 3 * 3 * 2 * 4


def _passes(kind: str, m: Column) -> Column:
    """The stated test of a base match."""
    if kind == "ip":
        return m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(10, 15) if kind == "phone" else F.lit(True)


def _found(text: str, pattern: str, needs: str | None) -> Column:
    """All matches in a text column, in order."""
    every = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    return F.when(F.instr(F.col(text), needs) > 0, every).otherwise(F.array().cast("array<string>")) if needs else every


def _placed(text: str, matches: str, pattern: str) -> Column:
    """Matches as (s, e, m), in code points, e exclusive."""
    pieces = F.split(F.col(text), pattern, -1)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))
    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("p"), F.col(matches).alias("m"))

    def one(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["p"])
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    placed = F.aggregate(pairs, begin, one)["out"]
    return F.when(F.size(matches) > 0, placed).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, c): the candidates of each text with their votes and features, in order. A null vote abstains."""
    out = docs.select("doc_id", whole_text().alias("text"))
    names = [(f"m_{k}", k, PATTERN[k], NEEDS.get(k), False) for k in KINDS] + [(f"l_{k}", k, p, None, True) for k, p in LOOSE.items()]
    out = out.select("*", *[_found("text", p, need).alias(n) for n, _, p, need, _ in names])
    out = out.select("doc_id", "text", *[_placed("text", n, p).alias(n) for n, _, p, _, _ in names])
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")

    def mark(kind: str, loose: bool):
        def go(x: Column) -> Column:
            m = x["m"]
            left = F.substring(F.col("text"), F.greatest(x["s"] - (BEFORE - 1), F.lit(1)), F.least(x["s"], F.lit(BEFORE)))
            context = F.when(left.rlike(AGAINST[kind]), 0).when(left.rlike(CONTEXT[kind]), 1)
            listed = flag(m.rlike(GAZETTEER[kind])) if kind in GAZETTEER else F.lit(None).cast("int")
            return F.struct(
                x["s"].alias("s"), F.lit(SPANS.index(kind)).alias("k"), x["e"].alias("e"), flag(m.rlike(FORM[kind]) if loose else _passes(kind, m)).alias("regex"),
                listed.alias("gazetteer"), context.alias("context"), flag(m.rlike(SHAPE[kind])).alias("shape"),
                F.lit(int(loose)).alias("loose"), flag((x["s"] == 0) | F.substring(left, -1, 1).rlike(r"\s")).alias("apart"), flag(F.length(m) > 19).alias("long"),
            )
        return go

    marked = [F.transform(n, mark(k, loose)) for n, k, _, _, loose in names]
    return out.select("doc_id", F.array_sort(F.concat(*marked)).alias("c"))


Votes = tuple[int | None, ...]


def reliabilities(rows: list[tuple[Votes, float]], assumed: tuple[float, ...], share: float = 0.5, trust: float = TRUST, rounds: int = 60) -> tuple[list[float], list[float]]:
    """Posteriors that patterns of votes (1, 0 or None for none, with counts) are personal data, and how often each labeler is right, by EM.

    What is assumed counts like ``trust`` times the votes seen, so that it means the same for any number of documents.
    """
    right, prior = list(assumed), share
    total = sum(c for _, c in rows)
    post: list[float] = []
    for _ in range(rounds):
        post = []
        for votes, _count in rows:
            odds = math.log(prior / (1 - prior)) + sum((1 if v else -1) * math.log(r / (1 - r)) for v, r in zip(votes, right, strict=True) if v is not None)
            post.append(1 / (1 + math.exp(-max(-700.0, min(700.0, odds)))))
        mass = sum(p * c for p, (_, c) in zip(post, rows, strict=True))
        prior = min(0.95, max(0.05, (mass + share * (trust * total + 2)) / (total * (1 + trust) + 2)))
        for j, a in enumerate(assumed):
            voted = [(p if v[j] else 1 - p, c) for p, (v, c) in zip(post, rows, strict=True) if v[j] is not None]
            n = sum(c for _, c in voted)
            right[j] = min(0.99, max(0.5, (sum(p * c for p, c in voted) + a * (trust * n + 2)) / (n * (1 + trust) + 2)))
    return post, right


def logistic(rows: list[tuple[tuple[float, ...], float, float]], rounds: int = 500) -> list[float]:
    """Weights (the last one the bias) from (features, posterior, weight), by gradient descent with a small penalty."""
    n = len(rows[0][0])
    w, total = [0.0] * (n + 1), sum(c for *_, c in rows)
    for _ in range(rounds):
        step = [0.0005 * x for x in w]
        for x, p, c in rows:
            z = w[n] + sum(a * b for a, b in zip(w, x, strict=False) if b)
            d = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p) * c / total
            for j, b in enumerate(x):
                step[j] += d * b
            step[n] += d
        w = [a - 1.0 * b for a, b in zip(w, step, strict=True)]
    return w


def _inputs(r) -> tuple[float, ...]:
    """What the classifier sees: the source's number as flags, votes as 1, -1 or 0, and features."""
    kinds = [float((r["k"], r["loose"]) == (k, loose)) for k in range(len(SPANS)) for loose in (0, 1)]
    return (*kinds, *[0.0 if r[v] is None else 2.0 * r[v] - 1 for v in VOTES], *[float(r[f]) for f in FEATURES[1:]])


def train(found: DataFrame) -> list[float] | None:
    """The span classifier's weights over _inputs and bias; None without candidates."""
    counted = found.select(F.explode("c").alias("x")).select("x.k", *[f"x.{n}" for n in (*VOTES, *FEATURES)])
    got = counted.groupBy("k", *VOTES, *FEATURES).agg(F.count("*").alias("n")).collect()  # PATTERNS rows at most
    if not got:
        return None
    taught = []
    for source in sorted({(r["k"], r["loose"]) for r in got}):
        own = [r for r in got if (r["k"], r["loose"]) == source]
        post, _ = reliabilities([(tuple(r[v] for v in VOTES), r.n) for r in own], *ASSUMED["secret" if source[0] == SPANS.index("secret") else "loose" if source[1] else "base"])
        # Each source weighs as much as the logarithm of its candidates: a rare kind is not drowned by a common one.
        size = sum(r.n for r in own)
        taught += [(_inputs(r), p, math.log1p(size) * (r.n / size + 1 / len(own))) for r, p in zip(own, post, strict=True)]
    return logistic(taught)


def find_personal(docs: DataFrame) -> DataFrame:
    """The rows of the op4 query."""
    found = materialise(candidates(docs), "candidates")
    weights = train(found)
    split = found.withColumn("base", F.filter("c", lambda x: (x["regex"] == 1) & (x["loose"] == 0)))
    if weights is None:
        further = F.array_except("base", "base")
    else:
        kinds, rest = weights[: 2 * len(SPANS)], weights[2 * len(SPANS) : -1]

        def good(x: Column) -> Column:
            z = F.lit(weights[-1]) + F.element_at(F.array(*map(F.lit, kinds)), x["k"] * 2 + x["loose"] + 1)
            for name, w in zip((*VOTES, *FEATURES[1:]), rest, strict=True):
                z = z + F.lit(w) * (F.coalesce(2 * x[name] - 1, F.lit(0)) if name in VOTES else x[name])
            clear = ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
            return ((x["regex"] == 0) | (x["loose"] == 1)) & (z > 0) & clear

        further = F.filter("c", good)
    split = split.select("doc_id", "base", further.alias("further"))
    names = F.array(*map(F.lit, SPANS))
    text = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"], x["e"])), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    every = F.array_sort(F.concat("base", "further"))
    return split.select("doc_id", *map(count, KINDS), F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(every).alias("spans"), F.size("further").cast("long").alias("n_further"))
