"""Text graders and the formatting of prompts, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Phrases that mark a refusal, matched in lower case as substrings.
REFUSALS = (
    "don't have", "do not have", "no data", "not available", "cannot answer", "can't answer",
    "unable to answer", "not in the data", "outside the scope", "out of scope", "not something i can",
)

CONTEXTS, CONTEXT_CHARS = 16, 800


def extract_numbers(c: Column) -> Column:
    """All numbers in a text, thousands separators dropped."""
    found = F.regexp_extract_all(c, F.lit(r"-?[0-9][0-9,]*(?:\.[0-9]+)?"), F.lit(0))
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double"))


def value_grade(answer: Column, expected: Column, tolerance_pct: float = 5.0) -> Column:
    """True if any number is within the tolerance of expected, inclusive."""
    room = F.abs(expected) * tolerance_pct / 100
    return F.coalesce(F.exists(extract_numbers(answer), lambda n: F.abs(n - expected) <= room), F.lit(False))


def topk_hits(answer: Column, keys: Column) -> Column:
    """How many keys stand in the answer as whole words."""
    return F.size(F.filter(keys, lambda k: F.call_function("rlike", answer, F.concat(F.lit(r"\b\Q"), k, F.lit(r"\E\b")))))


def topk_grade(answer: Column, keys: Column, min_hits: int) -> Column:
    return F.coalesce(topk_hits(answer, keys) >= min_hits, F.lit(False))


def refusal_grade(answer: Column) -> Column:
    low = F.lower(F.coalesce(answer, F.lit("")))
    out = F.lit(False)
    for phrase in REFUSALS:
        out = out | low.contains(phrase)
    return out


def grade(kind: Column, answer: Column, expected: Column, keys: Column, min_hits: int = 1) -> Column:
    """Dispatch by kind: value, topk or refusal; another kind is an error."""
    return (
        F.when(kind == "value", value_grade(answer, expected))
        .when(kind == "topk", topk_grade(answer, keys, min_hits))
        .when(kind == "refusal", refusal_grade(answer))
        .otherwise(F.raise_error(F.concat(F.lit("unknown grader: "), F.coalesce(kind, F.lit("NULL")))).cast("boolean"))
    )


def verdict_json(reply: Column, ddl: str) -> Column:
    """The object between the first ``{`` and the last ``}`` of a reply; NULL fields if there is none."""
    return F.from_json(F.regexp_extract(reply, r"(?s)\{.*\}", 0), ddl)


def clamp_score(c: Column) -> Column:
    """Into [0, 1]; NULL and NaN stay unscored."""
    return F.when(c.isNotNull() & ~F.isnan(c), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def format_contexts(contexts: Column) -> Column:
    """The first 16 contexts, blank ones left out, 800 characters each, numbered."""
    kept = F.filter(F.slice(contexts, 1, CONTEXTS), lambda x: F.trim(F.coalesce(x, F.lit(""))) != "")
    lines = F.transform(kept, lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), F.substring(x, 1, CONTEXT_CHARS)))
    return F.when(F.size(kept) > 0, F.array_join(lines, "\n\n---\n\n")).otherwise("(none)")


def format_chunk(title: Column, at: Column, channel: Column, text: Column) -> Column:
    return F.format_string("[%s @ %s] (channel: %s)\n%s", title, at, channel, text)


def hops(log: Column) -> Column:
    """Calls in a decision log: the numbers in ``across N call`` and the lines that begin with search: or retrieve:."""
    def one(acc: Column, line: Column) -> Column:
        across = F.aggregate(F.regexp_extract_all(line, F.lit(r"across ([0-9]+) call"), F.lit(1)), F.lit(0), lambda a, n: a + n.cast("int"))
        return acc + across + F.when(line.startswith("search:") | line.startswith("retrieve:"), 1).otherwise(0)

    return F.aggregate(log, F.lit(0), one)


def message_text(c: Column) -> Column:
    """A message as it is, or the text parts of a JSON list of parts; NULL as empty."""
    parts = F.from_json(F.when(F.trim(c).startswith("["), c), "array<struct<type:string,text:string>>")
    said = F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: p["text"]), "")
    return F.coalesce(F.when(parts.isNotNull(), said), c, F.lit(""))


def sub_questions(reply: Column, question: Column, most: int = 3) -> Column:
    """The lines of a reply without bullets, three at most; the question itself if there is none."""
    lines = F.filter(F.transform(F.split(reply, "\n"), lambda x: F.regexp_replace(x, "^[ \\-•\t]+|[ \\-•\t]+$", "")), lambda x: x != "")
    return F.when(F.size(lines) > 0, F.slice(lines, 1, most)).otherwise(F.array(question))
