"""URL filter: a trie over reversed host labels, then path segments.

A rule (host, path, verdict) fits its host and all subdomains where the url's path
starts with the rule's. The longest rule wins: the deeper host first, then the longer
path; an equal host and path for both verdicts blocks. Up to MAX_RULES rules go out as
one broadcast trie; more than that are joined by their keys.

Defined results: null, or a url without ``://``, has empty host and path, no rule, and
is blocked, as nothing can be fetched from it; other urls that no rule fits are allowed.
Repeated rows are judged one by one, extra columns stay, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import LOWER, UPPER, prepare_workers

#: A trie of so many rules is some tens of MB.
MAX_RULES = 100_000
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Host labels from the right, then the path's segments; the last one may be cut short."""

    def __init__(self, rules: list[Rule]):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            *whole, last = path.split("/")
            node = node.setdefault(None, {})  # the paths of this host
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(None, {})  # what the next segment may begin with
            if ends.get(last, ("", ""))[1] != "block":
                ends[last] = (host + path, verdict)

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        node, best = self.root, (None, None)
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                best = self._path(node[None], segments) or best
        return best

    @staticmethod
    def _path(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            if ends := node.get(None):
                # Longest first; a segment has few prefixes.
                best = next((ends[p] for n in range(len(segment), -1, -1) if (p := segment[:n]) in ends), best)
            node = node.get(segment)
            if node is None:
                break
        return best


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """All columns of pages, with host, path, rule and verdict (replaced where they exist)."""
    out = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    out = _by_trie(out, rules) if len(rules) <= MAX_RULES else _by_join(out, rules)
    default = F.when(F.col("host") == "", "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce("verdict", default))


def _by_trie(out: DataFrame, rules: list[Rule]) -> DataFrame:
    prepare_workers(out.sparkSession)
    shared = out.sparkSession.sparkContext.broadcast(rules)

    @F.pandas_udf("rule string, verdict string")
    def look(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = Trie(shared.value)
        for hosts, paths in parts:
            yield pd.DataFrame([trie.find(h, p) for h, p in zip(hosts, paths, strict=True)], columns=["rule", "verdict"])

    # Rows in a struct, so that a column of any name stays.
    out = out.drop("rule", "verdict")
    return out.select(F.struct("*").alias("row"), look("host", "path").alias("hit")).select("row.*", "hit.rule", "hit.verdict")


def _by_join(out: DataFrame, rules: list[Rule]) -> DataFrame:
    """The same for any number of rules: distinct urls' host suffixes and path prefixes meet the rules by key."""
    spark = out.sparkSession
    table = spark.createDataFrame(rules, "r_host string, r_path string, r_verdict string").groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
    lengths = [r.n for r in table.select(F.length("r_path").alias("n")).distinct().collect()]  # few: path lengths
    urls = out.select("host", "path").distinct()
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = urls.select("host", "path", F.explode(suffixes).alias("r_host")).select("*", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("n")).where(F.length("path") >= F.col("n"))
    hits = keys.withColumn("r_path", F.expr("substring(path, 1, n)")).join(table, ["r_host", "r_path"])
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("r_host"), F.length("r_path"), F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))).alias("_b"))
    best = best.select("host", "path", F.col("_b.rule").alias("rule"), F.col("_b.verdict").alias("verdict"))
    return out.drop("rule", "verdict").join(best, ["host", "path"], "left")
