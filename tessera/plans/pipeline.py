"""A small registry of datasets: dependencies come from parameter names, runs are topological."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from tessera.operators.quality import expect, watch


class Datasets:
    """Register functions of other datasets by name; run builds what is asked for, in order."""

    def __init__(self):
        self.made: dict[str, Callable[..., DataFrame]] = {}
        self.rules: dict[str, tuple[dict[str, Column], str]] = {}

    def dataset(self, name: str | None = None, expectations: Callable[[], dict[str, Column]] | None = None, mode: str = "warn"):
        """A decorator; expectations are made at run time, when a session exists."""

        def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            key = name or f.__name__
            if key in self.made:
                raise ValueError(f"dataset {key} exists")
            self.made[key] = f
            if expectations:
                self.rules[key] = (expectations, mode)
            return f

        return add

    def needs(self, name: str) -> list[str]:
        return list(inspect.signature(self.made[name]).parameters)

    def order(self, wanted: list[str] | None = None) -> list[str]:
        graph, todo = {}, list(wanted or self.made)
        while todo:
            n = todo.pop()
            if n in self.made and n not in graph:
                graph[n] = self.needs(n)
                todo += graph[n]
        return [n for n in TopologicalSorter(graph).static_order() if n in self.made]

    def run(self, spark: SparkSession, inputs: dict[str, DataFrame], wanted: list[str] | None = None) -> tuple[dict[str, DataFrame], dict[str, dict[str, int] | Observation]]:
        """All datasets (lazy), and the counts of rows that broke expectations.

        Rules that only warn are observed: their counts are there once the dataset has been
        read, as ``broken[name].get``. Those that drop or fail run at once.
        """
        done, broken = dict(inputs), {}
        for n in self.order(wanted):
            df = self.made[n](**{p: done[p] for p in self.needs(n)})
            if n in self.rules:
                rules, mode = self.rules[n]
                df, broken[n] = watch(df, rules()) if mode == "warn" else expect(df, rules(), mode)
            done[n] = df
        return done, broken
