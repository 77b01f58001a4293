"""Row constraints with three policies: fail, drop and warn.

A predicate that is null counts as violated. Counts are observed on the write itself, so nothing is read
twice; a failed constraint stops the write before it commits.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FAIL, DROP, WARN = "fail", "drop", "warn"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = WARN

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expect(name: str, predicate: str) -> list[Expectation]:
    return [Expectation(name, predicate, WARN)]


def expect_or_drop(name: str, predicate: str) -> list[Expectation]:
    return [Expectation(name, predicate, DROP)]


def expect_or_fail(name: str, predicate: str) -> list[Expectation]:
    return [Expectation(name, predicate, FAIL)]


def expect_all(action: str, **predicates: str) -> list[Expectation]:
    return [Expectation(n, p, action) for n, p in predicates.items()]


@dataclass
class Checked:
    """A guarded frame; metrics() is valid once an action over `frame` has ended."""

    dataset: str
    frame: DataFrame
    rules: list[Expectation]
    seen: Observation | None = field(default=None)

    def metrics(self, spark: SparkSession) -> DataFrame:
        got = self.seen.get if self.seen else {}
        rows = [(self.dataset, r.name, r.action, got["rows"] - got[f"v{k}"], got[f"v{k}"]) for k, r in enumerate(self.rules)]
        return spark.createDataFrame(rows, "dataset string, expectation string, action string, passed long, failed long")


def counted(rules: list[Expectation]) -> list[Column]:
    """Aggregates: rows, and the violations of every rule."""
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(~r.holds()).alias(f"v{k}") for k, r in enumerate(rules)]]


def enforced(df: DataFrame, rules: list[Expectation], dataset: str = "") -> DataFrame:
    """Stop on rules that must not fail, then drop rows that break a drop rule; warnings change nothing."""
    columns = df.columns
    for r in rules:
        if r.action == FAIL:
            stop = F.raise_error(F.lit(f"expectation {r.name} of {dataset or 'dataset'} failed: {r.predicate}")).cast("boolean")
            df = df.where(F.when(r.holds(), F.lit(True)).otherwise(stop))
    for r in rules:
        if r.action == DROP:
            df = df.where(r.holds())
    return df.select(*columns)


def guarded(df: DataFrame, rules: list[Expectation], dataset: str = "") -> Checked:
    """Count violations of every rule, stop on those that must not fail, drop rows that break a drop rule."""
    if not rules:
        return Checked(dataset, df, rules)
    seen = Observation()
    return Checked(dataset, enforced(df.observe(seen, *counted(rules)), rules, dataset), rules, seen)


def violations(df: DataFrame, rules: list[Expectation], dataset: str = "") -> DataFrame:
    """The same counts as one lazy query: a single pass, then one row for each rule."""
    sums = df.agg(*counted(rules))
    each = [F.struct(F.lit(r.name).alias("expectation"), F.lit(r.action).alias("action"), F.col(f"v{k}").alias("failed")) for k, r in enumerate(rules)]
    rows = sums.select("rows", F.explode(F.array(*each)).alias("e"))
    return rows.select(F.lit(dataset).alias("dataset"), "e.expectation", "e.action", (F.col("rows") - F.col("e.failed")).alias("passed"), "e.failed")
