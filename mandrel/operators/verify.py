"""Checks of whole tables: fingerprints, reruns, and reconciliation with an answer key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mandrel.streaming.ingest import delete, exists, names


def counted(columns: Sequence[str]) -> list[str]:
    """Columns that a fingerprint covers: load metadata (one underscore) is left out, history ends (two) stay."""
    return [c for c in columns if not c.startswith("_") or c.startswith("__")]


def md5_of(*columns: str) -> Column:
    """A 48-bit number from the text of a row's columns: a row hash that other engines have as well."""
    return F.conv(F.left(F.md5(F.concat_ws("|", *columns)), F.lit(12)), 16, 10).cast("long")


def fingerprint(df: DataFrame, row_hash: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """Row count and an order-independent hash: partial sums, one row."""
    h = row_hash(*counted(df.columns)).cast("decimal(38,0)")
    return df.select(h.alias("h")).agg(F.count("*").alias("n"), F.sum("h").alias("h"))


def fingerprints(tables: Mapping[str, DataFrame]) -> dict[str, tuple[int, str]]:
    return {name: (r["n"], str(r["h"])) for name, df in tables.items() for r in fingerprint(df).collect()}


def digests(df: DataFrame, part: str = "extract_date", row_hash: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """part, n, h: the fingerprint of each part of a table, by partial sums; a row for each part."""
    h = row_hash(*counted(df.columns)).cast("decimal(38,0)")
    return df.select(F.col(part).alias("part"), h.alias("h")).groupBy("part").agg(F.count("*").alias("n"), F.sum("h").alias("h"))


def combined(parts: DataFrame) -> DataFrame:
    """n, h: one fingerprint from those of the parts; equal tables have equal ones, and the table isn't read."""
    h = F.xxhash64(F.col("part").cast("string"), "n", F.col("h").cast("string")).cast("decimal(38,0)")
    return parts.select("n", h.alias("h")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("h").alias("h"))


def differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """part, n_before, n_after: parts whose digests differ or that one side lacks, from digests alone."""
    a, b = (df.select("part", F.col("n").alias(f"n_{name}"), F.col("h").alias(f"h_{name}")) for df, name in ((before, "before"), (after, "after")))
    rows = a.join(b, a["part"].eqNullSafe(b["part"]), "full")
    same = F.col("n_before").eqNullSafe(F.col("n_after")) & F.col("h_before").eqNullSafe(F.col("h_after"))
    return rows.where(~same).select(F.coalesce(a["part"], b["part"]).alias("part"), "n_before", "n_after")


class Digests:
    """Digests of tables, kept by part. A change of some parts is recorded by reading these parts alone, and a comparison reads no table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def record(self, name: str, df: DataFrame, part: str = "extract_date", only: Sequence | None = None) -> None:
        """All parts, or those in `only`; of these, parts that are no longer there go."""
        rows = digests(df if only is None else df.where(F.col(part).isin(list(only))), part)
        if only is not None:
            rows = rows.unionByName(self.read(name).where(~F.coalesce(F.col("part").isin(list(only)), F.lit(False))))
        # A number for each state: the last whole one counts, so a crash leaves the one before.
        state = max(self._states(name), default=-1) + 1
        rows.coalesce(1).write.parquet(f"{self.root}/{name}/state={state}")  # a row for each part
        for old in self._states(name):
            if old < state - 1:
                delete(self.spark, f"{self.root}/{name}/state={old}")

    def _states(self, name: str) -> list[int]:
        found = [n for n in names(self.spark, f"{self.root}/{name}") if exists(self.spark, f"{self.root}/{name}/{n}/_SUCCESS")]
        return [int(n.split("=")[1]) for n in found]

    def read(self, name: str, back: int = 0) -> DataFrame:
        """The last digests, or those `back` records before; only one is kept."""
        return self.spark.read.parquet(f"{self.root}/{name}/state={max(self._states(name)) - back}")

    def changed(self, name: str) -> DataFrame:
        """What the last record changed."""
        return differing(self.read(name, 1), self.read(name))


def listed(spark: SparkSession, prefix: str = "") -> list[str]:
    """Names of the catalog's tables and views that begin with a prefix."""
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(prefix))


def deliveries(tables: Mapping[str, DataFrame], date: str = "extract_date") -> DataFrame:
    """Rows of each table on each date."""
    return reduce(DataFrame.unionByName, [df.groupBy(date).agg(F.count("*").alias("n")).select(F.lit(name).alias("dataset"), date, "n") for name, df in tables.items()])


def compare(before: Mapping[str, tuple], after: Mapping[str, tuple]) -> list[str]:
    """Names whose fingerprints differ or that only one side has."""
    return sorted(n for n in {*before, *after} if before.get(n) != after.get(n))


def reconcile(hits: DataFrame, manifest: DataFrame, by_code: Sequence[str] = ("R05",)) -> DataFrame:
    """Per rule on the last date: expected, detected, matched, missed, extra, decoys hit, and first flags on the expected day.

    manifest: rule_id, expected_flag, LIFNR, BUKRS, expected_first (date). Rules in by_code count by company code.
    """
    code = lambda c: F.when(F.col("rule_id").isin(*by_code), F.col(c)).otherwise(F.lit(""))
    keys = ["rule_id", "LIFNR", "cc"]
    found = hits.withColumn("cc", code("BUKRS")).groupBy(*keys).agg(F.min("extract_date").alias("first"), F.max("extract_date").alias("latest"))
    last = hits.agg(F.max("extract_date").alias("last"))
    found = found.crossJoin(F.broadcast(last)).withColumn("detected", F.col("latest") == F.col("last"))  # one row
    known = manifest.withColumn("cc", code("BUKRS")).groupBy(*keys).agg(F.bool_or("expected_flag").alias("expected"), F.max("expected_first").alias("expected_first"))
    rows = known.join(found, keys, "full").withColumns({"expected": F.coalesce("expected", F.lit(None).cast("boolean")), "detected": F.coalesce("detected", F.lit(False))})
    yes, no = F.coalesce("expected", F.lit(False)), F.coalesce(~F.col("expected"), F.lit(False))
    count = lambda c, name: F.count_if(c).alias(name)
    d = F.col("detected")
    return rows.groupBy("rule_id").agg(
        count(yes, "expected"), count(d, "detected"), count(yes & d, "matched"), count(yes & ~d, "missed"), count(~yes & d, "extra"),
        count(no & F.col("first").isNotNull(), "decoys_hit"), count(yes & (F.col("first") == F.col("expected_first")), "first_day_ok"),
    )


def settled(report: DataFrame) -> Column:
    return (F.col("missed") == 0) & (F.col("extra") == 0) & (F.col("decoys_hit") == 0) & (F.col("first_day_ok") == F.col("expected"))


def require(report: DataFrame) -> None:
    """Raise if any rule disagrees with the answer key. The report has one row for each rule."""
    bad = [r["rule_id"] for r in report.where(~settled(report)).select("rule_id").collect()]
    if bad:
        raise ValueError(f"reconciliation differs for {', '.join(sorted(bad))}")


def defects(table: DataFrame, condition: str, planted: DataFrame, key: str = "LIFNR") -> int:
    """Planted defects that a table still shows."""
    return table.where(condition).join(planted.select(key).distinct(), key, "left_semi").select(key).distinct().count()
