"""Pay runs: which run pays which invoice, and what bank changes a control should then find.

Runs are few and known (one for each run day), so they go with every row as an array; facts never meet runs in a join
of ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields that hold a payment back while any is filled.
HOLDS = ("CONFS", "SPERZ", "SPERR", "LOEVM")


def all_runs(runs: DataFrame) -> Column:
    """An array of all run dates, as a literal: one entry for each run day."""
    return F.array(*[F.lit(r["run"]) for r in runs.select("run").distinct().orderBy("run").collect()]).cast("array<date>")


def states(base: DataFrame, changes: DataFrame, runs: DataFrame, hour: int = 12, fields: Sequence[str] = HOLDS) -> DataFrame:
    """(LIFNR, run, each field): a vendor's fields at the hour of every run, for vendors with changes.

    base: LIFNR and the fields before all changes; changes: LIFNR, ts, FNAME, VALUE_NEW. One window over changes and run
    marks together carries the last value forward; marks come behind changes of the same moment.
    """
    watched = changes.where(F.col("FNAME").isin(*fields)).select("LIFNR", "ts", "FNAME", "VALUE_NEW")
    vendors = watched.select("LIFNR").distinct()
    none = {f: F.lit(None).cast("string") for f in fields}
    start = base.join(vendors, "LIFNR", "left_semi").select("LIFNR", F.lit(None).cast("timestamp").alias("ts"), F.lit(0).alias("rank"), F.lit(None).cast("date").alias("run"), *fields)
    moves = watched.select("LIFNR", "ts", F.lit(1).alias("rank"), F.lit(None).cast("date").alias("run"), *[F.when(F.col("FNAME") == f, F.col("VALUE_NEW")).alias(f) for f in fields])
    day = F.explode(all_runs(runs))
    marks = vendors.withColumn("run", day).select("LIFNR", (F.col("run").cast("timestamp") + F.make_dt_interval(hours=F.lit(hour))).alias("ts"), F.lit(2).alias("rank"), "run", *[c.alias(f) for f, c in none.items()])
    order = Window.partitionBy("LIFNR").orderBy("ts", "rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = start.unionByName(moves).unionByName(marks)
    return rows.select("LIFNR", "run", *[F.last(f, ignorenulls=True).over(order).alias(f) for f in fields]).where("run IS NOT NULL")


def payable(state: DataFrame, fields: Sequence[str] = HOLDS) -> Column:
    """No field that holds payments back is filled."""
    clear = F.lit(True)
    for f in fields:
        clear = clear & (F.coalesce(f, F.lit("")) == "")
    return clear


def paid_by(invoices: DataFrame, runs: DataFrame, base: DataFrame, changes: DataFrame, ahead: int = 3) -> DataFrame:
    """invoices with `run`: the first run from `ahead` days before the due date on, and not before posting, at which the vendor is payable; null without one."""
    state = states(base, changes, runs)
    free = state.groupBy("LIFNR").agg(F.collect_list(F.when(payable(state), F.col("run"))).alias("free"))  # one entry for each run day
    still = base.select("LIFNR", payable(base).alias("still"))
    rows = invoices.join(free, "LIFNR", "left").join(still, "LIFNR", "left")
    whole = F.when(F.coalesce("still", F.lit(True)), all_runs(runs)).otherwise(F.array().cast("array<date>"))
    since = F.greatest(F.date_sub("netdt", ahead), F.col("budat"))
    return rows.withColumn("run", F.array_min(F.filter(F.coalesce("free", whole), lambda r: r >= since))).drop("free", "still")


def pay_documents(paid: DataFrame) -> DataFrame:
    """One payment for each run, vendor and company code."""
    return paid.where("run IS NOT NULL").groupBy("run", "LIFNR", "BUKRS").agg(F.sum("amount").alias("amount"), F.count("*").alias("invoices"))


def expected_after_change(changes: DataFrame, payments: DataFrame, end: Column, window: int = 14, look: int = 30) -> DataFrame:
    """Vendors with a bank change in the look-back before `end`: the first payment run within the window of any such change, or none.

    changes: LIFNR, day; payments: LIFNR, BUKRS, run. Days alone count, so a payment on the day of the change does.
    """
    recent = changes.where((F.col("day") <= end) & (F.date_add("day", look) >= end)).select("LIFNR", "day").distinct()
    hits = recent.join(payments.select("LIFNR", "BUKRS", "run"), "LIFNR").where((F.col("run") >= F.col("day")) & (F.col("run") <= F.date_add("day", window)))
    first = hits.groupBy("LIFNR").agg(F.min(F.struct("run", "BUKRS")).alias("f"))
    return recent.select("LIFNR").distinct().join(first, "LIFNR", "left").select("LIFNR", F.col("f").isNotNull().alias("expected_flag"), F.col("f.run").alias("expected_first"), F.col("f.BUKRS").alias("BUKRS"))
