"""As-of operators over extract dates.

Facts carry the interval of dates on which they count. Instead of a join of every date with every fact, an
interval is exploded to the extract dates that lie in it, so the work follows the result: dates are few (one for each
extract), go to every task as one row, and are found by position, not by search. Nothing is run to plan it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_version(rows: DataFrame, keys: Sequence[str], order: str | Column, values: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """Last value of each column by `order`, nulls included; partial aggregation, no sort of the input."""
    by = F.col(order) if isinstance(order, str) else order
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), by).alias("__last"), *extra)
    return last.select(*keys, "__last.*", *[c for c in last.columns if c not in (*keys, "__last")])


def dates_of(rows: DataFrame, date: str = "extract_date") -> DataFrame:
    """The distinct dates of a table, one row for each extract."""
    return rows.select(date).where(F.col(date).isNotNull()).distinct()


def spine(rows: DataFrame, date: str = "extract_date") -> DataFrame:
    """The same, in order, as a table that costs nothing to read again."""
    days = sorted(r[0] for r in dates_of(rows, date).collect())
    return rows.sparkSession.createDataFrame([(d,) for d in days], f"{date} date")


def _calendar(dates: DataFrame, date: str) -> DataFrame:
    """One row: the dates in order, and for each day from the first to the day after the last how many dates come before it; no row without dates."""
    known = dates.agg(F.array_sort(F.collect_set(date)).alias("days")).where(F.size("days") > 0)
    known = known.withColumns({"first": F.col("days")[0], "span": F.datediff(F.element_at("days", -1), F.col("days")[0])})
    day = lambda k: F.date_add("first", k)
    before = F.transform(F.sequence(F.lit(0), F.col("span") + 1), lambda k: F.size(F.filter("days", lambda d: d < day(k))))
    return known.select(F.struct("days", "first", "span", before.alias("before")).alias("__calendar"))


def on_dates(facts: DataFrame, dates: DataFrame, since: Column, until: Column, date: str = "extract_date") -> DataFrame:
    """facts on every date of `dates` in [since, until], both inclusive; an empty interval gives nothing.

    A null `since` or `until` is open. For each day between the first and the last date it is known how many dates
    come before it, so an interval is a slice of the dates: sparse dates make no more rows than they have.
    """
    columns = [c for c in facts.columns if c != date]
    day = lambda c: F.datediff(c, F.col("__calendar.first"))
    a, b = F.greatest(day(since), F.lit(0)), F.least(day(until), F.col("__calendar.span"))
    low, high = F.get("__calendar.before", a), F.get("__calendar.before", b + 1)
    # One row, of as many numbers as there are days from the first date to the last.
    met = facts.crossJoin(F.broadcast(_calendar(dates, date))).where(a <= b)
    return met.select(*columns, F.explode(F.slice("__calendar.days", low + 1, high - low)).alias(date))


def open_on(lines: DataFrame, dates: DataFrame) -> DataFrame:
    """Lines that are open on each date: delivered by then and not yet cleared."""
    return on_dates(lines, dates, F.col("first_extract_date"), F.date_sub("cleared_extract_date", 1))


def recent(payments: DataFrame, dates: DataFrame, days: int, booked: bool) -> DataFrame:
    """Payments delivered by a date and posted less than `days` before it; with `booked`, not after it either."""
    since = F.greatest("first_extract_date", "BUDAT") if booked else F.col("first_extract_date")
    return on_dates(payments, dates, since, F.date_add("BUDAT", days - 1))


def within(left: DataFrame, right: DataFrame, key: str, at: Column, low: Column, high: Column) -> DataFrame:
    """Interval join: rows of one key where the day `at` of right lies in [low, high], days of left.

    Intervals are short (a rule's window), so they are exploded to days, and rows meet by key and day: a vendor with many
    changes and many payments makes the pairs that count and no others.
    """
    days = left.where(low <= high).withColumn("__day", F.explode(F.sequence(low, high)))
    return days.join(right.withColumn("__day", at), [key, "__day"]).drop("__day")
