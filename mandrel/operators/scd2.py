"""Type-2 history from a change feed, in any order of arrival.

A version opens where a tracked column changes; its end is the next version's start. Untracked columns keep
the values of the event that opened the version. With ignore_null a null in the feed means "unchanged".
Two events with the same keys and sequence are one; the greatest by content stays, so results do not depend
on arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "__START_AT", "__END_AT"


def scd2(feed: DataFrame, keys: Sequence[str], sequence: Sequence[str], track: Sequence[str], ignore_null: bool = False) -> DataFrame:
    """feed's columns and the structs __START_AT and __END_AT (null: current). One shuffle, on the keys."""
    columns = feed.columns
    rest = [c for c in columns if c not in {*keys, *sequence}]
    same = Window.partitionBy(*keys).orderBy(*sequence)
    # The greatest by content comes first among equal sequences; every window runs on the same shuffle.
    within = Window.partitionBy(*keys).orderBy(*sequence, *[F.col(c).desc_nulls_last() for c in rest])
    at = F.struct(*sequence)
    df = feed.withColumn("__new", (F.row_number().over(within) == 1) | ~at.eqNullSafe(F.lag(at).over(within))).where("__new").drop("__new")
    if ignore_null:
        sofar = same.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        df = df.withColumns({c: F.last(c, ignorenulls=True).over(sofar) for c in track})
    first = F.row_number().over(same) == 1
    changed: Column = first
    for c in track:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(same))
    df = df.withColumn("__opens", changed).where("__opens").drop("__opens")
    start = F.struct(*sequence)
    return df.select(*columns, start.alias(START), F.lead(start).over(same).alias(END))


def current(history: DataFrame) -> DataFrame:
    return history.where(F.col(END).isNull())


def changes(history: DataFrame, key: str, value: str, at: str, tie: str, carry: Sequence[str] = ()) -> DataFrame:
    """Each version beside its neighbours: `prev`, and `next_*` for the value, its start, the tie and carried columns."""
    order = Window.partitionBy(key).orderBy(at, tie)
    ahead = {f"next_{c}": F.lead(c).over(order) for c in (value, at, tie, *carry)}
    return history.withColumns({"prev": F.lag(value).over(order)} | ahead)


def merged(history_feed: DataFrame, arrived: DataFrame, keys: Sequence[str], sequence: Sequence[str], track: Sequence[str], ignore_null: bool = False) -> tuple[DataFrame, DataFrame]:
    """The incremental form: (history of the keys that arrived, all events of these keys). Other keys' history stays as it is."""
    hit = arrived.select(*keys).distinct()
    events = history_feed.join(hit, list(keys), "left_semi").unionByName(arrived)
    return scd2(events, keys, sequence, track, ignore_null), events
