"""Type-2 history as keyed state of a stream: a batch costs what its own keys cost.

Every key's events are state, by their sequence, in a RocksDB store; events arrive in any order and any number of times. A batch adds its
events to the keys that it names, works out these keys' versions again and gives out only versions that are new, have
changed or are no longer there, as updates. What a stream gave out is a log of such changes, in one folder for each batch; the history is,
for every version, the last change of it. Batches that come again overwrite their own folder.

The rules are those of the rebuild: a version opens where a tracked column changes, untracked columns keep the values of
the event that opened it, with ignore_null a null in the feed means unchanged, and of events with the same keys and
sequence the greatest by content stays.

A key is the unit: its events meet in one task, as the order of all of them decides its versions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from mandrel.operators.scd2 import END, START
from mandrel.streaming.ingest import delete, exists, names

#: What happened to a version.
PUT, GONE = "put", "gone"
OP, BATCH = "__op", "__batch"
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def ranked(values: tuple) -> tuple:
    """Sorts as the rebuild does: nulls below every value."""
    return tuple((v is not None, v) if v is not None else (False,) for v in values)


def versions(events: Sequence[tuple], tracked: Sequence[int], ignore_null: bool) -> list[tuple]:
    """Events of a key in order of their sequence to (event that opened, with filled values; place of the next opening or None)."""
    filled: dict[int, Any] = {}
    opened: list[tuple[int, tuple]] = []
    before: tuple | None = None
    for at, event in enumerate(events):
        row = list(event)
        for k in tracked if ignore_null else ():
            if row[k] is None:
                row[k] = filled.get(k)
            else:
                filled[k] = row[k]
        now = tuple(row[k] for k in tracked)
        if before is None or now != before:
            opened.append((at, tuple(row)))
        before = now
    return [(row, opened[n + 1][0] if n + 1 < len(opened) else None) for n, (_, row) in enumerate(opened)]


class Versions(StatefulProcessor):
    """State of a key: its events by sequence, and the versions that were given out, by their start."""

    def __init__(self, feed: T.StructType, keys: Sequence[str], sequence: Sequence[str], track: Sequence[str], ignore_null: bool):
        self.names = [c for c in feed.names if c not in keys]
        self.types = T.StructType([feed[c] for c in self.names])
        self.keys, self.sequence = list(keys), list(sequence)
        self.at = [self.names.index(c) for c in sequence]
        self.tracked = [self.names.index(c) for c in track]
        self.rest = [k for k, c in enumerate(self.names) if c not in sequence]
        self.ignore_null = ignore_null

    def init(self, handle: StatefulProcessorHandle) -> None:
        order = T.StructType([self.types[c] for c in self.sequence])
        self.events = handle.getMapState("events", order, self.types)
        told = T.StructType([*self.types.fields, *[T.StructField(f"until_{c}", self.types[c].dataType) for c in self.sequence], T.StructField("has_until", T.BooleanType())])
        self.told = handle.getMapState("versions", order, told)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        content = lambda row: ranked(tuple(row[k] for k in self.rest))
        known = {tuple(k): tuple(v) for k, v in self.events.iterator()}
        fresh = set()
        for frame in rows:
            for row in zip(*(_values(frame[c]) for c in self.names), strict=True):
                at = tuple(row[k] for k in self.at)
                if at not in known or content(row) > content(known[at]):
                    known[at] = row
                    fresh.add(at)
        if not fresh:
            return
        for at in fresh:
            self.events.updateValue(at, known[at])
        ordered = [known[at] for at in sorted(known, key=ranked)]
        now = {}
        for row, until in versions(ordered, self.tracked, self.ignore_null):
            end = tuple(ordered[until][k] for k in self.at) if until is not None else None
            now[tuple(row[k] for k in self.at)] = row + (end or (None,) * len(self.at)) + (end is not None,)
        before = {tuple(k): tuple(v) for k, v in self.told.iterator()}
        out = []
        for start, version in now.items():
            if before.get(start) != version:
                self.told.updateValue(start, version)
                out.append((PUT, start, version))
        for start in before.keys() - now.keys():
            self.told.removeKey(start)
            out.append((GONE, start, before[start]))
        if out:
            yield self._frame(key, out)

    def _frame(self, key: Any, changes: list[tuple]) -> pd.DataFrame:
        n = len(self.names)
        data: dict[str, list] = {c: [v] * len(changes) for c, v in zip(self.keys, key, strict=True)}
        for k, c in enumerate(self.names):
            data[c] = [version[k] for _, _, version in changes]
        for k, c in enumerate(self.sequence):
            data[f"{START}_{c}"] = [start[k] for _, start, _ in changes]
            data[f"{END}_{c}"] = [version[n + k] for _, _, version in changes]
        data[f"{END}_is"] = [version[-1] for _, _, version in changes]
        data[OP] = [op for op, _, _ in changes]
        return pd.DataFrame(data, dtype=object)

    def close(self) -> None:
        pass


def _values(column: pd.Series) -> list:
    """Plain values, None for null."""
    return [None if v is None or v is pd.NaT or v != v else v.to_pydatetime() if isinstance(v, pd.Timestamp) else v.item() if hasattr(v, "item") else v for v in column.tolist()]


def changes(feed: DataFrame, keys: Sequence[str], sequence: Sequence[str], track: Sequence[str], ignore_null: bool = False) -> DataFrame:
    """The stream of changes of versions: feed's columns, flat start and end, and what happened. The session needs the store of STORE."""
    rest = [c for c in feed.columns if c not in keys]
    flat = [feed.schema[c] for c in (*keys, *rest)]
    flat += [T.StructField(f"{side}_{c}", feed.schema[c].dataType) for c in sequence for side in (START, END)]
    out = T.StructType([T.StructField(f.name, f.dataType) for f in flat]).add(f"{END}_is", T.BooleanType()).add(OP, T.StringType())
    made = Versions(feed.schema, keys, sequence, track, ignore_null)
    return feed.groupBy(*keys).transformWithStateInPandas(statefulProcessor=made, outputStructType=out, outputMode="Update", timeMode="None")


class History:
    """A history that follows a stream: the checkpoint has the state, `root` the log of changes."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], sequence: Sequence[str], track: Sequence[str], ignore_null: bool = False):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.sequence, self.track, self.ignore_null = list(keys), list(sequence), list(track), ignore_null

    def _log(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/changes/{BATCH}={batch}")

    def follow(self, feed: DataFrame) -> StreamingQuery:
        """Take in what is new and end. A query that was stopped at any point goes on from its checkpoint."""
        before = {name: self.spark.conf.get(name, None) for name in STORE}
        for name, value in STORE.items():
            self.spark.conf.set(name, value)
        try:
            found = changes(feed, self.keys, self.sequence, self.track, self.ignore_null)
            query = found.writeStream.foreachBatch(self._log).outputMode("update").option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start()
            query.awaitTermination()
        finally:
            for name, value in before.items():
                self.spark.conf.unset(name) if value is None else self.spark.conf.set(name, value)
        return query

    def _base(self) -> int | None:
        """The last batch that a whole compaction holds."""
        found = [n for n in names(self.spark, f"{self.root}/base") if exists(self.spark, f"{self.root}/base/{n}/_SUCCESS")]
        return max((int(n.split("=")[1]) for n in found), default=None)

    def log(self) -> DataFrame | None:
        """All changes that count, with the batch of each; none before the first batch."""
        base = self._base()
        batches = sorted(int(n.split("=")[1]) for n in names(self.spark, f"{self.root}/changes") if n.startswith(f"{BATCH}="))
        later = [b for b in batches if base is None or b > base]
        parts = [f"{self.root}/changes/{BATCH}={b}" for b in later]
        out = self.spark.read.option("basePath", f"{self.root}/changes").parquet(*parts) if parts else None
        if base is not None:
            old = self.spark.read.option("basePath", f"{self.root}/base").parquet(f"{self.root}/base/{BATCH}={base}")
            out = old if out is None else old.unionByName(out)
        return out

    def _last(self, log: DataFrame) -> DataFrame:
        """The versions that are there."""
        by = [*self.keys, *[f"{START}_{c}" for c in self.sequence]]
        rest = [c for c in log.columns if c not in by]
        return log.groupBy(*by).agg(F.max_by(F.struct(*rest), BATCH).alias("v")).select(*by, "v.*").where(F.col(OP) == PUT)

    def read(self, feed: T.StructType) -> DataFrame:
        """The history as the rebuild has it: feed's columns, __START_AT and __END_AT."""
        log = self.log()
        if log is None:
            struct = T.StructType([feed[c] for c in self.sequence])
            return self.spark.createDataFrame([], T.StructType([*feed.fields, T.StructField(START, struct), T.StructField(END, struct)]))
        start, end = ([F.col(f"{side}_{c}").alias(c) for c in self.sequence] for side in (START, END))
        return self._last(log).select(*feed.names, F.struct(*start).alias(START), F.when(F.col(f"{END}_is"), F.struct(*end)).alias(END))

    def compact(self) -> None:
        """Put the log so far into one table, so that reading follows the history and not the number of batches. A compaction counts once it
        is whole; only then is what it holds deleted."""
        log, before = self.log(), self._base()
        if log is None:
            return
        top = log.agg(F.max(BATCH)).first()[0]
        if top == before:
            return
        self._last(log).drop(BATCH).write.mode("overwrite").parquet(f"{self.root}/base/{BATCH}={top}")
        for folder, stays in (("changes", None), ("base", top)):
            for name in names(self.spark, f"{self.root}/{folder}"):
                if name.startswith(f"{BATCH}=") and int(name.split("=")[1]) <= top and int(name.split("=")[1]) != stays:
                    delete(self.spark, f"{self.root}/{folder}/{name}")
