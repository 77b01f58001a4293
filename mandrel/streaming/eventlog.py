"""Expectations on streams: counts of every micro-batch as a table, and batches that must not commit.

A guarded stream observes each rule on the rows of a batch, on the way to the sink and in the same pass. A listener takes the observed
counts from the query's progress and writes one small file for each data set and batch, whole or not at all; a batch that
runs again writes the same file. A rule that must not fail raises in the task, so the sink commits nothing of the batch,
and the log has nothing of it either.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent

from mandrel.operators.expectations import Expectation, counted, enforced
from mandrel.streaming.ingest import names, write_text

SCHEMA = "dataset string, expectation string, action string, batch long, passed long, failed long"


class _Listener(StreamingQueryListener):
    def __init__(self, take: Callable[[str, int, dict], None]):
        self.take = take

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        if p.numInputRows:
            self.take(str(p.runId), p.batchId, {k: v.asDict() for k, v in p.observedMetrics.items()})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass


class EventLog:
    """The log of a session's guarded streams, in a folder that stays."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.rules: dict[str, tuple[str, list[Expectation]]] = {}
        self.seen: dict[str, int] = {}
        self.listener = _Listener(self._take)

    def __enter__(self) -> EventLog:
        self.spark.streams.addListener(self.listener)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self.listener)

    def guarded(self, rows: DataFrame, rules: list[Expectation], dataset: str) -> DataFrame:
        """A stream whose batches are counted and enforced. Other observations of the query are left alone."""
        name = f"expectations_{uuid.uuid4().hex}"
        self.rules[name] = (dataset, rules)
        return enforced(rows.observe(name, *counted(rules)), rules, dataset)

    def _take(self, run: str, batch: int, found: dict[str, dict]) -> None:
        for name, got in found.items():
            if name in self.rules:
                dataset, rules = self.rules[name]
                rows = [{"dataset": dataset, "expectation": r.name, "action": r.action, "batch": batch, "passed": got["rows"] - got[f"v{k}"], "failed": got[f"v{k}"]} for k, r in enumerate(rules)]
                write_text(self.spark, f"{self.root}/{dataset}/{batch:020d}.json", "\n".join(map(json.dumps, rows)))
        self.seen[run] = max(batch, self.seen.get(run, -1))

    def finish(self, query: StreamingQuery, patience: float = 60) -> None:
        """Wait until a query has ended and the listener has heard of its last batch."""
        query.awaitTermination()
        done = [p.batchId for p in query.recentProgress if p.numInputRows]
        until = time.monotonic() + patience
        while done and self.seen.get(str(query.runId), -1) < max(done):
            if time.monotonic() > until:
                raise TimeoutError("no word of the last batch")
            time.sleep(0.05)

    def read(self) -> DataFrame:
        paths = [f"{self.root}/{n}" for n in names(self.spark, self.root)]
        return self.spark.read.schema(SCHEMA).json(paths) if paths else self.spark.createDataFrame([], SCHEMA)

    def totals(self) -> DataFrame:
        """The same counts as a check of all rows at once gives."""
        return self.read().groupBy("dataset", "expectation", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
