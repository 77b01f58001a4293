"""Streams: history as keyed state, and expectations of every batch."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from mandrel.operators.expectations import expect, expect_or_drop, expect_or_fail, violations
from mandrel.operators.scd2 import scd2
from mandrel.streaming import ingest, state
from mandrel.streaming.eventlog import EventLog

SCHEMA = "k string, at timestamp, nr string, a string, b string, who string"
KEYS, SEQUENCE, TRACK = ["k"], ["at", "nr"], ["a", "b"]


def events(n, seed=3):
    rng = random.Random(seed)
    day = datetime(2024, 1, 1)
    rows = [
        (f"k{rng.randint(0, 6)}", None if rng.random() < 0.02 else day + timedelta(hours=rng.randint(0, 50)), str(rng.randint(0, 2)), rng.choice([None, "x", "y"]), rng.choice([None, "p", "q"]), rng.choice(["s", "t", None]))
        for _ in range(n)
    ]
    rows += rows[:15]
    rng.shuffle(rows)
    return rows


def table(df):
    return sorted(map(str, df.collect()))


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(SCHEMA).parquet(str(folder))


@pytest.mark.parametrize("ignore_null", [False, True])
def test_state_gives_the_rebuild(spark, tmp_path, ignore_null):
    rows = events(240)
    whole = spark.createDataFrame(rows, SCHEMA)
    h = state.History(spark, f"file://{tmp_path}/h", KEYS, SEQUENCE, TRACK, ignore_null)
    assert h.read(whole.schema).count() == 0
    for low in range(0, len(rows), 90):
        h.follow(land(spark, tmp_path / "in", rows[low : low + 90]))
        if low == 90:
            h.compact()
            h.compact()
        part = spark.createDataFrame(rows[: low + 90], SCHEMA)
        assert table(h.read(whole.schema)) == table(scd2(part, KEYS, SEQUENCE, TRACK, ignore_null))
    h.follow(land(spark, tmp_path / "in", rows))  # all of it again: nothing is given out
    assert table(h.read(whole.schema)) == table(scd2(whole, KEYS, SEQUENCE, TRACK, ignore_null))
    assert h.log().where(F.col(state.BATCH) == 3).count() == 0
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != state.STORE["spark.sql.streaming.stateStore.providerClass"]


def test_a_batch_names_its_own_keys_only(spark, tmp_path):
    rows = events(200)
    h = state.History(spark, f"file://{tmp_path}/h", KEYS, SEQUENCE, TRACK)
    h.follow(land(spark, tmp_path / "in", rows))
    more = [("k1", datetime(2025, 1, 1), "0", "new", "new", "s"), ("new", datetime(2025, 1, 1), "0", "x", "x", "s")]
    query = h.follow(land(spark, tmp_path / "in", more))
    assert {r.k for r in h.log().where(F.col(state.BATCH) == 1).collect()} == {"k1", "new"}
    assert h.log().where(F.col(state.BATCH) == 1).count() == 3  # the version that ends, and two that begin
    assert query.lastProgress.numInputRows == 2
    assert table(h.read(spark.createDataFrame(more, SCHEMA).schema)) == table(scd2(spark.createDataFrame(rows + more, SCHEMA), KEYS, SEQUENCE, TRACK))


def test_a_batch_that_dies_comes_again(spark, tmp_path, monkeypatch):
    rows = events(120)
    whole = spark.createDataFrame(rows, SCHEMA)
    h = state.History(spark, f"file://{tmp_path}/h", KEYS, SEQUENCE, TRACK)
    h.follow(land(spark, tmp_path / "in", rows[:60]))
    real = h._log

    def dies(df, batch):
        real(df, batch)
        raise OSError("lost")

    monkeypatch.setattr(h, "_log", dies)
    with pytest.raises(StreamingQueryException):
        h.follow(land(spark, tmp_path / "in", rows[60:]))
    again = state.History(spark, f"file://{tmp_path}/h", KEYS, SEQUENCE, TRACK)
    again.follow(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))
    assert table(again.read(whole.schema)) == table(scd2(whole, KEYS, SEQUENCE, TRACK))


def test_a_compaction_that_is_not_whole_does_not_count(spark, tmp_path):
    rows = events(80)
    whole = spark.createDataFrame(rows, SCHEMA)
    h = state.History(spark, f"file://{tmp_path}/h", KEYS, SEQUENCE, TRACK)
    h.follow(land(spark, tmp_path / "in", rows))
    before = table(h.read(whole.schema))
    (tmp_path / "h" / "base" / f"{state.BATCH}=0").mkdir(parents=True)
    assert table(h.read(whole.schema)) == before
    h.compact()
    assert table(h.read(whole.schema)) == before and not list((tmp_path / "h" / "changes").glob("__batch=*"))


RULES = [*expect("low", "n < 50"), *expect("named", "v <> ''"), *expect_or_drop("even", "n % 2 = 0"), *expect_or_fail("known", "n IS NOT NULL")]


def test_counts_by_batch_add_up(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("n"), F.when(F.col("id") % 7 > 0, F.lit("x")).otherwise(F.when(F.col("id") % 2 == 0, F.lit(""))).alias("v"))
    with EventLog(spark, f"file://{tmp_path}/log") as log:
        assert log.read().count() == 0
        for lot in range(3):
            df.where(F.col("n") % 3 == lot).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = log.guarded(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), RULES, "numbers")
            log.finish(ingest.run(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
        # A run without anything new adds nothing.
        stream = log.guarded(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), RULES, "numbers")
        log.finish(ingest.run(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
        assert table(log.totals()) == table(violations(df, RULES, "numbers"))
        assert {r.batch for r in log.read().collect()} == {0, 1, 2} and log.read().count() == 3 * len(RULES)
        by = {(r.expectation, r.batch): (r.passed, r.failed) for r in log.read().collect()}
        for lot in range(3):
            part = [n for n in range(100) if n % 3 == lot]
            assert by["low", lot] == (sum(n < 50 for n in part), sum(n >= 50 for n in part))
    assert sorted(r.n for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(0, 100, 2))


def test_a_failed_expectation_stops_the_batch(spark, tmp_path):
    good, bad = spark.range(10).selectExpr("id AS n", "'x' AS v"), spark.createDataFrame([(2, "x"), (None, "x")], "n long, v string")
    with EventLog(spark, f"file://{tmp_path}/log") as log:
        for df in (good, bad):
            df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            query = ingest.run(log.guarded(spark.readStream.schema(good.schema).parquet(f"{tmp_path}/in"), RULES, "numbers"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
            if df is good:
                log.finish(query)
        with pytest.raises(StreamingQueryException, match="known"):
            log.finish(query)
        assert {r.batch for r in log.read().collect()} == {0}
    assert sorted(r.n for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 2, 4, 6, 8]
