from datetime import date, datetime
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from mandrel.operators import feeds, rules, temporal, verify
from mandrel.operators.expectations import expect, expect_or_drop, expect_or_fail, guarded, violations
from mandrel.operators.scd2 import END, START, current, scd2
from mandrel.streaming.state import History

D = date


def t(day, hour=0, minute=0):
    return datetime(2024, 1, day, hour, minute)


def test_expectations_count_drop_and_fail(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "k int, v string")
    got = guarded(df, [*expect("filled", "v != ''"), *expect_or_drop("known", "v IS NOT NULL")], "d")
    assert [r.k for r in got.frame.collect()] == [1, 3]
    assert {(r.expectation, r.failed) for r in got.metrics(spark).collect()} == {("filled", 2), ("known", 1)}
    with pytest.raises(Exception, match="positive"):
        guarded(df, expect_or_fail("positive", "k > 1"), "d").frame.collect()
    assert {(r.expectation, r.passed, r.failed) for r in violations(df, expect("filled", "v != ''"), "d").collect()} == {("filled", 1, 2)}


BANK = [("v", "A", t(1), "0"), ("v", "B", t(5, 8, 15), "7"), ("v", "A", t(5, 16, 45), "9"), ("v", "A", t(9, 10), "12")]


def versions(df, *tracked):
    rows = df.select(*tracked, F.col(f"{START}.at").alias("a"), F.col(f"{END}.at").alias("b")).orderBy("a", f"{START}.nr").collect()
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("order", list(permutations(range(4)))[::5])
def test_history_does_not_depend_on_arrival(spark, order):
    feed = spark.createDataFrame([BANK[k] for k in order], "k string, v string, at timestamp, nr string")
    got = scd2(feed, ["k"], ["at", "nr"], ["v"])
    assert versions(got, "v") == [("A", t(1), t(5, 8, 15)), ("B", t(5, 8, 15), t(5, 16, 45)), ("A", t(5, 16, 45), None)]
    assert current(got).count() == 1


def test_partial_updates_keep_what_is_null(spark):
    feed = spark.createDataFrame([("v", "", "X", t(1), "0"), ("v", "1", None, t(2), "1"), ("v", None, "", t(3), "2"), ("v", None, None, t(4), "3")], "k string, x string, y string, at timestamp, nr string")
    got = scd2(feed, ["k"], ["at", "nr"], ["x", "y"], ignore_null=True)
    assert versions(got, "x", "y") == [("", "X", t(1), t(2)), ("1", "X", t(2), t(3)), ("1", "", t(3), None)]


def test_equal_times_go_by_number_and_repeats_are_one(spark):
    rows = [("v", "A", t(1), "1"), ("v", "B", t(1), "2"), ("v", "B", t(1), "2"), ("w", "Z", t(1), "1")]
    got = scd2(spark.createDataFrame(rows, "k string, v string, at timestamp, nr string"), ["k"], ["at", "nr"], ["v"])
    assert sorted((r.k, r.v, r[START].nr) for r in got.collect()) == [("v", "A", "1"), ("v", "B", "2"), ("w", "Z", "1")]


def test_history_of_nothing(spark):
    assert scd2(spark.createDataFrame([], "k string, v string, at timestamp"), ["k"], ["at"], ["v"]).count() == 0


def test_incremental_history_equals_rebuild(spark, tmp_path):
    schema = "k string, v string, at timestamp, nr string"
    h = History(spark, f"file://{tmp_path}/h", ["k"], ["at", "nr"], ["v"])
    for part in (BANK[2:3], BANK[:1], BANK[3:] + [("w", "Q", t(2), "1")], BANK[1:2], BANK[1:2]):  # the last one comes again
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{tmp_path}/in")
        h.follow(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    whole = spark.createDataFrame([*BANK, ("w", "Q", t(2), "1")], schema)
    assert verify.fingerprint(h.read(whole.schema)).first() == verify.fingerprint(scd2(whole, ["k"], ["at", "nr"], ["v"])).first()


def test_open_items_end_the_day_before_clearing(spark):
    dates = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 3, 5)], "extract_date date")
    lines = spark.createDataFrame([("a", D(2024, 1, 2), D(2024, 1, 5)), ("b", D(2024, 1, 3), None), ("c", D(2024, 1, 3), D(2024, 1, 3)), ("d", D(2023, 1, 1), None)], "k string, first_extract_date date, cleared_extract_date date")
    got = {(r.k, r.extract_date.day) for r in temporal.open_on(lines, dates).collect()}
    assert got == {("a", 2), ("a", 3), ("b", 3), ("b", 5), ("d", 1), ("d", 2), ("d", 3), ("d", 5)}


def test_recent_payments_bounds(spark):
    dates = spark.createDataFrame([(D(2024, 4, 1),), (D(2024, 4, 10),)], "extract_date date")
    pays = spark.createDataFrame([("a", D(2024, 1, 2), D(2024, 1, 3)), ("b", D(2024, 1, 3), D(2024, 1, 3)), ("c", D(2024, 4, 5), D(2024, 4, 1))], "LIFNR string, BUDAT date, first_extract_date date")
    day = lambda booked: {(r.LIFNR, r.extract_date.day) for r in temporal.recent(pays, dates, 90, booked).collect()}
    assert day(True) == {("b", 1), ("c", 10)}  # 90 days before April 1 is January 2, and that is too long ago
    assert day(False) == {("b", 1), ("c", 1), ("c", 10)}


def hist(spark, rows):
    df = spark.createDataFrame(rows, "LIFNR string, BANKS string, BANKL string, BANKN string, change_ts timestamp, CHANGENR string, source string, changed_by string")
    return scd2(df, feeds.BANK_KEYS, feeds.BANK_SEQUENCE, feeds.BANK_TRACKED)


def pays(spark, rows):
    return spark.createDataFrame(rows, "LIFNR string, BUKRS string, GJAHR string, BELNR string, BUDAT date, HSL decimal(23,2), first_extract_date date")


def dates(spark, *days):
    return spark.createDataFrame([(D(2024, 1, d),) for d in days], "extract_date date")


def test_change_pay_change_within_one_day(spark):
    from decimal import Decimal

    h = hist(spark, [("v", "US", "1", "A", t(1), "0", "initial_load", None), ("v", "US", "1", "B", t(5, 8, 15), "7", "CDPOS", "u"), ("v", "US", "1", "A", t(5, 16, 45), "9", "CDPOS", "w")])
    p = pays(spark, [("v", "1000", "2024", "P2", D(2024, 1, 5), Decimal("10.00"), D(2024, 1, 5)), ("v", "1000", "2024", "P1", D(2024, 1, 5), Decimal("5.50"), D(2024, 1, 6))])
    rows = rules.r02_change_pay_change(rules.bank_changes(h), p, dates(spark, 4, 5, 6)).collect()
    assert sorted(r.extract_date.day for r in rows) == [5, 6]
    assert rows[0].detail == "Bank changed 2024-01-05 08:15 by u, paid 15.50 on 2024-01-05, changed again 2024-01-05 16:45 by w"
    assert '"reverted_to_original":true' in rows[0].evidence and rows[0].severity == "High"
    none = rules.r02_change_pay_change(rules.bank_changes(h), p.where("BUDAT < '2024-01-01'"), dates(spark, 5))
    assert none.count() == 0


def test_payment_after_change_takes_the_earliest_change(spark):
    from decimal import Decimal

    h = hist(spark, [("v", "US", "1", "A", t(1), "0", "initial_load", None), ("v", "US", "1", "B", t(3, 9), "1", "CDPOS", "u"), ("v", "US", "1", "C", t(6, 9), "2", "CDPOS", "u")])
    p = pays(spark, [("v", "1000", "2024", "P1", D(2024, 1, 7), Decimal("1"), D(2024, 1, 7)), ("v", "2000", "2024", "P0", D(2024, 1, 7), Decimal("2"), D(2024, 1, 7))])
    rows = rules.r08_paid_after_change(rules.bank_changes(h), p, dates(spark, 6, 7, 8)).orderBy("extract_date").collect()
    assert [(r.extract_date.day, r.BUKRS) for r in rows] == [(7, "2000"), (8, "2000")]
    assert rows[0].detail == "Bank changed 2024-01-03 09:00 by u, then 2 payment(s) totalling 3.00 from 2024-01-07"


def test_shared_bank_is_high_for_all_holders_with_an_employee(spark):
    d = D(2024, 1, 1)
    bank = spark.createDataFrame([(d, "a", "US", "1", "9"), (d, "b", "US", "1", "9"), (d, "c", "US", "1", "8")], "extract_date date, LIFNR string, BANKS string, BANKL string, BANKN string")
    codes = spark.createDataFrame([(d, "b", "007"), (d, "a", "")], "extract_date date, LIFNR string, PERNR string")
    rows = {r.LIFNR: (r.severity, r.related_lifnr, r.detail) for r in rules.r03_shared_bank(bank, codes).collect()}
    assert rows == {"a": ("High", "b", "Bank 1/9 also used by b (employee-linked)"), "b": ("High", "a", "Bank 1/9 also used by a (employee-linked)")}


def test_fingerprint_ignores_order_and_load_columns(spark):
    a = spark.createDataFrame([(1, "x", "f1"), (2, None, "f1")], "k int, v string, _source_file string")
    b = spark.createDataFrame([(2, None, "f2"), (1, "x", "f2")], "k int, v string, _source_file string")
    assert verify.compare(verify.fingerprints({"t": a}), verify.fingerprints({"t": b})) == []
    assert verify.compare(verify.fingerprints({"t": a}), verify.fingerprints({"t": a.where("k = 1")})) == ["t"]
    assert verify.counted(["a", "_x", "__y"]) == ["a", "__y"]


def test_digests_name_the_dates_that_changed(spark, tmp_path):
    rows = [(D(2024, 1, 1 + k % 6), f"v{k}", k) for k in range(60)] + [(None, "none", 0)]
    df = spark.createDataFrame(rows, "extract_date date, LIFNR string, n long").withColumn("_source_file", F.lit("a"))
    parts = verify.digests(df)
    assert parts.count() == 7 and tuple(verify.combined(parts).first()) == tuple(verify.combined(verify.digests(df.repartition(3).withColumn("_source_file", F.lit("b")))).first())
    planted = df.withColumn("n", F.when(F.col("LIFNR") == "v7", F.lit(99)).otherwise(F.col("n"))).where("extract_date IS NULL OR extract_date <> '2024-01-04'")
    more = planted.unionByName(spark.createDataFrame([(D(2025, 1, 1), "new", 1, "a")], df.schema))
    assert verify.combined(verify.digests(more)).first() != verify.combined(parts).first()
    assert {tuple(r) for r in verify.differing(parts, verify.digests(more)).collect()} == {(D(2024, 1, 2), 10, 10), (D(2024, 1, 4), 10, None), (D(2025, 1, 1), None, 1)}
    assert verify.differing(parts, verify.digests(df)).count() == 0
    kept = verify.Digests(spark, f"file://{tmp_path}/digests")
    kept.record("t", df)
    kept.record("t", df, only=[D(2024, 1, 1)])  # a rerun of one date
    assert kept.changed("t").count() == 0
    kept.record("t", more, only=[D(2024, 1, 2), D(2024, 1, 4), D(2025, 1, 1)])
    assert kept.changed("t").count() == 3 and verify.differing(kept.read("t"), verify.digests(more)).count() == 0
    (tmp_path / "digests" / "t" / "state=9").mkdir()  # a record that died
    assert verify.differing(kept.read("t"), verify.digests(more)).count() == 0


def test_evidence_by_typed_paths(spark):
    rows = [
        (D(2024, 1, 1), "R01", "a", "", '{"other":"b","other_name":"B","score":91.5,"name_score":90.0}'), (D(2024, 1, 1), "R03", "a", "", '{"BANKS":"US","holders":["a","b"],"group_has_employee":true}'),
        (D(2024, 1, 1), "R08", "a", "", '{"change_ts":"2024-01-01T08:15:00.000Z","payments":2,"paid_amount":12.50}'), (D(2024, 1, 1), "R99", "a", "", '{"score":1}'),
    ]
    df = rules.typed_evidence(spark.createDataFrame(rows, "extract_date date, rule_id string, LIFNR string, BUKRS string, evidence string"))
    got = {r.rule_id: r for r in df.drop("evidence").collect()}
    assert got["R01"].R01.score == 91.5 and got["R01"].R01.address_score is None and got["R03"].R03.holders == ["a", "b"] and got["R03"].R03.group_has_employee
    assert (got["R08"].R08.payments, str(got["R08"].R08.paid_amount), got["R08"].R08.change_ts) == (2, "12.50", datetime(2024, 1, 1, 8, 15))
    assert got["R99"].R01.score is None and got["R08"].R01.score is None


def test_reconcile_counts(spark):
    hits = spark.createDataFrame([("R02", "a", "", D(2024, 1, 2)), ("R02", "a", "", D(2024, 1, 3)), ("R02", "x", "", D(2024, 1, 3)), ("R05", "a", "1000", D(2024, 1, 3))], "rule_id string, LIFNR string, BUKRS string, extract_date date")
    key = spark.createDataFrame([("R02", True, "a", "", D(2024, 1, 2)), ("R02", True, "m", "", D(2024, 1, 2)), ("R02", False, "x", "", None), ("R05", True, "a", "1000", D(2024, 1, 3))], "rule_id string, expected_flag boolean, LIFNR string, BUKRS string, expected_first date")
    got = {r.rule_id: r for r in verify.reconcile(hits, key).collect()}
    r = got["R02"]
    assert (r.expected, r.detected, r.matched, r.missed, r.extra, r.decoys_hit, r.first_day_ok) == (2, 2, 1, 1, 1, 1, 1)
    with pytest.raises(ValueError, match="R02"):
        verify.require(verify.reconcile(hits, key))


def test_sparse_dates_by_brute_force(spark):
    days = [D(2024, 1, 31), D(2024, 2, 29), D(2024, 3, 1), D(2024, 6, 30)]
    facts = [(k, D(2024, 1 + k % 6, 1 + k % 28), D(2024, 1 + (k * 7) % 6, 1 + (k * 5) % 28) if k % 5 else None) for k in range(60)] + [(99, D(2023, 1, 1), None), (98, D(2025, 1, 1), None)]
    df = spark.createDataFrame(facts, "k int, a date, b date")
    spine = spark.createDataFrame([(d,) for d in days * 2], "extract_date date")
    got = sorted((r.k, r.extract_date) for r in temporal.on_dates(df, spine, F.col("a"), F.col("b")).collect())
    assert got == sorted((k, d) for k, a, b in facts for d in days if a <= d and (b is None or d <= b))
    assert temporal.on_dates(df, spine.where("false"), F.col("a"), F.col("b")).count() == 0
    assert [r[0] for r in temporal.spine(spine).collect()] == days


def test_catalog_listing(spark):
    for name in ("silver_x", "silver_y", "gold_z"):
        spark.range(1).createOrReplaceTempView(name)
    assert verify.listed(spark, "silver_") == ["silver_x", "silver_y"]
    for name in ("silver_x", "silver_y", "gold_z"):
        spark.catalog.dropTempView(name)
