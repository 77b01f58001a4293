"""Results kept up by deltas against a rebuild from all that is known, date by date."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mandrel.operators import rules, temporal
from mandrel.operators.scd2 import scd2
from mandrel.operators.verify import fingerprints
from mandrel.plans.daily import Daily

START = date(2024, 3, 1)
DAYS = [START + timedelta(days=k) for k in (0, 1, 2, 3, 4, 6)]
W = rules.Windows(recent_payment=6, second_change=2, completed_stays=3, payment_after_change=3, change_stays=4, dormant_months=1, due_ahead=2)
LINES = "LIFNR string, RBUKRS string, GJAHR string, BELNR string, DOCLN string, BLART string, BUDAT date, NETDT date, HSL decimal(23,2), first_extract_date date, cleared_extract_date date"


def seen(day):
    return next((d for d in DAYS if d >= day), None)


class World:
    """Deliveries with delays: lines come up to three days after they are posted, changes up to two days after they are made."""

    def __init__(self, spark, seed=1):
        from decimal import Decimal

        rng = random.Random(seed)
        names = [f"v{k}" for k in range(7)]  # the last one has no line
        flag = lambda p: "X" if rng.random() < p else ""
        vendor = [(d, n, n.upper(), flag(0.1), "", flag(0.1), flag(0.05), flag(0.3), "", flag(0.1), rng.choice(["", "1"]), date(2024, 1, 1)) for d in DAYS for n in names]
        self.vendor = spark.createDataFrame(vendor, "extract_date date, LIFNR string, NAME1 string, SPERR string, SPERZ string, SPERM string, LOEVM string, XCPDK string, LNRZA string, XZEMP string, CONFS string, created_on date")
        self.code = spark.createDataFrame([(d, n, c, flag(0.7), "T", rng.choice(["", "v1"]), flag(0.2), rng.choice(["", "1"])) for d in DAYS for n in names for c in ("1000", "2000")], "extract_date date, LIFNR string, BUKRS string, REPRF string, ZWELS string, LNRZB string, PERNR string, CONFS string")
        self.bank = spark.createDataFrame([(d, n, "US", "1", rng.choice("ABC")) for d in DAYS for n in names], "extract_date date, LIFNR string, BANKS string, BANKL string, BANKN string")
        lines = []
        for k in range(120):
            posted = START + timedelta(days=rng.randint(-12, 6))
            first = seen(max(posted, START) + timedelta(days=rng.choice([0, 0, 1, 3])))
            if first:
                cleared = seen(first + timedelta(days=rng.randint(1, 6))) if rng.random() < 0.6 else None
                lines.append((rng.choice(names[:-1]), rng.choice(["1000", "2000"]), "2024", f"B{k}", "1", rng.choice(["KR", "KZ"]), posted, posted + timedelta(days=3), Decimal(rng.randint(1, 999)), first, cleared))
        self.lines = spark.createDataFrame(lines, LINES).cache()
        events = [(n, datetime(2024, 1, 1), "0", "first", "initial_load", None, START) for n in names]
        for k in range(40):
            at = datetime(2024, 3, 1) + timedelta(hours=rng.randint(0, 150))
            known = seen(at.date() + timedelta(days=rng.choice([0, 0, 1, 2])))
            if known:
                events.append((rng.choice(names), at, str(k), rng.choice(["A", "B", "C"]), "CDPOS", rng.choice(["U1", "U2"]), known))
        self.events = spark.createDataFrame(events, "LIFNR string, change_ts timestamp, CHANGENR string, BANKN string, source string, changed_by string, known date").cache()
        self.matches = spark.createDataFrame([("v1", "v2", 95.0, 95.0, 90.0, True), ("v3", "v4", 92.0, 95.0, 90.0, True)], "LIFNR_A string, LIFNR_B string, score double, name_score double, address_score double, above_threshold boolean")

    def changes(self, day):
        feed = self.events.where(F.col("known") <= F.lit(day)).drop("known")
        return rules.bank_changes(scd2(feed, ["LIFNR"], ["change_ts", "CHANGENR"], ["BANKN"]))

    def delivered(self, days):
        of = lambda rows, c="extract_date": rows.where(F.col(c).isin(days))
        gone = of(self.lines, "cleared_extract_date").select("LIFNR", "RBUKRS", "GJAHR", "BELNR", "DOCLN", "cleared_extract_date")
        before = max((d for d in DAYS if d < days[0]), default=None)
        now = self.changes(days[-1])
        known = F.lit(days[-1]).alias("known")
        told = now.withColumn("gone", F.lit(False))
        if before:
            was = self.changes(before)
            key = ["LIFNR", "ts", "CHANGENR"]
            told = now.subtract(was).withColumn("gone", F.lit(False)).unionByName(was.join(now, key, "left_anti").withColumn("gone", F.lit(True)))
        return of(self.vendor), of(self.code), of(self.bank), of(self.lines, "first_extract_date"), gone, told.select("*", known), self.matches

    def rebuilt(self, day):
        """Exceptions, risk and history of all dates up to a day, from all that is known then."""
        days = self.vendor.sparkSession.createDataFrame([(d,) for d in DAYS if d <= day], "extract_date date")
        upto = lambda rows: rows.where(F.col("extract_date") <= F.lit(day))
        lines = self.lines.where(F.col("first_extract_date") <= F.lit(day)).withColumn("cleared_extract_date", F.when(F.col("cleared_extract_date") <= F.lit(day), F.col("cleared_extract_date")))
        vendor, code = upto(self.vendor), upto(self.code)
        items = temporal.open_on(lines, days).select("extract_date", "LIFNR", F.col("RBUKRS").alias("BUKRS"), "GJAHR", "BELNR", "DOCLN", "NETDT", "HSL", F.abs("HSL").alias("amount"))
        paid = lines.where("BLART = 'KZ'").select("LIFNR", F.col("RBUKRS").alias("BUKRS"), "GJAHR", "BELNR", "BUDAT", "HSL", "first_extract_date")
        changes = self.changes(day)
        hits = rules.exceptions([
            rules.r01_duplicate(self.matches, rules.active_vendors(vendor, items, paid, days, W)), rules.r02_change_pay_change(changes, paid, days, W), rules.r03_shared_bank(upto(self.bank), code),
            rules.r04_dormant(vendor, rules.last_postings(lines, days), W), rules.r05_check_off(code), rules.r06_payee(vendor, code, paid, days, W), rules.r07_held(vendor, code, items, W), rules.r08_paid_after_change(changes, paid, days, W),
        ]).cache()
        return {"exceptions": hits, "risk": rules.vendor_risk(hits, items, vendor), "history": rules.run_history(hits, items)}


@pytest.fixture(scope="module")
def world(spark):
    return World(spark)


def of(tables):
    return fingerprints({n: df.select(*sorted(df.columns)) for n, df in tables.items()})


def test_date_by_date_equals_the_rebuild(spark, world, tmp_path):
    daily = Daily(spark, f"file://{tmp_path}/daily", W)
    again = []
    for days in (DAYS[:3], *([d] for d in DAYS[3:])):
        again.append(len(daily.take(days, *world.delivered(days))) - len(days))
        want = world.rebuilt(days[-1])
        assert of({n: daily.read(n) for n in want}) == of(want), days
    assert again[0] == 0 and any(again)  # some deliveries were late
    assert {f"R0{k}" for k in range(1, 9)} == {r.rule_id for r in daily.read("exceptions").select("rule_id").distinct().collect()}
    daily.take(DAYS[-1:], *world.delivered(DAYS[-1:]))  # the last date again
    want = world.rebuilt(DAYS[-1])
    assert of({n: daily.read(n) for n in want}) == of(want)
    # A date reads its own folders, and those that the windows reach.
    plan = daily.at("vendor", DAYS[-1:])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "extract_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert daily.at("open_items", DAYS[-1:]).count() < daily.read("open_items").count() / 3


def test_what_a_date_no_longer_shows_is_deleted(spark, world, tmp_path):
    daily = Daily(spark, f"file://{tmp_path}/daily", W)
    first = DAYS[:1]
    vendor, code, bank, *rest = world.delivered(first)
    daily.take(first, vendor, code, bank, *rest)
    assert daily.read("exceptions").where("rule_id = 'R05'").count() > 0
    daily.take(first, vendor, code.withColumn("REPRF", F.lit("X")), bank, *rest)
    assert daily.read("exceptions").where("rule_id = 'R05'").count() == 0


def test_a_delivery_is_written_once_and_in_few_files(spark, tmp_path):
    """Rows of a table go to its folders alone, those of a folder together; a folder that is asked for and gets no rows is deleted."""
    daily = Daily(spark, f"file://{tmp_path}/once")
    rows = spark.range(40, numPartitions=8).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 2 AS INT)) AS extract_date")
    days = [(date(2024, 1, k),) for k in (1, 2)]
    daily._put("t", rows, ["extract_date"], days)
    assert sorted(p.name for p in (tmp_path / "once" / "t").iterdir() if "=" in p.name) == ["extract_date=2024-01-01", "extract_date=2024-01-02"]
    assert len(list((tmp_path / "once" / "t").glob("*/*.parquet"))) == 2
    daily._put("t", rows.where("id % 2 = 1"), ["extract_date"], days)
    assert sorted(r.id for r in daily.read("t").collect()) == list(range(1, 40, 2))
    assert not (tmp_path / "once" / "t" / "extract_date=2024-01-01").exists()


def test_pairs_and_accounts_are_made_where_they_are_read(spark, world, tmp_path):
    """Nothing that is made of pairs times dates, or names all holders, is stored; a date keeps the pairs that it was taken in with."""
    daily = Daily(spark, f"file://{tmp_path}/daily", W, ["exceptions"])
    fewer = world.matches.where("LIFNR_A = 'v3'")
    for day, pairs in ((DAYS[0], world.matches), (DAYS[1], fewer)):
        daily.take([day], *world.delivered([day])[:-1], pairs)
    stored = {p.name for p in (tmp_path / "daily" / "exceptions").glob("*/*")}
    assert stored and not stored & {"rule_id=R01", "rule_id=R03"}
    want = world.rebuilt(DAYS[1])["exceptions"].where((F.col("extract_date") == F.lit(DAYS[0])) | (F.col("rule_id") != "R01") | F.col("LIFNR").isin("v3", "v4"))
    assert of({"x": daily.read("exceptions")}) == of({"x": want})
    assert of({"x": daily.at("exceptions", DAYS[:1])}) == of({"x": want.where(F.col("extract_date") == F.lit(DAYS[0]))})


def test_a_run_keeps_up_what_is_asked_of_it(spark, world, tmp_path):
    """Risk alone makes no history and stores no hits."""
    daily = Daily(spark, f"file://{tmp_path}/daily", W, ["risk"])
    daily.take(DAYS[:1], *world.delivered(DAYS[:1]))
    assert of({"x": daily.read("risk")}) == of({"x": world.rebuilt(DAYS[0])["risk"]})
    assert not {"history", "exceptions"} & {p.name for p in (tmp_path / "daily").iterdir()}
