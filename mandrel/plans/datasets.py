"""The monitoring data sets as definitions of Spark's declarative pipelines.

Nothing here runs a graph: Spark finds out what reads what, keeps the streams' checkpoints and materialises the tables. Definitions are
lazy throughout, as a pipeline analyses them before any table is there. `pipelines/` has the specification that `spark-pipelines run` takes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import pipelines as dp
from pyspark.sql import DataFrame, SparkSession

from mandrel.operators import conform, feeds, rules, temporal
from mandrel.operators.expectations import enforced, violations
from mandrel.operators.matching import named
from mandrel.operators.scd2 import scd2
from mandrel.sources import bronze

#: Columns of the matcher's result.
CANDIDATES = "LIFNR_A string, LIFNR_B string, name_score double, address_score double, score double, above_threshold boolean, threshold long, name_weight double, name_scorer string"


def define(spark: SparkSession, inbox: str, initial: str, matches: str | None = None, windows: rules.Windows = rules.USUAL) -> None:
    """Register every data set over an inbox of delivered extracts. matches: the matcher's candidate pairs."""
    read = spark.read.table
    _deliveries(spark, inbox)
    for name, build in conform.SILVER.items():
        _guarded(name, lambda build=build: build(read))
    _histories(spark, initial)

    def candidates() -> DataFrame:
        return named(spark.read.parquet(matches) if matches else spark.createDataFrame([], CANDIDATES), read("silver_vendor"))

    _guarded("gold_duplicate_candidates", candidates)
    _rules(read, windows)
    checked = {name: rows for name, rows in conform.EXPECTATIONS.items() if rows}

    @dp.materialized_view(name="expectation_log", comment="Rows that pass and fail each expectation, by data set")
    def log() -> DataFrame:
        return reduce(DataFrame.unionByName, [violations(read(f"{name}_delivered"), rows, name) for name, rows in checked.items()])


def _deliveries(spark: SparkSession, inbox: str) -> None:
    """A streaming table for each delivered table, each file taken once."""
    for table in bronze.TABLES:
        dp.table(name=f"bronze_{table.lower()}", comment=f"Files of {table} as delivered")(lambda table=table: bronze.stream(spark, inbox, table))


def _guarded(name: str, build: Callable[[], DataFrame]) -> None:
    """A table whose expectations are enforced, over a view of the rows before that."""
    found = conform.EXPECTATIONS.get(name, [])
    if not found:
        dp.materialized_view(name=name)(build)
        return
    dp.temporary_view(name=f"{name}_delivered")(build)
    dp.materialized_view(name=name)(lambda: enforced(SparkSession.active().read.table(f"{name}_delivered"), found, name))


def _histories(spark: SparkSession, initial: str) -> None:
    read, stream = spark.read.table, spark.readStream.table

    # One flow for each table: a table of files has one log of batches, so a second flow's batches would count as written.
    @dp.table(name="bank_change_feed", comment="Accounts of the first day, then those that change documents insert")
    def accounts() -> DataFrame:
        items = feeds.change_items(stream("bronze_cdpos"), read("bronze_cdhdr"), ["LFBK"])
        return feeds.bank_feed(feeds.first_day(stream("bronze_lfbk"), initial), items, initial)

    @dp.table(name="controls_change_feed", comment="Control fields of the first day, then each that a change document updates")
    def controls() -> DataFrame:
        items = feeds.change_items(stream("bronze_cdpos"), read("bronze_cdhdr"), ["LFA1", "LFB1"])
        return feeds.controls_feed(feeds.first_day(read("bronze_lfa1"), initial), feeds.first_day(stream("bronze_lfb1"), initial), read("bronze_lfb1"), items, initial)

    @dp.materialized_view(name="dim_vendor_bank_scd2")
    def banks() -> DataFrame:
        return scd2(read("bank_change_feed"), feeds.BANK_KEYS, feeds.BANK_SEQUENCE, feeds.BANK_TRACKED)

    @dp.materialized_view(name="dim_vendor_controls_scd2")
    def control_history() -> DataFrame:
        return scd2(read("controls_change_feed"), feeds.CONTROL_KEYS, feeds.CONTROL_SEQUENCE, feeds.CONTROL_COLUMNS, ignore_null=True)


def _rules(read: Callable[[str], DataFrame], w: rules.Windows) -> None:
    @dp.materialized_view(name="extract_dates", comment="The dates that were delivered")
    def dates() -> DataFrame:
        return temporal.dates_of(read("bronze_lfa1"))

    @dp.temporary_view(name="active_vendor")
    def active() -> DataFrame:
        return rules.active_vendors(read("silver_vendor"), read("silver_open_items"), read("silver_payments"), read("extract_dates"), w)

    @dp.materialized_view(name="bank_changes")
    def changes() -> DataFrame:
        return rules.bank_changes(read("dim_vendor_bank_scd2"))

    hits = {
        "rule_r01": lambda: rules.r01_duplicate(read("gold_duplicate_candidates"), read("active_vendor")),
        "rule_r02": lambda: rules.r02_change_pay_change(read("bank_changes"), read("silver_payments"), read("extract_dates"), w),
        "rule_r03": lambda: rules.r03_shared_bank(read("silver_vendor_bank"), read("silver_vendor_company_code")),
        "rule_r04": lambda: rules.r04_dormant(read("silver_vendor"), rules.last_postings(read("silver_journal_lines"), read("extract_dates")), w),
        "rule_r05": lambda: rules.r05_check_off(read("silver_vendor_company_code")),
        "rule_r06": lambda: rules.r06_payee(read("silver_vendor"), read("silver_vendor_company_code"), read("silver_payments"), read("extract_dates"), w),
        "rule_r07": lambda: rules.r07_held(read("silver_vendor"), read("silver_vendor_company_code"), read("silver_open_items"), w),
        "rule_r08": lambda: rules.r08_paid_after_change(read("bank_changes"), read("silver_payments"), read("extract_dates"), w),
    }
    for name, build in hits.items():
        dp.temporary_view(name=name)(build)
    _guarded("gold_exceptions", lambda: rules.exceptions([read(name) for name in hits]))

    @dp.materialized_view(name="gold_vendor_risk")
    def risk() -> DataFrame:
        return rules.vendor_risk(read("gold_exceptions"), read("silver_open_items"), read("silver_vendor"))

    @dp.materialized_view(name="gold_run_history")
    def history() -> DataFrame:
        return rules.run_history(read("gold_exceptions"), read("silver_open_items"))
