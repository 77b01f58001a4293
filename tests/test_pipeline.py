"""The declared data sets over simulated extracts, against the answer key."""

from pathlib import Path

import pytest
from pyspark.pipelines.output import MaterializedView, StreamingTable, TemporaryView
from pyspark.sql import functions as F

from mandrel.operators import conform, verify
from mandrel.operators.scd2 import scd2
from mandrel.plans import datasets, pipeline, serving
from mandrel.sources import bronze
from tests.dataflow import Definitions, Runner
from tests.world import Simulator, World, write

WORLD = World()


@pytest.fixture(scope="module")
def world():
    return Simulator(WORLD).run()


def runner(spark, folder, name):
    found = Definitions(lambda: datasets.define(spark, f"file://{folder}/inbox", str(WORLD.start)))
    return Runner(spark, found, name, f"{folder}/checkpoints")


@pytest.fixture(scope="module")
def graph(spark, world, tmp_path_factory):
    folder = tmp_path_factory.mktemp("world")
    write(world[0], str(folder / "staging"))
    g = runner(spark, folder, "whole")
    g.staging, g.inbox = f"file://{folder}/staging", f"file://{folder}/inbox"
    pipeline.replay(g.update, g.staging, g.inbox, [str(d) for d in WORLD.dates], single_update=True)
    return g


def test_definitions_run_nothing(spark, tmp_path):
    """Kinds and names of all data sets; defining them needs no file and reads no table."""
    found = Definitions(lambda: datasets.define(spark, f"file://{tmp_path}/none", "2024-01-01"))
    kinds = {kind: {n for n, o in found.outputs.items() if type(o) is kind} for kind in (StreamingTable, MaterializedView, TemporaryView)}
    assert kinds[StreamingTable] == {*(f"bronze_{t.lower()}" for t in bronze.TABLES), "bank_change_feed", "controls_change_feed"}
    assert {*conform.SILVER, "dim_vendor_bank_scd2", "dim_vendor_controls_scd2", "gold_exceptions", "gold_vendor_risk", "gold_run_history", "gold_duplicate_candidates", "expectation_log"} <= kinds[MaterializedView]
    assert {f"rule_r0{k}" for k in range(1, 9)} | {"active_vendor"} <= kinds[TemporaryView]
    assert {f.target for f in found.flows} == set(found.outputs)


def test_specification_has_what_the_definitions_read():
    yaml = pytest.importorskip("yaml")
    folder = Path(datasets.__file__).parents[2] / "pipelines"
    spec = yaml.safe_load((folder / "spark-pipeline.yml").read_text())
    assert set(spec) <= {"name", "storage", "catalog", "database", "schema", "configuration", "libraries"} and {"name", "storage"} <= set(spec)
    (library,) = spec["libraries"]
    text = (folder / library["glob"]["include"]).read_text()
    assert all(key in text for key in spec["configuration"]) and all(isinstance(v, str) for v in spec["configuration"].values())


def test_same_seed_same_world(world):
    assert Simulator(WORLD).run()[0] == world[0]
    assert Simulator(World(seed=7)).run()[0] != world[0]


def test_ledger_balances(world):
    total = {}
    for tables in world[0].values():
        for r in tables["ACDOCA"]:
            total[r["RLDNR"], r["RBUKRS"], r["BELNR"], r["DOCLN"]] = float(r["HSL"])
    assert abs(sum(total.values())) < 1e-6


def test_no_changes_on_the_first_day(world):
    assert world[0][WORLD.start]["CDPOS"] == []


def test_rules_match_the_key(spark, graph, world):
    rows = [(c.rule_id, c.expected_flag, c.LIFNR, c.BUKRS, c.expected_first) for c in world[1] if c.rule_id != "DQ"]
    key = spark.createDataFrame(rows, "rule_id string, expected_flag boolean, LIFNR string, BUKRS string, expected_first date")
    report = verify.reconcile(graph.read("gold_exceptions"), key)
    verify.require(report)
    assert {r.rule_id for r in report.collect()} == {f"R0{k}" for k in range(2, 9)}


@pytest.mark.parametrize(
    ("variant", "table", "condition", "left"),
    [
        ("bank_key_present", "silver_vendor_bank", "BANKN = ''", 0),
        ("known_doc_type", "silver_journal_lines", "BLART = 'ZZ'", 0),
        ("routing_number_9_digits", "silver_vendor_bank", "length(BANKL) = 8", 1),
        ("known_payment_terms", "silver_vendor_company_code", "term_days IS NULL", 1),
        ("has_business_partner", "silver_vendor", "PARTNER IS NULL", 1),
        ("us_address", "silver_vendor", "COUNTRY != 'US'", 1),
    ],
)
def test_defects(spark, graph, world, variant, table, condition, left):
    planted = spark.createDataFrame([(c.LIFNR,) for c in world[1] if c.variant == variant], "LIFNR string")
    assert verify.defects(graph.read(table), condition, planted) == left
    failed = graph.read("expectation_log").where(F.col("expectation") == variant).agg(F.max("failed")).first()[0]
    assert failed > 0


def test_same_day_change_and_revert_are_two_versions(graph, world):
    lifnr = next(c.LIFNR for c in world[1] if c.variant == "same_day")
    assert graph.read("dim_vendor_bank_scd2").where(F.col("LIFNR") == lifnr).count() == 3


def test_control_history_fills_unchanged_fields(graph, world):
    lifnr = next(c.LIFNR for c in world[1] if c.rule_id == "R07" and c.expected_flag)
    rows = graph.read("dim_vendor_controls_scd2").where((F.col("LIFNR") == lifnr) & (F.col("BUKRS") == "1000")).orderBy("change_ts").collect()
    assert [(r.LFA1_CONFS, r.LFB1_REPRF) for r in rows] == [("", "X"), ("1", "X")]


def tables(graph):
    """Those that a rerun must not change: bronze tables have the time of loading."""
    return [n for n in graph.found.tables() if not n.startswith("bronze_")]


def test_feeds_are_what_the_batch_form_has(spark, graph):
    rows = scd2(graph.read("bank_change_feed"), ["LIFNR"], ["change_ts", "CHANGENR"], ["BANKS", "BANKL", "BANKN"])
    assert verify.fingerprints({"a": rows})["a"] == verify.fingerprints({"a": graph.read("dim_vendor_bank_scd2")})["a"]


def test_one_update_equals_one_for_each_date(spark, graph, tmp_path):
    g = runner(spark, tmp_path, "by_parts")
    inbox = f"file://{tmp_path}/inbox"
    for part in (WORLD.dates[:3], WORLD.dates[3:]):
        pipeline.replay(g.update, graph.staging, inbox, [str(d) for d in part], single_update=True)
    of = lambda x: verify.fingerprints({n: x.read(n) for n in tables(x)})
    assert verify.compare(of(g), of(graph)) == []


def test_rerun_and_rebuild_change_nothing(graph):
    assert pipeline.idempotent(graph.update, graph.read, tables(graph), graph.staging, graph.inbox, [str(WORLD.dates[-1])]) == {"rerun": [], "rebuild": []}


def test_updates_by_the_runner_of_the_specification(tmp_path):
    told = tmp_path / "told"
    script = tmp_path / "runner"
    script.write_text(f'#!/bin/sh\necho "$@" >> {told}\n')
    script.chmod(0o755)
    update = pipeline.spark_pipelines("spec.yml", (str(script),))
    update(False)
    update(True)
    assert told.read_text().splitlines() == ["run --spec spec.yml", "run --spec spec.yml --full-refresh-all"]


def test_exports_and_questions(spark, graph, world):
    serving.register({n: graph.read(n) for n in graph.found.tables()})
    serving.register({n: serving.export(spark, n) for n in serving.EXPORTS})
    lifnr = next(c.LIFNR for c in world[1] if c.variant == "same_day")
    last = WORLD.dates[-1]
    assert serving.ask(spark, "vendor", lifnr).count() == 1
    assert {r.rule_id for r in serving.ask(spark, "vendor_exceptions", lifnr, last).collect()} == {"R02", "R08"}
    assert [r.valid_to for r in serving.ask(spark, "bank_history", lifnr).collect()][-1] == "current"
    assert serving.ask(spark, "history").count() == WORLD.days * 7
    for name in ("dates", "vendor_count", "last_day", "high_severity", "top_risk"):
        assert serving.ask(spark, name).count() > 0
    assert serving.ask(spark, "ranking", last).first().risk_rank == 1
    assert serving.ask(spark, "duplicates", v=lifnr).count() == 0
    assert serving.ask(spark, "names", F.array(F.lit(lifnr))).count() == 1
    assert serving.ask(spark, "open_items", lifnr, last).count() == 1
    assert serving.ask(spark, "controls_history", lifnr).count() >= 1
