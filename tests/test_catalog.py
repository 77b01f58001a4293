"""Every registered query has rows or a reason, and its oracle names the same columns."""

import re

import pytest

import __spark_entry__
from mandrel.plans import adapters, catalog

SMALL = "/root/testdata/sf0.001"
WITHOUT_SQL = {"wratio_scores", "wratio_evaluation", "fellegi_sunter", "fingerprint"}


def test_every_query_has_an_oracle_or_is_listed():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == WITHOUT_SQL


def test_shapes_are_stated_before_they_are_used():
    for sql in catalog.oracle_sql().values():
        assert not re.search(r"\{events\}|\{part\}", sql)
    assert adapters.closed(["b_acdoca"]) == ["b_events", "b_acdoca"]


@pytest.mark.parametrize("name", ["vendor_conformed", "scd2_bank", "rule_r03_shared_bank", "pair_stats", "latest_version", "block_stats", "jw_scores", "crosstab_labels", "pr_curve", "match_weights", "tuned", "fold_evaluation", "controls_feed", "bank_feed_stream", "bank_history_by_batches", "evidence_r08", "evidence_typed", "skipped_pairs", "changed_dates", "transactions_of_archives", "stream_expectations", "serve_controls_history", "invoice_runs", "fingerprint_md5"])
def test_queries_equal_their_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in adapters.BASES:
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    ours = catalog.queries()[name](spark, SMALL)
    columns = sorted(ours.columns)
    theirs = c.execute(f"select {', '.join(columns)} from ({catalog.oracle_sql()[name]})").fetchall()
    key = lambda r: tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r)
    assert sorted(map(key, ours.select(*columns).collect())) == sorted(map(key, theirs))


def test_scores_and_labels_cover_both_passes(spark):
    q = {n: catalog.queries()[n](spark, SMALL) for n in ("candidate_pairs", "jw_scores", "label_and_fold", "fellegi_sunter", "fs_gamma_counts", "crosstab_labels", "wratio_scores")}
    pairs = lambda n: {(r.LIFNR_A, r.LIFNR_B) for r in q[n].collect()}
    want = pairs("candidate_pairs")
    assert pairs("jw_scores") == pairs("label_and_fold") == pairs("fellegi_sunter") == want
    assert q["fs_gamma_counts"].groupBy().sum("n").first()[0] == len(want) == sum(r.dev + r.test for r in q["crosstab_labels"].collect())
    frames = catalog.Frames(spark, SMALL)
    scored = catalog.matching.score_pairs(q["candidate_pairs"], frames.parties)
    assert pairs("wratio_scores") == {(r.LIFNR_A, r.LIFNR_B) for r in catalog.matching.candidates(scored, "WRatio", 0.9, 91).collect()}
    assert frames.scored.count() == len(want)


@pytest.mark.parametrize("name", ["pr_curve", "grid_curves"])
def test_recall_is_over_all_positives(spark, tmp_path, name):
    # Parts k and k + 700 share a key, brand and size.
    part = spark.range(1, 1401).selectExpr("id AS p_partkey", "concat('word', id % 700, ' name') AS p_name", "'kind' AS p_type", "concat('Brand#', id % 70) AS p_brand", "CAST(id % 5 AS INT) AS p_size")
    part.write.parquet(f"{tmp_path}/part.parquet")
    rows = catalog.queries()[name](spark, str(tmp_path)).where("threshold = 40").collect()
    assert rows and all((r.tp, r.recall) == (700, 1.0) for r in rows)


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1
