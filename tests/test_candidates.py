"""Candidate pairs are told apart where they meet, not by a comparison of all pairs."""

import itertools
import random

from mandrel.operators import matching


def test_pairs_of_several_blocks_come_once_and_are_not_shuffled(spark):
    rng = random.Random(3)
    rows = [(f"v{rng.randint(0, 40):02}", rng.choice(["", "a", "b", "c", None]), rng.choice(["", "x", "y", "z"])) for _ in range(70)]  # identities come again
    largest = 18
    size = lambda k, key: sum(r[k] == key for r in rows)
    want = set()
    for a, b in itertools.product(rows, rows):
        if a[0] < b[0] and any(a[k] and a[k] == b[k] and size(k, a[k]) <= largest for k in (1, 2)):
            want.add((a[0], b[0]))
    assert any(size(k, key) > largest for k in (1, 2) for key in {r[k] for r in rows if r[k]})
    got = matching.candidate_pairs(spark.createDataFrame(rows, "LIFNR string, area string, first_token string"), largest=largest)
    pairs = sorted(map(tuple, got.collect()))
    assert pairs == sorted(want)
    top = got._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]
    assert "Aggregate" not in top  # pairs are joined, and that is all


def test_compared_columns_come_with_the_pairs(spark):
    v = spark.createDataFrame([(f"v{k}", "a" if k < 6 else "b", f"name {k % 3}", f"road {k % 2}", "1") for k in range(9)] + [("v1", "a", "name 7", "", "2")], "LIFNR string, block string, name_norm string, address_norm string, zip5 string")
    pairs = matching.candidate_pairs(v, passes=("block",))
    carried = matching.comparisons(matching.candidate_pairs(v, passes=("block",), carried=matching.COMPARED), v)
    columns = ["LIFNR_A", "LIFNR_B", *matching.GAMMAS]
    rows = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert rows(carried) == rows(matching.comparisons(pairs, v)) != []
    assert "Join" not in carried._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]


def test_pairs_of_skipped_blocks_come_once_and_are_not_shuffled(spark):
    rng = random.Random(5)
    rows = [(f"v{k % 30:02}", rng.choice("ab"), rng.choice("xy"), " ".join(rng.sample(["one", "two", "six"], rng.randint(1, 3)))) for k in range(34)]  # four have several names
    want = set()
    for (a, *ka, x), (b, *kb, y) in itertools.product(rows, rows):
        s, t = set(x.split()), set(y.split())
        if a < b and any(p == q for p, q in zip(ka, kb, strict=True)) and 100 * len(s & t) >= 60 * len(s | t):
            want.add((a, b, len(s & t) / len(s | t)))
    got = matching.pairs_of_skipped(spark.createDataFrame(rows, "LIFNR string, area string, first_token string, name_norm string"), largest=3)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # Of identities with one name, pairs are joined and no more.
    plan = got._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union" and "Aggregate" not in plan.children().apply(0).toString()


def test_a_row_of_the_join_of_skipped_blocks_is_many_pairs(spark, monkeypatch):
    monkeypatch.setattr(matching, "SLICE", 8)
    monkeypatch.setattr(matching, "CHUNK", 3)
    rng = random.Random(6)
    rows = [(f"v{k:02}", rng.choice("ab"), rng.choice("xy"), rng.choice(["one two", "one two six", "six"])) for k in range(70)]
    rows += [("v69", "a", "x", "one"), ("v68", "b", "y", rows[68][3]), ("v67", "a", "", rows[67][3])]  # several names, or several blocks of one pass
    want = set()
    for (a, *ka, x), (b, *kb, y) in itertools.product(rows, rows):
        s, t = set(x.split()), set(y.split())
        if a < b and any(p == q != "" for p, q in zip(ka, kb, strict=True)) and 100 * len(s & t) >= 60 * len(s | t):
            want.add((a, b, len(s & t) / len(s | t)))
    got = matching.pairs_of_skipped(spark.createDataFrame(rows, "LIFNR string, area string, first_token string, name_norm string"), largest=3)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # What is joined has lists on both sides; pairs are made of a joined row and not shuffled.
    plan = got._jdf.queryExecution().optimizedPlan().children().apply(0).toString()
    assert plan.split("Join Inner")[0].count("Generate explode(m_") == 2
