import os
import random
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mandrel.functions import sap, similarity
from mandrel.functions.normalize import normalize_address, normalize_name, zip5
from tests import slow_similarity


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f("t")).first()[0]


@pytest.mark.parametrize(
    ("raw", "normal"),
    [
        ("Acme Widgets, Incorporated", "ACME WIDGETS INC"),
        ("Acme Widgets L.L.C.", "ACME WIDGETS LLC"),
        ("Acme Widgets L L C", "ACME WIDGETS LLC"),
        ("Smith and Jones", "SMITH & JONES"),
        ("Smith&Jones Company", "SMITH & JONES CO"),
        ("The Harbor Group Inc", "HARBOR GROUP INC"),
        ("Harbor Group Inc, The", "HARBOR GROUP INC"),
        ("Theodore Corp", "THEODORE CORP"),
        ("", ""),
        (None, ""),
    ],
)
def test_names(spark, raw, normal):
    assert one(spark, raw, normalize_name) == normal


@pytest.mark.parametrize(("raw", "normal"), [("12 North Main Street, Suite 4", "12 N MAIN ST STE 4"), ("P.O. Box 9", "PO BOX 9"), ("Post Office Box 9", "PO BOX 9"), ("1 Elm & Oak Avenue", "1 ELM AND OAK AVE"), (None, "")])
def test_addresses(spark, raw, normal):
    assert one(spark, raw, normalize_address) == normal


@pytest.mark.parametrize(("raw", "five"), [("12345-6789", "12345"), ("1234", ""), (" 98765 ", "98765"), (None, ""), ("", "")])
def test_zip(spark, raw, five):
    assert one(spark, raw, zip5) == five


def test_delivered_formats(spark):
    df = spark.createDataFrame([("20240131", "20240131081500", "12.345"), ("00000000", "99991231235959", "x"), ("", "20240101000000", "")], "d string, t string, a string")
    rows = df.select(sap.dats("d"), sap.stamp("t"), sap.amount("a")).collect()
    assert [r[0] for r in rows] == [date(2024, 1, 31), None, None]
    assert rows[0][1] == datetime(2024, 1, 31, 8, 15)
    assert [r[2] is None for r in rows] == [False, True, True]


def test_table_key_round_trip(spark):
    df = spark.createDataFrame([("0000012345", "US", "121000358", "0099")], "l string, s string, b string, n string")
    key = sap.encode_key((F.col("l"), 10), (F.col("s"), 3), (F.col("b"), 15), (F.col("n"), 18))
    got = df.select(key.alias("k")).select(*[sap.key_part("k", *sap.KEY_FIELDS[c]) for c in ("LIFNR", "BANKS", "BANKL", "BANKN")]).first()
    assert tuple(got) == ("0000012345", "US", "121000358", "0099")


def test_lookup(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [r[0] for r in df.select(sap.lookup({"a": 1}, "k")).collect()] == [1, None, None]


def test_articles_at_both_ends(spark):
    names = ["The The", "THE", "The Group Inc The", "Theatre", "a the", "The  A", "Bathe", "the the the"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(normalize_name("n")).collect()] == ["", "THE", "GROUP INC", "THEATRE", "A", "A", "BATHE", "THE"]


def score(f, a, b):
    return similarity.scores(f, [a], [b])[0]


# Scores that the literature's library gives for these strings.
@pytest.mark.parametrize(
    ("a", "b", "want"),
    [("COUNTY E11724 RD H 58", "E11724 COUNTY RD H58", 92.68293), ("RED INC", "RED SKY INC", 100.0), ("", "X", 0.0), ("A B", "A B", 100.0)],
)
def test_token_set(a, b, want):
    assert score(similarity.token_set_ratio, a, b) == pytest.approx(want, abs=1e-4)


def test_weighted_ratio_of_published_pairs():
    assert score(similarity.weighted_ratio, "LINDEBLAD MARK", "TRI COUNTY SEPTIC & SONS LLC") == pytest.approx(27.36, abs=1e-3)
    assert score(similarity.weighted_ratio, "PULIKLA TRIBE OF YUROK PEOPLE", "RESIGHINI RANCHERIA") == pytest.approx(27.0, abs=1e-3)
    assert score(similarity.weighted_ratio, "RED INC", "RED SKY INC") < 100
    assert score(similarity.weighted_ratio, "", "A") == 0


@pytest.mark.parametrize(("a", "b", "want"), [("MARTHA", "MARHTA", 0.961111), ("DIXON", "DICKSONX", 0.813333), ("DWAYNE", "DUANE", 0.84), ("", "A", 0.0), ("SAME", "SAME", 1.0)])
def test_jaro_winkler(a, b, want):
    assert score(similarity.jaro_winkler, a, b) == pytest.approx(want, abs=1e-5)


NAMES = "RED SKY BLUE ACME INC LLC CO GROUP OF THE & WIDGETS STEEL HARBOR MARINE 12 N MAIN ST STE é 漢字 SMITH JONES".split() + ["LONGWORD" * 9, "😀😀"]


def strings(rng, n, long):
    for _ in range(n):
        kind = rng.random()
        if kind < 0.03:
            yield rng.choice(["", " ", "  "])
        elif kind < 0.2:
            yield "".join(rng.choice("ABCDE ") for _ in range(rng.randint(1, 90 if long else 30)))
        elif kind < 0.25 and long:
            yield "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ  ") for _ in range(rng.randint(60, 200)))
        else:
            name = " ".join(rng.choice(NAMES[: len(NAMES) if long else -2]) for _ in range(rng.randint(1, 5)))
            yield name if rng.random() < 0.7 else name[: rng.randint(0, len(name))]


@pytest.mark.parametrize("name", ["ratio", "partial_ratio", "token_sort_ratio", "token_set_ratio", "partial_token_ratio", "weighted_ratio", "jaro_winkler"])
@pytest.mark.parametrize("long, n", [(True, 4_000), (False, 100_000)])
def test_batches_equal_single_pairs(name, long, n):
    if not long and name not in ("token_set_ratio", "weighted_ratio", "jaro_winkler"):
        n = 20_000
    rng = random.Random(n)
    a = list(strings(rng, n, long))
    b = [x if rng.random() < 0.03 else y for x, y in zip(a, strings(rng, n, long), strict=True)]
    slow = getattr(slow_similarity, name)
    fast = [x for k in range(0, n, 10_000) for x in similarity.scores(getattr(similarity, name), a[k : k + 10_000], b[k : k + 10_000])]
    assert fast == [slow(x, y) for x, y in zip(a, b, strict=True)]


def test_batches_are_split_to_fit(monkeypatch):
    rng = random.Random(1)
    a, b = list(strings(rng, 300, True)), list(strings(rng, 300, True))
    whole = [similarity.scores(f, a, b) for f in (similarity.weighted_ratio, similarity.jaro_winkler)]
    monkeypatch.setattr(similarity, "CELLS", 500)
    monkeypatch.setattr(similarity, "TOGETHER", 7)
    assert all((x == similarity.scores(f, a, b)).all() for x, f in zip(whole, (similarity.weighted_ratio, similarity.jaro_winkler), strict=True))
    assert len(similarity.scores(similarity.ratio, [], [])) == 0


def test_published_pairs(spark):
    """Every scored pair of the folder of CSV files that PUBLISHED_PAIRS names: nine tenths name, one tenth address."""
    folder = os.environ.get("PUBLISHED_PAIRS")
    if not folder:
        pytest.skip("PUBLISHED_PAIRS is not set")
    seen = 0
    for path in sorted(Path(folder).rglob("*.csv")):
        rows = spark.read.csv(str(path), header=True, multiLine=True, escape='"')
        if not {"name_A", "address_A", "score"} <= set(rows.columns):
            continue
        rows = rows.where("score IS NOT NULL")
        sides = {f"{kind}{side}": f(f"{kind}_{side}") for side in "AB" for kind, f in (("name", normalize_name), ("address", normalize_address))}
        got = rows.select(F.col("score").cast("double").alias("want"), (0.9 * similarity.SCORERS["WRatio"](sides["nameA"], sides["nameB"]) + 0.1 * similarity.SCORERS["token_set_ratio"](sides["addressA"], sides["addressB"])).alias("got"))
        for r in got.collect():
            assert r.got == pytest.approx(r.want, abs=0.0501 if "notes" in rows.columns else 1e-4)
            seen += 1
    print(seen, "pairs")
    assert seen


def test_vectorised_scores_take_nulls(spark):
    df = spark.createDataFrame([("A", None), ("A B", "B A")], "a string, b string")
    assert [r[0] for r in df.select(similarity.SCORERS["token_set_ratio"]("a", "b")).collect()] == [0.0, 100.0]
