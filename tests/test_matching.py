import random
import zipfile

import pytest
from pyspark.sql import functions as F

from mandrel.operators import matching as m
from mandrel.sources import archives, zipped


@pytest.fixture(scope="module")
def parties(spark):
    rows = [
        ("1", "RED SKY INC", "1 MAIN ST", "VA", "22101"), ("2", "RED SKY LLC", "1 MAIN ST", "VA", "22102"), ("3", "BLUE SKY INC", "9 OAK AVE", "VA", "22103"),
        ("4", "RED BARN CO", "4 ELM ST", "MD", "20850"), ("5", "GREEN CO", "5 ELM ST", "MD", "20851"),
    ]
    return m.block_keys(spark.createDataFrame(rows, "LIFNR string, name_norm string, address_norm string, state string, zip5 string")).cache()


def pairs(df):
    return {(r.LIFNR_A, r.LIFNR_B) for r in df.collect()}


def test_blocks_and_pairs(parties):
    assert pairs(m.candidate_pairs(parties)) == {("1", "2"), ("1", "3"), ("2", "3"), ("4", "5"), ("1", "4"), ("2", "4")}
    stats = {(r["pass"], r.key): (r.n, r.pairs) for r in m.blocks(parties).collect()}
    assert stats == {("area", "VA|221"): (3, 3), ("area", "MD|208"): (2, 1), ("first_token", "RED"): (3, 3)}


def test_large_blocks_are_skipped_and_reported(parties):
    assert pairs(m.candidate_pairs(parties, largest=2)) == {("4", "5")}
    assert m.blocks(parties, largest=2).where("skipped").count() == 2


def test_blank_keys_make_no_block(spark):
    v = m.block_keys(spark.createDataFrame([("1", "", "", "22101"), ("2", "", "", "22101")], "LIFNR string, name_norm string, state string, zip5 string"))
    assert m.candidate_pairs(v).count() == 0


def test_scores(parties):
    s = {(r.LIFNR_A, r.LIFNR_B): r for r in m.score_pairs(m.candidate_pairs(parties), parties).collect()}
    assert s["1", "2"].address_score == 100.0
    assert s["1", "2"].name_WRatio > s["1", "4"].name_WRatio


def test_labels(spark):
    key = spark.createDataFrame([("1", "u", ""), ("2", "u", ""), ("3", "w", "p"), ("4", "x", "p"), ("5", "p", "")], "LIFNR string, uei string, parent_uei string")
    every = key.select(F.col("LIFNR").alias("LIFNR_A")).crossJoin(key.select(F.col("LIFNR").alias("LIFNR_B"))).where("LIFNR_A < LIFNR_B")
    got = {(r.LIFNR_A, r.LIFNR_B): r.label for r in m.label_pairs(every, key).collect()}
    assert got["1", "2"] == "match" and got["3", "4"] == "related" and got["3", "5"] == "related" and got["1", "3"] == "non_match"
    assert pairs(m.positive_pairs(key)) == {("1", "2")}


def test_curve_counts_positives_that_blocking_missed(spark):
    s = spark.createDataFrame([(95.0, "match"), (80.0, "match"), (99.0, "non_match"), (50.0, "related")], "score double, label string")
    r = m.curve(s, "score", 4).where("threshold = 90").first()
    assert (r.tp, r.fp, r.precision, r.recall) == (1, 1, 0.5, 0.25)
    top = m.curve(s, "score", 4).where("threshold = 100").first()
    assert (top.tp, top.fp, top.precision, top.recall, top.f1) == (0, 0, 1.0, 0.0, 0.0)


def test_positives_counts_the_pairs(spark):
    key = spark.createDataFrame([("1", "u"), ("2", "u"), ("3", "u"), ("3", "u"), ("4", "w"), ("5", None), ("6", None)], "LIFNR string, uei string")
    assert m.positives(key) == m.positive_pairs(key).count() == 5
    assert m.positives(key.where("false")) == 0


def test_tune_prefers_the_first_choice_and_the_lowest_threshold(spark):
    s = spark.createDataFrame([(90.0, 90.0, 90.0, "match"), (40.0, 40.0, 40.0, "non_match")], "name_token_set_ratio double, name_WRatio double, address_score double, label string")
    assert m.tune(s, 1) == ("token_set_ratio", 1.0, 41)


def slow_tune(rows, positives, scorers):
    best = None
    for k, (s, w) in enumerate((s, w) for s in scorers for w in m.WEIGHTS):
        for t in m.THRESHOLDS:
            hits = [label for label, name, address in rows if w * name[s] + (1 - w) * address >= t]
            tp, fp = hits.count("match"), hits.count("non_match")
            p, r = tp / (tp + fp) if tp + fp else 1.0, tp / positives if positives else 0.0
            f1 = 2 * p * r / (p + r) if p + r else 0.0
            if best is None or round(f1, 12) > best[0]:
                best = (round(f1, 12), s, w, t)
    return best[1:]


def test_histogram_tells_what_pairs_tell(spark):
    rng = random.Random(5)
    names = ["RED SKY INC", "RED SKY", "SKY RED INC", "BLUE BARN CO", "BLUE BARNS CO", "GREEN", "RED SKY INTERNATIONAL MARINE"]
    v = m.block_keys(spark.createDataFrame([(f"{k:03d}", rng.choice(names), rng.choice(["1 MAIN ST", "2 MAIN ST", "9 ELM AVE"]), "VA", "22101", f"u{rng.randint(0, 14)}", rng.choice(["", "p"])) for k in range(45)], "LIFNR string, name_norm string, address_norm string, state string, zip5 string, uei string, parent_uei string"))
    pairs = m.label_pairs(m.candidate_pairs(v), v)
    scored = m.score_pairs(pairs, v).join(pairs, ["LIFNR_A", "LIFNR_B"]).withColumn("fold", m.fold()).cache()
    counted = m.histogram(scored, by=("fold",))
    assert counted.count() < scored.count() / 2 and counted.agg(F.sum("n")).first()[0] == scored.count()
    positives = {r["fold"]: r.positives for r in m.positives_by_fold(v).collect()}
    assert sum(positives.values()) == m.positives(v)
    rows = {f: [(r.label, {"token_set_ratio": r.name_token_set_ratio, "WRatio": r.name_WRatio}, r.address_score) for r in scored.collect() if r["fold"] == f] for f in (0, 1)}
    assert m.tune(counted.where("fold = 0"), positives[0]) == m.tune(scored.where("fold = 0"), positives[0]) == slow_tune(rows[0], positives[0], ("token_set_ratio", "WRatio"))
    got = {(r.method, r["fold"]): r for r in m.evaluated(scored.drop("fold"), v).collect()}
    assert set(got) == {("chosen", 0), ("chosen", 1), ("baseline", 0), ("baseline", 1)}
    for (method, f), r in got.items():
        scorer, weight, threshold = slow_tune(rows[0], positives[0], ("token_set_ratio", "WRatio") if method == "chosen" else ("token_set_ratio",))
        hits = [label for label, name, address in rows[f] if weight * name[scorer] + (1 - weight) * address >= threshold]
        assert (r.scorer, r.weight, r.threshold, r.tp, r.fp) == (scorer, weight, threshold, hits.count("match"), hits.count("non_match"))
        assert r.recall == pytest.approx(hits.count("match") / positives[f])


def test_fold_is_fixed_and_even(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("LIFNR_A"), (F.col("id") + 1).cast("string").alias("LIFNR_B"))
    share = df.select(F.avg(m.fold())).first()[0]
    assert 0.45 < share < 0.55


def test_candidates_round_before_they_compare(spark):
    s = spark.createDataFrame([("1", "2", 90.996, 90.996), ("1", "3", 80.0, 80.0)], "LIFNR_A string, LIFNR_B string, name_WRatio double, address_score double")
    rows = m.candidates(s, "WRatio", 0.9, 91).collect()
    assert [(r.score, r.above_threshold) for r in rows] == [(91.0, True)]


def test_fellegi_sunter_ranks_likely_pairs_first(parties):
    got = {(r.LIFNR_A, r.LIFNR_B): r.match_weight for r in m.fellegi_sunter(parties, m.candidate_pairs(parties)).collect()}
    assert got["1", "2"] > got["4", "5"]


def test_em_recovers_shares():
    u = {"g_name": {0: 0.9, 1: 0.025, 2: 0.025, 3: 0.025, 4: 0.025}, "g_address": {0: 0.94, 1: 0.02, 2: 0.02, 3: 0.02}, "g_zip": {0: 0.9, 1: 0.1}}
    counts = [((4, 3, 1), 90), ((0, 0, 0), 900), ((4, 0, 0), 20), ((0, 3, 1), 10)]
    w = m.em(counts, u, 0.1)
    assert w.m["g_name"][4] > 0.7 and 0.05 < w.prior < 0.2


def test_judge_ignores_undecided(spark):
    df = spark.createDataFrame([(95.0, "duplicate"), (None, "duplicate"), (92.0, "not_duplicate"), (99.0, "unsure")], "s double, label string")
    assert tuple(m.judge(df, "s", 91).select("tp", "fp", "fn").first()) == (1, 1, 1)


def test_error_samples(spark):
    s = spark.createDataFrame([("1", "2", 95.0, "non_match"), ("1", "3", 50.0, "match")], "LIFNR_A string, LIFNR_B string, score double, label string")
    pos = spark.createDataFrame([("1", "3"), ("7", "8")], "LIFNR_A string, LIFNR_B string")
    got = {k: pairs(v) for k, v in m.errors(s, pos, "score", 91).items()}
    assert got == {"false_positives": {("1", "2")}, "false_negatives": {("1", "3")}, "missed": {("7", "8")}}


HEADER = "recipient_uei,recipient_name_raw,recipient_doing_business_as_name,recipient_parent_uei,recipient_parent_name,recipient_address_line_1,recipient_city_name,recipient_state_code,recipient_zip_code,recipient_country_code"
ROWS = """U1,Acme Inc,,P,Parent,1 Main Street,Town,VA,22101,USA
U1,Acme Incorporated,,P,Parent,1 Main St,Town,VA,22101,USA
U1,Acme Inc,,P,Parent,1 Main St,Town,VA,22101,USA
U2,Bolt  LLC,,P,Parent,2 Oak Ave,Town,VA,22102,
U3,REDACTED DUE TO PII,,,,3 Elm,Town,VA,22103,USA
U4,Foreign Co,,,,4 Elm,Town,,,CAN
,No Key,,,,5 Elm,Town,VA,22105,USA"""


@pytest.fixture(scope="module")
def master(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("zips")
    with zipfile.ZipFile(folder / "FY2025_014_Contracts_Full_1.zip", "w") as z:
        z.writestr("part.csv", f"{HEADER}\n{ROWS}\n")
    return archives.vendors(archives.transactions(spark, str(folder))).cache()


def test_archives_become_vendors(master):
    rows = {(r.uei, r.name_raw, r.address_norm): r for r in master.collect()}
    assert set(rows) == {("U1", "Acme Inc", "1 MAIN ST"), ("U1", "Acme Incorporated", "1 MAIN ST"), ("U2", "Bolt LLC", "2 OAK AVE")}
    assert rows["U1", "Acme Inc", "1 MAIN ST"].transaction_count == 2


def test_pair_stats(master):
    r = archives.pair_stats(master).first()
    assert (r.vendor_rows, r.distinct_ueis, r.positive_pairs_all, r.positive_pairs_diff_name, r.positive_pairs_diff_norm_name, r.related_pairs_same_parent) == (3, 2, 1, 1, 0, 2)


def test_sample_keeps_groups_of_spellings(master):
    assert {r.uei for r in archives.sample(master, 2).collect()} == {"U1"}
    assert archives.sample(master, 3).count() == 3


def slow_sample(groups, target):
    left, out = target, set()
    for u, n in groups:
        if n <= left:
            out.add(u)
            left -= n
    return out


@pytest.mark.parametrize("target", [0, 1, 7, 30, 55, 500])
def test_groups_that_do_not_fit_are_passed_over(spark, target):
    sizes = [("a", 9), ("b", 14), ("c", 2), ("d", 40), ("e", 3), ("f", 5), ("g", 1), ("h", 22), ("i", 2), ("j", 8)]
    df = spark.createDataFrame(sizes, "uei string, n long").withColumn("h", F.xxhash64(F.lit(42), "uei"))
    order = [(r.uei, r.n) for r in df.orderBy("h", "uei").collect()]
    assert {r.uei for r in archives.fitting(df, target).collect()} == slow_sample(order, target)


def test_sample_of_many_groups(spark):
    rows = [(f"m{k}", f"name {j % 2}", f"{j} ST") for k in range(12) for j in range(2 + k)] + [(f"s{k}", "one name", "1 ST") for k in range(40)]
    df = spark.createDataFrame(rows, "uei string, name_raw string, address_norm string")
    for target in (5, 40, 120):
        got = [tuple(r) for r in archives.sample(df, target).collect()]
        assert got == sorted(got) and len(got) <= target
        many = {u for u, *_ in got if u.startswith("m")}
        assert all(sum(u == x for u, *_ in got) == 2 + int(x[1:]) for x in many)  # whole groups
    assert archives.sample(df, 120).count() == 120 and archives.sample(df, 10_000).count() == len(rows)


def test_hard_cases_and_their_labels(spark, tmp_path):
    v = spark.createDataFrame([(str(k), f"N{k % 3}", f"N{k % 3}", "1 ST", "T", "VA", "22101") for k in range(12)], "LIFNR string, name string, name_norm string, address string, city string, state string, zip5 string")
    rows = [(str(a), str(b), float(60 + (a * b) % 40), ("match", "non_match", "related")[(a + b) % 3]) for a in range(12) for b in range(a + 1, 12)]
    scored = spark.createDataFrame(rows, "LIFNR_A string, LIFNR_B string, score double, label string")
    kinds = {}
    for a, b, s, label in rows:
        same = int(a) % 3 == int(b) % 3
        kind = "same_name" if same and label != "match" else "near_threshold" if not same and 74 <= s <= 86 else "missed" if label == "match" and s < 80 else "related" if label == "related" and s >= 80 else None
        if kind:
            kinds[a, b] = kind
    got = m.strata(scored, v, "score", 80)
    assert {(r.LIFNR_A, r.LIFNR_B): r.stratum for r in got.collect()} == kinds
    sheet = m.hard_cases(scored, v, "score", 80, {"same_name": 3, "near_threshold": 2}).cache()
    assert sheet.groupBy("stratum").count().collect() and sheet.count() == min(3, list(kinds.values()).count("same_name")) + min(2, list(kinds.values()).count("near_threshold"))
    labelled = sheet.withColumn("label", F.when(F.col("pair_id") == "H001", "").otherwise("duplicate"))
    labelled.drop("stratum").coalesce(1).write.csv(str(tmp_path / "sheet"), header=True)
    read = m.read_labels(spark, str(tmp_path / "sheet"))
    assert read.count() == sheet.count() - 1 and dict(read.dtypes)["score"] == "string"
    key = sheet.select("pair_id", "LIFNR_A", "LIFNR_B", "stratum", F.lit("match").alias("uei_label"))
    assert m.labelled_scores(read, key, scored, ["score"]).count() == read.count()


def test_outputs_are_written(spark, tmp_path):
    one = spark.createDataFrame([(1, 0.5)], "threshold int, f1 double")
    m.write_outputs(str(tmp_path), one, one, {"missed": one}, one)
    assert spark.read.parquet(f"{tmp_path}/candidates").count() == spark.read.json(f"{tmp_path}/metrics").count() == spark.read.csv(f"{tmp_path}/errors_missed", header=True).count() == 1


def test_vendor_file_has_no_key(spark, master, tmp_path):
    archives.write(master, str(tmp_path / "v"), str(tmp_path / "l"))
    v, k = spark.read.parquet(str(tmp_path / "v")), spark.read.parquet(str(tmp_path / "l"))
    assert "uei" not in v.columns and sorted(r.vendor_id for r in v.collect()) == ["V000001", "V000002", "V000003"]
    assert v.join(k, "vendor_id").count() == 3


def test_headers_resolve_or_fail():
    of = lambda line: zipped.resolved(line.split(","), archives.HEADERS, archives.NEEDED)
    assert of(HEADER)["parent_name_raw"] == "recipient_parent_name"
    assert of("recipient_zip_code,recipient_zip_4_code," + HEADER)["zip"] == "recipient_zip_4_code"
    with pytest.raises(ValueError, match="uei"):
        of("recipient_name_raw")


def test_members_are_partitions(spark, tmp_path):
    heads = HEADER.split(",")
    other = [h.replace("recipient_zip_code", "recipient_zip_4_code") for h in heads if h != "recipient_doing_business_as_name"][::-1]
    with zipfile.ZipFile(tmp_path / "FY1_Full_a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("one.csv", "\ufeff" + HEADER + '\nU1,"Acme, ""The"" Inc",dba,,,"1 Main\nSt",T,VA,22101,USA\n\nU2,short\n')
        z.writestr("two.csv", ",".join(other).encode() + b"\nUSA,22102,VA,T,2 Oak,,P,B\xffd,U3\n")
        z.writestr("readme.txt", "no table")
    with zipfile.ZipFile(tmp_path / "FY2_Full_b.zip", "w") as z:
        z.writestr("empty.csv", HEADER + "\n")
        z.writestr("in/three.csv", HEADER + "\n" + "\n".join(f"V{k},N,,,,A,T,VA,1,USA" for k in range(20_000)))
    zipfile.ZipFile(tmp_path / "other.zip", "w").close()
    for folder in (str(tmp_path), f"file://{tmp_path}"):
        df = archives.transactions(spark, folder)
        assert df.rdd.getNumPartitions() == 4 and df.count() == 20_003
        rows = {r.uei: r for r in df.where("uei NOT LIKE 'V%'").collect()}
        assert (rows["U1"].name_raw, rows["U1"].address_line_1, rows["U1"].zip, rows["U1"].source_file) == ('Acme, "The" Inc', "1 Main\nSt", "22101", "FY1_Full_a.zip")
        assert rows["U2"].name_raw == "short" and rows["U2"].city == "" and set(df.columns) == {*archives.HEADERS, "source_file"}
        assert (rows["U3"].name_raw, rows["U3"].zip, rows["U3"].dba_name, rows["U3"].country) == ("B\ufffdd", "22102", "", "USA")


def test_archives_without_what_is_needed(spark, tmp_path):
    with pytest.raises(Exception, match="no archive members"):
        archives.transactions(spark, str(tmp_path)).count()
    with zipfile.ZipFile(tmp_path / "FY1_Full_a.zip", "w") as z:
        z.writestr("one.csv", "recipient_name_raw\nx\n")
    with pytest.raises(Exception, match="no header for"):
        archives.transactions(spark, str(tmp_path)).count()


@pytest.mark.parametrize("percent", [50, 60, 75, 100])
def test_similar_names_of_skipped_blocks_by_brute_force(spark, percent):
    rng = random.Random(percent)
    words = [f"W{k}" for k in range(14)] + ["THE", "INC"] * 3
    rows = [(f"{k:03d}", " ".join(rng.choice(words) for _ in range(rng.randint(0, 7))), "VA", rng.choice(["22101", "22199", "30000"])) for k in range(160)]
    v = m.block_keys(spark.createDataFrame(rows, "LIFNR string, name_norm string, state string, zip5 string"))
    got = {(r.LIFNR_A, r.LIFNR_B): r.similarity for r in m.pairs_of_skipped(v, percent, largest=12).collect()}
    sizes = {}
    keys = {k: {("area", f"VA|{z[:3]}"), *([("first_token", name.split(" ")[0])] if name else [])} for k, name, _, z in rows}
    for own in keys.values():
        for b in own:
            sizes[b] = sizes.get(b, 0) + 1
    want = {}
    for x, (a, name_a, *_) in enumerate(rows):
        for b, name_b, *_ in rows[x + 1 :]:
            p, q = set(name_a.split()), set(name_b.split())
            if p and q and any(sizes[k] > 12 for k in keys[a] & keys[b]) and 100 * len(p & q) >= percent * len(p | q):
                want[a, b] = len(p & q) / len(p | q)
    assert got == pytest.approx(want) and len(want) > 10
    assert m.pairs_of_skipped(v, percent).count() == 0
