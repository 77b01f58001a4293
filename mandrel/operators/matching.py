"""Entity resolution: block, score, label, tune and evaluate; and a Fellegi-Sunter model beside it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mandrel.functions.normalize import normalize_address, normalize_name
from mandrel.functions.similarity import JARO_WINKLER, SCORERS, token_set_ratio, vectorised
from mandrel.session import written

LARGEST = 1000
#: A table of so many names at most goes to every task.
SMALL = 200_000
WEIGHTS = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5)
THRESHOLDS = range(40, 101)
#: Match weights, in log2 odds, at which a curve is read.
WEIGHT_THRESHOLDS = tuple(-10 + k / 4 for k in range(201))
#: Pairs this far below the threshold are kept for review.
NEAR_MISS = 10
ADDRESS_SCORE = vectorised(token_set_ratio)


def vendors(lfa1: DataFrame, adrc: DataFrame) -> DataFrame:
    """Regular vendors with name and address, also in normal form."""
    a = adrc.select(F.col("ADDRNUMBER").alias("ADRNR"), "STREET", "PO_BOX", F.col("CITY1").alias("city"), F.col("REGION").alias("state"), F.col("POST_CODE1").alias("zip5"))
    v = lfa1.where("KTOKK = 'KRED'").select("LIFNR", "ADRNR", F.col("NAME1").alias("name")).join(a, "ADRNR")
    street = F.when(F.col("STREET") != "", F.col("STREET")).otherwise(F.concat(F.lit("PO BOX "), "PO_BOX"))
    return v.select("LIFNR", "name", street.alias("address"), "city", "state", "zip5", normalize_name("name").alias("name_norm"), normalize_address(street).alias("address_norm"))


def labels(answers: DataFrame, key_map: DataFrame, v: DataFrame) -> DataFrame:
    """The answer key of the vendors that are there."""
    return answers.join(key_map, "vendor_id").join(v.select("LIFNR"), "LIFNR", "left_semi").select("LIFNR", "uei", "parent_uei")


def block_keys(v: DataFrame) -> DataFrame:
    """Local area and first word of the name; blank where the input is missing."""
    zip3 = F.substring("zip5", 1, 3)
    area = F.when((F.col("state") != "") & (F.length(zip3) == 3), F.concat_ws("|", "state", zip3)).otherwise(F.lit(""))
    return v.withColumns({"area": area, "first_token": F.coalesce(F.split_part("name_norm", F.lit(" "), F.lit(1)), F.lit(""))})


def blocks(v: DataFrame, passes: Sequence[str] = ("area", "first_token"), largest: int = LARGEST) -> DataFrame:
    """Size and pairs of every block, and whether it is skipped for its size."""
    keys = v.select(F.explode(F.array(*[F.struct(F.lit(p).alias("pass"), F.col(p).alias("key")) for p in passes])).alias("b")).select("b.*")
    n = F.col("n")
    return keys.where("key != ''").groupBy("pass", "key").agg(F.count("*").alias("n")).where("n > 1").withColumns({"skipped": n > largest, "pairs": F.when(n > largest, F.lit(0)).otherwise((n * (n - 1) / 2).cast("long"))})


def candidate_pairs(v: DataFrame, identity: str = "LIFNR", passes: Sequence[str] = ("area", "first_token"), largest: int = LARGEST, carried: Sequence[str] = ()) -> DataFrame:
    """Distinct pairs (identity_A < identity_B) that share a block. Blocks over `largest` are skipped: a cap that is the feature, and blocks() reports them.

    carried: columns of v that come with either side, as column_A and column_B, so that pairs needn't meet v again.
    """
    n = len(passes)
    keyed = v.select(identity, *[F.col(p).alias(f"__{k}") for k, p in enumerate(passes)])
    for k in range(n):
        size = keyed.where(F.col(f"__{k}") != "").groupBy(f"__{k}").agg(F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") <= largest))
        keyed = keyed.join(size.select(f"__{k}", F.lit(True).alias(f"__ok{k}")), f"__{k}", "left")
    # What an identity's blocks are, in order: a pair counts in the first block that its sides share, so no pair has to be told from its copies.
    block = F.array(*[F.when(F.col(f"__ok{k}"), F.struct(F.lit(k).alias("pass"), F.col(f"__{k}").alias("key"))) for k in range(n)])
    known = keyed.groupBy(identity).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_compact(block))))).alias("blocks")).where(F.size("blocks") > 0)
    known = known.join(v.select(identity, *carried), identity) if carried else known
    members = known.select(identity, *carried, F.when(F.size("blocks") > 1, F.col("blocks")).alias("blocks"), F.explode("blocks").alias("block"))
    # Few members make many pairs: as many tasks as there are partitions, however small the members are.
    members = members.repartition(int(v.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block")
    told = [identity, *carried]
    a, b = (members.select("block", F.col("blocks").alias(f"blocks_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in told]) for x in "AB")
    met = a.join(b, "block").where(F.col(f"{identity}_A") < F.col(f"{identity}_B"))
    only = F.col("blocks_A").isNull() | F.col("blocks_B").isNull() | (F.col("block") == F.col("blocks_A")[0])
    return met.where(only | (F.col("block") == F.array_min(F.array_intersect("blocks_A", "blocks_B")))).select(*[f"{c}_{x}" for c in told for x in "AB"])


def skipped_members(v: DataFrame, identity: str = "LIFNR", passes: Sequence[str] = ("area", "first_token"), largest: int = LARGEST, name: str = "name_norm") -> DataFrame:
    """Members of the blocks that candidate_pairs skips: pass, key, identity, words (distinct, sorted) of the name. A name without words is left out."""
    words = F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(name, F.lit("")), " "), lambda w: w != "")))
    keys = F.explode(F.array(*[F.struct(F.lit(p).alias("pass"), F.col(p).alias("key")) for p in passes]))
    rows = v.select(F.col(identity), words.alias("words"), keys.alias("b")).select(identity, "words", "b.*").where((F.col("key") != "") & (F.size("words") > 0))
    return rows.join(blocks(v, passes, largest).where("skipped").select("pass", "key"), ["pass", "key"])


def similar_names(members: DataFrame, percent: int = 60) -> DataFrame:
    """pass, key, words_A, words_B, both, either: sets of words in one block whose Jaccard similarity is `percent` or more, exactly; a set
    that several members have is one row, and meets itself.

    Sets are compared by prefix and length: with its words in order of rarity, a set shares one of its first
    size - ceil(percent * size / 100) + 1 words with any set that is as similar, and no set less than `percent` of its size is. Only sets that
    meet by a rare word are compared, so a block costs what its similar names cost, not the square of its members.
    """
    sets = members.select("pass", "key", "words").distinct()
    word = sets.select("pass", "key", "words", F.explode("words").alias("word"))
    rarity = word.groupBy("pass", "key", "word").agg(F.count("*").alias("n"))
    ranked = word.join(rarity, ["pass", "key", "word"]).groupBy("pass", "key", "words").agg(F.array_sort(F.collect_list(F.struct("n", "word"))).alias("r"))
    size = F.size("words")
    prefix = (size - F.floor((percent * size + 99) / 100) + 1).cast("int")
    probe = ranked.select("pass", "key", "words", size.alias("size"), F.explode(F.transform(F.slice("r", F.lit(1), prefix), lambda x: x["word"])).alias("word"))
    a, b = (probe.select("pass", "key", "word", F.col("words").alias(f"words_{x}"), F.col("size").alias(f"size_{x}")) for x in "AB")
    near = (100 * F.least("size_A", "size_B") >= percent * F.greatest("size_A", "size_B")) & (F.array_join("words_A", " ") < F.array_join("words_B", " "))
    met = a.join(b, ["pass", "key", "word"]).where(near).select("pass", "key", "words_A", "words_B").distinct()
    both = F.size(F.array_intersect("words_A", "words_B"))
    met = met.withColumns({"both": both, "either": F.size("words_A") + F.size("words_B") - both}).where(100 * F.col("both") >= percent * F.col("either"))
    same = sets.select("pass", "key", F.col("words").alias("words_A"), F.col("words").alias("words_B"), size.alias("both"), size.alias("either"))
    return met.unionByName(same)


#: Identities with one set of words go into slices of about so many at most, which tasks share, and a slice into chunks, which are rows. A chunk that
#: meets a slice makes SLICE * CHUNK pairs before any is passed on.
SLICE, CHUNK = 2048, 32


def pairs_of_skipped(v: DataFrame, percent: int = 60, identity: str = "LIFNR", passes: Sequence[str] = ("area", "first_token"), largest: int = LARGEST) -> DataFrame:
    """Distinct pairs of skipped blocks with similar names, with their similarity; beside candidate_pairs, whose cap stays.

    Pairs are as many as the square of a name's bearers. A row of the join is two chunks of these, so a pair costs two steps of a loop and its own row.
    """
    # Names are brought into normal form once, not for each table that is made of them.
    v = written(v.select(identity, "name_norm", *passes), "named")
    members = written(skipped_members(v, identity, passes, largest).distinct(), "members")
    # The block of each pass but the last, and whether an identity has several names, or blocks of one pass: such an identity may make a row twice.
    own = [F.max(F.when(F.col("pass") == p, F.col("key"))).alias(f"__{k}") for k, p in enumerate(passes[:-1])]
    several = (F.size(F.collect_set("words")) > 1) | (F.size(F.collect_set(F.struct("pass", "key"))) > F.size(F.collect_set("pass")))
    members = written(members.join(members.groupBy(identity).agg(*own, several.alias("several")), identity), "skipped")
    named, plain = ["pass", "key", "words"], members.where("NOT several")
    n = F.count("*")
    slices = F.ceil(n / SLICE).cast("int")
    sizes = plain.groupBy(*named).agg(slices.alias("slices"), F.ceil(n / (slices * CHUNK)).cast("int").alias("chunks"))
    near = similar_names(members, percent).join(sizes.select("pass", "key", F.col("words").alias("words_A"), "slices"), ["pass", "key", "words_A"], "left")
    near = written(near.select("pass", "key", "words_A", "words_B", (F.col("both") / F.col("either")).alias("similarity"), "slices"), "similar")
    # What a pair may share before this block: the first block that it shares tells it, so no pair is told from its copies.
    before = [F.when(F.col("pass").isin(*passes[k + 1 :]), F.col(f"__{k}")).alias(f"before_{k}") for k in range(len(passes) - 1)]
    place = {"slice": F.pmod(F.xxhash64(identity), "slices").cast("int"), "chunk": F.pmod(F.hash(identity), "chunks")}
    cut = plain.join(sizes, named).withColumns(place).groupBy(*named, "slice", "chunk").agg(F.collect_list(F.struct(identity, *before)).alias("m"))
    cut = written(cut.drop("chunk"), "chunks")
    a, b = (cut.select("pass", "key", *[F.col(c).alias(f"{c}_{x}") for c in ("words", "slice", "m")]) for x in "AB")
    key = ["pass", "key", "words_A", "slice_A"]
    tasks = int(v.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    same = F.col("words_A") == F.col("words_B")
    met = near.where("slices > 0").withColumn("slice_A", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).join(b, ["pass", "key", "words_B"]).where(~same | (F.col("slice_B") >= F.col("slice_A")))
    # One side comes row by row, and meets the few chunks of a slice.
    met = met.select(*key, "similarity", (same & (F.col("slice_A") == F.col("slice_B"))).alias("within"), "m_B").repartition(tasks, *key).join(a.repartition(tasks, *key).hint("merge"), key)
    met = met.select("similarity", "within", "m_A", F.explode("m_B").alias("b")).select("similarity", "within", "b", F.explode("m_A").alias("a"))
    a, b = F.col(f"a.{identity}"), F.col(f"b.{identity}")
    first = [F.coalesce(F.col(f"a.before_{k}") != F.col(f"b.before_{k}"), F.lit(True)) for k in range(len(passes) - 1)]
    pair = lambda rows, a, b: rows.select(F.least(a, b).alias(f"{identity}_A"), F.greatest(a, b).alias(f"{identity}_B"), "similarity")
    once = met.where(reduce(Column.__and__, first, ~F.col("within") | (a < b)))
    # Those that may come twice are few, and are told from their copies.
    again = []
    for left, right in (("several", "true"), ("NOT several", "several")):
        rows = near
        for side, some in (("A", left), ("B", right)):
            rows = rows.join(members.where(some).select("pass", "key", F.col("words").alias(f"words_{side}"), F.col(identity).alias(f"{identity}_{side}")), ["pass", "key", f"words_{side}"])
        x, y = F.col(f"{identity}_A"), F.col(f"{identity}_B")
        again.append(pair(rows.where(x != y), x, y))
    return pair(once, a, b).unionByName(again[0].unionByName(again[1]).distinct())


def _both(pairs: DataFrame, v: DataFrame, columns: Sequence[str]) -> DataFrame:
    for side in "AB":
        pairs = pairs.join(v.select(F.col("LIFNR").alias(f"LIFNR_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in columns]), f"LIFNR_{side}")
    return pairs


def score_pairs(pairs: DataFrame, v: DataFrame) -> DataFrame:
    """Name scores by every scorer and the address score, 0 to 100."""
    df = _both(pairs, v, ["name_norm", "address_norm"])
    names = {f"name_{k}": f("name_norm_A", "name_norm_B") for k, f in SCORERS.items()}
    return df.withColumns(names | {"address_score": ADDRESS_SCORE("address_norm_A", "address_norm_B")}).select("LIFNR_A", "LIFNR_B", *names, "address_score")


def combine(scorer: str, weight: float) -> Column:
    return F.lit(weight) * F.col(f"name_{scorer}") + F.lit(1 - weight) * F.col("address_score")


def positive_pairs(key: DataFrame, identity: str = "LIFNR", group: str = "uei") -> DataFrame:
    a, b = key.select(group, F.col(identity).alias(f"{identity}_A")), key.select(group, F.col(identity).alias(f"{identity}_B"))
    return a.join(b, group).where(F.col(f"{identity}_A") < F.col(f"{identity}_B")).drop(group)


def positives(key: DataFrame, identity: str = "LIFNR", group: str = "uei") -> int:
    """How many rows positive_pairs has, from group sizes alone."""
    n = F.col("n")
    groups = key.where(F.col(group).isNotNull() & F.col(identity).isNotNull()).groupBy(group, identity).agg(F.count("*").alias("n")).groupBy(group)
    return groups.agg(F.sum("n").alias("n"), F.sum(n * n).alias("same")).agg(F.sum((n * n - F.col("same")) / 2).cast("long")).first()[0] or 0


def label_pairs(pairs: DataFrame, key: DataFrame) -> DataFrame:
    """match, related (one parent, or parent and child) or non_match."""
    df = _both(pairs, key, ["uei", "parent_uei"])
    siblings = (F.col("parent_uei_A") != "") & (F.col("parent_uei_A") == F.col("parent_uei_B"))
    line = (F.col("parent_uei_A") == F.col("uei_B")) | (F.col("parent_uei_B") == F.col("uei_A"))
    label = F.when(F.col("uei_A") == F.col("uei_B"), "match").when(siblings | line, "related").otherwise("non_match")
    return df.withColumn("label", label).drop("uei_A", "uei_B", "parent_uei_A", "parent_uei_B")


def fold(a: str | Column = "LIFNR_A", b: str | Column = "LIFNR_B") -> Column:
    """0: tuning, 1: reporting; from the pair alone."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", a, b)), 1, 8), 16, 10).cast("long") % 2).cast("int")


def positives_by_fold(key: DataFrame, identity: str = "LIFNR", group: str = "uei") -> DataFrame:
    """fold, positives. The fold is a hash of the pair, so the pairs of positive_pairs are enumerated."""
    return positive_pairs(key, identity, group).groupBy(fold(f"{identity}_A", f"{identity}_B").alias("fold")).agg(F.count("*").alias("positives"))


def histogram(scored: DataFrame, scorers: Sequence[str] = tuple(SCORERS), by: Sequence[str] = ()) -> DataFrame:
    """n pairs by label, by the columns of `by`, and by the exact scores of every scorer and of the address.

    What a threshold, a weight or a scorer does is read from here: pairs are counted once, map-side first, and never multiplied by choices.
    """
    return scored.groupBy("label", *by, *[f"name_{s}" for s in scorers], "address_score").agg(F.count("*").alias("n"))


def curve(scored: DataFrame, score: str, positives: int | Column, thresholds: Sequence[float] = THRESHOLDS, by: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """Precision and recall at each threshold, from counts of scores between thresholds: one pass, then a running sum over at most len(thresholds) rows for each group.

    n: the column that says how many pairs a row stands for; without it pairs are counted by exact score first. positives may be a column of `by`.
    """
    if not n:
        scored, n = scored.groupBy("label", *by, score).agg(F.count("*").alias(f"{score}_n")), f"{score}_n"
    steps = F.array(*[F.lit(float(t)) for t in thresholds])
    level = F.size(F.filter(steps, lambda t: t <= F.col(score)))
    of = lambda label, name: F.coalesce(F.sum(F.when(F.col("label") == label, F.col(n))), F.lit(0).cast("long")).alias(name)
    sums = scored.groupBy(*by, level.alias("level")).agg(of("match", "m"), of("non_match", "x"))
    grid = sums.select(*by).distinct() if by else scored.sparkSession.range(1).drop("id")
    grid = grid.withColumn("s", F.explode(F.transform(steps, lambda t, i: F.struct(t.alias("threshold"), (i + 1).alias("level"))))).select(*by, "s.*")
    rows = grid.join(sums, [*by, "level"], "left")  # level 0 is no step of the grid
    above = Window.partitionBy(*by).orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(*by, "threshold", F.coalesce(F.sum("m").over(above), F.lit(0)).alias("tp"), F.coalesce(F.sum("x").over(above), F.lit(0)).alias("fp"))
    p = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(1.0))
    n_all = positives if isinstance(positives, Column) else F.lit(positives)
    rows = rows.withColumns({"precision": p, "recall": F.when(n_all > 0, F.col("tp") / n_all).otherwise(F.lit(0.0))})
    both = F.col("precision") + F.col("recall")
    return rows.withColumn("f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0)))


def grid(scored: DataFrame, positives: int | Column, scorers: Sequence[str] = tuple(SCORERS), weights: Sequence[float] = WEIGHTS, by: Sequence[str] = ()) -> DataFrame:
    """Curves of every scorer and weight at once. scored: pairs, or their histogram; only rows of a histogram are read once for each choice."""
    counted = scored if "n" in scored.columns else histogram(scored, scorers, by)
    each = [F.struct(F.lit(k).alias("choice"), F.lit(s).alias("scorer"), F.lit(w).alias("weight"), combine(s, w).alias("score")) for k, (s, w) in enumerate((s, w) for s in scorers for w in weights)]
    rows = counted.select("label", *by, "n", F.explode(F.array(*each)).alias("g")).select("label", *by, "n", "g.*")
    return curve(rows, "score", positives, by=(*by, "choice", "scorer", "weight"), n="n")


def best(curves: DataFrame) -> DataFrame:
    """The row of the greatest F1; ties, to twelve digits, go to the first choice and then the lowest threshold."""
    order = F.struct(-F.round("f1", 12), "choice", "threshold")
    return curves.agg(F.min_by(F.struct(*curves.columns), order).alias("b")).select("b.*")


def tune(scored: DataFrame, positives: int, scorers: Sequence[str] = tuple(SCORERS), weights: Sequence[float] = WEIGHTS) -> tuple[str, float, int]:
    """Scorer, weight and threshold of the greatest F1; ties go to the first choice and then the lowest threshold. For the dev fold alone, give its rows and its positives."""
    row = best(grid(scored, positives, scorers, weights)).first()
    return row["scorer"], row["weight"], int(row["threshold"])


DEV, TEST = 0, 1


def evaluation(counted: DataFrame, positives: dict[int, int], scorers: Sequence[str] = tuple(SCORERS), weights: Sequence[float] = WEIGHTS, baseline: str = "token_set_ratio") -> DataFrame:
    """What tuning on the dev fold chooses, and how that does on either fold; the same with one scorer alone, as a baseline.

    counted: a histogram by fold. method, scorer, weight, threshold, fold, tp, fp, precision, recall, f1: two rows for each method.
    """
    dev = counted.where(F.col("fold") == DEV)
    out = None
    for method, names in (("chosen", tuple(scorers)), ("baseline", (baseline,))):
        scorer, weight, threshold = tune(dev, positives.get(DEV, 0), names, weights)
        n = F.when(F.col("fold") == DEV, F.lit(positives.get(DEV, 0))).otherwise(F.lit(positives.get(TEST, 0)))
        at = curve(counted.withColumn("score", combine(scorer, weight)), "score", n, thresholds=(threshold,), by=("fold",), n="n")
        chosen = [F.lit(method).alias("method"), F.lit(scorer).alias("scorer"), F.lit(weight).alias("weight"), F.lit(threshold).cast("long").alias("threshold")]
        at = at.select(*chosen, "fold", "tp", "fp", "precision", "recall", "f1")
        out = at if out is None else out.unionByName(at)
    return out


def evaluated(scored: DataFrame, key: DataFrame, scorers: Sequence[str] = tuple(SCORERS), **kw) -> DataFrame:
    """evaluation() of labelled, scored pairs: they are read once, for the histogram, which is written."""
    counted = written(histogram(scored.withColumn("fold", fold()), scorers, ("fold",)), "histogram")
    positives = {r["fold"]: r["positives"] for r in positives_by_fold(key).collect()}  # two rows
    return evaluation(counted, positives, scorers, **kw)


def candidates(scored: DataFrame, scorer: str, weight: float, threshold: int) -> DataFrame:
    """Pairs near the threshold or above; the flag looks at the score with two digits."""
    rows = scored.withColumn("raw", combine(scorer, weight)).where(F.col("raw") >= threshold - NEAR_MISS)
    score = F.round("raw", 2)
    return rows.select(
        "LIFNR_A", "LIFNR_B", F.col(f"name_{scorer}").alias("name_score"), "address_score", score.alias("score"), (score >= threshold).alias("above_threshold"),
        F.lit(threshold).cast("long").alias("threshold"), F.lit(weight).alias("name_weight"), F.lit(scorer).alias("name_scorer"),
    )


def named(pairs: DataFrame, vendor: DataFrame) -> DataFrame:
    """Both sides' names on the latest extract date."""
    latest = vendor.join(F.broadcast(vendor.agg(F.max("extract_date").alias("extract_date"))), "extract_date")  # one row
    for side in "AB":
        pairs = pairs.join(latest.select(F.col("LIFNR").alias(f"LIFNR_{side}"), F.col("NAME1").alias(f"NAME1_{side}")), f"LIFNR_{side}", "left")
    return pairs


def errors(scored: DataFrame, positives: DataFrame, score: str, threshold: int) -> dict[str, DataFrame]:
    """Worst false positives and negatives, and matches that blocking missed; reports of fixed length."""
    wrong = scored.where((F.col("label") == "non_match") & (F.col(score) >= threshold)).orderBy(F.desc(score), "LIFNR_A", "LIFNR_B").limit(10)
    low = scored.where((F.col("label") == "match") & (F.col(score) < threshold)).orderBy(score, "LIFNR_A", "LIFNR_B").limit(10)
    missed = positives.join(scored.select("LIFNR_A", "LIFNR_B"), ["LIFNR_A", "LIFNR_B"], "left_anti").orderBy("LIFNR_A", "LIFNR_B").limit(5)
    return {"false_positives": wrong, "false_negatives": low, "missed": missed}


def stratified(rows: DataFrame, stratum: str, sizes: dict[str, int], key: Sequence[str], seed: int = 7) -> DataFrame:
    """A fixed number of rows of each stratum, by hash order."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *key))
    want = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    r = F.row_number().over(Window.partitionBy(stratum).orderBy(h, *key))
    return rows.where(F.col(stratum).isin(list(sizes))).withColumn("__r", r).where(F.col("__r") <= F.try_element_at(want, F.col(stratum))).drop("__r")


#: How many hard pairs of each kind are put before a person.
STRATA = {"same_name": 45, "near_threshold": 45, "missed": 35, "related": 25}


def strata(scored: DataFrame, v: DataFrame, score: str, threshold: float, near: float = 6) -> DataFrame:
    """Pairs that are hard to tell, each with the first of the kinds that it is of: same name but no match, close to the threshold, missed, related above it."""
    same = F.col("name_norm_A") == F.col("name_norm_B")
    value, label = F.col(score), F.col("label")
    kind = F.when(same & (label != "match"), "same_name").when(~same & value.between(threshold - near, threshold + near), "near_threshold")
    kind = kind.when((label == "match") & (value < threshold), "missed").when((label == "related") & (value >= threshold), "related")
    return _both(scored, v, ["name_norm"]).withColumn("stratum", kind).where("stratum IS NOT NULL").drop("name_norm_A", "name_norm_B")


def hard_cases(scored: DataFrame, v: DataFrame, score: str, threshold: float, sizes: dict[str, int] | None = None, seed: int = 7) -> DataFrame:
    """The sheet of pairs to be labelled by hand: both sides' names and places, the score, and room for a label."""
    picked = stratified(strata(scored, v, score, threshold), "stratum", sizes or STRATA, ["LIFNR_A", "LIFNR_B"], seed)
    order = Window.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed + 1)), "LIFNR_A", "LIFNR_B")), "LIFNR_A", "LIFNR_B")  # sum(sizes) rows
    picked = picked.withColumn("pair_id", F.format_string("H%03d", F.row_number().over(order)))
    shown = [c for c in ("name", "address", "city", "state", "zip5") if c in v.columns]
    sides = [f"{c}_{side}" for side in "AB" for c in shown]
    return _both(picked, v, shown).select("pair_id", "LIFNR_A", "LIFNR_B", *sides, F.round(score, 1).alias("score"), F.lit("").alias("label"), F.lit("").alias("notes"), "stratum")


def read_labels(spark, path: str) -> DataFrame:
    """Hand-labelled pairs from CSV, all text; pairs without a label are left out."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns]).where("label != ''")


def labelled_scores(labelled: DataFrame, key: DataFrame, scored: DataFrame, scores: Sequence[str]) -> DataFrame:
    """Labelled pairs with what the answer key and the scorers say of them."""
    pair = ["LIFNR_A", "LIFNR_B"]
    return labelled.select("pair_id", *pair, "label").join(key.select("pair_id", *pair, "stratum", "uei_label"), ["pair_id", *pair]).join(scored.select(*pair, *scores), pair)


def write_outputs(folder: str, candidates: DataFrame, curves: DataFrame, wrong: dict[str, DataFrame], metrics: DataFrame) -> None:
    """Candidates as Parquet, metrics as JSON, the curve and the error samples as CSV."""
    candidates.write.mode("overwrite").parquet(f"{folder}/candidates")
    metrics.coalesce(1).write.mode("overwrite").json(f"{folder}/metrics")  # one row
    curves.coalesce(1).write.mode("overwrite").csv(f"{folder}/curve", header=True)  # one row for each threshold
    for name, df in wrong.items():
        df.coalesce(1).write.mode("overwrite").csv(f"{folder}/errors_{name}", header=True)  # ten rows at most


def with_model(pairs: DataFrame, weights: DataFrame, missing: float = -99.0) -> DataFrame:
    """Pairs with the model's match weight; what the model has no weight for counts as far below any threshold."""
    key = ["LIFNR_A", "LIFNR_B"]
    return pairs.join(weights.select(*key, "match_weight"), key, "left").withColumn("match_weight", F.coalesce("match_weight", F.lit(missing)))


def judge(decided: DataFrame, score: str, threshold: float) -> DataFrame:
    """Hits and errors against decided labels (duplicate or not); what has no score counts as far below."""
    hit = F.coalesce(score, F.lit(-99.0)) >= threshold
    yes = F.col("label") == "duplicate"
    rows = decided.where(F.col("label") != "unsure").agg(F.count_if(hit & yes).alias("tp"), F.count_if(hit & ~yes).alias("fp"), F.count_if(~hit & yes).alias("fn"))
    return rows.withColumns({"precision": F.col("tp") / (F.col("tp") + F.col("fp")), "recall": F.col("tp") / (F.col("tp") + F.col("fn"))})


# Fellegi-Sunter -------------------------------------------------------------------------------------------

#: Similarity levels, best first; what is below all is level 0, null or blank is -1.
NAME_LEVELS, ADDRESS_LEVELS = (0.95, 0.88, 0.8), (0.95, 0.85)


def _level(a: str, b: str, cuts: Sequence[float]) -> Column:
    s = JARO_WINKLER(a, b)
    out = F.when((F.col(a) == "") | (F.col(b) == ""), -1).when(F.col(a) == F.col(b), len(cuts) + 1)
    for k, cut in enumerate(cuts):
        out = out.when(s >= cut, len(cuts) - k)
    return out.otherwise(0)


#: What is compared of two vendors.
COMPARED = ("name_norm", "address_norm", "zip5")


def comparisons(pairs: DataFrame, v: DataFrame) -> DataFrame:
    """Agreement levels of each pair: g_name, g_address, g_zip. pairs may carry COMPARED already."""
    df = pairs if {f"{c}_{x}" for c in COMPARED for x in "AB"} <= set(pairs.columns) else _both(pairs, v, COMPARED)
    zips = F.when((F.col("zip5_A") == "") | (F.col("zip5_B") == ""), -1).otherwise((F.col("zip5_A") == F.col("zip5_B")).cast("int"))
    return df.withColumns({"g_name": _level("name_norm_A", "name_norm_B", NAME_LEVELS), "g_address": _level("address_norm_A", "address_norm_B", ADDRESS_LEVELS), "g_zip": zips})


GAMMAS = ("g_name", "g_address", "g_zip")


def patterns(compared: DataFrame) -> list[tuple[tuple[int, ...], int]]:
    """Pairs by agreement pattern: at most one row for each combination of levels."""
    return [(tuple(r[g] for g in GAMMAS), r["n"]) for r in compared.groupBy(*GAMMAS).agg(F.count("*").alias("n")).collect()]


@dataclass(frozen=True)
class Weights:
    """Shares of each level among matches (m) and others (u), and the prior."""

    m: dict[str, dict[int, float]]
    u: dict[str, dict[int, float]]
    prior: float

    def weight(self) -> Column:
        """log2 odds of a match; a null level adds nothing."""
        out = F.lit(float(np.log2(self.prior / (1 - self.prior))))
        for g in GAMMAS:
            table = [(k, float(np.log2(self.m[g][k] / self.u[g][k]))) for k in self.m[g]]
            m = F.create_map(*[F.lit(x) for kv in table for x in kv])
            out = out + F.coalesce(F.try_element_at(m, F.col(g)), F.lit(0.0))
        return out


def shares(counts: Sequence[tuple[tuple[int, ...], float]], smooth: float = 1e-6) -> dict[str, dict[int, float]]:
    out = {}
    levels = {"g_name": len(NAME_LEVELS) + 2, "g_address": len(ADDRESS_LEVELS) + 2, "g_zip": 2}
    for k, g in enumerate(GAMMAS):
        total = np.full(levels[g], smooth)
        for pattern, n in counts:
            if pattern[k] >= 0:
                total[pattern[k]] += n
        out[g] = dict(enumerate((total / total.sum()).tolist()))
    return out


def em(counts: Sequence[tuple[tuple[int, ...], int]], u: dict[str, dict[int, float]], prior: float, rounds: int = 50, fixed: Sequence[str] = ()) -> Weights:
    """m and the prior by expectation maximisation over pattern counts; u stays. Levels in `fixed` were blocked on and learn nothing."""
    m = {g: {k: (0.9 if k == max(u[g]) else 0.1 / max(u[g])) for k in u[g]} for g in GAMMAS}
    for _ in range(rounds):
        soft = []
        for pattern, n in counts:
            odds = prior / (1 - prior)
            for k, g in enumerate(GAMMAS):
                if g not in fixed and pattern[k] >= 0:
                    odds *= m[g][pattern[k]] / u[g][pattern[k]]
            soft.append((pattern, n * odds / (1 + odds)))
        new = shares(soft)
        m = {g: (m[g] if g in fixed else new[g]) for g in GAMMAS}
        prior = min(max(sum(x for _, x in soft) / max(sum(n for _, n in counts), 1), 1e-9), 1 - 1e-9)
    return Weights(m, u, prior)


def fellegi_sunter(v: DataFrame, pairs: DataFrame, recall: float = 0.7, max_pairs: int = 2_000_000, seed: int = 42) -> DataFrame:
    """Match weight and probability of every pair. u comes from random pairs (two hash orders of the vendors, at most max_pairs);
    m from pairs blocked on address and on name; the prior from pairs that agree on name and ZIP."""
    n = v.count()
    exact = v.where("name_norm != '' AND zip5 != ''").groupBy("name_norm", "zip5").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0))).first()[0]
    prior = min(max(float(exact) / recall / max(n * (n - 1) / 2, 1), 1e-9), 0.5)
    shifts = max(1, min(n - 1, max_pairs // max(n, 1), 64)) if n > 1 else 0
    h = Window.partitionBy("b").orderBy(F.xxhash64(F.lit(seed), "LIFNR"), "LIFNR")
    ranked = v.select("LIFNR", F.pmod(F.xxhash64(F.lit(seed + 1), "LIFNR"), F.lit(max(1, n // 1000))).alias("b")).withColumn("r", F.row_number().over(h))
    left = ranked.withColumn("t", F.explode(F.sequence(F.lit(1), F.lit(max(shifts, 1))))).select(F.col("b"), (F.col("r") + F.col("t")).alias("r"), F.col("LIFNR").alias("x"))
    rnd = left.join(ranked, ["b", "r"]).select(F.least("x", "LIFNR").alias("LIFNR_A"), F.greatest("x", "LIFNR").alias("LIFNR_B"))
    u = shares(patterns(comparisons(rnd, v)))
    learned = []
    for block, gamma in (("address_norm", "g_address"), ("name_norm", "g_name")):
        counts = patterns(comparisons(candidate_pairs(v, passes=(block,), carried=COMPARED), v))
        learned.append((gamma, em(counts, u, 0.1, fixed=(gamma,))))
    m = {g: {k: float(np.mean([w.m[g][k] for gamma, w in learned if gamma != g])) for k in u[g]} for g in GAMMAS}
    w = Weights(m, u, prior)
    scored = comparisons(pairs, v)  # carried columns spare a shuffle of all pairs
    # Term frequency: agreeing on a rare name says more than on a common one.
    total = float(max(n, 1))
    often = v.where("name_norm != ''").groupBy(F.col("name_norm").alias("name_norm_A")).agg((F.count("*") / total).alias("tf"))
    top = max(u["g_name"])
    scored = scored.join(F.broadcast(often) if n <= SMALL else often, "name_norm_A", "left")
    adjust = F.when(F.col("g_name") == top, F.log2(F.lit(u["g_name"][top]) / F.col("tf"))).otherwise(F.lit(0.0))
    scored = scored.withColumn("match_weight", w.weight() + F.coalesce(adjust, F.lit(0.0)))
    odds = F.pow(F.lit(2.0), F.least("match_weight", F.lit(500.0)))
    return scored.select("LIFNR_A", "LIFNR_B", "match_weight", (odds / (1 + odds)).alias("match_probability"))
