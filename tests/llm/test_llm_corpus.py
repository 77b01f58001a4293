"""Corpus-wide operators: near duplicates, packing, sharding; and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mandrel.llm import near_dup, packing, sharding

DOCS = "doc_id long, text string"
PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))) for _ in range(n)]


def corpus(seed=0):
    """Texts with exact, near and distant copies, many sharing a passage."""
    rng = random.Random(seed)
    out = [None, "", " \n ", "one two", "One TWO", "one two three four five", "one two three four five six"]
    passage = " ".join(words(rng, 30))
    for _ in range(25):
        base = words(rng, rng.randrange(20, 200))
        out.append(" ".join(base))
        for _ in range(rng.randrange(0, 4)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 20))):
                copy[rng.randrange(len(copy))] = "".join(words(rng, 1))
            out.append((passage + " " if rng.random() < 0.2 else "") + " ".join(copy))
    base = words(rng, 150)  # a large group, most of whose members do not link directly
    for _ in range(80):
        copy = list(base)
        for _ in range(rng.randrange(1, 7)):
            copy[rng.randrange(len(copy))] = "".join(words(rng, 1))
        out.append(" ".join(copy))
    out += [out[10], out[10].upper(), out[10].replace(" ", "  \n")]
    return out


def slow_classes(texts):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()

    sets = [shingles(t) for t in texts]
    up = list(range(len(texts)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return [(k, len(sets[k]), root(k)) for k in range(len(texts))]


@pytest.mark.parametrize("seed", [0, 1])
def test_classes_by_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(near_dup, "PAIRED", 4)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    texts = corpus(seed)
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumns({c: F.lit(1) for c in ("key", "label", "band", "n")})
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_dup.classes(df).collect())
    assert got == slow_classes(texts)


def test_repeated_and_null_ids(spark):
    text = " ".join(words(random.Random(3), 40))
    df = spark.createDataFrame([(None, text), (7, text), (7, text), (9, text + " x"), (None, None), (4, None)], DOCS).withColumn("source", F.lit("s"))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dup.classes(df).collect()), key=str)
    assert got == sorted([(None, 7, False), (7, 7, True), (7, 7, True), (9, 7, False), (None, None, True), (4, 4, True)], key=str)
    out = near_dup.kept(df)
    assert out.columns == df.columns and sorted((r.doc_id for r in out.collect()), key=str) == [4, 7, None]


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert near_dup.classes(empty).count() == 0 and packing.pack(empty, PATH).count() == 0 and sharding.assign(empty).count() == 0


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2))
    b = np.unique(np.concatenate([a[:2400], rng.integers(0, 2**63, 600, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
    x, y = near_dup.sketch(a), near_dup.sketch(b)
    got = ((x == y).mean() - near_dup.COLLISION) / (1 - near_dup.COLLISION)
    assert abs(got - 2400 / 3600) < 0.15
    assert (near_dup.sketch(a[:1]) == near_dup.sketch(a[:1])[0]).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(f"{k:03d}", f"{k + 1:03d}") for k in range(40)] + [("900", f"{k}") for k in range(901, 930)] + [("x", "x")]
    df = spark.createDataFrame([(bytes(a, "ascii"), bytes(b, "ascii")) for a, b in edges], "a binary, b binary")
    got, split = ({bytes(r.node).decode(): bytes(r.label).decode() for r in near_dup.components(df, hub).collect()} for hub in (1000, 3))
    assert got == split
    assert {got[f"{k:03d}"] for k in range(41)} == {"000"} and {got[f"{k}"] for k in range(900, 930)} == {"900"}


# Packing

TEXTS = [None, "", "Hello, World!", "hello hello's don't l'été ÉTÉ", "x\ty z 12½ Ⅷ", "<|endoftext|> a<|endoftext|>b", "été İstanbul ΣΑΣ", "😀 中文 \r\n\x1c\x85end", "a" * 3000, "word " * 5000, "don't" * 400, "a.b,c;d!? #$%"]


def test_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    for limit in (1_000_000, 3):
        w = packing.WordTokens(PATH, limit)
        for _ in range(2):
            for x, got in zip(TEXTS, w.encode([x or "" for x in TEXTS]), strict=True):
                assert np.frombuffer(got, "<u4").tolist() == t.encode(x or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer_on_odd_strings():
    from tokenizers import Tokenizer

    t, w, rng = Tokenizer.from_file(PATH), packing.WordTokens(PATH), random.Random(1)
    odd = ["İ", "I", "ı", "a", "B", "é", "ß", "ſ", "K", "ǅ", "ŉ", "ǰ", "ẞ", "Σ", ".", ",", "!", "-", "'", " ", "\n", "1", "½", "ª", "ɐ", "\u0301", "\u0307", "你", "😀", "#", "&", "\u00ad", "\u200d", "ﬁ", "Ⅷ"]
    texts = ["İ.", "GİBİ, EVET", "TÜRKİYELİ!"] + ["".join(rng.choice(odd) for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    for x, got in zip(texts, w.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, x


def test_combinations_by_brute_force():
    rng = random.Random(2)
    counts = np.array([0] + [rng.randrange(0, 3) for _ in range(39)])
    pairs, triples = packing.combinations(counts, 40)
    have = [k for k in range(1, 40) if counts[k]]
    assert sorted(map(tuple, pairs.tolist())) == sorted({(a, b) for a in have for b in have if a >= b and a + b == 40})
    assert sorted(map(tuple, triples.tolist())) == sorted({(a, b, c) for a in have for b in have for c in have if a >= b >= c and a + b + c == 40})


def test_least_squares_places_most_tails():
    rng = np.random.default_rng(3)
    counts = np.bincount(rng.lognormal(7, 1.2, 4000).astype(int) % 2048, minlength=2048)
    counts[0] = 0
    p = packing.plan(counts)
    placed = sum(high - low for _, low, high, _, _ in p.slots)
    assert placed >= 0.75 * counts.sum() and p.padding < 2048


def check_packed(rows, ids, window):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= window
    for doc, want in ids.items():
        at = 0
        for r in sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(np.array(want[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(want)
    return by


@pytest.mark.parametrize("window", [8, 64, 2048])
def test_round_trip(spark, window):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    texts = TEXTS + [" ".join(words(rng, rng.randrange(1, 60))) for _ in range(150)] + ["same text here"] * 40
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumns({c: F.lit(1) for c in ("tail", "pid", "slots")}).repartition(3)
    t = Tokenizer.from_file(PATH)
    ids = {k: [*t.encode(x or "", add_special_tokens=False).ids, 1] for k, x in enumerate(texts)}
    rows = packing.pack(df, PATH, window).collect()
    by = check_packed(rows, ids, window)
    assert sum(window - sum(n for _, n in p) for p in by.values()) < window  # only one sequence is padded


def test_plan_by_hand():
    counts = np.zeros(10, dtype=np.int64)
    counts[[3, 7, 6]] = 5, 5, 3
    p = packing.plan(counts, 10)
    assert p.sequences == 5 + 2 and p.padding == 2
    assert sum(high - low for _, low, high, _, _ in p.slots) == 10


def test_least_squares_is_not_negative_and_fits():
    counts = np.zeros(16)
    patterns = [(4, 12), (8, 8), (5, 5, 6)]
    for p, n in zip(patterns, (10, 0, 7), strict=True):
        for x in p:
            counts[x] += n
    assert packing.nnls(patterns, counts) == pytest.approx([10, 0, 7], abs=0.05)


# Sharding


@pytest.mark.parametrize("hot", [0, 300])
def test_shards_are_even_and_copies_together(spark, hot):
    rng = random.Random(6)
    texts = [None, None, "", ""] + [" ".join(words(rng, 5)) for _ in range(800)]
    texts += [t for t in texts[4:84] for _ in range(rng.randrange(1, 4))] + ["hot text"] * hot
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumns({c: F.lit(1) for c in ("size", "label", "hash", "shard")})
    rows = sharding.assign(df).collect()
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        raw = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
    assert set(by) == set(range(40)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    where = {}
    for r in rows:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    parted = sum(len(s) > 1 for t, s in where.items() if t not in (None, "hot text"))
    assert parted <= 6
    if hot:
        assert len(where["hot text"]) <= 40


def slow_cut(rows, texts):
    out = 0
    by = {}
    for r in rows:
        by.setdefault(texts[r.doc_id], []).append(r.shard)
    for t, shards in by.items():
        if t is not None:
            out += sum(a != b for k, a in enumerate(shards) for b in shards[:k])
    return out


@pytest.mark.parametrize("group, most", [(2, 0.02), (12, 0.25), (45, 0.35)])
def test_rounds_cut_fewer_links(spark, group, most):
    """Every row is linked, so no shard has room but for what leaves: the hardest case."""
    texts = [f"text {k // group}" for k in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    none, some = sharding.assign(df, shards=20, rounds=0).collect(), sharding.assign(df, shards=20).collect()
    for rows in (none, some):
        sizes = [sum(r.shard == s for r in rows) for s in range(20)]
        assert sum(sizes) == len(texts) and max(sizes) - min(sizes) <= 1
    assert sum(a.shard != b.shard for a, b in zip(sorted(none), sorted(some), strict=True)) > 500
    assert slow_cut(some, texts) <= most * slow_cut(none, texts)


def test_cut_links_of_every_round(spark):
    texts = [f"text {k // 5}" for k in range(400)] + [f"alone {k}" for k in range(1600)]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).select("doc_id", F.xxhash64("text").alias("hash"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.length("text").cast("long").alias("size"), F.pmod(F.xxhash64("doc_id"), F.lit(160)).cast("int").alias("place"))
    state, cuts = sharding.propagate(df, 2000)
    assert cuts[0] > 600 and cuts[-1] == 0 and cuts == sorted(cuts, reverse=True)
    assert state.agg(F.sum("n")).first()[0] == 400  # links of 80 groups of five, all in one shard each
    assert sharding.admitted({(0, 1): 10, (1, 0): 10}, [0, 0]) == [1.0, 1.0]
    assert sharding.admitted({(0, 1): 10}, [0, 4]) == [1.0, 0.4]


def test_sharding_is_native_and_repeatable(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 170).alias("text"))
    one, two = sharding.assign(df), sharding.assign(df.repartition(5))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert "Python" not in one._jdf.queryExecution().executedPlan().toString()


def test_split_join_is_the_plain_join(spark):
    from mandrel.llm.common import scanned, split_join

    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000).alias("k"), "id")
    info = rows.groupBy("k").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, split_join(rows, info, "k").select("k", "id", "n").collect())) == sorted(map(tuple, rows.join(info, "k").select("k", "id", "n").collect()))
    assert split_join(rows.where("false"), info.where("false"), "k").count() == 0
    sums = scanned(F.sequence(F.lit(1), F.lit(1000)), F.struct(F.lit(0).alias("s")), lambda a, x: F.struct(F.struct((a["s"] + x).alias("s")).alias("state"), F.array(a["s"] + x).alias("out")), "int")
    assert spark.range(1).select(sums.alias("x")).first().x == np.cumsum(range(1, 1001)).tolist()


# Pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(8)
    item = " ".join(words(rng, 20))
    good = [" ".join(words(rng, 120)) for _ in range(6)]
    rows = [
        (0, good[0], "en", "s", 1), (1, good[0], "en", "s", 1), (2, good[1] + " token = abcdef123456", "en", "s", 1), (3, item + " " + " ".join(words(rng, 60)), "en", "s", 1),
        (4, "short", "en", "s", 1), (5, None, None, None, None), (6, good[2], None, "s", 1), (6, good[2], None, "s", 1), (7, good[3], "en", None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "secret_scan", "packing"]
    left, df = [], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, str(tmp_path))
        assert df.columns == docs.columns
        df.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        left.append(sorted(r.doc_id for r in df.collect()))
    assert left == [[0, 1, 2, 3, 6, 6, 7], [0, 2, 3, 6, 7], [0, 2, 6, 7], [0, 2, 6, 7]]
    assert "abcdef123456" not in df.where("doc_id = 2").first().text
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == {0, 2, 6, 7}
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_names_with_dots_pass_all_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    more = ["meta.lang", "a`b", "text.x", "doc_id.y"]
    rows = [(k, " ".join(words(rng, 120)) + (" token = abcdef123456" if k == 1 else ""), "en", "s", 1, "m", "n", "o", 7) for k in range(4)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `meta.lang` string, `a``b` string, `text.x` string, `doc_id.y` long"
    df = docs = spark.createDataFrame([*rows, rows[0]], schema)
    spark.createDataFrame([(1, " ".join(words(rng, 20)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, str(tmp_path))
        assert df.columns == docs.columns
        df.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted(r["doc_id"] for r in df.collect()) == [0, 1, 2, 3] and {tuple(r[c] for c in more) for r in df.collect()} == {("m", "n", "o", 7)}
    assert corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).select("doc_id").distinct().count() == 4


def test_words_of_small_letters_reach_the_model_at_once():
    """They need no normal form and no parts; their ids are the tokenizer's."""
    import numpy as np
    from tokenizers import Tokenizer

    from mandrel.llm import packing

    text = "the don re ve ll abchtzq the " + "x" * 300
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    w = packing.WordTokens(PATH)
    w.tokenizer = None
    assert np.frombuffer(w.encode([text])[0], dtype="<u4").tolist() == want
