"""Media columns, fill-in-middle and ranked search against brute force."""

import hashlib
import io
import math
import random
import re
import struct
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mandrel.llm import fill_middle, media, search

NAMES = ("n", "form", "key", "score", "rank", "terms", "media", "output", "draws", "tiles", "meta.lang", "a`b")


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit("mine") for c in NAMES})


# Media


def slow_cells(image, down, across):
    """Sums by cell, each sample by the part of it that lies inside."""
    h, w = image.shape
    out = [[Fraction(0)] * across for _ in range(down)]
    for i in range(down):
        for j in range(across):
            for y in range(h):
                tall = min(Fraction(y + 1), Fraction((i + 1) * h, down)) - max(Fraction(y), Fraction(i * h, down))
                for x in range(w) if tall > 0 else ():
                    wide = min(Fraction(x + 1), Fraction((j + 1) * w, across)) - max(Fraction(x), Fraction(j * w, across))
                    if wide > 0:
                        out[i][j] += tall * wide * int(image[y, x])
    return out


@pytest.mark.parametrize("h, w", [(1, 1), (8, 9), (3, 64), (17, 5), (40, 31)])
def test_cells_by_brute_force(h, w, monkeypatch):
    monkeypatch.setattr(media, "BAND", 7)
    image = np.random.default_rng(h * w).integers(0, 256, (h, w, 1), dtype=np.uint8)
    slow = slow_cells(image[:, :, 0], 8, 9)
    fast = media.cell_sums(image)
    assert [[Fraction(int(v), 72) for v in row] for row in fast] == slow
    mean = media.area_resized(image, 8, 9)[:, :, 0]
    assert np.allclose(mean, np.array([[float(v) * 72 / (h * w) for v in row] for row in slow]))


def ppm(image, kind, depth=255):
    h, w, c = image.shape
    if kind in (4, 1):
        head = f"P{kind}\n# a note\n{w} {h}\n".encode()
        bits = 1 - image[:, :, 0]
        return head + (np.packbits(bits, axis=1).tobytes() if kind == 4 else "".join(map(str, bits.reshape(-1))).encode())
    if kind == 7:
        return f"P7\nWIDTH {w}\nHEIGHT {h}\nDEPTH {c}\nMAXVAL {depth}\nTUPLTYPE ANY\nENDHDR\n".encode() + image.astype(">u2" if depth > 255 else "u1").tobytes()
    head = f"P{kind} {w}\t{h}#x\n {depth}\n".encode()
    return head + (image.astype(">u2" if depth > 255 else "u1").tobytes() if kind > 3 else " ".join(map(str, image.reshape(-1))).encode())


@pytest.mark.parametrize("kind, channels, depth", [(1, 1, 1), (2, 1, 255), (3, 3, 255), (4, 1, 1), (5, 1, 255), (5, 1, 1000), (6, 3, 255), (6, 3, 65535), (7, 4, 255), (7, 2, 300), (2, 1, 40000)])
def test_netpbm_round_trip(kind, channels, depth):
    image = np.random.default_rng(kind).integers(0, depth + 1, (7, 13, channels))
    name, got = media.decode(ppm(image, kind, depth))
    assert name == f"P{kind}" and (got == image).all() and got.dtype == (np.uint16 if depth > 255 else np.uint8)


def bmp(rows, bits, palette=b"", upside=True, packing=0, masks=b"", core=False):
    """A bitmap file of rows of bytes, not yet padded."""
    rows = [r + b"\0" * (-len(r) % 4) for r in rows] if packing != 1 else rows
    data = b"".join(rows[::-1] if upside else rows)
    return data, bits, palette, upside, packing, masks, core


def bmp_file(width, height, parts):
    data, bits, palette, upside, packing, masks, core = parts
    if core:
        head = struct.pack("<IHHHH", 12, width, height, 1, bits)
    else:
        head = struct.pack("<IiiHHIIiiII", 40, width, height if upside else -height, 1, bits, packing, len(data), 0, 0, len(palette) // 4, 0)
    at = 14 + len(head) + len(masks) + len(palette)
    return b"BM" + struct.pack("<IHHI", at + len(data), 0, 0, at) + head + masks + palette + data


@pytest.mark.parametrize("bits", [1, 4, 8])
@pytest.mark.parametrize("core", [False, True])
def test_bmp_palettes(bits, core):
    rng = np.random.default_rng(bits)
    pixels = rng.integers(0, 1 << bits, (5, 11))
    colours = rng.integers(0, 256, (1 << bits, 3), dtype=np.uint8)
    palette = b"".join(bytes(c[::-1]) + (b"" if core else b"\0") for c in colours)
    lines = ["".join(format(v, f"0{bits}b") for v in row) for row in pixels]
    rows = [int(x.ljust(-(-len(x) // 8) * 8, "0"), 2).to_bytes(-(-len(x) // 8), "big") for x in lines]
    name, got = media.decode(bmp_file(11, 5, bmp(rows, bits, palette, core=core)))
    assert name == "BMP" and (got == colours[pixels]).all()


@pytest.mark.parametrize("upside", [True, False])
def test_bmp_colours(upside):
    image = np.random.default_rng(3).integers(0, 256, (4, 5, 3), dtype=np.uint8)
    got = media.decode(bmp_file(5, 4, bmp([r[:, ::-1].tobytes() for r in image], 24, upside=upside)))[1]
    assert (got == image).all()
    plain = media.decode(bmp_file(5, 4, bmp([np.pad(r[:, ::-1], ((0, 0), (0, 1))).tobytes() for r in image], 32, upside=upside)))[1]
    assert (plain == image).all()
    low = (image >> 3).astype("<u2")
    words = (low[:, :, 0] << 10) | (low[:, :, 1] << 5) | low[:, :, 2]
    short = media.decode(bmp_file(5, 4, bmp([r.astype("<u2").tobytes() for r in words], 16, upside=upside)))[1]
    assert (short == low.astype(int) * 255 // 31).all()
    masks = struct.pack("<3I", 0xFF, 0xFF00, 0xFF0000)
    fielded = media.decode(bmp_file(5, 4, bmp([np.pad(r, ((0, 0), (0, 1))).tobytes() for r in image], 32, upside=upside, packing=3, masks=masks)))[1]
    assert (fielded == image).all()


def test_bmp_run_lengths():
    gray = b"".join(bytes((k, k, k, 0)) for k in range(256))
    data = b"\x03\x07\x02\x09\x00\x00" + b"\x00\x03\x01\x02\x03\x00" + b"\x02\x04" + b"\x00\x01"
    got = media.decode(bmp_file(5, 2, bmp([data], 8, gray, packing=1)))[1][:, :, 0]
    assert got.tolist() == [[1, 2, 3, 4, 4], [7, 7, 7, 9, 9]]


BROKEN = [None, b"", b"P", b"P5", b"P5\n2 2\n255\nabc", b"P5\n0 2\n255\n", b"P9\n1 1\n255\na", b"BM", b"BM" + b"\0" * 60, b"P1\n2 1\n0x", b"P2\n1 1\n9\n10", b"P7\nWIDTH 1\n", b"P6 99999999 99999999 255\n", b"GIF89a"]


def test_broken_media_have_no_tiles(spark):
    rows = media.stored(spark.createDataFrame([(k, bytearray(x) if x is not None else None) for k, x in enumerate(BROKEN)], "id long, media binary"), ["id"]).collect()
    assert len(rows) == len(BROKEN) and all(r["format"] is None and r["tiles"] == [] and r["hash"] is None for r in rows)


def test_tiles_hold_the_samples(spark, monkeypatch):
    rng = np.random.default_rng(5)
    images = [rng.integers(0, 256, s, dtype=np.uint8) for s in ((1, 1, 1), (256, 256, 1), (300, 520, 3), (257, 2, 1))]
    images.append(rng.integers(0, 65536, (20, 30, 1)).astype(np.uint16))
    media_of = [ppm(x, 6 if x.shape[2] == 3 else 5, 65535 if x.dtype == np.uint16 else 255) for x in images]
    df = spark.createDataFrame([(k, bytearray(b), "mine") for k, b in enumerate(media_of)], "id long, media binary, `meta.lang` string")
    found = media.stored(df, ["id", "meta.lang"])
    for row, image in zip(sorted(found.collect(), key=lambda r: r["id"]), images, strict=True):
        tiles = [(t["row"], t["col"], np.load(io.BytesIO(t["npy"])), t["hash"]) for t in row["tiles"]]
        whole = np.zeros_like(image)
        for y, x, part, digest in tiles:
            whole[y : y + part.shape[0], x : x + part.shape[1]] = part
            assert max(part.shape[:2]) <= media.TILE and digest == media.difference_hash(part)
        assert (whole == image).all() and (row["height"], row["width"], row["channels"]) == image.shape
    back = {r["id"]: r for r in media.read_back(found, ["id", "meta.lang"]).collect()}
    for k, image in enumerate(images):
        assert back[k]["payload_sha256"] == hashlib.sha256(image.tobytes()).hexdigest() and back[k]["meta.lang"] == "mine"
    each = media.each_tile(found, ["id", "meta.lang"])
    assert each.columns == ["id", "meta.lang", "row", "col", "hash", "npy"] and each.count() == 1 + 1 + 6 + 2 + 1
    assert media.stored(df.where("false"), ["id"]).count() == 0


def test_hash_says_which_neighbour_is_lighter():
    rising = np.tile(np.arange(90, dtype=np.uint8), (80, 1))[:, :, None]
    assert media.difference_hash(rising) == "f" * 16 and media.difference_hash(rising[:, ::-1]) == "0" * 16
    assert media.difference_hash(np.repeat(rising, 3, axis=2)) == "f" * 16
    bright = (rising // 2 + 40).astype(np.uint8)
    assert bin(int(media.difference_hash(bright), 16) ^ int(media.difference_hash(rising), 16)).count("1") <= 8


TEXTS = [None, "", "a", "x" * 64, "x" * 65, "é" * 40, "😀", "\x00\x01", "long text " * 5000, "a"]


def test_payload_of_texts(spark):
    df = docs(spark, TEXTS)
    images = df.select("doc_id", media.as_graymap(media.padded(F.col("text"))).alias("media"))
    rows = {r["doc_id"]: r for r in media.read_back(media.stored(images, ["doc_id"]), ["doc_id", "hash"]).collect()}
    for k, text in enumerate(TEXTS):
        raw = (text or "").encode()
        raw += b"\0" * (max(-(-len(raw) // 64), 1) * 64 - len(raw))
        assert rows[k]["payload_bytes"] == len(raw) and rows[k]["payload_sha256"] == hashlib.sha256(raw).hexdigest()
    same = lambda k: [v for c, v in rows[k].asDict().items() if c != "doc_id"]
    assert same(2) == same(9) and same(0) == same(1)


# Fill in the middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def slow_fim(doc_id, text, rate=50, first=80):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < first:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@given(st.text(alphabet="ab é😀 \t\n\x0b\x0c\r\x1f\x85 <PSM>", max_size=60))
@settings(max_examples=400, deadline=None)
def test_units_by_brute_force(text):
    units = UNIT.findall(text)
    spaces, sentinel = fill_middle.events(text)
    found = fill_middle.Units(spaces, len(text))
    assert found.n == len(units) and sentinel == bool(re.search("<[PSM]>", text))
    assert [found.end(k) for k in range(found.n + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


ODD = [None, "", " ", "\n\n", "one", " one", "one ", "a b c", "<P> x", "x <S", "<", "P>", "a<M>b", "é ü 😀\tz\r\n", "x\x1fy\x85z", "word " * 4000, "<P x> " * 9, "a b c"]


def test_forms_by_brute_force(spark):
    texts = ODD * 6
    df = docs(spark, texts).union(spark.createDataFrame([(None, "null id here")], "doc_id long, text string").withColumns({c: F.lit("mine") for c in NAMES}))
    rows = fill_middle.transformed(df).withColumn("back", fill_middle.restored()).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = "null id here" if r["doc_id"] is None else texts[r["doc_id"]]
        assert tuple(r)[1:6] == slow_fim(r["doc_id"], text) and r["back"] == (text or "")
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert fill_middle.transformed(df.where("false")).count() == 0


def test_rates_are_parameters(spark):
    df = docs(spark, ["a b c d"] * 200)
    count = lambda **kw: {r["form"]: r["count"] for r in fill_middle.transformed(df, **kw).groupBy("form").count().collect()}
    assert count(rate=0) == {"plain": 200} and count(rate=100, suffix_first=0) == {"psm": 200} and count(rate=100, suffix_first=100) == {"spm": 200}
    seeds = [{r["doc_id"]: r["output"] for r in fill_middle.transformed(df, seed=s, rate=100).collect()} for s in (1, 2)]
    assert seeds[0] != seeds[1]


# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_search(rows, items, k=10):
    held = [(d, terms_of(t)) for d, t in rows]
    held = [(d, t) for d, t in held if t]
    n, total = len(held), sum(len(t) for _, t in held)
    out = {}
    for item in {i for i, _ in items}:
        asked = {w for i, t in items if i == item for w in terms_of(t)}
        scores = []
        for d, t in held:
            m = 10 + 90 * len(t) * n // total
            s = 0
            for w in asked:
                df, tf = sum(w in x for _, x in held), t.count(w)
                s += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (1000000000 * tf // (1000 * tf + 8 * m))
            if s:
                scores.append((-s, d is None, d))
        out[item] = [(r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return out


@pytest.mark.parametrize("seed, leaf, wide, most, size", [(0, 2, 2, 1000, 7), (1, 32, 8, 12, 4096), (2, 4, 3, 1000, 60), (3, 1, 2, 5, 16)])
def test_search_by_brute_force(spark, monkeypatch, seed, leaf, wide, most, size):
    for name, value in (("LEAF", leaf), ("FAN", wide), ("RANGE", size)):
        monkeypatch.setattr(search, name, value)
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "Zwei", "x9", "naïve"]
    texts = [" ".join(rng.choice(vocabulary[: rng.randint(2, 34)]) for _ in range(rng.randint(0, 40))) for _ in range(90)] + ["", None, "... !!", texts_same := "w1 w2 w3", texts_same, texts_same]
    texts += ["w0 " * 3000, "w29"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    rows.append((None, "w4 w5"))
    items = [(k, " ".join(rng.sample(vocabulary, rng.randint(1, 12))) + ", W1!") for k in range(15)] + [(3, "w7 w8"), (50, ""), (51, None), (52, "unknown words"), (53, "w0 w0 w0")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("mine") for c in NAMES}).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit("mine"))
    got = found(search.ranked(df, asked, most=most).collect())
    want = {k: v for k, v in slow_search(rows, items).items() if v}
    assert got == want


def test_repeated_documents_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (0, "a b"), (2, "c")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "a"), (None, "c")], "item_id string, text string")
    got = found(search.ranked(df, items).collect())
    assert [(r, d) for r, d, _ in got["x"]] == [(1, 0), (2, 1), (3, 1)] and [d for _, d, _ in got[None]] == [2]
    assert search.ranked(df.where("false"), items).count() == 0 and search.ranked(df, items.where("false")).count() == 0
    assert search.ranked(df, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_leave_most_nodes_closed():
    rng = np.random.default_rng(4)
    n, per, terms = 4096, 30, 500
    held = [np.unique(rng.zipf(1.3, per) % terms) for _ in range(n)]
    popular = np.concatenate(held).astype(np.int64)
    r = search.Range(list(range(n)), [100] * n, popular, rng.integers(1, 9, len(popular)), np.array([len(x) for x in held]), np.linspace(10, 9000, terms).astype(np.int64))
    asked = np.array([5, 77, 130, 420])
    best: list = []
    opened = r.search(asked, best)
    total = np.zeros(n, dtype=np.int64)
    leaves = r.levels[0].shape[1]
    for t in r.rows(asked):
        own = slice(r.first[t * leaves], r.first[(t + 1) * leaves])
        total[r.place[own]] += r.score[own]
    want = sorted(((-s, d) for d, s in enumerate(total.tolist()) if s))[:10]
    assert sorted((-s, -d) for s, _, d in best) == want
    assert opened < leaves
