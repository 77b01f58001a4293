"""Near-duplicate classes by HyperMinHash sketches, verified on full shingle sets.

1. One pass over the texts: words, the 128-bit key of the whole word sequence, and the sketch. A shingle's
   64-bit hash picks one of 256 buckets; a bucket's register keeps the leading-zero count of its least hash
   and the ten bits behind the leading one: 16 bits. Empty buckets borrow from a bucket that a fixed
   sequence of hashes picks, the same for every text.
2. Texts with the same key are copies: one class representative stands for them from here on.
3. Banding: 51 bands of five compressed registers. At a similarity of 0.75 a pair shares no band with a
   probability of 1e-6. Bands that one representative has alone are dropped by a partial count.
4. First round: members of a band meet two centres, the one whose bands have most members (of a group of
   near copies that is the least edited one) and the least key (a random one). Pairs whose
   collision-corrected estimate is five standard errors below the threshold are dropped, the others
   verified on full sets.
5. Components of the verified links. Where a band's members lie in different components, members of
   different components are compared: pair by pair in bands of up to 16, and in larger ones by blocks,
   in which everyone outside the band's largest component meets everyone, on full sets; a block returns
   links that join components, at most one for each member. So a large group of near copies costs a star
   and its outliers, and no pair over components that shares a band goes unverified.

Defined results: a text without words has an empty set, links with nothing and is kept; fewer words than
the shingle size are one shingle; null ids sort last, so a class's id is its least id that isn't null;
repeated rows are copies; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandrel.llm.common import OWN, release, small, split_join, staged

SHINGLE, THRESHOLD = 5, 75
BUCKET_BITS, MANTISSA_BITS = 8, 10
BUCKETS = 1 << BUCKET_BITS
BANDS, ROWS = 51, 5
#: Probability that two unrelated registers agree: equal leading-zero counts (a half at most), equal mantissas.
COLLISION = 0.5 / (1 << MANTISSA_BITS)

#: Bands of up to PAIRED members are compared pair by pair, larger ones in blocks of BLOCK.
PAIRED, BLOCK, BLOCK_SHINGLES = 16, 1024, 1 << 20

#: Edges of one node that a task may read.
HUB = 100_000

_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _picks(rounds: int = 64) -> np.ndarray:
    """For each round, the bucket that an empty bucket looks at."""
    with np.errstate(over="ignore"):
        at = np.arange(rounds * BUCKETS, dtype=np.uint64) * _STEP + np.uint64(0x5EED)
        return (_mix(at) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64).reshape(rounds, BUCKETS)


_PICKS = _picks()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower() and split() are ASCII's


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    one = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(one, words), dtype=np.uint64, count=len(words))
    n = min(size, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            out = out * _STEP + _mix(h[k : len(h) - n + 1 + k])
        return np.unique(_mix(out))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """256 registers of 16 bits from sorted hashes."""
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    filled, first = np.unique(bucket, return_index=True)
    rest = hashes[first] << np.uint64(BUCKET_BITS)
    rest = np.where(rest == 0, np.uint64(1), rest)
    # Leading zeros by the float exponent, made exact where rounding carried over.
    top = np.floor(np.log2(rest.astype(np.float64))).astype(np.int64)
    top = np.where((top > 63) | (np.uint64(1) << np.minimum(top, 63).astype(np.uint64) > rest), top - 1, top)
    zeros = 63 - top
    behind = (rest << np.minimum(zeros, 62).astype(np.uint64)) << np.uint64(1)
    register = (zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS)) | (behind >> np.uint64(64 - MANTISSA_BITS))
    out = np.zeros(BUCKETS, dtype="<u2")
    full = np.zeros(BUCKETS, dtype=bool)
    out[filled], full[filled] = register.astype("<u2"), True
    empty = np.flatnonzero(~full)
    original, n = full.copy(), 0
    while len(empty):
        if n < len(_PICKS):
            source = _PICKS[n][empty]
        else:  # few buckets are full: each empty one goes on from where its picks led
            source = (source + 1) % BUCKETS
        got = original[source]
        out[empty[got]] = out[source[got]]
        empty, source = empty[~got], source[~got]
        n += 1
    return out


SKETCHED = "doc_id long, raw long, key binary, n_shingles long, sketch binary"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            part = batch.slice(low, 512)
            keys, counts, sketches = [], [], []
            for text in part.column(1).to_pylist():
                words = words_of(text)
                if words:
                    h = shingle_hashes(words)
                    keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
                    counts.append(len(h))
                    sketches.append(sketch(h).tobytes())
                else:
                    keys.append(None)
                    counts.append(0)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(sketches, pa.binary())], names=["doc_id", "raw", "key", "n_shingles", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            keys, sets = [], []
            for text in batch.slice(low, 256).column(0).to_pylist():
                words = words_of(text)
                keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
                sets.append(shingle_hashes(words).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["key", "shingles"])


@F.pandas_udf(T.DoubleType())
def estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    """Collision-corrected Jaccard estimate of two sketches."""
    if not len(a):
        return pd.Series([], dtype=float)
    x = np.frombuffer(b"".join(a), dtype="<u2").reshape(len(a), BUCKETS)
    y = np.frombuffer(b"".join(b), dtype="<u2").reshape(len(b), BUCKETS)
    return pd.Series(((x == y).mean(axis=1) - COLLISION) / (1 - COLLISION))


def components(edges: DataFrame, hub: int = HUB) -> DataFrame:
    """(node, label): label is the least node of the component. edges: a, b. Alternating large and small stars; each round is written.

    The hub of a star may have a third of all edges; where a node has more than `hub` edges, joins split such nodes.
    """
    edges = staged(edges.where("a != b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    both = lambda: edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    before = None
    while True:
        per = both().groupBy("u").agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        now = per.agg(F.sum("n"), F.sum("h"), F.max("n")).first()
        if not now[0] or now == before:
            break
        before, star = now, now[2] > hub
        made = [edges]
        keep = lambda df, label: made.append(staged(df, label)) or made[-1] if star else df  # noqa: E731, B023
        meet = split_join if star else lambda rows, info, key: rows.join(info, key)
        least = keep(both().groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"), "least")
        large = keep(meet(both(), least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u != v").distinct(), "large")
        # Small star: every edge (u, v), u < v, hangs from v; v's least neighbour takes v and v's other neighbours.
        least = keep(large.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n")), "least")
        small = meet(large, least, "v").select(F.col("m").alias("x"), F.explode(F.array("u", "v")).alias("y")).where("x != y")
        edges = staged(small.select(F.col("x").alias("u"), F.col("y").alias("v")).distinct(), "edges")
        for done in made:
            release(done)
    stars = edges.select(F.col("v").alias("node"), F.col("u").alias("label"))
    return stars.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct())


def _verified(pairs: DataFrame, reps: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """a, b, distance (1 - Jaccard), linked; only pairs that the estimate leaves."""
    s = reps.select("key", "sketch", "n_shingles")
    p = pairs.join(s.select(F.col("key").alias("b"), F.col("sketch").alias("sb"), F.col("n_shingles").alias("nb")), "b")
    p = p.join(s.select(F.col("key").alias("a"), F.col("sketch").alias("sa"), F.col("n_shingles").alias("na")), "a")
    # Sizes alone rule out pairs whose sets differ too much.
    p = p.where((100 * F.least("na", "nb")) >= threshold * F.greatest("na", "nb"))
    share = threshold / 100
    margin = 5 * F.sqrt(F.lit(share * (1 - share)) / F.least(F.lit(float(BUCKETS)), F.col("na"), F.col("nb")))
    p = p.where(estimate("sa", "sb") >= F.lit(share) - margin).select("a", "b")
    p = p.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("xb")), "b")
    p = p.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("xa")), "a")
    p = p.select("a", "b", F.size(F.array_intersect("xa", "xb")).cast("long").alias("both"), (F.size("xa") + F.size("xb")).cast("long").alias("sum"))
    union = F.col("sum") - F.col("both")
    return p.select("a", "b", (1 - F.col("both") / union).alias("distance"), (100 * F.col("both") >= threshold * union).alias("linked"))


def _joins(group: pd.DataFrame, threshold: int = THRESHOLD) -> pd.DataFrame:
    """Links between components in one block: every probe against every row, on full sets."""
    flat = np.concatenate(group["shingles"].to_numpy())
    ends = np.cumsum([len(x) for x in group["shingles"]])
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    names, where = np.unique(flat, return_inverse=True)
    keys, probe = group["key"].to_numpy(), group["probe"].to_numpy()
    of = pd.factorize(group["label"])[0]
    links = []
    for k in np.flatnonzero(probe):
        others = of != of[k]
        if not others.any():
            continue
        mark = np.zeros(len(names), dtype=np.int32)
        mark[where[starts[k] : ends[k]]] = 1
        both = np.add.reduceat(mark[where], starts)
        near = np.flatnonzero(others & (100 * both >= threshold * (sizes + sizes[k] - both)))
        for x in near:
            if of[x] != of[k]:
                links.append((keys[k], keys[x]))
                of[of == of[x]] = of[k]
    return pd.DataFrame(links, columns=["a", "b"])


def _over_components(members: DataFrame, labels: DataFrame, first: DataFrame, reps: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) between members of a band that lie in different components so far."""
    named = members.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    mixed = named.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.first("n").alias("n")).where("x != y").select("band", "n")
    mixed = staged(mixed, "bands")
    named = staged(split_join(named.drop("n"), mixed, "band"), "mixed")
    few = named.where(F.col("n") <= PAIRED).select("band", "key", "label")
    meets = (F.col("l.band") == F.col("r.band")) & (F.col("l.key") < F.col("r.key")) & (F.col("l.label") != F.col("r.label"))
    more = few.alias("l").join(few.alias("r"), meets).select(F.col("l.key").alias("a"), F.col("r.key").alias("b")).distinct()
    more = staged(more.join(first.select("a", "b"), ["a", "b"], "left_anti"), "more")
    paired = _verified(more, reps, sets, threshold).where("linked").select("a", "b")
    many = named.where(F.col("n") > PAIRED)
    each = many.groupBy("band", "label").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("w"), F.first("n").alias("n"))
    each = each.groupBy("band").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.max("c").alias("c"), F.first("n").alias("n"), F.sum("w").alias("w"), F.max_by("w", F.struct("c", "label")).alias("main_w"))
    many = split_join(many.drop("n"), staged(each, "main"), "band").withColumn("probe", F.col("label") != F.col("main"))
    # A block has BLOCK members and BLOCK_SHINGLES shingles on either side, as an average over a band's blocks.
    blocks = lambda n, w: F.greatest(F.ceil(n / F.lit(BLOCK)), F.ceil(w / F.lit(BLOCK_SHINGLES))).cast("int")
    at = F.xxhash64("key")
    rows, probes = blocks(F.col("n"), F.col("w")), blocks(F.col("n") - F.col("c"), F.col("w") - F.col("main_w"))
    task = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    as_row = many.select("band", "key", "label", F.lit(False).alias("probe"), F.explode(F.transform(upto(probes), lambda i: task(i, F.pmod(at, rows)))).alias("t"))
    as_probe = many.where("probe").select("band", "key", "label", "probe", F.explode(F.transform(upto(rows), lambda j: task(F.pmod(at, probes), j))).alias("t"))
    tasks = as_row.unionByName(as_probe).select("band", "t.i", "t.j", "key", "label", "probe").join(sets, "key")
    blocked = tasks.groupBy("band", "i", "j").applyInPandas(lambda g: _joins(g, threshold), "a binary, b binary")
    second = staged(paired.unionByName(blocked).distinct(), "second")
    for done in (mixed, named, more):
        release(done)
    return second


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (least id of its class), kept."""
    return _classed(docs, doc_id, text, threshold).select("doc_id", "n_shingles", "component_id", "kept")


def _classed(docs: DataFrame, doc_id: str, text: str, threshold: int) -> DataFrame:
    """The same with `key` (of the words) and `raw` (hash of the text as it is)."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("raw"))
    rows = staged(docs.mapInArrow(_sketched, SKETCHED), "sketched")
    copies = staged(rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "copies")
    reps = rows.where("key is not null").join(copies.select(F.col("key").alias("k"), "rep"), F.col("key").eqNullSafe(F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    reps = staged(reps.select("key", "rep", "n_shingles", "sketch").dropDuplicates(["key"]), "reps")
    bands = reps.select("key", "n_shingles", F.explode(F.array(*[F.xxhash64(F.lit(j), F.substring("sketch", 2 * ROWS * j + 1, 2 * ROWS)) for j in range(BANDS)])).alias("band"))
    shared = staged(bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    members = staged(split_join(bands, shared, "band"), "members")
    company = members.groupBy("key").agg(F.sum("n").alias("company"))
    centres = members.join(company, "key").groupBy("band").agg(F.max_by("key", F.struct("company", "key")).alias("best"), F.min("key").alias("low"), F.first("n").alias("n"))
    centres = staged(centres, "centres")
    pairs = split_join(members.select("band", "key"), centres, "band").select(F.col("key").alias("b"), F.explode(F.array("best", "low")).alias("a")).where("a != b")
    pairs = staged(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    # Full sets of the representatives that any pair needs; only ids and keys move, then their texts.
    asked = members.select(F.col("key").alias("k")).distinct().join(reps.select(F.col("key").alias("k"), "rep"), "k").select(F.col("rep").alias("doc_id"))
    ids = small(staged(asked.distinct(), "asked"), F.lit(16))
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").select("text")
    sets = texts.where("text is not null").mapInArrow(_sets, "key binary, shingles array<long>")
    sets = staged(sets.dropDuplicates(["key"]), "sets")
    first = staged(_verified(pairs, reps, sets, threshold), "first")
    labels = components(first.where("linked").select("a", "b"))
    second = _over_components(members, labels, first, reps, sets, threshold)
    # Components of the whole: links of both rounds; the first round's are stars already.
    labels = components(labels.select(F.col("label").alias("a"), F.col("node").alias("b")).unionByName(second))
    for done in (reps, shared, members, centres, pairs, ids, sets, first, second):
        release(done)
    named = copies.join(labels.withColumnRenamed("node", "key"), "key", "left").select("key", "rep", "n", F.coalesce("label", "key").alias("label"))
    least = staged(named.groupBy("label").agg(F.min("rep").alias("component_id"), F.count("*").alias("m")), "least")
    of_key = staged(split_join(named, least, "label", "m").select("key", "n", "component_id"), "of_key")
    # A text that a third of all documents copy is one row here, and goes to its documents.
    columns = ["doc_id", "n_shingles", "key", "raw"]
    out = split_join(rows.select(*columns), of_key, "key").select(*columns, "component_id")
    out = out.unionByName(rows.where("key is null").select(*columns, F.lit(None).cast("long").alias("component_id")))
    out = out.select("doc_id", "n_shingles", "key", "raw", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.col("key").isNull().alias("empty"))
    return out.withColumn("kept", F.col("empty") | F.col("doc_id").eqNullSafe(F.col("component_id"))).drop("empty")


_ID, _RAW = f"{OWN}id", f"{OWN}raw"


def kept(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each class, that of its least id, with the columns of docs. Texts without words all stay.

    Rows that repeat a kept document, with its id and words, are the same document again; one of them stays.
    """
    found = staged(_classed(docs, doc_id, text, THRESHOLD).select(F.col("doc_id").alias(_ID), F.col("raw").alias(_RAW), "key", "kept"), "classed")
    each = found.groupBy(_ID, "key", _RAW).agg(F.count("*").alias("n"), F.first("kept").alias("kept"))
    # Of one document's spellings the least hash stays; texts without words have no key and stay.
    least = found.where("key is not null").groupBy(_ID, "key").agg(F.min(_RAW).alias("least"))
    each = each.join(least, each[_ID].eqNullSafe(least[_ID]) & (each["key"] == least["key"]), "left").select(each[_ID], each[_RAW], "n", "kept", "least")
    stays = F.col("kept") & (F.col("least").isNull() | (F.col("least") == F.col(_RAW)))
    ids = staged(each.select(_ID, _RAW, stays.alias("stays"), (stays & F.col("least").isNotNull() & (F.col("n") > 1)).alias("again")), "ids")
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(_ID)) & F.xxhash64(text).eqNullSafe(F.col(_RAW))
    # What goes is less than what stays, and often small enough for every task; then no text moves.
    gone = staged(ids.where("again OR NOT stays").select(_ID, _RAW), "gone")
    rows = docs.join(small(gone, F.lit(32)), same, "left_anti")
    again = staged(ids.where("again").select(_ID, _RAW), "again")
    if not again.limit(1).count():
        return rows
    return rows.unionByName(docs.join(small(again, F.lit(32)), same, "left_semi").dropDuplicates([doc_id, text]))
