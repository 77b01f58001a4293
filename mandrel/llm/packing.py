"""Sequence packing by non-negative least squares over a length histogram.

1. Tokenise every document once (ids, then the end id). A document becomes full windows, which need no
   company, and one tail shorter than a window. The table that is written holds lengths, checksums and
   the tail's ids.
2. The histogram of tail lengths has one bin for each length below the window, whatever the corpus.
   All combinations of two or three lengths that fill a window are enumerated and priced; non-negative
   least squares finds how often to use each that lowers the error; counts are rounded, and lowered to
   what the histogram still has.
3. What the rounded counts leave is packed greedily, the longest first, cutting a tail where a window
   ends; only the last sequence of all is padded.
4. Every tail finds its place from its length and its rank among the tails of that length. Ranks are
   counted where tails are written and shifted by sums over (length, partition), so a length that a third
   of all documents share lands in as many tasks as it came from.

Defined results: a null text is an empty one, whose only id is the end id; repeated rows are documents of
their own; ties of length go by partition and place in it; null ids stay null; an empty table gives no pieces; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mandrel.llm.common import small, staged

WINDOW = 2048
END_ID = 1
#: Bytes of words and ids, with what a dictionary spends on an entry, that a worker remembers at most: beyond half of it, what has not been met since goes.
CACHE_BYTES, ENTRY_BYTES = 512 << 20, 130
#: Rounds in which combinations enter the least-squares problem, the gain that one must promise, and how many of a round may share a length.
ROUNDS, GAIN, SPREAD = 12, 0.5, 4
#: Full windows of one partition are numbered in a range of their own of this size.
RANGE = 1 << 36

STAGED = "doc_id long, pid long, n_tokens long, n_full long, full_base long, full_crcs array<long>, tail long, tail_rank long, tail_crc long, tail_ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_PUNCTUATION = ".,;:!?*$%&#"


class WordTokens:
    """Ids of whole texts as little-endian 32-bit bytes, remembered by word.

    The tokenizer drops white space and never joins over it, so a text's ids are those of its words in turn.
    A word of letters and trailing punctuation is split once more, as the tokenizer itself does.
    """

    def __init__(self, path: str, limit: int = CACHE_BYTES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        """The words that were met since the last time become the old ones, and the old ones go."""
        self.old = getattr(self, "words", {})
        self.words: dict[str, bytes] = {"": b""}
        self.size = 0

    def _unknown(self, words: set[str]) -> set[str]:
        """What is new of words; of the rest, what is old is taken into use again."""
        words = words.difference(self.words)
        again = words & self.old.keys()
        self.words.update((w, self.old[w]) for w in again)
        self._count(again)
        return words - again

    def _count(self, words) -> None:
        self.size += ENTRY_BYTES * len(words) + 2 * sum(map(len, words))

    def _letters(self, missing: list[str]) -> None:
        """Words of small ASCII letters: normal as they are and in one part, so they go to the tokenizer's model at once."""
        got = list(map(self.model.tokenize, missing))
        cut = [0, *accumulate([4 * len(x) for x in got])]
        ids = np.array([t.id for x in got for t in x], dtype="<u4").tobytes()
        self.words.update(zip(missing, map(ids.__getitem__, map(slice, cut, cut[1:])), strict=False))

    def _runs(self, missing: list[str]) -> None:
        if not missing:
            return
        got = self.tokenizer.encode(" ".join(missing), add_special_tokens=False)
        owner = np.array(got.word_ids)
        if owner[-1] == len(missing) - 1:
            cut = (4 * np.searchsorted(owner, np.arange(len(missing) + 1))).tolist()
            ids = np.array(got.ids, dtype="<u4").tobytes()
            self.words.update(zip(missing, map(ids.__getitem__, map(slice, cut, cut[1:])), strict=False))
        else:
            self._whole(missing, self.words)

    def _whole(self, missing: list[str], into: dict[str, bytes]) -> None:
        for w, got in zip(missing, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False), strict=True):
            into[w] = np.array(got.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [x.replace("\n", " ").split(" ") for x in texts]
        if 2 * self.size > self.limit:
            self._forget()
        fresh = self._unknown(set(chain.from_iterable(split)))
        # Lists of plain strings: nothing here is of interest to the collector of cycles.
        plain, whole, parted, lows, rests = [], [], [], [], []
        for w in fresh:
            if w.isascii() and w.isalpha() and w.islower():
                plain.append(w)
                continue
            stem = w.rstrip(_PUNCTUATION)
            low, rest = stem.lower(), w[len(stem) :]
            # Lower case of a capital dotted I ends in a mark that the tokenizer joins to what follows.
            if stem.isalpha() and (stem.isascii() or max(stem) < "ɐ") and low.isalpha():
                parted.append(w)
                lows.append(low)
                rests.append(rest)
            else:
                whole.append(w)
        more = self._unknown({*lows, *rests}).difference(plain)
        small = [w for w in more if w.isascii() and w.isalpha()]
        self._letters([*plain, *small])
        self._runs(list(more.difference(small)))
        if whole:
            self._whole(whole, self.words)
        known = self.words
        known.update(zip(parted, map(add, map(known.__getitem__, lows), map(known.__getitem__, rests)), strict=True))
        self._count(fresh)
        self._count(more)
        find = self.words.__getitem__
        return [b"".join(map(find, x)) for x in split]


_WORKER: dict[str, WordTokens] = {}


def _tokenised(path: str, window: int, end_id: int, cache: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _WORKER:
            _WORKER.clear()
            _WORKER[path] = WordTokens(path)
        words = _WORKER[path]
        words.limit = cache
        pid = TaskContext.get().partitionId()
        rank = np.zeros(window, dtype=np.int64)
        full = 0
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                part = batch.slice(low, 128)
                out = []
                for doc, ids in zip(part.column(0).to_pylist(), words.encode([x or "" for x in part.column(1).to_pylist()]), strict=True):
                    ids += end
                    n, step = len(ids) // 4, 4 * window
                    n_full, tail = divmod(n, window)
                    rest = ids[n_full * step :]
                    out.append((doc, pid, n, n_full, pid * RANGE + full, [zlib.crc32(ids[k * step : (k + 1) * step]) for k in range(n_full)], tail, int(rank[tail]), zlib.crc32(rest), rest))
                    rank[tail] += 1
                    full += n_full
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], names=_NAMES)

    return run


_NAMES = [x.split()[0] for x in STAGED.split(", ")]
_TYPES = [pa.int64()] * 5 + [pa.list_(pa.int64())] + [pa.int64()] * 3 + [pa.binary()]


def tokenised(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, cache: int = CACHE_BYTES) -> DataFrame:
    """One row for each document: lengths, checksums, the tail's ids and its rank in its partition. Written once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return staged(rows.mapInArrow(_tokenised(path, window, end_id, cache), STAGED), "tokenised")


@dataclass(frozen=True)
class Plan:
    """slots: (tail length, first rank, end rank, first sequence, offset) of the combinations. rest: (tail length, first rank, first position in the greedy stream). first: sequence where that stream starts."""

    slots: list[tuple[int, int, int, int, int]]
    rest: list[tuple[int, int, int]]
    first: int
    sequences: int
    padding: int


def combinations(counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Every multiset of two or three present lengths that fills a window exactly: pairs (n, 2), triples (n, 3), the longest first."""
    present = counts > 0
    present[0] = False
    have = np.flatnonzero(present[:window])
    pairs = have[(2 * have >= window) & present[window - have]]
    triples = []
    for a in have[3 * have >= window]:
        b = have[(have <= a) & (2 * have >= window - a) & (have < window - a)]
        b = b[present[window - a - b]]
        triples.append(np.column_stack([np.full(len(b), a), b, window - a - b]))
    empty = np.zeros((0, 3), dtype=np.int64)
    return np.column_stack([pairs, window - pairs]), np.concatenate([empty, *triples])


def solved(counts: np.ndarray, window: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """The least-squares repeat count of every combination that has one.

    All combinations are priced, but only those that can lower the error enter the problem: all pairs, then, round
    by round, the triples whose lengths are most under-filled by the solution so far. It ends where none would gain.
    """
    pairs, triples = combinations(counts, window)
    patterns: list[tuple[int, ...]] = [tuple(p) for p in pairs.tolist()]
    open_ = np.ones(len(triples), dtype=bool)
    x = nnls(patterns, counts)
    for _ in range(ROUNDS):
        left = counts.astype(float)
        for_all = np.array([v for p in patterns for v in p], dtype=np.int64)
        if len(for_all):
            left -= np.bincount(for_all, weights=np.repeat(x, [len(p) for p in patterns]), minlength=len(counts))
        price = np.where(open_, left[triples].sum(axis=1), 0.0) if len(triples) else np.zeros(0)
        good = np.flatnonzero(price > GAIN)
        if not len(good):
            break
        # Of equal lengths the best-priced triple first, so that the entering ones cover many lengths.
        good = good[np.argsort(-price[good], kind="stable")]
        used = np.zeros(len(counts), dtype=np.int64)
        enter = []
        for k in good:
            t = triples[k]
            if used[t].max() < SPREAD:
                np.add.at(used, t, 1)
                enter.append(k)
        open_[enter] = False
        patterns += [tuple(t) for t in triples[enter].tolist()]
        x = nnls(patterns, counts, start=np.concatenate([x, np.zeros(len(enter))]))
    return patterns, x


def nnls(patterns: list[tuple[int, ...]], counts: np.ndarray, steps: int = 400, start: np.ndarray | None = None) -> np.ndarray:
    """x >= 0 that minimises |A x - counts|^2, A's columns being the patterns; accelerated projected gradient."""
    if not patterns:
        return np.zeros(0)
    rows = np.array([x for p in patterns for x in p])
    cols = np.array([k for k, p in enumerate(patterns) for _ in p])
    target = counts.astype(float)
    size, n = len(patterns), len(counts)
    times = lambda v: np.bincount(rows, weights=v[cols], minlength=n)
    back = lambda r: np.bincount(cols, weights=r[rows], minlength=size)
    v = np.ones(size)
    for _ in range(20):
        v = back(times(v))
        v /= np.linalg.norm(v)
    rate = 1.0 / (np.linalg.norm(back(times(v))) * 1.02)
    x = y = np.zeros(size) if start is None else start
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - rate * back(times(y) - target))
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def plan(counts: np.ndarray, window: int = WINDOW) -> Plan:
    """Where tails go, from the histogram of their lengths (counts[n]: tails of n tokens, 0 < n < window)."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    used = np.zeros(window, dtype=np.int64)
    slots, sequence = [], 0
    patterns, want = solved(left, window)
    for k in np.argsort(-want, kind="stable"):
        need = np.bincount(np.array(patterns[k]), minlength=window)
        most = min(int(left[x] // need[x]) for x in set(patterns[k]))
        times = min(int(want[k] + 0.5), most)
        if times <= 0:
            continue
        offset = 0
        for x in patterns[k]:
            slots.append((x, int(used[x]), int(used[x]) + times, sequence, offset))
            used[x] += times
            left[x] -= times
            offset += x
        sequence += times
    rest, position = [], 0
    for x in sorted(np.flatnonzero(left), reverse=True):
        rest.append((int(x), int(used[x]), position))
        position += int(x) * int(left[x])
    more = -(-position // window)
    return Plan(slots, rest, sequence, sequence + more, more * window - position)


def packed(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of tokenised rows, each with its sequence and offset."""
    spark = rows.sparkSession
    groups = rows.where("tail > 0").groupBy("tail", "pid").agg(F.count("*").alias("n"))
    groups = staged(groups, "tails")
    counts = np.zeros(window, dtype=np.int64)
    for r in groups.groupBy("tail").agg(F.sum("n").alias("n")).collect():  # at most one row for each length
        counts[r["tail"]] = r["n"]
    p = plan(counts, window)
    # Ranks of a length run over its partitions in turn; one row for each (length, partition).
    before = groups.select(F.col("tail").cast("int").alias("tail"), F.col("pid").cast("int").alias("pid"), F.coalesce(F.sum("n").over(Window.partitionBy("tail").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    before = small(staged(before, "before"), F.lit(32))
    # The plan has at most three slots for each combination that entered and one rest for each length: window, ROUNDS and SPREAD bound it.
    slots = spark.createDataFrame(p.slots or [(-1, 0, 0, 0, 0)], "tail long, low long, high long, seq long, at long")
    lists = slots.groupBy("tail").agg(F.sort_array(F.collect_list(F.struct("low", "high", "seq", "at"))).alias("slots"))
    rest = spark.createDataFrame(p.rest or [(-1, 0, 0)], "tail long, rest_low long, rest_at long")
    lists = F.broadcast(lists.join(rest, "tail", "full"))
    full = rows.where("n_full > 0").select("doc_id", "n_tokens", "full_base", F.posexplode("full_crcs").alias("k", "crc"))
    full = full.select(
        "doc_id", (F.col("k") * F.lit(window)).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), F.col("crc").alias("ids_crc32"),
        F.col("n_tokens").alias("doc_tokens"), (F.lit(p.sequences) + F.col("full_base") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    tails = rows.where("tail > 0").join(before, ["tail", "pid"]).join(lists, "tail")
    tails = tails.withColumn("rank", F.col("tail_rank") + F.col("before"))
    slot = F.get(F.filter("slots", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"])), F.lit(0))
    tails = tails.withColumn("slot", slot).withColumn("stream", F.col("rest_at") + (F.col("rank") - F.col("rest_low")) * F.col("tail"))
    whole = F.struct(F.lit(0).cast("long").alias("from"), F.col("tail").alias("n"), (F.col("slot.seq") + F.col("rank") - F.col("slot.low")).alias("seq"), F.col("slot.at").alias("at"))
    room = F.lit(window) - F.pmod("stream", F.lit(window))
    first = F.least("tail", room)
    seq = F.lit(p.first) + F.floor(F.col("stream") / F.lit(window))
    one = F.struct(F.lit(0).cast("long").alias("from"), first.cast("long").alias("n"), seq.cast("long").alias("seq"), F.pmod("stream", F.lit(window)).cast("long").alias("at"))
    two = F.struct(first.cast("long").alias("from"), (F.col("tail") - first).cast("long").alias("n"), (seq + 1).cast("long").alias("seq"), F.lit(0).cast("long").alias("at"))
    cuts = F.when(F.col("slot").isNotNull(), F.array(whole)).when(F.col("tail") <= room, F.array(one)).otherwise(F.array(one, two))
    tails = tails.select("doc_id", "n_tokens", "n_full", "tail", "tail_crc", "tail_ids", F.explode(cuts).alias("c"))
    piece = F.when(F.col("c.n") == F.col("tail"), F.col("tail_crc")).otherwise(F.crc32(F.substring("tail_ids", (4 * F.col("c.from") + 1).cast("int"), (4 * F.col("c.n")).cast("int"))))
    tails = tails.select(
        "doc_id", (F.col("n_full") * F.lit(window) + F.col("c.from")).alias("start"), F.col("c.n").alias("length"), piece.alias("ids_crc32"),
        F.col("n_tokens").alias("doc_tokens"), F.col("c.seq").alias("sequence_id"), F.col("c.at").alias("offset"),
    )
    return full.unionByName(tails)


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, cache: int = CACHE_BYTES) -> DataFrame:
    """Pack whole documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. cache: bytes that a worker remembers of words; fewer take longer."""
    return packed(tokenised(docs, path, window, end_id, cache), window)
