"""Ranked lexical search: the best documents for each item, exactly, by branch and bound over max trees.

1. One pass over the texts gives each document its number of terms and, of the items' terms, those that it holds with
   their counts. That table is staged; texts aren't read again.
2. Numbers of documents, of terms and of documents with each term follow from it.
3. A task takes its documents range by range, RANGE of them or POSTINGS postings. Every term has a tree of the range: a leaf is the greatest
   score that the term gives to one of LEAF documents, and a node above the greatest of FAN nodes below. The sum over an
   item's terms bounds what any document under a node can reach. The search opens the node of the highest sum
   first, down to the documents, and stops where no bound reaches the lowest of the best; nodes that equal it are opened, as a
   lower id may hide there. What one range found bounds the next.
4. Each task gives its best for each item, k rows at most, and these are ranked twice, first by parts of the tasks.

Scores are integers, so sums and bounds are exact and do not depend on an order.

Items go in parts of about TERMS distinct terms of items, one pass each, so what the driver and a task hold of them is bounded
by that number and by the longest item, whatever the number of items.

Defined results: a null text, or one without a term, is no document and found by nothing; an item without terms, or whose
terms no document has, has no rows; rows that repeat an item_id are one item of all their terms; rows that repeat a document are
documents of their own, with ranks of their own; equal scores go by ascending doc_id, null last; very long texts are read whole; empty
tables give no rows; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from mandrel.llm.common import OWN, release, sliced, staged
from mandrel.llm.decontaminate import normalised

BEST = 10
LEAF, FAN, RANGE, POSTINGS, TERMS = 32, 8, 4096, 1 << 20, 20_000
#: Parts of the tasks whose results are ranked before all are.
PARTS = 64


def weight(documents: int, holding: int) -> int:
    """How much a term counts that so many of all documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_norm(terms: int, documents: int, all_terms: int) -> int:
    """A document's length against the mean, in hundredths, softened by nine tenths."""
    return 100 - 90 + (90 * terms * documents) // all_terms


class Range:
    """Documents of one range: their postings by term, and the max tree of every term."""

    def __init__(self, ids: list, norms: list[int], terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray, weights: np.ndarray):
        """ids, norms and sizes of documents; terms and counts of their postings, one document after another."""
        self.ids = ids
        place = np.repeat(np.arange(len(ids), dtype=np.int64), sizes)
        norm = np.array(norms, dtype=np.int64)[place]
        order = np.argsort(terms, kind="stable")
        counts, norm = counts[order], norm[order]
        self.place = place[order]
        self.score = weights[terms[order]] * ((1_000_000_000 * counts) // (1000 * counts + 8 * norm))
        self.names, row = np.unique(terms[order], return_inverse=True)
        leaves = -(-len(ids) // LEAF)
        self.levels = [np.zeros((len(self.names), leaves), dtype=np.int64)]
        key = row * leaves + self.place // LEAF
        # Where the postings of a term under a leaf begin; those of the next leaf, or term, follow.
        self.first = np.zeros(len(self.names) * leaves + 1, dtype=np.int32)
        np.cumsum(np.bincount(key, minlength=len(self.first) - 1), out=self.first[1:])
        if len(self.place):
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            self.levels[0].reshape(-1)[key[starts]] = np.maximum.reduceat(self.score, starts)
        while self.levels[-1].shape[1] > 1:
            below = self.levels[-1]
            wide = -(-below.shape[1] // FAN) * FAN
            below = np.pad(below, ((0, 0), (0, wide - below.shape[1])))
            self.levels.append(below.reshape(len(self.names), -1, FAN).max(axis=2))

    def rows(self, terms: np.ndarray) -> np.ndarray:
        """Which rows of the trees belong to an item's terms."""
        at = np.searchsorted(self.names, terms)
        at[at == len(self.names)] = 0
        return at[self.names[at] == terms] if len(self.names) else at[:0]

    def documents(self, rows: np.ndarray, leaf: int, least: int) -> Iterator[tuple[int, int]]:
        """(place, score) of the documents under a leaf that hold a term and reach a score."""
        at = rows * self.levels[0].shape[1] + leaf
        starts, sizes = self.first[at], self.first[at + 1] - self.first[at]
        ends = np.cumsum(sizes)
        picked = np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)
        total = np.zeros(LEAF, dtype=np.int64)
        np.add.at(total, self.place[picked] - leaf * LEAF, self.score[picked])
        for k in np.flatnonzero(total >= max(least, 1)).tolist():
            yield leaf * LEAF + k, int(total[k])

    def search(self, terms: np.ndarray, best: list, k: int = BEST) -> int:
        """Improve a heap of the k best (score, has an id, -id). Gives how many nodes were opened."""
        rows = self.rows(terms)
        if not len(rows):
            return 0
        top = len(self.levels) - 1
        nodes = [(-int(self.levels[top][rows, 0].sum()), top, 0)]
        opened = 0
        while nodes:
            bound, level, at = heapq.heappop(nodes)
            if not bound or (len(best) == k and -bound < best[0][0]):
                break
            opened += 1
            if level:
                low = at * FAN
                sums = self.levels[level - 1][rows, low : low + FAN].sum(axis=0)
                least = best[0][0] if len(best) == k else 1
                for j in np.flatnonzero(sums >= least).tolist():
                    heapq.heappush(nodes, (-int(sums[j]), level - 1, low + j))
                continue
            for place, score in self.documents(rows, at, best[0][0] if len(best) == k else 1):
                name = self.ids[place]
                found = (score, name is not None, -name if name is not None else 0)
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return opened


@dataclass(frozen=True)
class Part:
    """Items that are searched together: names, the numbers of their terms, and the weight of each term."""

    items: list
    terms: list[np.ndarray]
    weights: np.ndarray
    documents: int
    all_terms: int


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, term: each term of an item once."""
    given = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 1):
                found = [sorted(set(normalised(t))) for t in part.column(1).to_pylist()]
                rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
                names = [w.decode("utf-8", "surrogatepass") for x in found for w in x]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string())], names=["item_id", "term"])

    return given.mapInArrow(run, T.StructType([given.schema["item_id"], T.StructField("term", T.StringType())])).distinct()


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, terms, counts: documents with a term, and what they hold of a vocabulary."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = held.value.get
        for batch in batches:
            for part in sliced(batch, 1):
                ids, sizes, terms, counts = [], [], [], []
                for name, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = normalised(t)
                    if words:
                        known = sorted((k, n) for w, n in Counter(words).items() if (k := get(w)) is not None)
                        ids.append(name)
                        sizes.append(len(words))
                        terms.append([k for k, _ in known])
                        counts.append([n for _, n in known])
                made = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(made, names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<bigint>")


def ranges(batches: Iterator[pa.RecordBatch], part: Part) -> Iterator[Range]:
    """Documents as they come, RANGE of them or about POSTINGS postings at a time."""
    rows: list[tuple] = []
    size = 0

    def closed() -> Range:
        ids, n, terms, counts = zip(*rows, strict=True)
        norms = [length_norm(x, part.documents, part.all_terms) for x in n]
        return Range(list(ids), norms, np.concatenate(terms), np.concatenate(counts), np.array([len(x) for x in terms]), part.weights)

    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            cut = batch.slice(low, 512)
            lists = [(c.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum([0, *(x or 0 for x in c.value_lengths().to_pylist())])) for c in (cut.column(2), cut.column(3))]
            (terms, ends), (counts, _) = lists
            for i, (name, n) in enumerate(zip(cut.column(0).to_pylist(), cut.column(1).to_pylist(), strict=True)):
                rows.append((name, n, terms[ends[i] : ends[i + 1]], counts[ends[i] : ends[i + 1]]))
                size += int(ends[i + 1] - ends[i])
                if len(rows) >= RANGE or size >= POSTINGS:
                    yield closed()
                    rows, size = [], 0
    if rows:
        yield closed()


def _searched(found: DataFrame, part: Part, item_type: T.DataType, k: int) -> DataFrame:
    """item_id, doc_id, score: each task's k best for each item."""
    held = found.sparkSession.sparkContext.broadcast(part)
    schema = T.StructType([T.StructField("item_id", item_type), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value
        best: list[list] = [[] for _ in p.items]
        for each in ranges(batches, p):
            for terms, heap in zip(p.terms, best, strict=True):
                each.search(terms, heap, k)
        rows = [(item, -name if there else None, score) for item, heap in zip(p.items, best, strict=True) for score, there, name in heap]
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=arrow)

    return found.mapInArrow(run, schema)


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, doc_id: str = "doc_id", text: str = "text", most: int = TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of the highest scores above 0 for each item."""
    pairs = staged(item_terms(items), "terms")
    parts = max(1, -(-pairs.count() // most))
    of = F.pmod(F.xxhash64("item_id"), F.lit(parts))
    out = None
    for number in range(parts):
        asked: dict = {}
        vocabulary: dict[bytes, int] = {}
        for row in pairs.where(of == number).orderBy("item_id", "term").collect():  # about `most` rows, an item at least
            term = row["term"].encode("utf-8", "surrogatepass")
            asked.setdefault(row["item_id"], []).append(vocabulary.setdefault(term, len(vocabulary)))
        if not vocabulary:
            continue
        found = staged(vectors(docs, vocabulary, doc_id, text), "vectors")
        documents, all_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = {r[0]: r[1] for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # a row for each term of the part
        weights = np.array([weight(documents, holding[t]) if t in holding else 0 for t in range(len(vocabulary))], dtype=np.int64)
        part = Part(list(asked), [np.array(sorted(t), dtype=np.int64) for t in asked.values()], weights, documents, all_terms)
        best = _searched(found, part, pairs.schema["item_id"].dataType, k)
        best = staged(best, "best") if parts > 1 else best
        if parts > 1:
            release(found)
        out = best if out is None else out.unionByName(best)
    if out is None:
        out = pairs.select("item_id", F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    at, rank = f"{OWN}part", F.row_number()
    first = Window.partitionBy("item_id", at).orderBy(*order)
    out = out.withColumn(at, F.spark_partition_id() % PARTS).withColumn("rank", rank.over(first)).where(F.col("rank") <= k)
    last = Window.partitionBy("item_id").orderBy(*order)
    return out.withColumn("rank", rank.over(last)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
