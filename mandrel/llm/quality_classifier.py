"""Quality scores from random-indexing word vectors and a two-layer network.

Every token has a sparse ternary index vector that its hash alone determines. A token's word vector is the
sum of the index vectors of its neighbours over the training sample, beside its own; a token that the sample lacks
has its own alone. A document is pooled from vectors and nothing else: the mean of the word vectors, and the mean
inner product of index vectors one to FAR places apart, which shows what a mean can't: words that come again soon. A
two-layer network over this gives a logit; a temperature, fitted on a part of the sample that the network did not see,
calibrates it.

The sample is bounded: MAX_ROWS labelled rows of documents that are there, whose ids hash lowest (ties by id, label and text), of
texts of MAX_CHARS at most; all other documents are scored whole, in batches of matrix operations over TOKENS tokens, through which a
longer text goes in turn. The vocabulary is the MAX_TOKENS most frequent tokens of the sample.

Defined results: a null or empty text has no tokens and gets the score of an empty document; without labels
or with labels of one kind only, every score is the share of label 1 (0.5 without any); a document with
several labels counts for each; repeated rows are scored each on its own; an empty table gives no rows; other columns
are not looked at, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS, MAX_CHARS, MAX_TOKENS = 4000, 32_768, 20_000
DIMENSION, NONZERO, NEIGHBOURS = 96, 6, 2
#: How far apart vectors are compared; tokens whose vectors are held at a time.
FAR, TOKENS = 4, 1 << 15
HIDDEN, STEPS, SEED = 16, 400, 11

_FACTOR = np.uint64(0xD1342543DE82EF95)

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")


def tokens(text: str | None) -> list[str]:
    """Words as they are written, and runs of punctuation."""
    return _TOKEN.findall(text or "")


def index_entries(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each token's sparse ternary index vector, from its hash."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, names), dtype=np.uint64, count=len(names))[:, None]
    with np.errstate(over="ignore"):  # a multiplicative generator, started by the hash, then its high bits
        h = (h | np.uint64(1)) * (_FACTOR ** np.arange(1, NONZERO + 1, dtype=np.uint64)) + h
    return ((h >> np.uint64(40)) % np.uint64(DIMENSION)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def index_vectors(names: list[str]) -> np.ndarray:
    places, signs = index_entries(names)
    out = np.zeros((len(names), DIMENSION), dtype=np.float32)
    np.add.at(out, (np.arange(len(names))[:, None], places), signs)
    return _unit(out)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def word_vectors(docs: list[np.ndarray], names: list[str]) -> np.ndarray:
    """From documents as numbers of tokens, len(names) for unknown ones: the neighbours' index vectors added up
    and normed, beside the token's own, which keeps tokens apart that share their neighbours."""
    size = len(names)
    places, signs = index_entries(names)
    flat = np.zeros(size * DIMENSION)
    gap = np.full(NEIGHBOURS, size)
    ids = np.concatenate([x for d in docs for x in (d, gap)]) if docs else gap
    for d in range(1, NEIGHBOURS + 1):
        for at, by in ((ids[d:], ids[:-d]), (ids[:-d], ids[d:])):
            known = (at < size) & (by < size)
            at, by = at[known], by[known]
            for k in range(NONZERO):
                flat += np.bincount(at * DIMENSION + places[by, k], weights=signs[by, k], minlength=len(flat))
    return _unit(_unit(flat.reshape(size, DIMENSION)) + index_vectors(names))


def pooled(table: np.ndarray, own: np.ndarray, docs: list[np.ndarray]) -> np.ndarray:
    """One row for each document of token numbers: mean word vector, mean inner product of index vectors 1 to FAR places apart."""
    out = np.zeros((len(docs), DIMENSION + FAR))
    for row, ids in zip(out, docs, strict=True):
        for at in range(0, len(ids), TOKENS):
            before = min(at, FAR)
            row[:DIMENSION] += np.ones(len(ids[at : at + TOKENS]), dtype=np.float32) @ table[ids[at : at + TOKENS]]
            v = own[ids[at - before : at + TOKENS]]  # behind the FAR tokens before it
            for d in range(1, min(FAR, len(v) - 1) + 1):
                right = v[max(before, d) :]
                row[DIMENSION + d - 1] += np.vdot(right, v[len(v) - d - len(right) : len(v) - d])
        row /= max(len(ids), 1)
    return out


@dataclass(frozen=True)
class Network:
    """vocabulary, its word and index vectors, the layers, and the temperature."""

    vocabulary: dict[str, int]
    vectors: np.ndarray
    own: np.ndarray
    first: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    constant: float
    temperature: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        hidden = np.tanh(pooled(*numbered([tokens(t) for t in texts], self.vocabulary, self.vectors, self.own)) @ self.first + self.bias)
        logits = hidden @ self.out + self.constant
        return 1 / (1 + np.exp(-np.clip(logits / self.temperature, -40, 40)))


def numbered(docs: list[list[str]], vocabulary: dict[str, int], vectors: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Tables of word and index vectors, known tokens' and then these documents' others', and the documents as rows of them."""
    others: dict[str, int] = {}
    get, add, size = vocabulary.get, others.setdefault, len(vocabulary)
    out = []
    for words in docs:
        ids = [get(w, -1) for w in words]
        if -1 in ids:
            ids = [k if k >= 0 else add(w, size + len(others)) for k, w in zip(ids, words, strict=True)]
        out.append(np.array(ids, dtype=np.int64))
    more = index_vectors(list(others))
    return np.concatenate([vectors, more]), np.concatenate([own, more]), out


def _adam(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Two-layer network by full-batch gradient descent with moments, on weighted log loss."""
    rng = np.random.default_rng(SEED)
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
    for t in range(1, STEPS + 1):
        h = np.tanh(x @ p[0] + p[1])
        z = h @ p[2] + p[3]
        d = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        dh = np.outer(d, p[2]) * (1 - h * h)
        grads = [x.T @ dh + 1e-3 * p[0], dh.sum(0), h.T @ d + 1e-3 * p[2], np.array([d.sum()])]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            p[k] = p[k] - 0.02 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return p[0], p[1], p[2], float(p[3][0])


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, on a grid."""
    if len(set(y.tolist())) < 2:
        return 1.0
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.logaddexp(0, -np.where(y > 0, 1, -1) * logits / t).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(sample: list[tuple[str | None, int]]) -> Network | float:
    """A network from (text, label) rows, or the share of label 1 where there is nothing to learn."""
    y = np.array([q for _, q in sample], dtype=float)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    docs = [tokens(t) for t, _ in sample]
    often = Counter(w for words in docs for w in words)
    names = [w for w, n in sorted(often.items(), key=lambda x: (-x[1], x[0]))[:MAX_TOKENS] if n > 1]
    vocabulary = {w: k for k, w in enumerate(names)}
    unknown = len(names)
    numbers = [np.fromiter((vocabulary.get(w, unknown) for w in words), dtype=np.int64, count=len(words)) for words in docs]
    vectors = word_vectors(numbers, names)
    own = index_vectors(names)
    x = pooled(*numbered(docs, vocabulary, vectors, own))
    held = np.arange(len(y)) % 5 == 0  # rows are in hash order
    fitted = ~held if len(set(y[~held].tolist())) == 2 else np.ones(len(y), dtype=bool)
    mean, scale = x[fitted].mean(0), x[fitted].std(0) + 1e-3
    weight = np.full(int(fitted.sum()), 1 / fitted.sum())
    w1, b1, w2, b2 = _adam((x[fitted] - mean) / scale, y[fitted], weight)
    w1 = w1 / scale[:, None]
    b1 = b1 - mean @ w1
    logits = np.tanh(x[held] @ w1 + b1) @ w2 + b2
    return Network(vocabulary, vectors, own, w1, b1, w2, b2, _temperature(logits, y[held]))


def train(docs: DataFrame, labels: DataFrame, allowed: Column, max_rows: int = MAX_ROWS) -> Network | float:
    """docs: doc_id, text; labels: doc_id, quality. `allowed` is over doc_id."""
    short = F.length(F.coalesce("text", F.lit(""))) <= MAX_CHARS
    order = [F.xxhash64("doc_id"), "doc_id", "quality"]
    # Labels of documents that are there: of both sides ids alone are shuffled, and the sample is counted after that.
    there = docs.where(short & allowed).select("doc_id").distinct()
    marks = labels.where(allowed & F.col("quality").isin(0, 1)).select("doc_id", "quality").join(there, "doc_id", "left_semi").orderBy(*order).limit(max_rows)
    rows = docs.select("doc_id", "text").where(short).join(F.broadcast(marks), "doc_id")  # max_rows rows at most
    rows = rows.orderBy(*order, "text").limit(max_rows)
    return fit([(r["text"], r["quality"]) for r in rows.collect()])


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """doc_id and the calibrated probability of label 1, from the text alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                values = np.full(part.num_rows, m) if isinstance(m, float) else m.scores(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
