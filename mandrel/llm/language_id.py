"""Language identification with string kernels.

A text is the set of its character n-grams of one to three lower-cased characters (white space runs are one
space): the blended-spectrum presence kernel of two texts is the share of common n-grams,
k(x, y) = |x & y| / sqrt(|x| |y|). Landmarks drawn from the training sample give Nyström features, and one
ridge regression for each language over these separates it from the rest. Scoring is batched matrix
products: presence rows times the landmark matrix, norms, then the weights.

Training reads a bounded sample of every language: PER_LANGUAGE documents of each at most, those whose id hashes
lowest, and fewer where there are more languages than SAMPLE holds at that number; each goes to the driver as
the bitmap of its n-gram set, 8 KB whatever the text's length, 105 MB for all, and they are opened block by block. More than
MOST languages are an error, as each has landmarks, two at least.

Defined results: a null text or one without a letter is `und` with score 0; without any labelled row every
text is `und`; ties go to the first language by name; repeated rows are scored each on its own, and learned from
once; texts are read whole; an empty table gives no rows; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mandrel.llm.common import PARTS

ORDERS = (1, 2, 3)
#: n-grams are hashed to this many places.
PLACES = 1 << 16
PER_LANGUAGE, LANDMARKS = 200, 160
#: Documents of all languages together, at most.
SAMPLE = 64 * PER_LANGUAGE
#: Languages at most: landmarks of so many are 268 MB.
MOST = 512
#: Samples that are opened at a time.
BLOCK = 256
RIDGE = 1e-2
UNKNOWN = "und"

_MULTIPLY = np.uint32(2654435761)


def grams(text: str) -> np.ndarray:
    """Sorted distinct hashed n-grams of a whole text."""
    text = " " + " ".join(text.lower().split()) + " "
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    seen = np.zeros(PLACES, dtype=bool)
    with np.errstate(over="ignore"):
        h = np.zeros(len(codes), dtype=np.uint32)
        for n in ORDERS:
            h = (h[: len(codes) - n + 1] + codes[n - 1 :].astype(np.uint32) + np.uint32(n)) * _MULTIPLY
            seen[h >> np.uint32(16)] = True
    return np.flatnonzero(seen).astype(np.int32)


def packed(places: np.ndarray) -> bytes:
    """A set of places as a bitmap."""
    seen = np.zeros(PLACES, dtype=bool)
    seen[places] = True
    return np.packbits(seen).tobytes()


def opened(bitmap: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8))).astype(np.int32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    """places: n-grams that occur in a landmark; landmarks: presence, normed, landmarks by places; weights: landmarks (and a constant) by languages."""

    languages: tuple[str, ...]
    places: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        column = np.full(PLACES, -1, dtype=np.int64)
        column[self.places] = np.arange(len(self.places))
        out = np.zeros((len(sets), len(self.places)), dtype=np.float32)
        for row, s in zip(out, sets, strict=True):
            at = column[s]
            row[at[at >= 0]] = 1 / np.sqrt(max(len(s), 1))
        return out @ self.landmarks.T

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        k = self.kernel(sets)
        return k @ self.weights[:-1] + self.weights[-1]


def fit(sample: list[tuple[str, bytes]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """One-versus-rest kernel ridge regression in the Nyström space of landmarks, which are spread over the languages. sample: language and bitmap."""
    if not sample:
        return None
    languages = tuple(sorted({lang for lang, _ in sample}))
    by = {lang: [s for x, s in sample if x == lang] for lang in languages}
    each = max(2, landmarks // len(languages))
    marks = [opened(s) for lang in languages for s in by[lang][:each]]
    places = np.unique(np.concatenate(marks))
    column = np.full(PLACES, -1, dtype=np.int64)
    column[places] = np.arange(len(places))
    m = np.zeros((len(marks), len(places)), dtype=np.float32)
    for row, s in zip(m, marks, strict=True):
        row[column[s]] = 1 / np.sqrt(max(len(s), 1))
    bare = Model(languages, places, m, np.zeros((len(marks) + 1, len(languages)), dtype=np.float32))
    k_mm = bare.kernel(marks).astype(float)
    values, vectors = np.linalg.eigh((k_mm + k_mm.T) / 2)
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])  # Nystroem: features = kernel @ root
    x = np.vstack([bare.kernel([opened(s) for _, s in sample[k : k + BLOCK]]).astype(float) for k in range(0, len(sample), BLOCK)]) @ root
    y = np.array([[1.0 if lang == l else -1.0 for l in languages] for lang, _ in sample])
    # Languages weigh alike, however many rows each has.
    weight = np.array([1 / len(by[lang]) for lang, _ in sample])[:, None]
    mean_x, mean_y = (weight * x).sum(0) / weight.sum(), (weight * y).sum(0) / weight.sum()
    xc, yc = x - mean_x, y - mean_y
    beta = np.linalg.solve(xc.T @ (weight * xc) + ridge * np.eye(x.shape[1]), xc.T @ (weight * yc))
    return Model(languages, places, m, np.vstack([root @ beta, mean_y - mean_x @ beta]).astype(np.float32))


def train(docs: DataFrame, allowed: Column, per_language: int = PER_LANGUAGE) -> Model | None:
    """docs: doc_id, text, lang. Only rows where `allowed` holds and lang and text are not null are learned from."""
    rows = docs.select("doc_id", "text", "lang").where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull())
    names = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MOST + 1).collect())
    if not names:
        return None
    if len(names) > MOST:
        raise ValueError(f"more than {MOST} languages")
    per_language = min(per_language, SAMPLE // len(names))
    # Of rows that repeat an id and language, the text that hashes lowest counts, so that they crowd nobody out.
    rows = rows.withColumn("hash", F.xxhash64("text"))
    single = rows.groupBy("doc_id", "lang").agg(F.min("hash").alias("hash"))
    # Ranked by parts of a language first, so that a language that most documents share sends few rows to one task.
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64("doc_id"), "doc_id")) <= per_language
    single = single.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS))).withColumn("first", rank("lang", "part")).where("first")
    picked = F.broadcast(single.withColumn("first", rank("lang")).where("first").drop("first", "part"))  # SAMPLE rows at most

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [(i, lang, t) for i, t, lang in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in keep], pa.int64()), pa.array([x[1] for x in keep], pa.string()), pa.array([packed(grams(x[2])) for x in keep], pa.binary())], names=["doc_id", "lang", "grams"])

    chosen = rows.join(picked, ["doc_id", "lang", "hash"], "left_semi").dropDuplicates(["doc_id", "lang"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    got = chosen.mapInArrow(featurise, "doc_id long, lang string, grams binary").orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(SAMPLE)
    return fit([(r["lang"], bytes(r["grams"])) for r in got.collect()])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, from the text alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = part.column(1).to_pylist()
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                known = [k for k, t in enumerate(texts) if has_letter(t)] if m else []
                if known:
                    s = m.scores([grams(texts[k]) for k in known])
                    best = s.argmax(axis=1)
                    scores[known] = np.clip((s[np.arange(len(known)), best] + 1) / 2, 0, 1)
                    for k, b in zip(known, best, strict=True):
                        names[k] = m.languages[b]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
