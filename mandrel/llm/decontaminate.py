"""Benchmark decontamination with one Aho-Corasick automaton over normalised benchmark text.

The pattern set is every window of `span` words of every item (a shorter item is one window). Texts and items are
normalised alike (ASCII lower case, every run of other characters than word characters parts words) and a word of the
benchmark becomes two characters, so a window is a string of 2 * `span` characters and an occurrence has its word
positions; `ranges` maps them to offsets of the original. A text is scanned once.

An automaton holds MAX_WINDOWS windows or so, some 100 MB, whatever the benchmark's size. A benchmark with more is dealt over
several by hash, and documents pass one after another, with what was found so far beside them, in a table written
between: a Python worker holds one automaton at a time, the driver one part of the benchmark, and no window is lost.
Long items are dealt in slices that overlap by a window.

Defined results: a null or empty text, or one without words, has no hits; a null item or one without words gives
no window; the same item twice counts once for its item_id; null item ids are named ''; repeated rows are scanned each
on its own and very long texts whole; an empty benchmark hits nothing and an empty table gives no rows; other columns
pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandrel.llm.common import OWN, fields, staged

SPAN = 13
#: The digest of no items.
NOTHING = hashlib.sha256(b"").hexdigest()
#: Windows in one automaton, as an average over the parts of a benchmark; a window has two nodes a word at most.
MAX_WINDOWS = 50_000
#: Words of an item that are dealt together.
SLICE = 4096

#: Bytes that are no part of a word become a space, A-Z become a-z.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))
#: A word before lower-casing, over the original text.
_ORIGINAL = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def normalised(text: str | None) -> list[bytes]:
    """The words of a text, as bytes. After the translation \\x20 is the only white space left."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def slices(text: str | None, span: int = SPAN, size: int = SLICE) -> list[list[bytes]]:
    """The words of an item in slices, of which each window of `span` words lies in one; all of them if they are fewer."""
    words = normalised(text)
    return [words[at : at + size + span - 1] for at in range(0, max(len(words) - span + 1, 1), size)] if words else []


class Automaton:
    """An Aho-Corasick automaton over the windows of benchmark items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], span: int = SPAN):
        """items: name, and words of the item or of a slice of it."""
        words = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(x for _, x in items)))}
        # Two characters for each word, from alphabets of their own: so a node has few edges, whatever the vocabulary, and a match begins at a word.
        base = math.isqrt(len(words)) + 1
        self.letters = {w: chr(1 + k // base) + chr(1 + base + k % base) for w, k in words.items()}
        entries: dict[str, set[str]] = {}
        for name, own in items:
            line = "".join([self.letters[w] for w in own])
            n = min(span, len(own))
            for at in range(len(own) - n + 1 if n else 0):
                entries.setdefault(line[2 * at : 2 * (at + n)], set()).add(name)
        self.names = [tuple(x) for x in entries.values()]
        self.trie = ahocorasick.Automaton()
        for k, window in enumerate(entries):
            self.trie.add_word(window, (len(window) // 2, k))
        if entries:
            self.trie.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Words of the text, merged word ranges that are hit (end exclusive), items that occur."""
        words = normalised(text)
        if not words or not self.names:
            return len(words), [], set()
        get = self.letters.get
        found: list[tuple[int, int]] = []
        seen: set[int] = set()
        for end, (n, k) in self.trie.iter("".join([get(w, "\0\0") for w in words])):
            last = end // 2 + 1
            found.append((last - n, last))
            seen.add(k)
        return len(words), merged(found), {x for k in seen for x in self.names[k]}


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges without overlap, in order."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def original_ranges(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as code point offsets of the original text, end exclusive."""
    spots = [m.span() for m in _ORIGINAL.finditer(text)] if ranges else []
    return [(spots[a][0], spots[b - 1][1]) for a, b in ranges]


_CACHE: dict[str, Automaton] = {}


def _automaton(items: tuple[str, tuple[tuple[str, bytes], ...]], span: int) -> Automaton:
    """Built once for each Python worker, which holds one at a time."""
    key = f"{items[0]} {span}"
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = Automaton([(name, words.split(b" ")) for name, words in items[1]], span)
    return _CACHE[key]


SCALARS = fields(n_words="long", n_hit="long", n_items="long", items_sha256="string")
_RANGES = T.ArrayType(fields(start="long", end="long"))


def schema(words: bool, offsets: bool) -> T.StructType:
    """What a scan gives: numbers and a digest; with items and word ranges; with ranges of the original text."""
    out = T.StructType(list(SCALARS.fields))
    if words:
        out = out.add("items", T.ArrayType(T.StringType())).add("words", _RANGES)
    return out.add("ranges", _RANGES) if offsets else out


def _told(spans: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in spans]


def _found(auto: Automaton, text: str | None, keeps: bool, offsets: bool, words: object = None, items: object = None) -> tuple:
    """A row of the schema, with what earlier parts of the benchmark found."""
    n, ranges, names = auto.scan(text)
    if words is not None and len(words):
        ranges = merged([*ranges, *((x["start"], x["end"]) for x in words)])
    listed = sorted(names if items is None else names.union(items))
    digest = hashlib.sha256(",".join(listed).encode("utf-8", "surrogatepass")).hexdigest() if listed else NOTHING
    out = (n, sum(b - a for a, b in ranges), len(listed), digest)
    if keeps:
        out += (listed, _told(ranges))
    return out + (_told(original_ranges(text or "", ranges)),) if offsets else out


def scanner(items: list[tuple[str, bytes]], spark, keeps: bool, offsets: bool, span: int = SPAN):
    """Column functions that scan a text column for one part of a benchmark: alone, and with an earlier part's words and items."""
    items = tuple(sorted(items))
    held = spark.sparkContext.broadcast((hashlib.sha256(repr(items).encode("utf-8", "surrogatepass")).hexdigest(), items))
    form = schema(keeps, offsets)
    names = form.names

    @F.pandas_udf(form)
    def first(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        auto = _automaton(held.value, span)
        for texts in batches:
            yield pd.DataFrame([_found(auto, x, keeps, offsets) for x in texts], columns=names)

    @F.pandas_udf(form)
    def further(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        auto = _automaton(held.value, span)
        for texts, words, found in batches:
            yield pd.DataFrame([_found(auto, x, keeps, offsets, w, i) for x, w, i in zip(texts, words, found, strict=True)], columns=names)

    return first, further


def _sliced(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, b" ".join(x), max(len(x) - span + 1, 1)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in slices(t, span)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.binary(), pa.int64()))], names=["item", "words", "n"])

    return run


def dealt(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", span: int = SPAN, most: int = MAX_WINDOWS) -> list[DataFrame]:
    """Slices of items (item, words), dealt by hash into parts of about `most` windows; one part at least."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).where("t is not null")
    rows = staged(rows.mapInArrow(_sliced(span), "item string, words binary, n long"), "slices")
    parts = max(1, -(-(rows.agg(F.sum("n")).first()[0] or 0) // most))
    return [rows.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == k).select("item", "words").distinct() for k in range(parts)]


def is_contaminated(found: Column) -> Column:
    """At least one word hit and a twentieth of all words or more."""
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])


def with_matches(docs: DataFrame, benchmark: DataFrame, into: str = f"{OWN}found", text: str = "text", most: int = MAX_WINDOWS, ranges: bool = True) -> DataFrame:
    """docs and one struct column: words, hits, number and digest of items; with `ranges` the items, word ranges and code point ranges in the original text too. No shuffle."""
    parts = dealt(benchmark, most=most)
    keeps = ranges or len(parts) > 1
    for k, part in enumerate(parts):
        items = [(r["item"], bytes(r["words"])) for r in part.collect()]  # one part of the benchmark
        last = k + 1 == len(parts)
        first, further = scanner(items, docs.sparkSession, keeps, ranges and last)
        found = further(F.col(text), F.col(f"{into}.words"), F.col(f"{into}.items")) if k else first(F.col(text))
        docs = docs.withColumn(into, found)
        if not last:
            docs = staged(docs, "scanned")
    return docs


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs that are not contaminated, with the columns of docs."""
    into = f"{OWN}found"
    return with_matches(docs, benchmark, into, text, ranges=False).where(~is_contaminated(F.col(into))).drop(into)
