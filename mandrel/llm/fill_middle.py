"""Fill-in-middle transformation by an event scan.

One Aho-Corasick automaton runs over a text once and reports its events: white space, the only characters at which
the class of characters changes, and sentinels. A unit is a run of white space with the run of other characters behind it, or white
space at the end. So a unit ends where a white space follows a gap, that is, where two events are not neighbours, and at the
end of the text: the number of units up to an event is the number of gaps before it, and the k-th gap is where unit k ends. The text
between events is never looked at again.

Four draws by hash of the seed and the document's id choose two cuts between units and the form: plain, the
text as it is; psm, prefix, suffix and middle behind their sentinels; spm, suffix, prefix and middle. A text that holds a sentinel is always plain,
so that `restored` rebuilds every text from output and form alone.

Defined results: a null text is empty, and empty texts are plain with no unit; a null id draws as the empty text; repeated rows
have the same result; very long texts are read whole, with four bytes an event beside them; an empty table gives
no rows; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandrel.llm.common import fields, sliced

SEED, RATE, SUFFIX_FIRST = 42, 50, 80
#: White space, and what marks the parts of an output.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Value 0 for white space, 1 for a sentinel."""
    found = ahocorasick.Automaton()
    for mark, value in [*((c, 0) for c in SPACES), *((s, 1) for s in (PREFIX, SUFFIX, MIDDLE))]:
        found.add_word(mark, value)
    found.make_automaton()
    return found


def events(text: str) -> tuple[np.ndarray, bool]:
    """Places of white space, and whether there is a sentinel."""
    sentinel = False

    def spaces() -> Iterator[int]:
        nonlocal sentinel
        for at, value in automaton().iter(text):
            if value:
                sentinel = True
            else:
                yield at

    return np.fromiter(spaces(), dtype=np.int32 if len(text) < 1 << 31 else np.int64), sentinel


class Units:
    """How many units a text has, and where each ends."""

    def __init__(self, spaces: np.ndarray, length: int):
        self.length = length
        self.ends = spaces[np.diff(spaces, prepend=-1) > 1]
        self.n = len(self.ends) + 1 if length else 0

    def end(self, k: int) -> int:
        """Code points up to the end of unit k; 0 for none."""
        return 0 if k == 0 else self.length if k == self.n else int(self.ends[k - 1])


def arranged(text: str, draws: tuple[int, int, int, int], rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, output."""
    spaces, sentinel = events(text)
    units = Units(spaces, len(text))
    if not text or sentinel or draws[2] % 100 >= rate:
        return units.n, "plain", None, None, text
    low, high = sorted((draws[0] % (units.n + 1), draws[1] % (units.n + 1)))
    a, b = units.end(low), units.end(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < suffix_first:
        return units.n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return units.n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def draws(doc_id: Column, seed: int = SEED) -> Column:
    """Four numbers of 32 bits from the seed and the id as text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


SCHEMA = fields(n="long", form="string", prefix_chars="long", middle_chars="long", output="string")
_ARROW = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def transformed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output. rate: percent of texts that are cut; suffix_first: percent of these in spm. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, 1):
                rows = [arranged(t or "", d, rate, suffix_first) for t, d in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                made = [pa.array([r[k] for r in rows], t) for k, t in enumerate(_ARROW)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names=["doc_id", *SCHEMA.names])

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), draws(F.col(doc_id), seed).alias("draws"))
    return given.mapInArrow(run, T.StructType([given.schema["doc_id"], *SCHEMA.fields]))


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that an output was made of."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    order = lambda *ks: F.concat(*[F.get(parts, F.lit(k)) for k in ks])
    return F.when(form == "psm", order(1, 3, 2)).when(form == "spm", order(2, 3, 1)).otherwise(output)
