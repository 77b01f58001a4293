"""Secret scans with DataFrame functions only.

Three base kinds are regular expressions: `assign` (a keyword, a separator and a value), `access` and
`hex`. The fourth, `entropy`, slides a window of characters over candidate strings and keeps a candidate
where the window's Shannon entropy reaches the threshold of its character class. Counts move with the
window: one character enters, one leaves, and the entropy sum changes by these two terms alone. Candidates
on the allow list, or inside a base span, are suppressed; base spans always stay. Of a candidate that a base span
covers in part, what is left on either side is a candidate of its own; shorter than a window it can't be measured, and counts where it
adjoins an access key or a hex string and is more than words and a number.

Positions are code points, end exclusive. They come from splitting a text at a pattern's matches: pieces and
matches alternate, so running lengths are offsets.

Defined results: a null or empty text has no spans; repeated rows are scanned each on its own; a text of
any length is scanned whole; of spans that begin alike the kind listed first comes first; an empty table gives no
rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mandrel.llm.common import OWN, named, scanned

#: The base patterns. A match of `assign` whose value is shorter than six is dropped after
#: matching, so it still uses up its characters; the other two can state their lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class CharClass:
    """Candidates wholly of these characters; `alphabet` gives each character's place in the count vector."""

    name: str
    alphabet: str
    threshold: float


WINDOW = 20
CLASSES = (
    CharClass("hex", "0123456789abcdefABCDEF", 3.0),
    CharClass("lower", "0123456789abcdefghijklmnopqrstuvwxyz", 3.5),
    CharClass("upper", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", 3.5),
    CharClass("alnum", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 3.7),
    CharClass("base64", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/=_-", 3.7),
)
#: A candidate: WINDOW characters or more, a letter at least; entropy and the allow list decide, no count of digits.
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Words: capitalised, or runs of letters in one case that separators part or that have three letters or more.
#: What has nothing else, but one number at most, is on the allow list; so letters of one case alone are no secret.
WORDS = r"(?<![A-Za-z0-9])(?:[A-Z]?[a-z]+|[A-Z]+)(?![A-Za-z0-9])|[A-Z][a-z]+|[a-z]{3,}|[A-Z]{3,}"
NUMBERED = r"^[.+/_=-]*[0-9]*[.+/_=-]*$"
#: Strings that look random and are none: identifiers of public form, counting sequences, placeholders.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|xxxxxx|changeme",
    r"0123456789|abcdefghij|ABCDEFGHIJ",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T_-]",
)


def _spans(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Array of (start, kind, end, value) of a pattern's matches."""
    span = "struct<start:int,kind:int,end:int,value:string>"
    empty = F.array().cast(f"array<{span}>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.zip_with(F.split(text, pattern, -1), found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + x["gap"]
        b = a + F.coalesce(F.length(x["m"]), F.lit(0))
        one = F.struct(a.alias("start"), F.lit(kind).alias("kind"), b.alias("end"), x["m"].alias("value"))
        return F.struct(F.struct(b.alias("at")).alias("state"), F.when(x["m"].isNull(), empty).otherwise(F.array(one)).alias("out"))

    spans = scanned(sizes, F.struct(F.lit(0).alias("at")), step, span)
    if keep is not None:
        spans = F.filter(spans, lambda s: keep(s))
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def _term(n: Column) -> Column:
    """n * log2(n), 0 for 0."""
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def peak_entropy(value: Column, cls: CharClass, window: int = WINDOW) -> Column:
    """Greatest Shannon entropy, in bits a character, of any window of a string of the class's characters.

    A string shorter than the window has none (null).
    """
    size = len(cls.alphabet)
    codes = F.filter(F.transform(F.split(value, ""), lambda c: F.instr(F.lit(cls.alphabet), c)), lambda k: k > 0)
    start = F.struct(
        F.array_repeat(F.lit(0), size).alias("n"), F.lit(0.0).alias("sum"), F.lit(None).cast("double").alias("least"), F.lit(0).alias("i"),
    )

    def step(acc: Column, x: Column) -> Column:
        enters, leaves = x["enters"], x["leaves"]
        one = F.lit(1)
        more = F.element_at(acc["n"], enters)
        added = acc["sum"] + _term(more + 1) - _term(more)
        lost = F.element_at(acc["n"], F.greatest(leaves, one)) + (leaves == enters).cast("int")
        total = F.when(leaves == 0, added).otherwise(added - _term(lost) + _term(lost - 1))
        n = F.transform(acc["n"], lambda c, j: c + (j + 1 == enters).cast("int") - (j + 1 == leaves).cast("int"))
        least = F.when(acc["i"] + 1 >= window, F.least(acc["least"], total)).otherwise(acc["least"])
        return F.struct(n.alias("n"), total.alias("sum"), least.alias("least"), (acc["i"] + 1).alias("i"))

    def peak(cs: Column) -> Column:
        behind = F.slice(F.concat(F.array_repeat(F.lit(0), window), cs), F.lit(1), F.size(cs))
        moves = F.zip_with(cs, behind, lambda a, b: F.struct(a.alias("enters"), b.alias("leaves")))
        # H = log2(w) - sum(n log2 n) / w over the window's counts n.
        return F.aggregate(moves, start, step, lambda acc: F.lit(math.log2(window)) - acc["least"] / window)

    return F.element_at(F.transform(F.array(codes), peak), 1)


def is_allowed(value: Column) -> Column:
    """Words with one number at most, or an allowed form."""
    allowed = F.regexp_replace(value, WORDS, ".").rlike(NUMBERED)
    for form in ALLOWED:
        allowed = allowed | value.rlike(form)
    return allowed


def is_secret(value: Column) -> Column:
    """Whether a candidate's peak entropy reaches its class's threshold and no allowed form fits."""
    high = F.lit(False)
    for cls in reversed(CLASSES):
        inside = value.rlike("^[" + cls.alphabet.replace("-", "\\-") + "]+$")
        high = F.when(inside, F.coalesce(peak_entropy(value, cls) >= cls.threshold, F.lit(False))).otherwise(high)
    return ~is_allowed(value) & high


def _left(s: Column, base: Column) -> Column:
    """What base spans leave of a candidate: pieces (start, kind, end, value, beside); beside says that it adjoins an access key or a hex string."""
    piece = "array<struct<start:int,kind:int,end:int,value:string,beside:boolean>>"
    over = F.filter(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    stop = F.struct(s["end"].alias("start"), F.lit(9).alias("kind"), s["end"].alias("end"))
    begin = F.struct(s["start"].alias("at"), F.lit(False).alias("hard"), F.array().cast(piece).alias("out"))

    def step(acc: Column, b: Column) -> Column:
        hard = (b["kind"] == 1) | (b["kind"] == 2)
        one = F.struct(
            acc["at"].alias("start"), s["kind"].alias("kind"), b["start"].alias("end"),
            F.substr(s["value"], acc["at"] - s["start"] + 1, b["start"] - acc["at"]).alias("value"), (acc["hard"] | hard).alias("beside"),
        )
        out = F.when(b["start"] > acc["at"], F.concat(acc["out"], F.array(one))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.when(b["end"] >= acc["at"], hard).otherwise(acc["hard"]).alias("hard"), out.alias("out"))

    whole = F.array(F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"), F.lit(False).alias("beside")))
    left = F.aggregate(F.concat(F.array_sort(over), F.array(stop)), begin, step, lambda acc: acc["out"])
    return F.when(F.size(over) == 0, whole.cast(piece)).otherwise(left)


def with_spans(docs: DataFrame, text: str = "text", into: str = f"{OWN}spans") -> DataFrame:
    """docs and one array column of (start, kind, end), by start and then kind; kind indexes KINDS. No shuffle."""
    t = F.coalesce(F.col(text), F.lit(""))
    plain = "array<struct<start:int,kind:int,end:int>>"
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).cast(plain)
    # A value of six characters or more ends its match: no shorter one has six of its characters at the end.
    long_value = lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6
    base, more = f"{into}_base", f"{into}_more"
    df = docs.withColumn(base, bare(F.concat(_spans(t, ASSIGN, 0, long_value), _spans(t, ACCESS, 1), _spans(t, HEX, 2))))
    pieces = F.flatten(F.transform(_spans(t, CANDIDATE, 3), lambda s: _left(s, F.col(base))))
    short = lambda s: s["beside"] & (F.length(s["value"]) < WINDOW) & ~is_allowed(s["value"])
    df = df.withColumn(more, bare(F.filter(pieces, lambda s: short(s) | is_secret(s["value"]))))
    return df.withColumn(into, F.array_sort(F.concat(base, more))).drop(base, more)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, text: str = "text", by: str = "[SECRET]") -> DataFrame:
    """docs with every span replaced; overlapping spans count as one. A column n_chars, if any, follows the text."""
    spans, t = f"{OWN}spans", F.col(text)

    def step(acc: Column, s: Column) -> Column:
        gap = F.array(F.struct((acc["at"] + 1).alias("from"), (s["start"] - acc["at"]).alias("n")))
        none = F.array().cast("array<struct<from:int,n:int>>")
        return F.struct(F.struct(F.greatest(acc["at"], s["end"]).alias("at")).alias("state"), F.when(s["start"] >= acc["at"], gap).otherwise(none).alias("out"))

    gaps = scanned(F.col(spans), F.struct(F.lit(0).alias("at")), step, "struct<from:int,n:int>")
    behind = F.substring(t, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(t))
    whole = F.array_join(F.concat(F.transform(gaps, lambda g: F.substring(t, g["from"], g["n"])), F.array(behind)), by)
    df = with_spans(docs, text, spans)
    found = F.size(spans) > 0
    df = df.withColumn(f"{OWN}text", F.when(found, whole).otherwise(t))
    out = []
    for c in docs.columns:
        if c == text:
            out.append(F.col(f"{OWN}text").alias(c))
        elif c == "n_chars":
            out.append(F.when(found, F.length(f"{OWN}text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            out.append(named(c))
    return df.select(*out)
