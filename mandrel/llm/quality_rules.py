"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger stores the measurements and one failure bit
for each rule; a policy is a versioned mask over those bits, so a new policy or an ablation never reads
a text again.

Defined results: a null or empty text has no words, measures 0 everywhere and fails `few_words`; very long texts are
measured whole; repeated rows are measured each on its own; an empty table gives an empty ledger; other columns are
not looked at, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandrel.llm.common import OWN, staged

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")
SCHEMA = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])

#: White space, symbol characters and ASCII letters that the measurements are defined over.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = b"abcdefghijklmnopqrstuvwxyz"


def measure(text: str | None) -> tuple[int, ...]:
    """All measurements of one text, in the order of MEASURES."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    triples = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(triples)) < len(triples):
        times = Counter(triples)
        covered = 0  # words before this position are counted
        for at, triple in enumerate(triples):
            if times[triple] > 1:
                repeated += at + 3 - max(covered, at)
                covered = at + 3
    upper = len(raw) - len(raw.translate(None, UPPER))
    lower = len(raw) - len(raw.translate(None, LOWER))
    spaces = sum(map(text.count, SPACES))
    return (len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated, upper + lower, upper)


@F.pandas_udf(SCHEMA)
def measured(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(x) for x in texts], columns=list(MEASURES), dtype="int64")


@dataclass(frozen=True)
class Rule:
    """A rule fails a document where `fails` holds; its bit in the ledger is 1 << bit and never reused."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbol_heavy", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "shouting", "n_letters >= 20 and 2 * n_upper > n_letters"),
    Rule(5, "word_length", "word_chars < 2 * n_words or word_chars > 25 * n_words"),
)
BASE = ("few_words", "repeated_windows")

#: Versioned policies: the rules whose failure rejects a document.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbol_heavy", "duplicate_lines", "shouting", "word_length"),
}
CURRENT = "v2"
#: Changes with any rule, as bits of another version can't be compared.
VERSION = 1


def mask_of(names: tuple[str, ...]) -> int:
    known = {r.name: r.mask for r in RULES}
    return sum(known[n] for n in set(names))


def with_ledger(docs: DataFrame, text: str = "text", into: str = f"{OWN}ledger") -> DataFrame:
    """docs and one struct column: the measurements and `fail_bits`. No shuffle; other columns pass through."""
    m, bits = f"{into}_m", F.lit(0).cast("long")
    df = docs.withColumn(m, measured(F.col(text)))
    for r in RULES:
        fails = F.expr(_qualified(r.fails, m))
        bits = bits.bitwiseOR(F.when(fails, F.lit(r.mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return df.withColumn(into, F.struct(*[F.col(f"{m}.{c}").alias(c) for c in MEASURES], bits.alias("fail_bits"))).drop(m)


def _qualified(rule: str, struct: str) -> str:
    for c in sorted(MEASURES, key=len, reverse=True):
        rule = rule.replace(c, f"`{struct}`.@{MEASURES.index(c)}")
    for c in MEASURES:
        rule = rule.replace(f"@{MEASURES.index(c)}", c)
    return rule


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: its id, every measurement and `fail_bits`."""
    df = with_ledger(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    return df.select("doc_id", f"{OWN}ledger.*")


def passes(policy: str = CURRENT, bits: Column | None = None) -> Column:
    """Whether a document passes a policy, from its failure bits alone."""
    bits = F.col("fail_bits") if bits is None else bits
    return bits.bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """What each rule of a policy does: documents that fail it, that fail only it, and that stay without it.

    The ledger shrinks to one row for each distinct bit pattern before anything else; there are at most
    2 ** len(RULES) of these, whatever the input.
    """
    names = [r for r in RULES if r.name in POLICIES[policy]]
    full = F.lit(mask_of(POLICIES[policy])).cast("long")
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(full).alias("bits")).agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("mask")) for r in names]))
    n = F.col("n")
    return (
        patterns.select("bits", "n", each.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.mask")) != 0, n).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.mask"), n).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.mask"))) == 0, n).otherwise(0)).alias("n_kept_without"),
        )
    )


def stored(rows: DataFrame) -> DataFrame:
    """The ledger as a table in the shared folder, with the version of the rules that its bits are of: texts are measured once,
    and policies, ablations and later versions of policies read the table."""
    return staged(rows.withColumn("rule_version", F.lit(VERSION)), "ledger")


def compared(rows: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """policy, without, n_kept, n_rejected: each policy whole (without is '') and without each of its rules.

    The ledger shrinks to its bit patterns first, and masks meet patterns alone.
    """
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    masks = [(p, "", mask_of(names)) for p, names in policies.items()]
    masks += [(p, gone, mask_of(tuple(x for x in names if x != gone))) for p, names in policies.items() for gone in names]
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(w).alias("without"), F.lit(m).cast("long").alias("mask")) for p, w, m in masks]))
    fails = F.col("fail_bits").bitwiseAND(F.col("m.mask")) != 0
    both = [F.sum(F.when(x, F.col("n")).otherwise(0)).alias(name) for x, name in ((~fails, "n_kept"), (fails, "n_rejected"))]
    return patterns.select("fail_bits", "n", each.alias("m")).groupBy("m.policy", "m.without").agg(*both)


def kept(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows of docs that pass a policy, with the columns of docs."""
    into = f"{OWN}ledger"
    return with_ledger(docs, text, into).where(passes(policy, F.col(f"{into}.fail_bits"))).drop(into)
