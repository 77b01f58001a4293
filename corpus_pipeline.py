"""From raw documents to packed sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents.

quality rules    documents that the current policy rejects go
near duplicates  one document of each class stays, that of the least id
decontamination  documents that hold benchmark passages go
secret scans     every found secret is replaced in the text; n_chars follows
packing          documents become pieces of sequences of 2048 tokens

Defined results, stage by stage: a null, empty or short text fails the quality rules, so later stages see none of
these unless they are given them, and then a text without words is kept by near duplicates and decontamination, has no
secret and becomes one end id. Very long texts are read whole. Of rows that repeat a document, or tie for the least id,
one stays. Null ids and nulls in other columns pass through; further columns do too, whatever their names. An empty
table gives an empty table of the same columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mandrel.llm import decontaminate, near_dup, packing, quality_rules, secret_scan
from mandrel.llm.common import shared_dir, table

#: SQL has no tokenizer.
ORACLE_SQL = None
#: What a packing worker remembers of words: less than on its own, as executors have worked on four stages before.
CACHE_BYTES = 64 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.kept(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), cache=CACHE_BYTES)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
