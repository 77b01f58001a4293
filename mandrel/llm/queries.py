"""The registered queries of this subpackage: each runs its operator over its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mandrel.llm import chat_format, decontaminate, fill_middle, html_extract, language_id, media, near_dup, packing, quality_classifier, quality_rules, search, secret_scan, sharding
from mandrel.llm.common import OWN, crc_fold, staged, table
from mandrel.llm.oracle import ORACLES


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = F.lit(quality_rules.mask_of(quality_rules.BASE)).cast("long")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(base) != 0).alias("base_failed"), quality_rules.passes().alias("kept"), "n_lines", "fail_bits",
    )


def op1_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy does, from the failure bits of the whole table."""
    return quality_rules.ablation(quality_rules.ledger(table(spark, sf_dir, "documents")))


def op1_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every policy, and every policy without each of its rules, from one stored ledger: documents that stay and that go."""
    rows = quality_rules.stored(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return quality_rules.compared(rows)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = chat_format.read_back(chat_format.windows(turns.unionByName(probe)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = back.select("conv_id", F.struct("window", F.size("turns").cast("long").alias("n"), said.alias("said"), "target", "chars").alias("w"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("ws"))
    joined = lambda c: F.array_join(F.transform("ws", lambda w: w[c]), "")
    total = lambda c: F.aggregate("ws", F.lit(0).cast("long"), lambda a, w: a + w[c])
    convs = convs.select("conv_id", total("n").alias("n_turns"), joined("said").alias("said"), joined("target").alias("target"), total("chars").alias("formatted_chars"), F.size("ws").cast("long").alias("n_windows"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return convs.select(
        "conv_id", "n_turns", digest("said").alias("turns_sha256"), F.length("target").cast("long").alias("loss_chars"),
        digest("target").alias("loss_sha256"), "formatted_chars", "n_windows",
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = f"{OWN}spans"
    rows = secret_scan.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), into=spans)
    of = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    base = F.filter(spans, lambda s: s["kind"] < 3)
    return rows.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"), secret_scan.listed(F.col(spans)).alias("spans"), of(3).alias("n_entropy"),
    )


def op3_base_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op3_secret_scan that SQL can state."""
    return op3_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def op4_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"))


def op4_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laws of the packing: every document's pieces follow each other to its last id, and every sequence's fill it from 0 without a gap."""
    pieces = staged(op4_packing(spark, sf_dir), "pieces")
    whole = lambda at: (F.min(at) == 0) & (F.max(F.col(at) + F.col("length")) == F.sum("length")) & (F.count_distinct(at) == F.count("*"))
    docs = pieces.groupBy("doc_id").agg((whole("start") & (F.sum("length") == F.max("doc_tokens"))).alias("covered"))
    sequences = pieces.groupBy("sequence_id").agg((whole("offset") & (F.sum("length") <= packing.WINDOW)).alias("fits"), F.sum("length").alias("n"))
    sums = sequences.agg(F.bool_and("fits").alias("sequences_fit"), (F.count_if(F.col("n") < packing.WINDOW) <= 1).alias("one_padded"))
    return docs.crossJoin(F.broadcast(sums))  # one row


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_fold(F.col("doc_id"), 3) == 1
    found = language_id.predict(docs, language_id.train(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.assign(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laws of the sharding, by shard: its rows, and that slots run from 0 without a gap."""
    rows = staged(op6_sharding(spark, sf_dir), "sharded")
    slots = (F.min("slot") == 0) & (F.max("slot") == F.count("*") - 1) & (F.count_distinct("slot") == F.count("*"))
    return rows.groupBy("shard").agg(F.count("*").alias("n_rows"), slots.alias("gapless"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_extract.main_text(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = f"{OWN}found"
    rows = decontaminate.with_matches(docs, table(spark, sf_dir, "benchmark"), found, ranges=False)
    return rows.select("doc_id", *[f"{found}.{c}" for c in ("n_words", "n_hit", "n_items", "items_sha256")], decontaminate.is_contaminated(F.col(found)).alias("contaminated"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_fold(F.col("doc_id"), 5) == 0
    found = quality_classifier.score(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels"), ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    images = docs.select("doc_id", n_bytes.alias("n_bytes"), media.as_graymap(media.padded(F.col("text"))).alias("media"))
    back = media.read_back(media.stored(images, ["doc_id", "n_bytes"]), ["doc_id", "n_bytes", "hash"])
    return back.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.col("hash").alias("feature"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.transformed(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(fill_middle.restored()).alias("restored_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = (
        op1_quality_rules, op2_chat_format, op3_secret_scan, op4_packing, op5_language_id, op6_sharding, op7_html_extract, op8_near_dup, op9_decontaminate,
        op10_quality_classifier, op11_media, op12_fill_middle, op13_ranked_search,
    )
    return {f.__name__: f for f in (*each, op1_ablation, op1_policies, op3_base_columns, op4_coverage, op6_laws)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
