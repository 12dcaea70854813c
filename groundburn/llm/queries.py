"""The registered queries over the test tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.llm import byte_bpe, chat, class_ngram, host_quality, html_blocks, language_id, near_dup, packing, sharding, source_audit, token_records, whitening, wu_manber
from groundburn.llm.base import id_remainder, table

BYTE_BPE = byte_bpe.BpeRules(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

WORD_BPE = token_records.RecordRules(public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op1_html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.extracted(table(spark, folder, "pages"), html_blocks.trained(), keep=["page_id", "url"])


def op2_class_ngram(spark: SparkSession, folder: str) -> DataFrame:
    held_out = id_remainder(F.col("doc_id"), 5) == 1
    return class_ngram.scored(table(spark, folder, "documents"), held_out, keep=["doc_id"])


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dup.classes(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "class_size")


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, folder, "documents"), BYTE_BPE, keep=["doc_id"])


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    sizes = sharding.document_sizes(table(spark, folder, "documents"))
    return sharding.sharded(sizes, ["doc_id", "text_crc32"], "size", 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"))


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    added = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(added)
    return chat.digests(chat.read_back(chat.formatted(turns)))


def op7_token_records(spark: SparkSession, folder: str) -> DataFrame:
    path = token_records.fresh_path(spark)
    files = token_records.written(table(spark, folder, "documents"), path, WORD_BPE)
    return token_records.read_back(files, path, WORD_BPE)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = wu_manber.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_host_quality(spark: SparkSession, folder: str) -> DataFrame:
    return host_quality.judged_by_host(table(spark, folder, "documents"), columns=["doc_id"]).drop("soft_failed", "host_rate")


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.where(~held_out))
    return language_id.identified(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    rules = packing.PackRules(WORD_BPE.tokenizer, WORD_BPE.end_id)
    return packing.packed(table(spark, folder, "documents"), rules, keep=["doc_id"])


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.components_of(table(spark, folder, "embeddings"), keep=["vec_id"])


def op13_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.divergences(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_html_blocks, op2_class_ngram, op3_near_duplicates, op4_byte_bpe, op5_sharding, op6_chat, op7_token_records, op8_decontamination, op9_host_quality, op10_language_id,
    op11_packing, op12_whitening, op13_source_audit)}
