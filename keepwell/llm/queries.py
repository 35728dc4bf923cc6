"""The registered queries of the training-data operators and, where SQL can say the
same, their DuckDB SQL. Each runs its operator over its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.llm import (bpe, chat, exact, merkle, mixing, packing, quality, sharding, simhash, token_count, tokens, toxicity,
                          warc, whiten)
from keepwell.llm.common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read(warc.write(table(spark, sf_dir, "pages"), revisit_bytes=0))
    return records.where(F.col("record_type").isin("response", "revisit")).select(
        warc.page_id(F.col("record_id")).cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_id(F.col("refers_to")).cast("long").alias("refers_to"), "digest_ok")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark(table(spark, sf_dir, "documents"), digest_all=True)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out("doc_id")))
    return toxicity.score(docs, model)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    said = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(turns.unionByName(added)))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group(table(spark, sf_dir, "documents"), size=3, radius=3)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.judge(docs.select("doc_id", "text", "lang"), labels, keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_documents(table(spark, sf_dir, "documents"), vocab=tokens.public("byte_bpe_multi_50k.tiktoken"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, text = table(spark, sf_dir, "documents"), F.col("text")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    built = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], claims=(tampered, {"text": lowered}))
    return merkle.prove(built)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    rows = whiten.transform(vectors, whiten.fit(vectors, components=16))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = tokens.public("byte_bpe_multi_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), vocab=vocab), vocab=vocab)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc, op2_exact_dedup, op3_toxicity, op4_chat_format, op5_simhash, op6_quality_rules,
                            op7_best_fit_packing, op8_mixing, op9_sharding, op10_token_counts, op11_merkle_manifest,
                            op12_embedding_whitening, op13_byte_bpe)}
