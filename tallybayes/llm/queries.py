"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybayes.llm import oracles
from tallybayes.llm.align import align
from tallybayes.llm.chat import conversation_digests, format_conversations
from tallybayes.llm.decontam import contaminated
from tallybayes.llm.fingerprint import edited_fingerprints
from tallybayes.llm.langid import identify
from tallybayes.llm.license import scan
from tallybayes.llm.linededup import drop_recurring_lines
from tallybayes.llm.minhash import near_duplicates
from tallybayes.llm.packing import pack_documents
from tallybayes.llm.quality import importance_resample
from tallybayes.llm.rules import text_rules
from tallybayes.llm.search import ranked_search
from tallybayes.llm.storage import documents
from tallybayes.llm.warc import archive_pages, read_records


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), k=4, percent=80)


def op2_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    text = F.lit("</s>[INST] ok [/INST]")
    more = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-1).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"),
                 F.lit(role).alias("role"), text.alias("text")) for i, role in enumerate(("user", "assistant"))])))
    return conversation_digests(format_conversations(rows.union(more)))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = identify(docs, ~held_out & F.col("doc_id").isNotNull())
    return found.withColumn("held_out", held_out)


def op5_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(documents(spark, sf_dir).select("doc_id", "text"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(documents(spark, sf_dir), items).withColumn("tiles", F.size("tiles"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_records(spark, target).select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "ratio", "n_chunks", "n_bad_chunks")


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_license": op2_license,
    "op3_chat": op3_chat,
    "op4_langid": op4_langid,
    "op5_linededup": op5_linededup,
    "op6_fingerprint": op6_fingerprint,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_quality": op10_quality,
    "op11_align": op11_align,
    "op12_search": op12_search,
    "op13_rules": op13_rules,
}
ORACLE: dict[str, str] = {"op2_license": oracles.LICENSE, "op3_chat": oracles.CHAT, "op9_warc": oracles.WARC,
                          "op12_search": oracles.SEARCH}
