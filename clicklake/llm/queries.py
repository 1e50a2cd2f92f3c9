"""Registered queries of the operators, one per operator, and their SQL twins where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.llm import (
    chat_format, exact_dedup, language_id, line_dedup, mixing, near_dedup, packing, prefix_trie, quality_model, quality_rules, spelling, sql, token_counts, warc,
)
from clicklake.llm.common import documents
from clicklake.session import scratch_path


def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.scored(docs, quality_model.learn(docs, labels))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, sf_dir), shingle_words=2).drop("text_hash")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.line_dedup(documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("clean_text", 256).alias("clean_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir), keep="largest")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, language_id.learn(docs))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", stated), (-7, 1, "assistant", stated)], "conv_id long, turn long, role string, text string"
    )
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.windows(given.unionByName(extra)))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.cascade(documents(spark, sf_dir)).drop("rejected_by")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write(warc.page_records(spark.read.parquet(f"{sf_dir}/pages.parquet")), folder)
    return warc.page_digests(spark, folder)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_quality_model, op2_near_dedup, op3_line_dedup, op4_exact_dedup, op5_packing, op6_mixing, op7_language_id,
        op8_chat_format, op9_quality_rules, op10_token_counts, op11_warc, op12_prefix_trie, op13_spelling,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(sql.TWINS)
