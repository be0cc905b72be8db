"""Registered queries of the training-data operators, their SQL, and the stages of the corpus pipeline."""
from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffhouse.llm import (byte_bpe, chat_repair, conversation_audit, line_dedup, near_dedup, ngram_join, packed_ids, permutation_index, quality_gam, secret_scan,
                            toxicity_cnn, whitening, winnowing)
from staffhouse.llm.common import ship, table
from staffhouse.llm.sql import CONTAMINATION, NEAR_DUPLICATES, NGRAM_JACCARD
from staffhouse.session import shared_path


def op1_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf_dir, "conversations")).drop("at")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, secret_scan.KINDS))
    count = lambda kind: F.size(F.filter("found", lambda x: x["k"] == kind)).cast("long")
    spans = F.array_join(F.transform("found", lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), "base_sha256", spans.alias("spans"),
                        count(3).alias("n_random"))


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th")


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, whole=False, remembered=500_000)


def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_cnn.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("th")


def op8_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = shared_path(spark, "staffhouse-ids", spark.sql("select uuid()").first()[0])
    packed_ids.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), target, added_tokens=True)
    return packed_ids.read(spark, target, whole=False)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_audit.audit(table(spark, sf_dir, "conversations"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def shipped(f: Callable) -> Callable:
    @wraps(f)
    def run(spark: SparkSession, *rest) -> DataFrame:
        ship(spark)
        return f(spark, *rest)
    return run


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: shipped(f) for f in (
    op1_chat_repair, op2_secret_scan, op3_winnowing, op4_quality_gam, op5_byte_bpe, op6_permutation_index, op7_toxicity_cnn,
    op8_packed_ids, op9_line_dedup, op10_near_dedup, op11_conversation_audit, op12_ngram_join, op13_whitening)}
LLM_ORACLE: dict[str, str] = {"op3_winnowing": CONTAMINATION, "op10_near_dedup": NEAR_DUPLICATES, "op12_ngram_join": NGRAM_JACCARD}


@shipped
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity_cnn.drop_toxic(docs, table(spark, sf_dir, "labels"))


@shipped
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, drop_emptied=True)


@shipped
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


@shipped
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@shipped
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # executors have the memory of earlier stages on them
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, remembered=100_000).drop("decoded")
