"""Registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyslip.llm import byte_bpe, conversation_repair, embedding, language_id, line_dedup, packing, quality, simhash, token_count, toxicity, url_filter, whitening, winnowing
from tallyslip.llm.common import table


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return packing.pack(pieces)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark))


QUERIES = {
    f.__name__: f
    for f in (op2_byte_bpe, op3_simhash, op6_embedding_dedup, op7_token_count, op9_packing, op10_url_filter)
}


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_fingerprints(table(spark, sf_dir, "documents"))


QUERIES["op4_winnowing"] = op4_winnowing


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.predict(docs.select("doc_id", "text"), quality.train(docs))
    return out.select("doc_id", "score", "keep", "label_posterior")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~language_id.held_out()))
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out()))
    out = toxicity.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


QUERIES |= {f.__name__: f for f in (op1_quality, op5_language_id, op8_toxicity)}


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES |= {f.__name__: f for f in (op11_whitening, op12_conversation_repair, op13_line_dedup)}
