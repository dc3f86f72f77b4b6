"""Corpus cleaning: language ID, quality, SimHash near-dedup, best-fit packing, each stage written and read again.

Every stage takes (spark, docs, sf_dir), works on all rows that the one before it kept, and applies its decisions.
All but the last return the columns of documents; extra columns pass through, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyslip.llm import language_id, packing, quality, simhash
from tallyslip.llm.common import materialize, table

#: Documents whose mean probability of the best language, over the positions of their letters, is less than this are rejected.
LEAST_LANGUAGE_SCORE = 0.4

#: DuckDB can't run the models of the first stages.
ORACLE_SQL = None


def aside(docs: DataFrame) -> DataFrame:
    """`docs` with all columns but the text under other names, so that none clashes with an operator's own columns."""
    return docs.select(*[F.col(c).alias(c if c == "text" else f"_in_{c}") for c in docs.columns])


def back(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` again."""
    return kept.select(*[F.col(c if c == "text" else f"_in_{c}").alias(c) for c in docs.columns])


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters (null and empty texts are such) or without a sure language go. Null and repeated ids and repeated rows are
    decided row by row; very long texts are read whole; without labelled documents all go; empty table, empty result."""
    model = language_id.train(docs.filter(~language_id.held_out()))
    sure = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return back(language_id.predict(aside(docs), model).filter(sure), docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't keep go; null and empty texts are such. Row by row: repeated rows share their decision.
    Very long texts are read whole; empty table, empty result."""
    return back(quality.predict(aside(docs), quality.train(docs)).filter("keep"), docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one with the smallest id (null ids last, ties by row number). Ids may be null or
    repeated: rows are told apart by their own number. Texts without words (null, empty) are copies of each other. Very long texts are
    read whole; empty table, empty result."""
    rows, groups = simhash.similar_rows(aside(docs))
    order = F.struct(F.col("_in_doc_id").isNull(), F.col("_in_doc_id"), F.col("_row"))
    kept = rows.select("_row", "_in_doc_id").join(groups, "_row").groupBy("_group").agg(F.min(order)["_row"].alias("_row"))
    # texts meet the list of kept rows in one shuffle at every size
    return back(rows.join(materialize(kept.select("_row")).hint("merge"), "_row", "left_semi"), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences. Null and empty texts are their end id; repeated rows are documents of
    their own; very long texts are cut; extra columns are ignored; empty table, empty result."""
    pieces = packing.cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return packing.pack(pieces)


STAGES = [("language_id", languages), ("quality", good_quality), ("simhash_dedup", one_of_each), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
