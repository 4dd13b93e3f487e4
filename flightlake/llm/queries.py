"""The registered queries of this package: each applies one operator to its
whole table and derives the columns of the query's contract."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import functions as F

from . import ann, bpe, conversations, html_extract, line_dedup, packing, ranker, repeats, spelling, sql, toxicity
from .common import small_batches, table
from .ngram_join import ngram_join
from .quality import quality
from .url_filter import url_filter


def op1_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = toxicity.trained(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark, sf_dir):
    return ngram_join(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_url_filter(spark, sf_dir):
    return url_filter(table(spark, sf_dir, "pages"))


def op7_suffix_array(spark, sf_dir):
    return repeats.digest(table(spark, sf_dir, "documents"))


def op8_html_extract(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op9_nearest_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_quality(spark, sf_dir):
    out = quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


def op11_conversation_repair(spark, sf_dir):
    return conversations.summary(conversations.damaged(table(spark, sf_dir, "conversations")), absent="absent")


def op12_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_quality_classifier(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    ranking = ranker.trained(documents, table(spark, sf_dir, "labels"))
    return ranker.score(documents.select("doc_id", "text"), ranking).select(
        "doc_id", ranker.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= ranker.THRESHOLD).cast("int").alias("predicted"))


def _utc(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        small_batches(spark)
        return fn(spark, sf_dir)
    return run


def queries() -> dict:
    return {f.__name__: _utc(f) for f in (
        op1_toxicity, op2_line_dedup, op3_ngram_jaccard, op4_byte_bpe, op5_best_fit_packing, op6_url_filter, op7_suffix_array,
        op8_html_extract, op9_nearest_neighbours, op10_quality, op11_conversation_repair,
        op12_spelling_variants, op13_quality_classifier)}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filter": sql.OP6, "op10_quality": sql.OP10}
