"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that the one before it kept, with the operator's
own parameters. All stages but the last return the columns of ``documents``;
``n_chars`` follows the text where a stage changes it. A stage never drops a
document but for its own reason: toxicity drops those it rejects, the n-gram
join keeps the smallest ``doc_id`` of each near-copy group, the others keep
every document, with an empty text if nothing is left. Null texts stay null
until the last stage, which packs them as empty; rows with a null ``doc_id``
pass through. Columns beyond those of ``documents`` are carried along.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import line_dedup, ngram_join, packing, repeats, toxicity
from flightlake.llm.common import free_name, small_batches, stored, table


def _stage(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, docs, sf_dir)
    return run


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long"))


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs)
    return toxicity.score(docs, model, out_col=score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


@_stage
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_dedup.dedup_lines(docs))


@_stage
def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


@_stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(repeats.remove_repeats(docs))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram join", dedup_near_copies),
    ("suffix array", cut_repeats),
    ("packing", pack),
]

#: Learned scores, string sets and packings are not for SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
