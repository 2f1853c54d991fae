"""The corpus pipeline: language ID, line dedup, n-gram Jaccard join, decontamination, mixing.

Every stage takes what the one before kept. All but the last return the columns of
``documents``; the last adds what the mix takes of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from veil.llm import decontaminate, langid, line_dedup, mix, ngram_join
from veil.llm.common import scratch, table
from veil.runtime import remove_folder, work_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: A document whose language is less sure than this is rejected.
LEAST_SCORE = 0.5

#: A document goes when repeated lines make up this share of its characters: it is a near copy of earlier ones.
MOST_REPEATED = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; ``lang`` becomes the predicted one.

    Rejected: null text, text without a letter, and a posterior below ``LEAST_SCORE``.
    """
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.identify(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out; a document of which no word stays goes, and so does one that loses ``MOST_REPEATED`` of its characters.

    What is left of a near copy without its repeated lines looks like nothing else, so no later stage would find it. Null and
    empty texts stay as they are; rows that repeat an id lose the same lines.
    """
    left = line_dedup.dedup_lines(docs)
    left = left.where("n_removed = 0 or n_removed < n_lines - n_blank")
    lost = F.col("chars_removed")
    left = left.where((lost == 0) | (lost < F.lit(MOST_REPEATED) * (lost + F.length("text"))))
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each component of near copies (five words, 0.8).

    Null ids and texts without a word link with nothing and stay; rows that repeat an id stay or go together.
    """
    return ngram_join.keep_first(docs).select(*COLUMNS)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item.

    Null ids and texts without a word stay; rows that repeat an id count as one document, so they stay or go together.
    """
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents it takes words of, with ``size``, ``source_size``, ``target`` and ``taken``.

    A null source is a source; documents without a word are never taken. Empty tables pass through all stages.
    """
    mixed = mix.mix_sources(docs, mix.word_count(F.col("text")), carry=["text", "lang", "n_chars"])
    return mixed.where("taken > 0")


STAGES = [
    ("language_id", language_id), ("line_dedup", dedup_lines), ("ngram_jaccard_join", dedup_documents),
    ("decontamination", decontaminate_benchmark), ("mix_sources", mix_sources),
]

#: SQL cannot express the language model, nor the joins at this size; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what earlier stages have written is removed as soon as the next one has read it."""
    docs, before = table(spark, sf_dir, "documents").select(*COLUMNS), None
    for name, stage in STAGES:
        path = work_dir(spark, name)
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        remove_folder(spark, before)
        before = path
    return docs
