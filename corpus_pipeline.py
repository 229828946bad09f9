"""From raw documents to token ids: rules, lines, near duplicates, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All stages but the last return the columns of ``documents``; null texts stay null."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import table, written
from shelfmark.llm.decontamination import decontaminate
from shelfmark.llm.line_templates import drop_recurring_lines
from shelfmark.llm.ngram_jaccard import keep_one_of_each
from shelfmark.llm.quality_rules import keep_good
from shelfmark.llm.sentencepiece_codec import encode

#: What counts as a near copy.
NEAR = {"size": 5, "percent": 80}


def _lengths(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules accept."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template recurs in ten or more texts. Of long lines that are the same in two
    or more texts, one stays. Texts that would lose more than half
    stay whole if they have a near copy for the next stage to judge."""
    return _lengths(drop_recurring_lines(docs, near_copies=NEAR, long_docs=2))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates: five words, similarity of 0.8."""
    return keep_one_of_each(docs, **NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ten or more words they share with benchmark items; a document that
    consists of them by more than half goes."""
    return _lengths(decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10, max_coverage=0.5))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    back = encode(docs, model, decoded="decoded")
    return back.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: SQL has no SentencePiece; ``tests/llm/test_pipeline.py`` compares every stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
