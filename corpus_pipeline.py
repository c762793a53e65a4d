"""The corpus pipeline: five operators in a row, each stage on all that the one before kept."""

from __future__ import annotations

import os
import sys
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tableport.llm import decontam, langid, linespread, ordermin, pieces  # noqa: E402
from tableport.llm.queries import piece_model  # noqa: E402
from tableport.session import materialize  # noqa: E402
from tableport.sources.tables import read_table  # noqa: E402

# a text in none of the learned languages spreads its probability over them
MIN_LANGUAGE_SCORE = 0.35


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage):
    """Columns beyond those of ``DOCUMENT`` pass through a stage under names that no operator uses."""
    @wraps(stage)
    def guarded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = docs.columns
        return stage(spark, docs.toDF(*[c if c in DOCUMENT else f"extra_{i}" for i, c in enumerate(own)]), sf_dir).toDF(*own)

    return guarded


@keeps_columns
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised; texts without a letter and strange ones go."""
    network = langid.train_network(docs.where(~langid.held_out()))
    named = langid.identify(docs, network)
    return named.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


@keeps_columns
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes cross-site boilerplate lines out of the texts and counts their characters again."""
    cleaned = linespread.remove_boilerplate(docs)
    n_chars = F.when(F.col("removed").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
    return cleaned.withColumn("n_chars", n_chars).select(*docs.columns)


@keeps_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return ordermin.first_of_each(docs).select(*docs.columns)


@keeps_columns
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item or a long excerpt of one."""
    found = decontam.find_items(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with the digests of the ids and of the decoded text."""
    encoded = pieces.encode_texts(docs.select("doc_id", "lang", "source", "text"), piece_model())
    return pieces.with_digests(encoded).select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("encoding", encoding)]

# a trained network, sketches and a tokenizer have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
