"""The corpus pipeline: stages over ``documents``, each written and read again before the next.

Documents in no learned language go, then all but one of each group of equal
texts, then all but one of each component of near-duplicates. Benchmark passages
are cut out of what is left (a document that is mostly benchmark goes), and the
rest is packed into token sequences. Every stage keeps the columns of
``documents``, extra ones included, but the last, which returns the pieces.

Null, empty and letterless texts are in no language and go with the first stage;
texts of any length are read whole. Of equal texts the row with the largest
doc_id stays, of near-duplicates the one with the smallest; rows without an id
lose against others of their text and are never near-duplicates. Rows that
repeat an id are judged by their texts. An empty table passes all stages empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedwright.llm import decontam, exact, langid, minmax, packing
from feedwright.llm.common import stored, table
from feedwright.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled rows teach."""
    return langid.in_learned_language(docs, langid.learn(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the largest doc_id of each group of equal texts."""
    return exact.winners(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of near-duplicates."""
    return minmax.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Trained language filters and token packing have no SQL; the tests hold the stages against plain models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
