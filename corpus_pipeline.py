"""The training-text pipeline: each stage works on all documents that the one before it kept.

Defined cases, beside those of the operators: null and empty texts have the score that the classifiers give a text without
words, are never near duplicates or contaminated, and leave with the mix, which takes documents of at least one word; rows with
a null id go through all filters like others; repeated rows count as copies, of which one stays; texts of any length are read
whole; extra columns stay as they are; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadweave.llm.decontaminate import decontaminate
from leadweave.llm.mixing import mixed
from leadweave.llm.neardup import one_per_class
from leadweave.llm.quality import keep_good
from leadweave.llm.toxicity import drop_toxic
from leadweave.session import cut


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier, fitted on labelled documents, scores below 0.3."""
    return keep_good(docs, _table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxic passages score 0.3 or more."""
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each class of near duplicates."""
    return one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth of the words or more repeat benchmark passages."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the mix takes; `copies` says how often, `taken` how many words that makes."""
    return mixed(docs)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing)]

# Classifiers and sketches have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read back."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
