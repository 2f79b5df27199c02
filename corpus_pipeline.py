"""Corpus pipeline: the stages that turn raw documents into packed training sequences.

Each stage takes the rows that its predecessor kept, with the columns of ``documents``; the last one
returns the pieces of the packed sequences. Null and empty texts are undetermined in language and go in the
first stage; an empty table passes every stage as an empty table; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from baflow.llm import decontam, jaccard, langid, packing, pii
from baflow.llm.common import fold, read, save


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined stay; the classifier learns from the labels of ``docs``."""
    return langid.accepted(docs, langid.train(docs, may_learn=fold("doc_id", 4) != 2))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of least id; links are five-word Jaccard similarities of 0.8 or more."""
    return jaccard.keep_one(docs, words=5, threshold=(80, 100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item stay."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their text is replaced by its kind in brackets."""
    return pii.redact(docs, pii.train(docs))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences of tokens."""
    return packing.pack(docs)


STAGES = [("language ID", language_id), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("PII", private_data), ("packing", pack_documents)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's table is written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = save(docs, name.replace(" ", "_"))
    return docs
