"""From raw documents to encoded ones, in five stages.

Each stage is a function of ``(spark, docs, sf_dir)``. ``run`` writes the result of every stage
to the shared folder and reads it back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telestrata.llm import decontam, langid, neardup, pii, sentencepiece
from telestrata.llm.common import fresh, stored, table
from telestrata.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; ``lang`` stays what the source said."""
    name = fresh("language", docs)
    found = docs.withColumn(name, langid.prediction(docs, langid.fit(docs)))
    return found.where(~F.col(f"{name}.rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal and near-equal ones."""
    return neardup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark question."""
    return decontam.cleaned(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in their text."""
    return pii.mask(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their pieces, the number of them, and the round-trip check."""
    return sentencepiece.encoded(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("pieces", pieces),
]

# Trained models and tokenizers have no counterpart in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace('_', '-')}")
    return docs
