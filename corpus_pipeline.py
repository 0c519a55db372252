"""Corpus pipeline: five stages over ``documents``.

Toxic documents go, one document of each near-duplicate group stays, documents that hold
benchmark items go, personal data in the texts is replaced, and what is left is packed into
sequences. All but the last stage return the columns of ``documents``.

Rows without an id stay unless they are toxic or hold a benchmark item; they are no one's duplicate. Null and empty texts stay
and are packed as their end mark. Rows of one id count as one document in the second stage, as rows of their own in
all others. Of equal similarity the smallest id stays. Further columns of any name go along; an empty table, or one
that a stage empties, gives an empty result. Without labels or benchmark items their stages keep everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import decontam, neardup, packing, pii, toxicity
from weft.llm.queries import vocabulary
from weft.scratch import Scratch


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return toxicity.drop_toxic(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group."""
    scratch = Scratch(spark, "pipeline-neardup")
    return scratch.bind(neardup.drop_duplicates(spark, docs, scratch))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    scratch = Scratch(spark, "pipeline-decontam")
    return scratch.bind(decontam.drop_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), scratch))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts reads ``[KIND]``; every document stays, ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean

    changed = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.coalesce(changed, "n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences, sources in proportion."""
    scratch = Scratch(spark, "pipeline-packing")
    return scratch.bind(packing.pack(spark, docs, scratch, vocabulary()))


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", personal_data),
    ("packing", pack),
]
#: A trained classifier decides the first stage, so SQL can't state the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; between two of them the documents are written and read again."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return scratch.bind(STAGES[-1][1](spark, docs, sf_dir))
