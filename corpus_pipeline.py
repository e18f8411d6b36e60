"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, folder) that returns a DataFrame; ``run`` writes it to the shared folder as
Parquet, and the next stage reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymint.llm import packing, personal, quality, quotient, similar
from tallymint.llm.common import small_batches
from tallymint.session import workspace


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier predicts good.

    From this first stage on texts go to Python workers in small batches, since an executor never gets smaller again.
    """
    small_batches(spark)
    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest id."""
    return quotient.drop_copies(docs)


def similar_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of five-word sets: that with the smallest id."""
    return similar.drop_similar(docs, width=5, part=80)


def personal_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` follows the text."""
    clean = personal.sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents, with their ids and sequences.

    The executors' heaps have grown in the stages before, so the workers remember fewer words than in packing alone.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end=1, remembered=250_000)


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("ngram_jaccard", similar_stage),
    ("personal_data", personal_stage),
    ("packing", packing_stage),
]

#: No SQL: the first stage is a trained model, and the last a tokenizer. Tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents`` in the folder."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = workspace(spark, f"pipeline-{name}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, folder)
