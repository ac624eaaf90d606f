"""From raw documents to packed sequences: toxicity, exact copies, near copies, secrets, packing."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import dedup, jaccard, packing, secret_scan, toxicity
from lakemart.llm.queries import tokenizer, toxicity_classifier
from lakemart.session import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trains on the stage's own documents and drops those it rejects."""
    return toxicity.drop_toxic(docs, toxicity_classifier(spark, docs, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owners' credentials are cut out of the texts; widely copied examples stay."""
    return secret_scan.redact(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

#: Classifier training and packing have no form in SQL; tests compare the stages with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents, each written as Parquet and read again."""
    folder = f"{shared_folder(spark)}/lakemart-pipeline/{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return made
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs
