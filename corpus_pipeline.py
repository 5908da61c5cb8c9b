"""From documents to packed sequences, in stages that each apply one text operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm.common import stage, stored
from roadpulse.llm.exact_dedup import drop_copies
from roadpulse.llm.mixing import mixed_documents
from roadpulse.llm.packing import pack, tokenizer_path
from roadpulse.llm.quality_classifier import keep_good
from roadpulse.llm.simhash import drop_near_copies


@stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of those it gets, does not reject."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


@stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by their five-word shingles."""
    return drop_near_copies(docs)


@stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as documents: the words taken of each, a second row for those taken twice."""
    return mixed_documents(docs)


@stage
def harmonic_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents of the mix in sequences of 2,048 tokens, with their ids. ``row`` tells the two rows of a document taken twice apart."""
    return pack(docs, tokenizer_path(), special=True).withColumnRenamed("rid", "row")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing to target weights", source_mixing),
    ("packing", harmonic_packing),
]

# The classifier, the fingerprints and the tokenizer have no SQL form; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two stages the table is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, run_stage) in enumerate(STAGES):
        docs = run_stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
