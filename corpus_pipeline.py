"""The corpus pipeline: documents in, packed token sequences out.

Every stage takes (spark, docs, sf_dir), calls one operator of ``kinfold.llm`` and works on all
rows its predecessor kept. All but the last return the columns of ``docs``. Classifiers are
fitted on the labelled documents of ``sf_dir``. Null and empty texts, nulls in other columns, repeated
rows, empty tables and extra columns are treated as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinfold.llm import packing, quality, simhash, tiling, toxicity
from kinfold.llm.registry import table
from kinfold.llm.store import written
from kinfold.llm.text import bounded_batches
from kinfold.session import tune


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold of their language."""
    model = toxicity.train(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), toxicity.ToxicityParams()
    )
    return toxicity.drop_toxic(docs, model)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), quality.QualityParams())
    return quality.keep_good(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in order or reordered."""
    return tiling.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), tiling.TilingParams())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.packed(docs, packing.default_params())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("packing", pack),
]

#: No stage but the joins can be stated in SQL; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written as Parquet and read again."""
    bounded_batches(tune(spark))
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
