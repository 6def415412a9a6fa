"""The corpus pipeline: five stages, each over all that the one before has kept.

``STAGES`` names them in order. A stage takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's ``docs``. All but the last keep
the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.exact_dedup import drop_exact_copies
from tidemark.llm.near_dedup import drop_near_duplicates
from tidemark.llm.piece_sampling import sample_pieces
from tidemark.llm.stash import Stash
from tidemark.llm.toxicity import drop_toxic


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on ``labels``, does not reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id."""
    return drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as sampled pieces, with a check that they decode to the text."""
    return sample_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("sentencepiece", as_pieces),
]

ORACLE_SQL = None  # trained models, alignments and samples are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    stash = Stash(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
