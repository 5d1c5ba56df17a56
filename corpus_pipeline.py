"""A training corpus from documents, in five stages.

Each stage is a function of (spark, docs, sf_dir) whose result is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of documents.

1. language_id drops texts without a letter, or in none of the learned languages.
2. exact_dedup keeps one of the documents whose texts are equal but for A-Z case.
3. near_dedup keeps one document of each component of near duplicates.
4. mixing takes the tokens that the target weights allow from each source.
5. sentencepiece encodes and decodes what is left.

Rows that repeat an id are treated as each operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspike.llm import exact_dedup, language_id, mixing, near_dedup, pieces
from marlspike.session import materialize

#: Of all tokens that reach the mixing stage, the part that is kept.
MIX_PERCENT = 80


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = docs.filter(F.col("lang").isNotNull() & ~language_id.held_out(F.col("doc_id")))
    return language_id.keep_identified(docs, language_id.train(labelled))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_documents(docs, mixing.WEIGHTS, MIX_PERCENT)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.digests(docs).withColumnRenamed("doc", "doc_id")


STAGES = [
    ("language_id", identify),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("sentencepiece", tokenize),
]

#: The first stage is a trained model, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
