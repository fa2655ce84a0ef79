"""The corpus pipeline: rules, classifier, near duplicates, mixing, tokens.  Each stage reads what the one before wrote.

Defined cases, in all stages: a null text is an empty one; rows with a null, repeated or shared doc_id are rows of their
own; very long texts are read whole; ties are broken as each operator says; an empty table gives empty stages; extra columns of
any name go through all stages but the last.  The tables of the stages stay in the shared folder, as the last is read lazily.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import mixing, near_duplicates, piece_bpe, quality_classifier, quality_rules
from starloom.llm.common import fresh_name, materialise, shared_folder, table
from starloom.llm.queries import model_path

#: No stage can be written in SQL for any SQL engine: learned rules, trees, MinHash and BPE merges.
ORACLE_SQL = None


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rules = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep(docs, rules)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    forest = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    score = fresh_name(docs, "score")
    return quality_classifier.score(docs, forest, name=score).where(F.col(score) >= 0.3).select(*docs.columns)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, that with the least id; rows without an id come last, and rows without words are groups of their own."""
    row = fresh_name(docs, "row")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()))  # ids may be repeated, shared or null
    group = near_duplicates.near_duplicates(rows, key=row).select(F.col("doc_id").alias(row), "group_id")
    joined = rows.select(row, "doc_id").join(group, row)
    kept = joined.groupBy("group_id").agg(F.min_by(row, F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias(row)).select(row)
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A flatter mix of the sources: every document stays, those of small sources up to twice.  Each file is a mix of its own, in mixed order."""
    return mixing.mix(docs, ordered=True).select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_bpe.digest(piece_bpe.encode_decode(docs, model_path()))


STAGES = [
    ("quality rules", rules_stage),
    ("quality classifier", classifier_stage),
    ("n-gram Jaccard join", duplicates_stage),
    ("mixing", mixing_stage),
    ("SentencePiece", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written as Parquet in the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
