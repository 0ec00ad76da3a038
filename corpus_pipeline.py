"""From raw documents to packed sequences: five stages, each written and read again.

A stage takes (spark, docs, sf_dir) and decides on all documents that the one before has kept:
toxic documents go, later repeats of runs of lines are cut (and documents that they leave empty go), one
document of each group of near duplicates stays, documents with a passage of the benchmark go, and what is
left is packed into sequences, which is the result: a row per piece, as in `op1_best_fit_packing`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from memberlytics.llm.common import cut, table
from memberlytics.llm.decontamination import clean_documents
from memberlytics.llm.lines import dedup_lines
from memberlytics.llm.packing import pack_documents
from memberlytics.llm.similar import keep_first
from memberlytics.llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs, drop_emptied=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
# The trained classifier and the tokenizer are beyond SQL; tests/llm holds a small run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
