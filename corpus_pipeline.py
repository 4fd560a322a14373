"""The corpus pipeline: toxicity, quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows as Parquet in the
shared folder and gives them to the next one. All but the last return documents' own columns. The classifiers
learn from the labels of documents that are still there.

Defined cases, for every stage: null texts count as empty; null ids, nulls in other columns and extra columns, whatever their names, stay as
they are (packing returns its own columns); very long texts are taken whole; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import classify, minhash, packing, suffixes
from gridloom.llm.common import saved, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that score as toxic. Equal texts, so also repeated rows, go or stay together."""
    model = classify.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return classify.keep_by_score(docs, model, _below(classify.TOXIC_THRESHOLD))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that score as low in quality. Equal texts go or stay together; empty ones are scored as well."""
    model = classify.fit_quality(docs, table(spark, sf_dir, "labels"))
    return classify.keep_by_score(docs, model, _from(classify.QUALITY_THRESHOLD))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one document of each class of near duplicates, that with the smallest doc_id.

    A null id is greater than any other. Rows that share an id are told by their texts, equal ones leave one row. All empty
    texts are copies of each other.
    """
    return minhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the bytes that a document with a smaller doc_id has in a string of 50.

    No row goes, even if its text is empty then. Rows of one id take nothing from each other; null ids are greater than any other.
    """
    return suffixes.keep_new(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of docs in sequences of tokens. Every row is a document of its own; an empty one has the end id alone."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


def _below(threshold: float):
    return lambda scores: np.asarray(scores) < threshold


def _from(threshold: float):
    return lambda scores: np.asarray(scores) >= threshold


STAGES = [
    ("toxicity", toxicity),
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("packing", packed),
]

#: Classifiers, signatures and suffix arrays have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
