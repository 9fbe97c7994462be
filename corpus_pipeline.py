"""The corpus pipeline: five stages over ``documents``, each applied to all that its predecessor kept.

Every stage but the last returns the columns of ``documents``; ``run`` writes each result as Parquet in the
shared folder and reads it again, so a later stage never computes an earlier one anew.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trendframe.llm import jaccard_join, langid, packing, pii, resampling
from trendframe.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the good labelled ones keeps."""
    return resampling.keep(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known to the models trained on ``docs``."""
    return langid.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group that links of similarity 0.8 or more hold together."""
    return jaccard_join.distinct(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048, end_id=1)


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("packing", pack),
]

#: Models, tokens and sampled sums are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
