"""The training-data pipeline: language ID, near duplicates, benchmark
decontamination, secret scan, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written and read again as the next stage's ``docs``. All stages but the last
return the columns of ``documents``:

* ``language_id`` drops texts without a letter and texts of which no language
  has a third of the letters;
* ``near_duplicates`` keeps one document of each component of the n-gram
  Jaccard join (five words, 0.8), the one with the smallest id;
* ``decontamination`` drops documents that hold a test phrase of ``benchmark``;
* ``secrets`` masks found secrets in the text (``n_chars`` follows);
* ``packing`` gives every document its length bucket, batch and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import decontamination, jaccard_join, language_id, packing, secret_scan
from feedloom.llm.tables import remainder, table
from feedloom.session import stage_table

#: Near duplicates and secrets have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.filter(~remainder(F.col("doc_id"), 4, 2)))
    return language_id.keep_identified(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, k=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_scan.mask_secrets(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, buckets=16, token_budget=65_536)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared
    folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
