"""One query for each operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination, fill_in_middle, jaccard_join, language_id, lexical_search, license_scan, lm_scoring, minhash_dedup,
    nearest, packing, secret_scan, sharding, token_counts,
)
from .tables import remainder, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), buckets=16, token_budget=65_536)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~remainder(F.col("doc_id"), 4, 2)))
    found = language_id.identify(docs, model)
    return found.select("doc_id", remainder(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = "/opt/tokenizers/piece_bpe_32k.model") -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.load_vocabulary(vocabulary))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    base, first = F.array_distinct("places.label"), F.col("places.first")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("matches.label"))), ",").alias("labels"), "score")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_components(table(spark, sf_dir, "documents"), k=5)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 7, 2)
    found = lm_scoring.score(docs, lm_scoring.learn(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.transform(fill_in_middle.store(table(spark, sf_dir, "documents")), outputs=False)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_language_id": op3_language_id,
    "op4_nearest": op4_nearest,
    "op5_secret_scan": op5_secret_scan,
    "op6_token_counts": op6_token_counts,
    "op7_license_scan": op7_license_scan,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_sharding": op10_sharding,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_lexical_search": op12_lexical_search,
    "op13_minhash_dedup": op13_minhash_dedup,
}
