"""The registered queries of this package: thin layers over its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.centroids import lloyd_sql


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm._arrow import fold
    from quillon.llm.lm_score import score_texts

    out = score_texts(_table(spark, sf_dir, "documents").select("doc_id", "text"), fold("doc_id", 10) != 0)
    return out.select("doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm._arrow import fold
    from quillon.llm.quality import score_quality

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_quality(docs, _table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm.neardup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]).select("doc_id", "dup.n_shingles", "dup.component_id", "dup.kept")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm.decontam import find_leaks

    return find_leaks(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))


def op5_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm.quotes import reply_ordered

    return reply_ordered(_table(spark, sf_dir, "conversations"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm._arrow import fold
    from quillon.llm.langid import identify

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify(docs, fold("doc_id", 4) != 2)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm.token_count import count_tokens, zipf_scores

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, zipf_scores()).select("doc_id", "n_pretokens", "n_tokens")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm.ann import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm.shard import shuffle_into_shards

    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    out = shuffle_into_shards(docs, shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm.mix import pareto_mix

    out = pareto_mix(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.copies") * F.col("mix.size")).alias("taken"), "mix.copies")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm.whiten import whiten

    out = whiten(_table(spark, sf_dir, "embeddings"), ["vec_id"])
    rows = out.select("vec_id", "white.*").select("*", F.posexplode("whitened").alias("p", "w"))
    return rows.select("vec_id", (F.col("p") + 1).alias("component"), "n", "deviation", F.col("w").alias("whitened"), F.get("explained", "p").alias("explained"), "identity_error")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm.centroids import cluster

    return cluster(_table(spark, sf_dir, "embeddings"), ["vec_id"]).select("vec_id", "found.*")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillon.llm.packing import pack

    out = pack(_table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("doc_id", "piece.start", "piece.length", F.crc32("piece.ids").alias("ids_crc32"), "piece.doc_tokens", "piece.sequence_id", "piece.offset", "piece.doc_key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_quality": op2_quality,
    "op3_near_dedup": op3_near_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_chat_quotes": op5_chat_quotes,
    "op6_language_id": op6_language_id,
    "op7_nearest": op7_nearest,
    "op9_token_counts": op9_token_counts,
    "op8_sharding": op8_sharding,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening,
    "op12_centroids": op12_centroids,
    "op13_packing": op13_packing,
}

ORACLE_SQL: dict[str, str] = {"op12_centroids": lloyd_sql()}
