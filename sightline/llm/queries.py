"""One query for each operator, over its whole table and with production parameters."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import (
    cap_filters,
    hard_negatives,
    jaccard_join,
    language_id,
    license_scan,
    mixing,
    packing,
    quality_rules,
    secret_scan,
    sharding,
    token_files,
    toxicity,
    whitening,
)
from sightline.llm.text import fold, table
from sightline.sources.tables import durable, shared_folder


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs, fold(F.col("doc_id"), 5) != 0)
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    found = language_id.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "n_langs")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A budget of all tokens: large sources are cut, small ones repeated up to four times.

    One row for each document, with the epoch, block and position of all its copies.
    """
    rows = durable(mixing.items(table(spark, sf_dir, "documents")))
    budget = rows.agg(F.sum("n_tokens")).first()[0] or 0
    mix = mixing.plan(rows, target_entropy=0.95, repetition=4.0, budget=budget)
    mixed = mixing.scheduled(rows, mix)
    return mixed.select("doc_id", "source", "n_tokens", "weight", "copies", "places")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    stats = durable(quality_rules.statistics(docs).select("doc_id", "__q.*"))
    rules = quality_rules.learn(stats, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(stats, rules)
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "kept", "rule")


def op6_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels, fold(F.col("doc_id"), 4) != 2)
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def _crc(batches):
    for batch in batches:
        crc = [zlib.crc32(x.as_buffer()) for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    chunks = token_files.write_token_files(docs, folder)
    rows = token_files.read_token_files(chunks).select("doc_id", "start", "n_tokens", "ids")
    return rows.mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces_of(packing.pack_documents(table(spark, sf_dir, "documents")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh id are wrong by one on purpose, so that labels and vectors disagree."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of near equal bytes."""
    placed = sharding.assign(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_mixing": op3_mixing,
    "op4_secret_scan": op4_secret_scan,
    "op5_quality_rules": op5_quality_rules,
    "op6_cap_filters": op6_cap_filters,
    "op7_toxicity": op7_toxicity,
    "op8_token_files": op8_token_files,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_kd_shards": op12_kd_shards,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {"op2_license_scan": license_scan.sql()}
