"""A training corpus in five stages: quality rules, near-duplicate join, secrets, mixing, packing.

Every stage reads what the one before has written and works on all of it.

Null and empty texts do not pass the quality rules. Rows with a null id stay, each by itself; rows equal in
every column are one; unlike texts of one id stay apart. Texts of any length go through whole. Further columns are
carried to the last stage, whatever their names, and an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm import jaccard_join, mixing, packing, quality_rules, secret_scan
from sightline.sources.tables import durable, shared_folder

SHINGLE_WORDS = 5
SIMILARITY = 80  # percent
REPETITION = 2.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rules or the learned decision list reject."""
    stats = quality_rules.statistics(docs)
    rows = stats.select(F.struct(*docs.columns).alias("__row"), "doc_id", "__q.*")
    rows = durable(rows)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality_rules.learn(rows.drop("__row"), labels)
    return quality_rules.judge(rows, rules).filter("kept").select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component, once. Rows without an id stay.

    Ids name the rows while they are unique. Where any is repeated, a hash over all columns does, so
    unlike texts of one id stay apart, and rows equal in every column are one.
    """
    known = docs.filter(F.col("doc_id").isNotNull())
    link = lambda rows: jaccard_join.link(rows, SHINGLE_WORDS, SIMILARITY)
    if known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        first = link(known).filter("component_id = doc_id").select("doc_id")
        kept = known.join(first, "doc_id", "left_semi").select(*docs.columns)
    else:
        keyed = known.withColumn("__key", F.xxhash64(*docs.columns))
        linked = link(keyed.select(F.col("__key").alias("doc_id"), "text"))
        components = linked.select(F.col("doc_id").alias("__key"), "component_id").distinct()
        first = (
            keyed.select("__key", "doc_id")
            .distinct()
            .join(components, "__key")
            .groupBy("component_id")
            .agg(F.min(F.struct("doc_id", "__key")).alias("__first"))
            .select("__first.__key")
        )
        kept = keyed.join(first, "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; every document stays."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents of small sources up to `REPETITION` times; every document stays."""
    return mixing.mix_documents(docs, target_entropy=0.95, repetition=REPETITION)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 token ids with their pieces and the ids of their documents."""
    sequences = packing.pack_documents(docs)
    return sequences.withColumn("doc_ids", F.col("pieces.doc_id"))


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mix),
    ("packing", pack),
]

#: The stages learn rules, follow links and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
