"""Session settings the jobs are meant to run under."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Run-time plans: coalescing, and splitting of hot join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The cleaning jobs compute dozens of text columns per row. Fused into one generated method
    # they outgrow what the JVM compiles (8000 bytes of bytecode) and would run interpreted;
    # beyond that size Spark is told to evaluate them operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
