"""Readers and sinks: raw tables, layered Parquet tables, views, samples, counts and the day spine."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sightline.sources.schemas import SCHEMAS


def read_source(
    spark: SparkSession, name: str, root: str, fmt: str = "parquet", null_tokens=(), **options
) -> DataFrame:
    """Scan a raw table from `<root>/<name>`; `null_tokens` are texts that mean null."""
    schema = SCHEMAS[name]
    if fmt == "csv":
        # Columns are found by their names in the header, not by position.
        options = {"header": "true", "enforceSchema": "false", **options}
        names = spark.read.format(fmt).options(**options).load(f"{root}/{name}").columns
        kinds = {f.name: f for f in StructType.fromDDL(schema).fields}
        in_file = StructType([kinds.get(n, StructField(n, StringType())) for n in names])
        df = spark.read.format(fmt).schema(in_file).options(**options).load(f"{root}/{name}")
        df = df.select(*kinds)
    else:
        df = spark.read.format(fmt).schema(schema).options(**options).load(f"{root}/{name}")
    tokens = list(null_tokens)
    if not tokens:
        return df
    return df.select(
        *[
            F.when(~F.col(c).isin(tokens), F.col(c)).alias(c) if kind == "string" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def _refuse_own_input(df: DataFrame, path: str) -> None:
    bare = lambda p: "/" + p.split(":", 1)[-1].strip("/")
    if any(f"{bare(f)}/".startswith(f"{bare(path)}/") for f in df.inputFiles()):
        raise ValueError(f"{path} would be overwritten while it is read")


def write_table(
    df: DataFrame, root: str, layer: str, name: str, partition_by=None, mode: str = "overwrite"
) -> DataFrame:
    """Full refresh of `<root>/<layer>/<name>`, read back so that later jobs start from the files.

    A frame that reads the table it would replace is refused; store it under another name.
    """
    path = f"{root}/{layer}/{name}"
    _refuse_own_input(df, path)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return read_table(df.sparkSession, root, layer, name)


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{layer}/{name}")


def refresh_partitions(
    df: DataFrame, root: str, layer: str, name: str, partition_by: list[str]
) -> DataFrame:
    """Incremental refresh: only the partitions present in `df` are replaced."""
    path = f"{root}/{layer}/{name}"
    _refuse_own_input(df, path)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return read_table(df.sparkSession, root, layer, name)


def commit_table(
    df: DataFrame, root: str, layer: str, name: str, partition_by: list[str] | None = None
) -> DataFrame:
    """Replace a table by a new version, which readers see whole or not at all.

    The rows are written beside the old ones. Only when they are complete, a row with the version's folder is
    added to the table's log, and from then on `current_table` reads it. Frames that were read before
    keep their files, so a table may be rewritten from itself; a write that fails leaves no trace
    in the log. Of two writers of one version the one whose folder comes first by name counts.
    Old versions are left to the folder's retention rules.
    """
    spark, base = df.sparkSession, f"{root}/{layer}/{name}"
    last = _log(spark, base).agg(F.max("version")).first()[0] or 0
    folder = f"v{last + 1:08d}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base}/{folder}")
    entry = spark.createDataFrame([(last + 1, folder)], LOG)
    entry.coalesce(1).write.mode("append").parquet(f"{base}/log")
    return current_table(spark, root, layer, name)


LOG = "version long, folder string"


def _log(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(LOG).parquet(f"{base}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def current_table(spark: SparkSession, root: str, layer: str, name: str, version: int | None = None) -> DataFrame:
    """The newest version of a table, or an older one that is still there."""
    base = f"{root}/{layer}/{name}"
    log = _log(spark, base)
    wanted = log if version is None else log.filter(F.col("version") == version)
    newest = wanted.orderBy(F.desc("version"), "folder").first()
    if newest is None:
        raise ValueError(f"{base} has no version{'' if version is None else f' {version}'}")
    return spark.read.parquet(f"{base}/{newest['folder']}")


def shared_folder(spark: SparkSession) -> str:
    """The folder of intermediate tables, which the driver and all executors share."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and go on from the files.

    Used where a result is read several times, or where row positions must not change when
    an executor is lost. Unlike a cache it survives executors, and later reads prune columns.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from `start` to `end`, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def spine_over(df: DataFrame, day: str) -> DataFrame:
    """One row per day from the first to the last day of a table."""
    ends = df.agg(F.min(F.to_date(day)).alias("low"), F.max(F.to_date(day)).alias("high"))
    return ends.select(F.explode(F.sequence("low", "high")).alias("date_day"))


def sample_table(df: DataFrame, n: int = 100, order_by: list[Column] | None = None) -> DataFrame:
    """First `n` rows in the given order (per-task top-n, then a merge of n rows)."""
    return df.orderBy(*(order_by or df.columns)).limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("mart_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
