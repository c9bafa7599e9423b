"""Writing tables: appends, replaced partitions, retention, and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    df.write.mode("append").partitionBy(*(partition or [])).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition: list[str]) -> None:
    """The partitions that ``df`` has rows for are replaced as one; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def new_generation(df: DataFrame, base: str) -> str:
    """Writes ``df`` beside what it was made from; returns the new path. A table is read while it is rewritten, so never in place."""
    path = f"{base}/generation-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def retained(table: DataFrame, at: str, now: Column, days: int) -> DataFrame:
    """Rows not older than so many days; a null time stays."""
    return table.where(F.col(at).isNull() | (F.col(at) >= now - F.make_dt_interval(F.lit(days))))


def export_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).schema(schema).csv(path)
