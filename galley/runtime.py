"""Session helpers: reading tables, cutting lineage in the shared folder, sending modules to executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder; a single file or a folder of parts."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's spark.checkpoint.dir.

    Only where that is unset and the executors are this machine (tests), a temporary local folder is taken.
    """
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="galley-")
        spark.sparkContext.setCheckpointDir(known)
    return known.rstrip("/")


def written(df: DataFrame, what: str, *, partitions: int | None = None) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    The lineage ends there, so a lost executor costs a read and not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    if partitions:
        df = df.coalesce(partitions)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, factor: int = 1) -> DataFrame:
    """Round-robin to the session's shuffle width, for tables of few files that feed heavy work.

    A table that already has that many splits is left as it is.
    """
    spark = df.sparkSession
    want = int(spark.conf.get("spark.sql.shuffle.partitions")) * factor
    return df if df.rdd.getNumPartitions() >= min(want, spark.sparkContext.defaultParallelism) else df.repartition(want)
