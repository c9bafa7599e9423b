"""Mixed timestamp notations to one UTC instant, through an incremental dictionary of distinct values.

A value is parsed once for each (text, zone, date order) it occurs with, however many rows hold it. The
dictionary is a Parquet table that grows by the values it does not know yet; rows get their instant by an
equi-join on the three fields. Nothing is broadcast by force: the join is left to the adaptive planner, and
since the dictionary has each key once, a hot value costs one dictionary row and a skewed side that AQE splits.
The dictionary does not depend on the table it was filled from: it lies in the shared folder under the parser's version, and
every run adds what it does not know yet. One run at a time may add to it.

Defined cases: null, empty and senseless texts give null; a text without zone whose zone is unknown gives
null; repeated rows keep their number; extra columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import shared_dir, table

KEY = ["raw", "zone", "date_order"]
#: Changes whenever the parser reads a text otherwise; older dictionaries are then left alone.
VERSION = 2
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in KEY] + [T.StructField("utc_ms", T.LongType())])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from ..functions.instants import instant_ms

    for b in batches:
        raw, zone, order = (b.column(k).to_pylist() for k in range(3))
        ms = [instant_ms(*x) for x in zip(raw, zone, order, strict=True)]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(ms, pa.int64())], names=[*KEY, "utc_ms"])


def parsed(values: DataFrame) -> DataFrame:
    """``values`` (raw, zone, date_order), each distinct value once, with its instant."""
    return values.select(*KEY).mapInArrow(_parse, SCHEMA)


def update_dictionary(values: DataFrame, path: str, *, exists: bool | None = None) -> DataFrame:
    """Adds to the dictionary at ``path`` the distinct values that it lacks; returns the whole dictionary.

    Only new values are parsed. Rows with a null text are left out, for they name no instant.
    """
    spark = values.sparkSession
    new = values.where(F.col("raw").isNotNull()).select(*KEY).distinct()
    if exists is None:
        j = spark.sparkContext._jvm
        where = j.org.apache.hadoop.fs.Path(path)
        exists = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    if exists:
        old = spark.read.schema(SCHEMA).parquet(path)
        same = [new[k].eqNullSafe(old[k]) for k in KEY]
        new = new.join(old, same, "left_anti")
    parsed(new).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def with_instants(rows: DataFrame, dictionary: DataFrame, raw: str, zone: str, date_order: str, out: str) -> DataFrame:
    """``rows`` with the instant of column ``raw`` in ``out`` (bigint milliseconds, null where there is none)."""
    d = dictionary.select(*[F.col(k).alias(f"__{k}") for k in KEY], F.col("utc_ms").alias("__ms"))
    on = [F.col(a).eqNullSafe(F.col(f"__{k}")) for a, k in zip((raw, zone, date_order), KEY, strict=True)]
    joined = rows.join(d, on, "left")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.col("__ms").alias(out))


def feed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_items' two times in long form: id, field_name, raw, zone, date_order."""
    raw = table(spark, sf_dir, "raw_items").select("id", "source_name", "collector_run_id", "published_at", "fetched_at")
    # sources and collector runs are dimension tables that do not grow with the items; the planner decides
    src = table(spark, sf_dir, "sources").groupBy("source_name").agg(F.min("home_zone").alias("home_zone"), F.min("date_order").alias("date_order"))
    run = table(spark, sf_dir, "collector_runs").groupBy("run_id").agg(F.min("clock_zone").alias("clock_zone"))
    rows = raw.join(src, "source_name", "left").join(run, raw.collector_run_id == run.run_id, "left")
    both = F.array(
        F.struct(F.lit("published_at").alias("field_name"), F.col("published_at").alias("raw"), F.col("home_zone").alias("zone"), "date_order"),
        F.struct(F.lit("fetched_at").alias("field_name"), F.col("fetched_at").alias("raw"), F.col("clock_zone").alias("zone"), "date_order"),
    )
    return rows.select("id", F.explode(both).alias("x")).select("id", "x.*")


def is_canonical(raw: str | F.Column) -> F.Column:
    """Whether a text is already written exactly as YYYY-MM-DDTHH:MM:SS.mmmZ."""
    return F.col(raw).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}Z\z")


def dictionary_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/instants-dictionary-{VERSION}"


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p3_found: the values that name an instant and are not canonical yet, with that instant."""
    rows = feed_times(spark, sf_dir).where(F.col("raw").isNotNull() & ~is_canonical("raw"))
    d = update_dictionary(rows, dictionary_path(spark)).where(F.col("utc_ms").isNotNull())
    return with_instants(rows, d, "raw", "zone", "date_order", "utc_ms").where(F.col("utc_ms").isNotNull()).select("id", "field_name", "utc_ms")


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p3_normalised: both times of every raw item as UTC instants, null where the text names none."""
    rows = feed_times(spark, sf_dir)
    open_ = F.col("raw").isNotNull() & ~is_canonical("raw")
    d = update_dictionary(rows.where(open_), dictionary_path(spark))
    # what needs no look-up does not join, so that canonical and null values are no hot key
    ready = rows.where(~F.coalesce(open_, F.lit(False))).select("id", "field_name", F.unix_millis(F.try_to_timestamp("raw")).alias("utc_ms"))
    return ready.unionByName(with_instants(rows.where(open_), d, "raw", "zone", "date_order", "utc_ms").select("id", "field_name", "utc_ms"))


def readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p3_iso: the instants of the values in the one notation that SQL reads by itself, for comparison with it."""
    rows = feed_times(spark, sf_dir).where(F.col("raw").rlike(ISO))
    d = update_dictionary(rows, dictionary_path(spark))
    return with_instants(rows, d, "raw", "zone", "date_order", "utc_ms").select("id", "field_name", "utc_ms")


ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(Z|[+-][0-9]{2}:[0-9]{2})$"
ISO_SQL = f"""select id, f as field_name, epoch_ms(cast(raw as timestamptz)) as utc_ms from (select id, 'published_at' as f, published_at as raw from raw_items union all select id, 'fetched_at', fetched_at from raw_items) where regexp_matches(raw, '{ISO}')"""
