"""Scores, ranks, capped tiers, budgets and selections by rank.

Ranks over a whole table need one order of all rows. ``ranked`` gets them without one task holding the table: rows are
sorted by range over all tasks, and each task adds the number of rows in the partitions before its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import written

#: Tiers from the widest down (fixed values).
LADDER = ["feature", "standard", "brief"]


def outlets(source: Column, parent: Column) -> Column:
    """The number of distinct outlets of a group, a source with a parent counting as that; at least 1."""
    return F.greatest(F.lit(1), F.count_distinct(F.coalesce(parent, source))).cast("int")


def combined_score(score: Column, sources: Column, weight: float = 9.0) -> Column:
    """Score plus the weighted logarithm of the number of sources, which counts as 1 at least."""
    return score + F.lit(weight) * F.ln(F.greatest(F.lit(1), sources))


def adjusted_score(score: Column, penalty: Column) -> Column:
    return F.greatest(F.lit(0), score - F.coalesce(penalty, F.lit(0)))


def ranked(df: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """``df`` with its place in the order, from 1. The order must be total for the same result every time."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # range partitions in one order; the written table fixes which row is in which partition
    spread = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    spread = written(spread, "ranked")
    local = spread.withColumn("__row", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    counts = spread.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # one row a partition
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return local.join(F.broadcast(before), "__part").withColumn(out, (F.col("__before") + F.col("__row")).cast("int")).drop("__part", "__row", "__before")


def assign_tiers(df: DataFrame, order: list[Column], cap: Column, sizes: tuple[int, int], partition: list[str] | None = None, out: str = "tier") -> DataFrame:
    """Tiers in rank order: the first rows that may, up to the first size, are features, the next that may standard, the rest brief.

    ``cap`` is the widest tier of a row (0 feature, 1 standard, 2 brief; null is 0). Within partitions where some are named; otherwise
    only the rows that can still matter, a bounded number at the top of each cap, are looked at in one place.
    """
    capped = df.withColumn("__cap", F.coalesce(cap, F.lit(0)))
    if partition:
        w = Window.partitionBy(*partition).orderBy(*order)
        return _tiers(capped, w, w, sizes, out)
    # features come from the first sizes[0] of cap 0, standard from the first sizes[0] + sizes[1] of caps 0 and 1
    top = capped.where("__cap < 2").orderBy(*order).limit(2 * sum(sizes)).unionAll(capped.where("__cap = 0").orderBy(*order).limit(sum(sizes))).distinct()
    tiers = _tiers(top, Window.orderBy(*order), Window.orderBy(*order), sizes, out)
    other = tiers.select(*[F.col(c).alias(f"__{c}") for c in df.columns], out)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in df.columns]
    return df.join(other, same, "left").select(*df.columns, F.coalesce(out, F.lit(LADDER[2])).alias(out))


def _tiers(df: DataFrame, w, w2, sizes: tuple[int, int], out: str) -> DataFrame:
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("__f", (F.col("__cap") == 0) & (F.sum(F.when(F.col("__cap") == 0, 1).otherwise(0)).over(before) <= sizes[0]))
    may = ~F.col("__f") & (F.col("__cap") <= 1)
    df = df.withColumn("__s", may & (F.sum(F.when(may, 1).otherwise(0)).over(w2.rowsBetween(Window.unboundedPreceding, 0)) <= sizes[1]))
    return df.withColumn(out, F.when(F.col("__f"), LADDER[0]).when(F.col("__s"), LADDER[1]).otherwise(LADDER[2])).drop("__f", "__s", "__cap")


def most_permissive(cap: Column) -> Column:
    """Aggregate: the widest of the caps (0 the widest); null if any is null or there is none."""
    return F.when(F.count(F.lit(1)) == F.count(cap), F.min(cap))


def water_fill(df: DataFrame, partition: list[str], order: list[Column], length: Column, *, total: int | None, floor: int, per_item: int, out: str = "granted") -> DataFrame:
    """Shares a budget among the rows of a partition: a floor each, then up to ``per_item``, then the rest, in order. No total, no limit.

    Floors are granted in any case, so small budgets may be exceeded.
    """
    if total is None:
        return df.withColumn(out, length)
    w = Window.partitionBy(*partition)
    before = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    prior = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    df = df.withColumn("__a", F.least(length, F.lit(floor))).withColumn("__r", F.greatest(F.lit(0), F.lit(total) - F.sum("__a").over(w)))
    df = df.withColumn("__w", F.greatest(F.lit(0), F.least(length, F.lit(per_item)) - F.col("__a")))
    df = df.withColumn("__e", F.greatest(F.lit(0), F.least(F.col("__w"), F.col("__r") - prior("__w"))))
    df = df.withColumn("__r2", F.greatest(F.lit(0), F.col("__r") - F.sum("__w").over(w))).withColumn("__w2", length - F.col("__a") - F.col("__e"))
    df = df.withColumn("__e2", F.greatest(F.lit(0), F.least(F.col("__w2"), F.col("__r2") - prior("__w2"))))
    return df.withColumn(out, F.col("__a") + F.col("__e") + F.col("__e2")).drop("__a", "__r", "__w", "__e", "__r2", "__w2", "__e2")


def diverse_first(df: DataFrame, partition: list[str], group: Column, order: list[Column], most: int, out: str = "place") -> DataFrame:
    """At most ``most`` rows of each partition: the first of every group, then the others, each in order; with their place from 1."""
    rn = F.row_number().over(Window.partitionBy(*partition, group).orderBy(*order))
    df = df.withColumn("__again", rn > 1)
    place = F.row_number().over(Window.partitionBy(*partition).orderBy("__again", *order))
    return df.withColumn(out, place).where(F.col(out) <= most).drop("__again")


def first_of(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row, in order, of every key."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rn).where("__rn = 1").drop("__rn")


def every_nth(df: DataFrame, strata: list[str], order: list[Column], step: int, most: int) -> DataFrame:
    """Every ``step``-th row of each stratum, at most ``most``: the same sample each time."""
    rn = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    return df.withColumn("__rn", rn - 1).where((F.col("__rn") % step == 0) & (F.col("__rn") < step * most)).drop("__rn")
