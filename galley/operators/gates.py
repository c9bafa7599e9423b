"""Data-quality gates: checks on a row of metrics, each with a severity and a reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEVERITIES = ["ok", "warn", "fail"]


@dataclass(frozen=True)
class Check:
    """A check fires where ``when``, a SQL condition on the metrics, holds; null does not fire. ``reason`` is a SQL text."""

    name: str
    severity: str
    when: str
    reason: str


def fraction(part: Column, whole: Column) -> Column:
    """Part of a whole; 0 where there is no whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def evaluate(metrics: DataFrame, checks: list[Check]) -> DataFrame:
    """``metrics`` with verdict (the greatest severity that fires, else ok) and reasons (all that fire, in the order of the checks)."""
    fired = F.array(*[F.when(F.coalesce(F.expr(c.when), F.lit(False)), F.struct(F.lit(SEVERITIES.index(c.severity)).alias("s"), F.concat(F.lit(f"{c.name}: "), F.expr(c.reason).cast("string")).alias("r"))) for c in checks])
    kept = F.filter(fired, lambda x: x.isNotNull())
    worst = F.coalesce(F.array_max(F.transform(kept, lambda x: x["s"])), F.lit(0))
    return metrics.withColumn("verdict", F.element_at(F.array(*map(F.lit, SEVERITIES)), worst + 1)).withColumn("reasons", F.array_join(F.transform(kept, lambda x: x["r"]), "; "))


def merged(gates: DataFrame, keys: list[str]) -> DataFrame:
    """Several gates of a key as one: the worst verdict and all reasons, in order of the gate."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("verdict"))
    g = gates.groupBy(*keys).agg(F.max(rank).alias("w"), F.sort_array(F.collect_list(F.struct("gate", "reasons"))).alias("x"))
    return g.select(*keys, F.element_at(F.array(*map(F.lit, SEVERITIES)), F.col("w").cast("int")).alias("verdict"), F.array_join(F.filter(F.transform("x", lambda v: v["reasons"]), lambda v: v != ""), "; ").alias("reasons"))
