"""The daily run as stages: each reads tables, writes one, and can be run from and to any stage.

A stage is a function of (spark, tables) where tables gives the test or feed tables and the results of earlier stages by name. Judgments of
people or models enter as verdict tables (``verdicts``: id, keep), so a run is the same every time; without one everything is kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import urls as u
from ..operators import history, ranking
from ..operators.gates import Check, evaluate
from ..runtime import table

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Stage:
    name: str
    build: Callable[[SparkSession, Tables], DataFrame]
    metrics: tuple[Check, ...] = (Check("rows", "fail", "n = 0", "'no rows'"),)


def collect(spark: SparkSession, tables: Tables) -> DataFrame:
    """Raw items once for each source and identifier, with canonical address and title."""
    d = tables("raw_items").select("id", "source_name", "item_guid", "title", "body", "original_url", "collector_run_id")
    first = ranking.first_of(d, [F.col("source_name"), F.col("item_guid")], [F.col("collector_run_id"), F.col("id")])
    return first.withColumn("canonical_url", u.canonical_url("original_url")).withColumn("title", t.clean_title("title")).withColumn("body_text", t.strip_html("body")).drop("body")


def preprocess(spark: SparkSession, tables: Tables) -> DataFrame:
    """Items that no other item of their parent stands for, and that no verdict cuts."""
    src = tables("sources").select("source_name", "parent_source")
    d = tables("collect").join(src, "source_name", "left").withColumn("outlet", F.coalesce("parent_source", "source_name"))
    run = tables("collector_runs").select(F.col("run_id").alias("collector_run_id"), F.col("started_at").alias("ord"))
    keyed = d.join(run, "collector_run_id", "left").select("id", F.col("canonical_url").alias("url"), t.normalize_title("title").alias("title_key"), "ord", "outlet")
    kept = history.absorb_within(keyed, "outlet").where("kept").select("id")
    out = d.join(kept, "id", "left_semi")
    verdicts = tables("verdicts")
    return out if verdicts is None else out.join(verdicts.where("not keep").select("id"), "id", "left_anti")


def group(spark: SparkSession, tables: Tables) -> DataFrame:
    """Stories: items with one title, with their length and outlets."""
    d = tables("preprocess").withColumn("story", F.xxhash64(F.coalesce(t.normalize_title("title"), F.lit(""))))
    g = d.groupBy("story").agg(F.max(F.coalesce(F.length("body_text"), F.lit(0))).alias("chars"), ranking.outlets(F.col("source_name"), F.col("parent_source")).alias("source_count"), F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n_items"))
    return g.withColumn("score", F.least(F.lit(100), (F.col("chars") / 20).cast("int")))


def rank(spark: SparkSession, tables: Tables) -> DataFrame:
    """Stories in order of score and the logarithm of their outlets, with tiers."""
    d = tables("group").withColumn("combined", F.round(ranking.combined_score(F.col("score"), F.col("source_count")), 6))
    d = ranking.ranked(d, [F.col("combined").desc(), F.col("first_id")])
    return ranking.assign_tiers(d, [F.col("rank")], F.lit(0), (15, 60))


def packets(spark: SparkSession, tables: Tables) -> DataFrame:
    """Articles of the ranked stories with the characters that each story's budget grants them."""
    items = tables("preprocess").withColumn("story", F.xxhash64(F.coalesce(t.normalize_title("title"), F.lit(""))))
    top = tables("rank").where("tier <> 'brief'").select("story", "rank", "tier")
    d = items.join(top, "story").select("rank", "tier", "id", "outlet", F.coalesce(F.length("body_text"), F.lit(0)).cast("bigint").alias("chars"))
    d = ranking.diverse_first(d, ["rank"], F.col("outlet"), [F.col("id")], 12)
    return ranking.water_fill(d, ["rank"], [F.col("place")], F.col("chars"), total=12_000, floor=300, per_item=4000)


STAGES = [Stage("collect", collect), Stage("preprocess", preprocess), Stage("group", group), Stage("rank", rank), Stage("packets", packets)]


def plan(first: str | None = None, last: str | None = None) -> list[str]:
    """The names of the stages from ``first`` to ``last``."""
    names = [s.name for s in STAGES]
    for n in (first, last):
        if n is not None and n not in names:
            raise ValueError(f"no stage {n!r}; stages are {', '.join(names)}")
    return names[names.index(first) if first else 0 : (names.index(last) if last else len(names) - 1) + 1]


def run(spark: SparkSession, sf_dir: str, out_dir: str, *, first: str | None = None, last: str | None = None, dry_run: bool = False, verdicts: DataFrame | None = None) -> dict[str, str]:
    """Runs the stages and gives the verdict of each one's gate; a stage that fails stops the run. Results lie in ``out_dir`` by stage; earlier stages than ``first`` are read from there."""
    chosen = plan(first, last)
    if dry_run:
        return dict.fromkeys(chosen, "planned")
    built = {s.name for s in STAGES}

    def tables(name: str) -> DataFrame | None:
        if name == "verdicts":
            return verdicts
        return spark.read.parquet(f"{out_dir}/{name}") if name in built else table(spark, sf_dir, name)

    out = {}
    for s in STAGES:
        if s.name in chosen:
            s.build(spark, tables).write.mode("overwrite").parquet(f"{out_dir}/{s.name}")
            n = tables(s.name).agg(F.count(F.lit(1)).alias("n"))
            got = evaluate(n, list(s.metrics)).first()
            out[s.name] = got.verdict
            if got.verdict == "fail":
                raise RuntimeError(f"stage {s.name}: {got.reasons}")
    return out


def inspect(spark: SparkSession, out_dir: str, stage: str) -> DataFrame:
    """The result of a stage."""
    plan(stage, stage)
    return spark.read.parquet(f"{out_dir}/{stage}")
