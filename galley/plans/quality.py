"""Queries of data-quality gates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.gates import Check, evaluate, fraction, merged
from ..runtime import table

COLLECT = [
    Check("few", "fail", "n < 5", "concat(n, ' items')"),
    Check("repeated", "warn", "repeated > 0.1", "concat(round(100 * repeated), ' % repeated')"),
    Check("empty", "warn", "empty > 0.15", "concat(round(100 * empty), ' % without a text')"),
]
FETCH = [Check("blocked", "warn", "blocked > 0.05", "concat(round(100 * blocked), ' % blocked')"), Check("none", "fail", "ok = 0", "'nothing fetched'")]


def _collect(spark, sf):
    d = table(spark, sf, "raw_items")
    g = d.groupBy("source_name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item_guid").alias("guids"), F.count_if(F.coalesce("body", F.lit("")) == "").alias("n_empty"))
    return g.select("source_name", "n", (1 - fraction(F.col("guids"), F.col("n"))).alias("repeated"), fraction(F.col("n_empty"), F.col("n")).alias("empty"))


def gate_collect(spark, sf):
    """Each source's raw items against limits of number, repetition and empty texts."""
    return evaluate(_collect(spark, sf), COLLECT).select("source_name", "n", "verdict", "reasons")


def gate_all(spark, sf):
    """The gates of collecting and fetching of each source as one."""
    items = table(spark, sf, "preprocessed_items").select(F.col("id").alias("preprocessed_item_id"), "source_name")
    a = table(spark, sf, "article_texts").join(items, "preprocessed_item_id").groupBy("source_name").agg(F.count_if(F.col("status") == "blocked").alias("b"), F.count_if(F.col("status") == "ok").alias("ok"), F.count(F.lit(1)).alias("n"))
    fetch = evaluate(a.select("source_name", fraction(F.col("b"), F.col("n")).alias("blocked"), "ok"), FETCH)
    both = gate_collect(spark, sf).select("source_name", F.lit("1 collect").alias("gate"), "verdict", "reasons").unionByName(fetch.select("source_name", F.lit("2 fetch").alias("gate"), "verdict", "reasons"))
    return merged(both, ["source_name"])


QUERIES = {"gate_collect": gate_collect, "gate_all": gate_all}
_C = """with m as (select source_name, count(*) as n, 1 - count(distinct item_guid) / count(*) as repeated, count(*) filter (where coalesce(body, '') = '') / count(*) as empty from raw_items group by 1),
  c as (select source_name, n, case when n < 5 then 2 when repeated > 0.1 or empty > 0.15 then 1 else 0 end as s, concat_ws('; ', case when n < 5 then 'few: ' || n || ' items' end, case when repeated > 0.1 then 'repeated: ' || round(100 * repeated) || ' % repeated' end, case when empty > 0.15 then 'empty: ' || round(100 * empty) || ' % without a text' end) as reasons from m)"""
SQL = {
    "gate_collect": _C + " select source_name, n, ['ok', 'warn', 'fail'][s + 1] as verdict, reasons from c",
    "gate_all": _C + """, a as (select source_name, count(*) filter (where status = 'blocked') / count(*) as blocked, count(*) filter (where status = 'ok') as ok from article_texts join (select id, source_name from preprocessed_items) p on p.id = preprocessed_item_id group by 1),
  f as (select source_name, case when ok = 0 then 2 when blocked > 0.05 then 1 else 0 end as s, concat_ws('; ', case when blocked > 0.05 then 'blocked: ' || round(100 * blocked) || ' % blocked' end, case when ok = 0 then 'none: nothing fetched' end) as reasons from a)
  select coalesce(c.source_name, f.source_name) as source_name, ['ok', 'warn', 'fail'][greatest(coalesce(c.s, 0), coalesce(f.s, 0)) + 1] as verdict, concat_ws('; ', nullif(c.reasons, ''), nullif(f.reasons, '')) as reasons from c full join f on c.source_name = f.source_name""",
}
