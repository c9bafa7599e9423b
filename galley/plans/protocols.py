"""Queries of the line protocols, on replies written from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import replies as p
from ..runtime import table


def _replies(spark, sf, line, where="true"):
    """One reply for each source, a line for each of its items in order of id."""
    d = table(spark, sf, "preprocessed_items").where(where).select("source_name", "id", F.expr(line).alias("line"))
    # test input: the replies of a source are one text, as a model would give them
    g = d.groupBy(F.col("source_name").alias("reply")).agg(F.sort_array(F.collect_list(F.struct("id", "line"))).alias("x"))
    return g.select("reply", F.array_join(F.transform("x", lambda v: v["line"]), "\n").alias("raw"))


def _expected(spark, sf):
    return table(spark, sf, "preprocessed_items").select(F.col("source_name").alias("reply"), "id")


def verdict_parse_screen(spark, sf):
    line = "concat(id, ' ;; ', case when id % 5 = 0 then 'CUT' when id % 5 = 1 then 'opinion' when id % 5 = 2 then 'what' else 'news' end, ';;', case when id % 11 = 0 then '' else concat('because; ', id) end)"
    return p.verdicts(_replies(spark, sf, line, "id % 7 <> 0"), _expected(spark, sf))


def verdict_parse_score(spark, sf):
    line = "concat(id, ';;', id % 61 - 5, ' ;; ', id % 47, ';;why')"
    return p.scores(_replies(spark, sf, line, "id % 6 <> 0"), _expected(spark, sf))


def score_second_try(spark, sf):
    line = "concat(id, ';;', id % 61 - 5, ' ;; ', id % 47, ';;why')"
    first = p.scores(_replies(spark, sf, line, "id % 2 = 0"), _expected(spark, sf))
    return p.with_second_try(first, p.scores(_replies(spark, sf, line, "id % 3 = 0"), _expected(spark, sf)))


def digest_parse(spark, sf):
    d = p.digest(_replies(spark, sf, "case when id % 3 = 0 then concat('group ', id, ';;x;;', id, ', ', id + 1) else concat('talk ', id) end"))
    return d.select("reply", "cluster_index", "title", F.array_join(F.transform("members", lambda x: x.cast("string")), ",").alias("members"))


def tiebreak_parse(spark, sf):
    return p.tie_breaks(_replies(spark, sf, "case when id % 4 = 0 then 'none' else concat('- s', id % 9, ' first') end"))


def novelty_parse(spark, sf):
    return p.grades(_replies(spark, sf, "case when id % 3 = 0 then concat(id, ';;**MINOR**;;news') when id % 3 = 1 then concat(id, ';;news;;Rerun') else concat(id, ';;news') end"))


def continuity_parse(spark, sf):
    return p.confirmed(_replies(spark, sf, "concat(id % 10, ';;', case when id % 3 = 0 then 'yes' else 'NO' end, ';;r', id)"))


def describe_parse(spark, sf):
    return p.descriptions(_replies(spark, sf, "case when id % 2 = 0 then concat(id % 40, ';;multi;;title ', id, ';;sum') else concat(id % 40, ';;title ', id, ';;sum') end"))


def translation_parse(spark, sf):
    return p.json_lines(_replies(spark, sf, "case when id % 5 = 0 then '{broken' else to_json(named_struct('id', string(id % 50), 'title', concat('t', id))) end"))


def attach_parse(spark, sf):
    replies = table(spark, sf, "preprocessed_items").select(F.col("id").alias("reply"), F.expr("case when id % 4 = 0 then 'none' else concat(id % 7, ', ', id % 5, ' ', id % 9, 'x') end").alias("raw"))
    return p.attached(replies, replies.select("reply", F.lit(4).alias("n")))


QUERIES = {f.__name__: f for f in (verdict_parse_screen, verdict_parse_score, score_second_try, digest_parse, tiebreak_parse, novelty_parse, continuity_parse, describe_parse, translation_parse, attach_parse)}
_SCORES = "select source_name as reply, id, case when {w} then greatest(0, least(50, id % 61 - 5))::int end as first, case when {w} then greatest(0, least(50, id % 47))::int end as second, case when {w} then (greatest(0, least(50, id % 61 - 5)) + least(50, id % 47))::int else 0 end as score from preprocessed_items"
SQL = {
    "verdict_parse_screen": "select source_name as reply, id, case when id % 7 = 0 or id % 11 = 0 then true else id % 5 <> 0 end as keep, case when id % 7 <> 0 and id % 11 <> 0 and id % 5 = 1 then 'opinion' else 'news' end as kind, case when id % 7 = 0 or id % 11 = 0 then 'no verdict' else 'because; ' || id end as reason, id % 7 = 0 or id % 11 = 0 as missing from preprocessed_items",
    "verdict_parse_score": _SCORES.format(w="id % 6 <> 0"),
    "score_second_try": _SCORES.format(w="(id % 2 = 0 or id % 3 = 0)"),
    "digest_parse": "select source_name as reply, (row_number() over (partition by source_name order by id) - 1)::int as cluster_index, 'group ' || id as title, id || ',' || (id + 1) as members from preprocessed_items where id % 3 = 0",
    "tiebreak_parse": "with d as (select source_name as reply, 'S' || id % 9 as ref, min(id) as f from preprocessed_items where id % 4 <> 0 group by all) select reply, ref, row_number() over (partition by reply order by f)::int as place from d",
    "novelty_parse": "select source_name as reply, id::int as n, case when id % 3 = 0 then 'minor' else 'rerun' end as grade from preprocessed_items where id % 3 <> 2",
    "continuity_parse": "select source_name as reply, (id % 10)::int as n, 'r' || max(id) as reason from preprocessed_items where id % 3 = 0 group by all",
    "describe_parse": "with d as (select source_name as reply, (id % 40)::int as idx, min(id) as f from preprocessed_items group by all) select reply, idx, f % 2 = 0 as multi, 'title ' || f as title, 'sum' as summary from d",
    "translation_parse": "with d as (select source_name as reply, id % 50 as k, min(id) as f from preprocessed_items where id % 5 <> 0 group by all) select reply, k::varchar as id, 't' || f as title, null::varchar as body from d",
    "attach_parse": "select distinct id as reply, m as member from (select id, unnest([id % 7, id % 5, id % 9]) as m from preprocessed_items where id % 4 <> 0) where m between 1 and 4",
}
