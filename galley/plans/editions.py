"""Queries of editions and stories: lookbacks, sections, budgets, labels, formats, and orders with defined ties."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import ranking as r
from ..runtime import table


def _packets(spark, sf):
    return table(spark, sf, "packet_articles")


def editions_lookback(spark, sf):
    """Articles of the three packets before the last: the list of packets is a top-n, joined as a semi-join."""
    a = _packets(spark, sf)
    last = a.groupBy("packet_id").agg(F.min("article_id").alias("first")).orderBy(F.col("packet_id").desc()).limit(4)
    before = last.orderBy("packet_id").limit(3).select("packet_id")
    return a.join(before, "packet_id", "left_semi").select("packet_id", "article_id")


def grade_policy(spark, sf):
    """Penalties and caps by grade, and scores after them; no grade changes nothing."""
    d = table(spark, sf, "preprocessed_items").select("id", (F.col("id") % 101).cast("int").alias("score"), F.when(F.col("id") % 5 == 0, "minor").when(F.col("id") % 5 == 1, "routine").when(F.col("id") % 5 == 2, "rerun").alias("grade"))
    policy = spark.createDataFrame([("minor", 12, "standard", False), ("routine", 20, "brief", False), ("rerun", 0, None, True)], "grade string, penalty int, max_tier string, withheld boolean")
    j = d.join(F.broadcast(policy), "grade", "left")  # three rows
    return j.select("id", "grade", F.coalesce("withheld", F.lit(False)).alias("withheld"), r.adjusted_score(F.col("score"), F.col("penalty")).cast("int").alias("score"), "max_tier")


def grade_histogram(spark, sf):
    return grade_policy(spark, sf).groupBy(F.coalesce("grade", F.lit("ungraded")).alias("grade")).agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("most"))


def graded_top(spark, sf):
    """The first fifty by the order of grades, then score, then id."""
    order = F.nullif(F.array_position(F.array(*map(F.lit, ["rerun", "routine", "minor"])), F.col("grade")), F.lit(0))
    d = grade_policy(spark, sf).withColumn("place", order.cast("int"))
    return d.orderBy(F.col("place").asc_nulls_last(), F.col("score").desc_nulls_last(), "id").limit(50).select("id", "place", "score")


def thread_rollup(spark, sf):
    """Threads of items: the best score, and the sum of sources over members that are not reduced, at least 1."""
    d = table(spark, sf, "preprocessed_items").select((F.col("id") % 157).cast("int").alias("thread"), (F.col("id") % 89).cast("int").alias("score"), (F.col("id") % 4 + 1).cast("int").alias("sources"), (F.col("id") % 3 == 0).alias("reduced"))
    g = d.groupBy("thread").agg(F.max("score").alias("score"), F.sum(F.when(~F.col("reduced"), F.col("sources")).otherwise(0)).alias("s"), F.count(F.lit(1)).alias("members"))
    return g.select("thread", "score", F.greatest(F.lit(1), F.col("s")).cast("int").alias("sources"), "members")


def pile_topn(spark, sf):
    """Threads and single items in one order, a thread before an item of the same score: the first hundred."""
    t = thread_rollup(spark, sf).select(F.concat(F.lit("T"), "thread").alias("ref"), "score", F.lit(0).alias("is_row"), F.col("thread").cast("bigint").alias("ord"))
    i = table(spark, sf, "preprocessed_items").select(F.concat(F.lit("S"), "id").alias("ref"), (F.col("id") % 89).cast("int").alias("score"), F.lit(1).alias("is_row"), F.col("id").alias("ord"))
    top = t.unionByName(i).orderBy(F.col("score").desc(), "is_row", "ord").limit(100)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.col("score").desc(), "is_row", "ord"))).select("place", "ref", "score")


def paper_budget(spark, sf):
    """Packets held to six pieces: the last of the standalone ones drop out, sections and one standalone piece stay."""
    d = _packets(spark, sf).select("packet_id", "article_id", (F.col("article_id") % 3 == 0).alias("section"))
    w = Window.partitionBy("packet_id")
    d = d.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("alone", F.count_if(~F.col("section")).over(w))
    d = d.withColumn("rn", F.row_number().over(Window.partitionBy("packet_id", "section").orderBy(F.col("article_id").desc())))
    drop = ~F.col("section") & (F.col("rn") <= F.least(F.col("n") - 6, F.col("alone") - 1))
    return d.where(~drop).select("packet_id", "article_id", "section")


def sections(spark, sf):
    """The first article with enough text leads its packet, up to three more stand beside it, the rest are lines."""
    d = _packets(spark, sf).select("packet_id", "article_id", (F.coalesce("chars", F.lit(0)) >= 400).alias("enough"))
    nth = F.sum(F.col("enough").cast("int")).over(Window.partitionBy("packet_id").orderBy("article_id").rowsBetween(Window.unboundedPreceding, 0))
    role = F.when(F.col("enough") & (nth == 1), "lead").when(F.col("enough") & (nth <= 4), "sidebar").otherwise("line")
    return d.select("packet_id", "article_id", role.alias("role"))


def story_articles(spark, sf):
    """An item belongs to the first packet that holds it."""
    return r.first_of(_packets(spark, sf).select("preprocessed_item_id", "packet_id", "article_id"), [F.col("preprocessed_item_id")], [F.col("packet_id"), F.col("article_id")])


def candidate_texts(spark, sf):
    """The three longest bodies of each source, 120 characters each, as one text."""
    d = table(spark, sf, "preprocessed_items").where("body_text is not null").select("source_name", "id", F.length("body_text").alias("n"), F.substring("body_text", 1, 120).alias("part"))
    top = d.withColumn("rn", F.row_number().over(Window.partitionBy("source_name").orderBy(F.col("n").desc(), "id"))).where("rn <= 3")
    g = top.groupBy("source_name").agg(F.sort_array(F.collect_list(F.struct("rn", "part"))).alias("x"))  # three parts
    return g.select("source_name", F.array_join(F.transform("x", lambda v: v["part"]), "\n").alias("text"))


def auto_labels(spark, sf):
    """Groups named after their first title, with their first five titles as a summary."""
    d = table(spark, sf, "preprocessed_items").where("title is not null").select((F.col("id") % 157).cast("int").alias("g"), "id", "title")
    top = d.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("id"))).where("rn <= 5")
    g = top.groupBy("g").agg(F.substring(F.min_by("title", "id"), 1, 80).alias("label"), F.sort_array(F.collect_list(F.struct("rn", "title"))).alias("x"))
    return g.select("g", "label", F.array_join(F.transform("x", lambda v: v["title"]), " | ").alias("summary"))


def item_blocks(spark, sf):
    """Items as lines for a reader: id, source, type, time, and the begin of the title."""
    d = table(spark, sf, "preprocessed_items")
    time = F.coalesce(F.date_format("fetched_at", "HH:mm"), F.lit("--:--"))
    return d.select("id", F.concat(F.lit("["), "id", F.lit("] "), "source_name", F.lit(" | "), F.coalesce("source_type", F.lit("journalism")), F.lit(" | "), time, F.lit(" UTC | "), F.substring(F.coalesce("title", F.lit("")), 1, 50)).alias("block"))


def packet_blocks(spark, sf):
    """Articles of a packet as numbered source blocks."""
    d = _packets(spark, sf).withColumn("n", F.row_number().over(Window.partitionBy("packet_id").orderBy("article_id")))
    head = F.concat(F.lit("--- SOURCE "), "n", F.lit(": "), "source_name", F.when(F.col("truncated"), " [truncated]").otherwise(""))
    return d.select("packet_id", "article_id", F.concat_ws("\n", head, "title", "url", F.nullif(F.substring("text", 1, 100), F.lit(""))).alias("block"))


def chunk_ids(spark, sf):
    """Items in batches of 500 in order of id."""
    d = r.ranked(table(spark, sf, "preprocessed_items").select("id"), [F.col("id")], "n")
    return d.select("id", F.floor((F.col("n") - 1) / 500).cast("int").alias("chunk"))


def edition_days(spark, sf):
    """The reader's day and date line of every packet article."""
    d = _packets(spark, sf).where("published_at is not null").withColumn("local", F.from_utc_timestamp("published_at", "America/New_York"))
    return d.select("article_id", F.date_format("local", "yyyy-MM-dd").alias("day"), F.date_format("local", "EEEE, MMMM d, yyyy").alias("line"), F.date_format("local", "MMM d").alias("marker"))


def material_levels(spark, sf):
    """Packets by the characters they can draw on."""
    d = _packets(spark, sf).groupBy("packet_id").agg(F.coalesce(F.sum("chars"), F.lit(0)).cast("bigint").alias("chars"))
    level = F.when(F.col("chars") < 300, "headline").when(F.col("chars") < 1500, "thin").when(F.col("chars") < 6000, "fair").otherwise("rich")
    return d.select("packet_id", "chars", level.alias("level"), F.least(F.lit(900), F.floor(F.col("chars") / 6)).cast("int").alias("words"))


def closest_flagged(spark, sf):
    """Of each source the two longest articles are flagged, and all are listed newest first."""
    d = _packets(spark, sf).select("source_name", "article_id", F.coalesce("chars", F.lit(0)).alias("chars"), "published_at")
    w = Window.partitionBy("source_name")
    near = F.row_number().over(w.orderBy(F.col("chars").desc(), "article_id")) <= 2
    place = F.row_number().over(w.orderBy(F.col("published_at").desc_nulls_last(), "article_id"))
    return d.select("source_name", "article_id", near.alias("with_body"), place.alias("place"))


def chronological(spark, sf):
    """Articles of a packet by date, those without one last, the id deciding ties."""
    w = Window.partitionBy("packet_id").orderBy(F.col("published_at").asc_nulls_last(), "article_id")
    return _packets(spark, sf).select("packet_id", "article_id", F.row_number().over(w).alias("place"))


def member_keys(spark, sf):
    """Every key of a packet, its own and its members', with the packet it stands for."""
    g = _packets(spark, sf).select("packet_id", "member_ref").distinct()
    own = g.select(F.concat(F.lit("P"), "packet_id").alias("key"), "packet_id")
    return own.union(g.select(F.col("member_ref").alias("key"), "packet_id")).distinct()


def digest_outlets(spark, sf):
    """Distinct outlets of each packet's members, at least 1; members without an item drop out."""
    a = _packets(spark, sf).select("packet_id", F.col("preprocessed_item_id").alias("id"))
    i = table(spark, sf, "preprocessed_items").select("id", "source_name")
    s = table(spark, sf, "sources").select("source_name", "parent_source")
    return a.join(i, "id").join(s, "source_name", "left").groupBy("packet_id").agg(r.outlets(F.col("source_name"), F.col("parent_source")).alias("outlets"))


QUERIES = {f.__name__: f for f in (
    editions_lookback, grade_policy, grade_histogram, graded_top, thread_rollup, pile_topn, paper_budget, sections, story_articles, candidate_texts, auto_labels, item_blocks, packet_blocks, chunk_ids, edition_days, material_levels,
    closest_flagged, chronological, member_keys, digest_outlets,
)}

_GRADE = "with p as (select id, id % 101 as s, case when id % 5 = 0 then 'minor' when id % 5 = 1 then 'routine' when id % 5 = 2 then 'rerun' end as grade from preprocessed_items), g as (select id, grade, coalesce(grade = 'rerun', false) as withheld, greatest(0, s - case grade when 'minor' then 12 when 'routine' then 20 else 0 end)::int as score, case grade when 'minor' then 'standard' when 'routine' then 'brief' end as max_tier from p)"
_THREAD = "with t as (select (id % 157)::int as thread, max(id % 89)::int as score, greatest(1, sum(case when id % 3 <> 0 then id % 4 + 1 else 0 end))::int as sources, count(*) as members from preprocessed_items group by 1)"
SQL = {
    "editions_lookback": "with l as (select distinct packet_id from packet_articles order by packet_id desc limit 3 offset 1) select packet_id, article_id from packet_articles where packet_id in (select packet_id from l)",
    "grade_policy": _GRADE + " select * from g",
    "grade_histogram": _GRADE + " select coalesce(grade, 'ungraded') as grade, count(*) as n, max(score) as most from g group by 1",
    "graded_top": _GRADE + " select id, list_position(['rerun', 'routine', 'minor'], grade)::int as place, score from g order by nullif(list_position(['rerun', 'routine', 'minor'], grade), 0) asc nulls last, score desc nulls last, id limit 50",
    "thread_rollup": _THREAD + " select * from t",
    "pile_topn": _THREAD + ", u as (select 'T' || thread as ref, score, 0 as is_row, thread::bigint as ord from t union all select 'S' || id, (id % 89)::int, 1, id from preprocessed_items) select row_number() over (order by score desc, is_row, ord)::int as place, ref, score from u qualify place <= 100",
    "paper_budget": "with d as (select packet_id, article_id, article_id % 3 = 0 as section, count(*) over (partition by packet_id) as n, count(*) filter (where article_id % 3 <> 0) over (partition by packet_id) as alone, row_number() over (partition by packet_id, article_id % 3 = 0 order by article_id desc) as rn from packet_articles) select packet_id, article_id, section from d where not (not section and rn <= least(n - 6, alone - 1))",
    "sections": "with d as (select packet_id, article_id, coalesce(chars, 0) >= 400 as enough from packet_articles), e as (select *, sum(enough::int) over (partition by packet_id order by article_id) as nth from d) select packet_id, article_id, case when enough and nth = 1 then 'lead' when enough and nth <= 4 then 'sidebar' else 'line' end as role from e",
    "story_articles": "select preprocessed_item_id, packet_id, article_id from packet_articles qualify row_number() over (partition by preprocessed_item_id order by packet_id, article_id) = 1",
    "candidate_texts": "with d as (select source_name, substr(body_text, 1, 120) as part, row_number() over (partition by source_name order by length(body_text) desc, id) as rn from preprocessed_items where body_text is not null) select source_name, string_agg(part, chr(10) order by rn) as text from d where rn <= 3 group by 1",
    "auto_labels": "with d as (select (id % 157)::int as g, title, row_number() over (partition by id % 157 order by id) as rn from preprocessed_items where title is not null) select g, substr(max(case when rn = 1 then title end), 1, 80) as label, string_agg(title, ' | ' order by rn) as summary from d where rn <= 5 group by 1",
    "item_blocks": "select id, '[' || id || '] ' || source_name || ' | ' || coalesce(source_type, 'journalism') || ' | ' || coalesce(strftime(fetched_at at time zone 'UTC', '%H:%M'), '--:--') || ' UTC | ' || substr(coalesce(title, ''), 1, 50) as block from preprocessed_items",
    "packet_blocks": "select packet_id, article_id, concat_ws(chr(10), '--- SOURCE ' || row_number() over (partition by packet_id order by article_id) || ': ' || source_name || case when truncated then ' [truncated]' else '' end, title, url, nullif(substr(text, 1, 100), '')) as block from packet_articles",
    "chunk_ids": "select id, ((row_number() over (order by id) - 1) // 500)::int as chunk from preprocessed_items",
    "edition_days": "select article_id, strftime(published_at at time zone 'America/New_York', '%Y-%m-%d') as day, strftime(published_at at time zone 'America/New_York', '%A, %B %-d, %Y') as line, strftime(published_at at time zone 'America/New_York', '%b %-d') as marker from packet_articles where published_at is not null",
    "material_levels": "with d as (select packet_id, coalesce(sum(chars), 0)::bigint as chars from packet_articles group by 1) select packet_id, chars, case when chars < 300 then 'headline' when chars < 1500 then 'thin' when chars < 6000 then 'fair' else 'rich' end as level, least(900, chars // 6)::int as words from d",
    "closest_flagged": "select source_name, article_id, row_number() over (partition by source_name order by coalesce(chars, 0) desc, article_id) <= 2 as with_body, row_number() over (partition by source_name order by published_at desc nulls last, article_id)::int as place from packet_articles",
    "chronological": "select packet_id, article_id, row_number() over (partition by packet_id order by published_at asc nulls last, article_id)::int as place from packet_articles",
    "member_keys": "select 'P' || packet_id as key, packet_id from packet_articles union select member_ref, packet_id from packet_articles",
    "digest_outlets": "select packet_id, greatest(1, count(distinct coalesce(s.parent_source, i.source_name)))::int as outlets from packet_articles p join (select id, source_name from preprocessed_items) i on i.id = p.preprocessed_item_id left join (select source_name, parent_source from sources) s on s.source_name = i.source_name group by 1",
}
