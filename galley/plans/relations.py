"""Queries of ranking, history, joins and aggregates over the whole domain tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import urls as u
from ..operators import history as h
from ..operators import ranking as r
from ..runtime import table

#: sources is a dimension that does not grow with the items; the planner chooses how it is joined.


def _sources(spark, sf):
    return table(spark, sf, "sources").select("source_name", "parent_source", "source_group", "track")


def _items(spark, sf):
    d = table(spark, sf, "preprocessed_items").select("id", "source_name", "title", "body_text", "canonical_url", "original_url", "fetched_at", "published_at")
    return d.join(_sources(spark, sf), "source_name", "left")


def _stories(spark, sf):
    """One row a story: a small synthetic grouping of the items, score and number of outlets."""
    d = _items(spark, sf).withColumn("cluster_index", (F.col("id") * F.col("id") % 397).cast("int"))
    g = d.groupBy("cluster_index").agg(F.max(F.coalesce(F.length("body_text"), F.lit(0)) % 51).alias("score"), r.outlets(F.col("source_name"), F.col("parent_source")).alias("source_count"))
    return g.select("cluster_index", "score", "source_count", F.round(r.combined_score(F.col("score"), F.col("source_count")), 6).alias("combined"), F.concat(F.lit("C"), F.col("cluster_index")).alias("ref"))


def _cap():
    return F.when(F.col("cluster_index") % 7 == 0, 2).when(F.col("cluster_index") % 7 == 3, 1).otherwise(0)


def prominence_rank(spark, sf):
    """Stories ranked by score and the logarithm of their outlets, with capped tiers."""
    order = [F.col("combined").desc(), F.col("ref")]
    d = r.ranked(_stories(spark, sf), order)
    return r.assign_tiers(d, [F.col("rank")], _cap(), (15, 20)).select("rank", "ref", "cluster_index", "score", "source_count", "combined", "tier")


def parent_dedup(spark, sf):
    d = _items(spark, sf).select("id", F.col("canonical_url").alias("url"), t.normalize_title("title").alias("title_key"), F.col("fetched_at").alias("ord"), F.coalesce("parent_source", "source_name").alias("parent"))
    return h.absorb_within(d, "parent")


def cross_run_dedup(spark, sf):
    d = _items(spark, sf).select("id", "source_name", F.coalesce("parent_source", "source_name").alias("parent"), "canonical_url", t.normalize_title("title").alias("title_key"))
    today, before = d.where("id % 4 = 0"), d.where("id % 4 <> 0")
    return h.unknown_to(today, before, "id", "source_name", "parent", "canonical_url", "title_key").select("id", "source_name")


def exact_dup_first(spark, sf):
    d = table(spark, sf, "raw_items").select("id", "source_name", "item_guid", "collector_run_id")
    return r.first_of(d, [F.col("source_name"), F.col("item_guid")], [F.col("collector_run_id"), F.col("id")]).select("id", "source_name", "item_guid")


def snapshot_latest(spark, sf):
    """The last event of every user, and of every user and type."""
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"))
    return h.latest(e, ["user_id", "event_type"], [F.col("ts_us").desc(), F.col("event_id").desc()])


def as_of_latest(spark, sf):
    """Each purchase with the value of the user's last view at or before it."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "value")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "at")
    right = e.where("event_type = 'view'").groupBy("user_id", "at").agg(F.max("value").alias("last_value"))
    return h.as_of(left, right.withColumnRenamed("at", "seen_at"), "user_id", "at", "seen_at", ["last_value"])


def host_cooldown(spark, sf):
    a = table(spark, sf, "article_texts").where("status <> 'skipped'")
    return a.groupBy("host").agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("status") == "ok").alias("n_ok")).where("attempts >= 3 and n_ok * 4 < attempts * 3")


def newly_cooled(spark, sf):
    """Failures of a host, by answer, in the later attempts that it had not had in the earlier ones."""
    a = table(spark, sf, "article_texts").where("status in ('blocked', 'error')").select("host", F.coalesce("http_status", F.lit(0)).alias("answer"), "id")
    return a.where("id % 2 = 1").select("host", "answer").distinct().join(a.where("id % 2 = 0"), ["host", "answer"], "left_anti")


def fetch_plan(spark, sf):
    """The first attempt of every address, with the reason to skip it or null."""
    items = table(spark, sf, "preprocessed_items").select("id", "canonical_url", F.coalesce(F.length("body_text"), F.lit(0)).alias("chars"), F.coalesce(t.ends_mid_sentence("body_text"), F.lit(False)).alias("open"))
    first = r.first_of(items.where("canonical_url is not null"), [F.col("canonical_url")], [F.col("id")])
    a = table(spark, sf, "article_texts")
    tried = a.where("status <> 'skipped'").select(F.col("canonical_url")).distinct().withColumn("tried", F.lit(True))
    cool = host_cooldown(spark, sf).select("host").withColumn("cool", F.lit(True))
    d = first.join(tried, "canonical_url", "left").withColumn("host", u.host_of("canonical_url")).join(cool, "host", "left")
    why = F.when((F.col("chars") >= 800) & ~F.col("open"), "long enough").when(F.col("tried"), "recent").when(F.col("cool"), "cooldown")
    return d.select("id", "canonical_url", "host", why.alias("skip_reason"))


def fetch_targets(spark, sf):
    """One target an address with its items, and hosts by their number of targets."""
    d = fetch_plan(spark, sf).where("skip_reason is null")
    n = d.groupBy("host").agg(F.count(F.lit(1)).alias("n_targets"))
    return n.select("host", "n_targets", F.row_number().over(Window.orderBy(F.col("n_targets").desc(), "host")).alias("place"))


def conditional_upsert(spark, sf):
    """Attempts merged by address: a skipped one replaces only a skipped one."""
    a = table(spark, sf, "article_texts").select("canonical_url", "status", "id")
    first = r.first_of(a.where("id % 2 = 0"), [F.col("canonical_url")], [F.col("id")])
    second = r.first_of(a.where("id % 2 = 1"), [F.col("canonical_url")], [F.col("id")])
    return h.upsert(first, second, ["canonical_url"], (F.col("new.status") == "skipped") & (F.col("old.status") != "skipped"))


def plain_upsert(spark, sf):
    a = table(spark, sf, "article_texts").select("canonical_url", "status", "id")
    return h.upsert(r.first_of(a.where("id % 2 = 0"), [F.col("canonical_url")], [F.col("id")]), r.first_of(a.where("id % 2 = 1"), [F.col("canonical_url")], [F.col("id")]), ["canonical_url"])


def insert_ignore(spark, sf):
    a = table(spark, sf, "raw_items").select("source_name", "item_guid", "id", "collector_run_id")
    old = r.first_of(a.where("collector_run_id <= 90"), [F.col("source_name"), F.col("item_guid")], [F.col("id")])
    return h.insert_ignore(old, a.where("collector_run_id > 90"), ["source_name", "item_guid"], [F.col("id")]).select("id", "source_name", "item_guid")


def breaker_trip(spark, sf):
    """For each source in order, runs of failed translations and whether five in a row had occurred."""
    d = table(spark, sf, "preprocessed_items").select("id", "source_name", F.coalesce("translation_failed", F.lit(False)).alias("failed"))
    return h.failure_runs(d, ["source_name"], [F.col("id")], F.col("failed"), 2).select("id", "source_name", "run", "tripped")


def sittings(spark, sf):
    s = h.sittings(table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", "6 hours")
    return s.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n_events")


def stage_order(spark, sf):
    """Collector runs that start before one with a smaller number did."""
    c = table(spark, sf, "collector_runs").select("run_id", F.unix_micros("started_at").alias("started"))
    before = Window.orderBy("run_id").rowsBetween(Window.unboundedPreceding, -1)
    return c.withColumn("latest", F.max("started").over(before)).select("run_id", F.coalesce(F.col("started") < F.col("latest"), F.lit(False)).alias("early"))


def budget_waterfill(spark, sf):
    d = table(spark, sf, "packet_articles").select("packet_id", "article_id", F.coalesce("chars", F.lit(0)).cast("bigint").alias("chars"))
    return r.water_fill(d, ["packet_id"], [F.col("article_id")], F.col("chars"), total=6000, floor=300, per_item=1500).select("packet_id", "article_id", "chars", F.col("granted").cast("bigint").alias("granted"))


def diverse_sources(spark, sf):
    d = table(spark, sf, "packet_articles").select("packet_id", "article_id", F.coalesce("parent_source", "source_name").alias("outlet"))
    return r.diverse_first(d, ["packet_id"], F.col("outlet"), [F.col("article_id")], 3).select("packet_id", "article_id", "outlet", "place")


def paragraph_dedup(spark, sf):
    """Of each packet's paragraphs the first of every text, in order of article and place."""
    d = table(spark, sf, "packet_articles").where("text is not null").select("packet_id", "article_id", F.posexplode(F.split("text", "\n\n+")).alias("pos", "paragraph"))
    d = d.withColumn("key", t.normalize_title("paragraph")).where("key <> ''")
    return r.first_of(d, [F.col("packet_id"), F.xxhash64("key")], [F.col("article_id"), F.col("pos")]).select("packet_id", "article_id", "pos")


def tier_caps(spark, sf):
    """Tiers within each source, in order of fetching."""
    d = table(spark, sf, "preprocessed_items").select("id", "source_name", (F.col("id") % 97).cast("int").alias("cluster_index"))
    return r.assign_tiers(d, [F.col("id")], _cap(), (3, 4), partition=["source_name"]).select("id", "source_name", "tier")


def cap_of_group(spark, sf):
    d = table(spark, sf, "preprocessed_items").select((F.col("id") % 211).cast("int").alias("g"), F.when(F.col("id") % 13 != 0, (F.col("id") % 3).cast("int")).alias("cap"))
    return d.groupBy("g").agg(r.most_permissive(F.col("cap")).alias("cap"))


def tie_groups(spark, sf):
    s = _stories(spark, sf)
    return s.groupBy("score", "source_count").agg(F.count(F.lit(1)).alias("n"), F.min("ref").alias("first_ref")).where("n >= 2")


def rank_changes(spark, sf):
    """How ranks of sources move between two halves of the items."""
    d = table(spark, sf, "preprocessed_items").select("id", "source_name")
    place = lambda x: x.groupBy("source_name").agg(F.count(F.lit(1)).alias("n")).select("source_name", "n", F.row_number().over(Window.orderBy(F.col("n").desc(), "source_name")).alias("place"))
    return h.changes(place(d.where("id % 2 = 0")), place(d.where("id % 2 = 1")), "source_name", ["n", "place"])


def published_articles(spark, sf):
    a = table(spark, sf, "packet_articles").select("preprocessed_item_id", "article_id", "packet_id")
    return r.first_of(a, [F.col("preprocessed_item_id")], [F.col("packet_id").desc(), F.col("article_id").desc()])


def packet_index(spark, sf):
    """Packets with their number of articles, first source and place by the first article."""
    a = table(spark, sf, "packet_articles")
    g = a.groupBy("packet_id").agg(F.count(F.lit(1)).alias("n_articles"), F.min("article_id").alias("first_article"), F.min_by("source_name", "article_id").alias("first_source"))
    return r.ranked(g, [F.col("first_article")], "place")


def packet_sources(spark, sf):
    """Sources of a packet once for each address, with their place."""
    a = table(spark, sf, "packet_articles").select("packet_id", "url", "article_id")
    one = r.first_of(a, [F.col("packet_id"), F.col("url")], [F.col("article_id")])
    return one.withColumn("position", F.row_number().over(Window.partitionBy("packet_id").orderBy("article_id"))).select("packet_id", "article_id", "position")


def every_nth(spark, sf):
    d = table(spark, sf, "preprocessed_items").select("id", "source_name")
    return r.every_nth(d, ["source_name"], [F.col("id")], 5, 10)


def recency_backstop(spark, sf):
    """Items fetched in the last day of the table, and those of them published long before, which drop out; a null date stays."""
    d = table(spark, sf, "preprocessed_items").select("id", "fetched_at", "published_at")
    now = d.agg(F.max("fetched_at").alias("now"))
    x = d.join(F.broadcast(now)).where(F.col("fetched_at") >= F.col("now") - F.expr("interval 720 hours"))
    return x.select("id", F.coalesce(F.col("published_at") < F.col("now") - F.expr("interval 30 days"), F.lit(False)).alias("dropped"))


QUERIES = {f.__name__: f for f in (
    prominence_rank, parent_dedup, cross_run_dedup, exact_dup_first, snapshot_latest, as_of_latest, host_cooldown, newly_cooled, fetch_plan, fetch_targets, conditional_upsert, plain_upsert, insert_ignore, breaker_trip,
    sittings, stage_order, budget_waterfill, diverse_sources, paragraph_dedup, tier_caps, cap_of_group, tie_groups, rank_changes, published_articles, packet_index, packet_sources, every_nth, recency_backstop,
)}

_T = r"trim(regexp_replace(lower({}), '[\s\x{{00a0}}]+', ' ', 'g'))"
_HOST = r"regexp_replace(lower(regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '')"
_STORIES = """with stories as (select (id * id % 397)::int as cluster_index, max(coalesce(length(body_text), 0) % 51)::int as score, greatest(1, count(distinct coalesce(parent_source, source_name)))::int as source_count
  from preprocessed_items left join (select source_name, parent_source from sources) using (source_name) group by 1), s as (select *, round(score + 9 * ln(source_count), 6) as combined, 'C' || cluster_index as ref from stories)"""
_MID = r"""case when regexp_matches(rtrim(regexp_replace(body_text, '[\s\x{00a0}]+$', '')), '(\.\.\.|…)[)\]"''”’»›]*$') then true when regexp_replace(body_text, '([)\]"''”’»›]|[\s\x{00a0}])+$', '') = '' then false else not regexp_matches(regexp_replace(body_text, '([)\]"''”’»›]|[\s\x{00a0}])+$', ''), '[.!?。！？؟।]$') end"""
_COOL = "select host, count(*) as attempts, count(*) filter (where status = 'ok') as n_ok from article_texts where status <> 'skipped' group by host having count(*) >= 3 and count(*) filter (where status = 'ok') * 4 < count(*) * 3"
_PLAN = f"""with first as (select id, canonical_url, coalesce(length(body_text), 0) as chars, coalesce({_MID}, false) as open from preprocessed_items where canonical_url is not null qualify row_number() over (partition by canonical_url order by id) = 1),
  tried as (select distinct canonical_url from article_texts where status <> 'skipped'), cool as ({_COOL}),
  plan as (select id, first.canonical_url, {_HOST.format('first.canonical_url')} as host, case when chars >= 800 and not open then 'long enough' when tried.canonical_url is not null then 'recent' when cool.host is not null then 'cooldown' end as skip_reason
  from first left join tried on tried.canonical_url = first.canonical_url left join cool on cool.host = {_HOST.format('first.canonical_url')})"""
_TIERS = """select *, f, not f and cap <= 1 and sum((not f and cap <= 1)::int) over ({w} rows unbounded preceding) <= {b} as st from (select *, cap = 0 and sum((cap = 0)::int) over ({w} rows unbounded preceding) <= {a} as f from ({src}))"""

SQL = {
    "prominence_rank": _STORIES + ", k as (select *, row_number() over (order by combined desc, ref)::int as rank, case when cluster_index % 7 = 0 then 2 when cluster_index % 7 = 3 then 1 else 0 end as cap from s) select rank, ref, cluster_index, score, source_count, combined, case when f then 'feature' when st then 'standard' else 'brief' end as tier from ("
    + _TIERS.format(w="order by rank", a=15, b=20, src="select * from k") + ")",
    "cross_run_dedup": f"with d as (select id, source_name, coalesce(parent_source, source_name) as parent, canonical_url as url, {_T.format('title')} as t from preprocessed_items left join (select source_name, parent_source from sources) using (source_name)), o as (select * from d where id % 4 <> 0) select id, source_name from d where id % 4 = 0 and not exists (select 1 from o where o.url = d.url and o.source_name is not distinct from d.source_name) and not exists (select 1 from o where o.url = d.url and o.parent = d.parent) and not exists (select 1 from o where o.t = d.t and length(d.t) >= 30)",
    "exact_dup_first": "select id, source_name, item_guid from raw_items qualify row_number() over (partition by source_name, item_guid order by collector_run_id, id) = 1",
    "snapshot_latest": "select user_id, event_type, event_id, epoch_us(ts)::bigint as ts_us from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1",
    "as_of_latest": "with v as (select user_id, epoch_us(ts)::bigint as seen, max(value) as last_value from events where event_type = 'view' group by all), p as (select event_id, user_id, epoch_us(ts)::bigint as moment from events where event_type = 'purchase') select event_id, p.user_id, p.moment as \"at\", last_value from p asof left join v on p.user_id = v.user_id and p.moment >= v.seen",
    "host_cooldown": _COOL,
    "newly_cooled": "select distinct host, coalesce(http_status, 0)::int as answer from article_texts where id % 2 = 1 and status in ('blocked', 'error') except select host, coalesce(http_status, 0)::int from article_texts where id % 2 = 0 and status in ('blocked', 'error')",
    "fetch_plan": _PLAN + " select * from plan",
    "fetch_targets": _PLAN + " select host, count(*) as n_targets, row_number() over (order by count(*) desc, host)::int as place from plan where skip_reason is null group by host",
    "conditional_upsert": "with a as (select canonical_url, status, id from article_texts where id % 2 = 0 qualify row_number() over (partition by canonical_url order by id) = 1), b as (select canonical_url, status, id from article_texts where id % 2 = 1 qualify row_number() over (partition by canonical_url order by id) = 1) select coalesce(a.canonical_url, b.canonical_url) as canonical_url, case when b.id is null or (a.id is not null and b.status = 'skipped' and a.status <> 'skipped') then a.status else b.status end as status, case when b.id is null or (a.id is not null and b.status = 'skipped' and a.status <> 'skipped') then a.id else b.id end as id from a full join b on a.canonical_url = b.canonical_url",
    "plain_upsert": "with a as (select canonical_url, status, id from article_texts where id % 2 = 0 qualify row_number() over (partition by canonical_url order by id) = 1), b as (select canonical_url, status, id from article_texts where id % 2 = 1 qualify row_number() over (partition by canonical_url order by id) = 1) select * from b union all select * from a where canonical_url not in (select canonical_url from b)",
    "insert_ignore": "with o as (select id, source_name, item_guid from raw_items where collector_run_id <= 90 qualify row_number() over (partition by source_name, item_guid order by id) = 1), n as (select id, source_name, item_guid from raw_items where collector_run_id > 90 qualify row_number() over (partition by source_name, item_guid order by id) = 1) select * from o union all select * from n where not exists (select 1 from o where o.source_name = n.source_name and o.item_guid = n.item_guid)",
    "breaker_trip": "with d as (select id, source_name, coalesce(translation_failed, false) as f, sum((not coalesce(translation_failed, false))::int) over (partition by source_name order by id) as isl from preprocessed_items), e as (select *, sum(f::int) over (partition by source_name, isl order by id)::int as run from d) select id, source_name, run, max(run) over (partition by source_name order by id) >= 2 as tripped from e",
    "sittings": "with e as (select user_id, epoch_us(ts)::bigint as t, lag(epoch_us(ts)::bigint) over (partition by user_id order by ts) as b from events), g as (select *, sum((b is null or t - b >= 21600000000)::int) over (partition by user_id order by t) as s from e) select user_id, min(t) as start_us, max(t) as end_us, count(*) as n_events from g group by user_id, s",
    "stage_order": "select run_id, coalesce(epoch_us(started_at) < max(epoch_us(started_at)) over (order by run_id rows between unbounded preceding and 1 preceding), false) as early from collector_runs",
    "budget_waterfill": """with d as (select packet_id, article_id, coalesce(chars, 0)::bigint as chars from packet_articles), a as (select *, least(chars, 300) as a0 from d), b as (select *, greatest(0, 6000 - sum(a0) over (partition by packet_id)) as r, greatest(0, least(chars, 1500) - a0) as w1 from a),
      c as (select *, greatest(0, least(w1, r - coalesce(sum(w1) over (partition by packet_id order by article_id rows between unbounded preceding and 1 preceding), 0))) as e1, greatest(0, r - sum(w1) over (partition by packet_id)) as r2 from b), e as (select *, chars - a0 - e1 as w2 from c)
      select packet_id, article_id, chars, (a0 + e1 + greatest(0, least(w2, r2 - coalesce(sum(w2) over (partition by packet_id order by article_id rows between unbounded preceding and 1 preceding), 0))))::bigint as granted from e""",
    "diverse_sources": "with d as (select packet_id, article_id, coalesce(parent_source, source_name) as outlet from packet_articles), e as (select *, row_number() over (partition by packet_id, outlet order by article_id) > 1 as again from d) select packet_id, article_id, outlet, row_number() over (partition by packet_id order by again, article_id)::int as place from e qualify place <= 3",
    "paragraph_dedup": f"with d as (select packet_id, article_id, unnest(range(len(regexp_split_to_array(text, '\\n\\n+'))))::int as pos, unnest(regexp_split_to_array(text, '\\n\\n+')) as p from packet_articles where text is not null), k as (select *, {_T.format('p')} as key from d) select packet_id, article_id, pos from k where key <> '' qualify row_number() over (partition by packet_id, key order by article_id, pos) = 1",
    "tier_caps": "select id, source_name, case when f then 'feature' when st then 'standard' else 'brief' end as tier from (" + _TIERS.format(w="partition by source_name order by id", a=3, b=4, src="select id, source_name, case when id % 97 % 7 = 0 then 2 when id % 97 % 7 = 3 then 1 else 0 end as cap from preprocessed_items") + ")",
    "cap_of_group": "select (id % 211)::int as g, (case when count(*) = count(case when id % 13 <> 0 then 1 end) then min(id % 3) end)::int as cap from preprocessed_items group by 1",
    "tie_groups": _STORIES + " select score, source_count, count(*) as n, min(ref) as first_ref from s group by 1, 2 having count(*) >= 2",
    "rank_changes": "with a as (select source_name, count(*) as n, row_number() over (order by count(*) desc, source_name)::int as place from preprocessed_items where id % 2 = 0 group by 1), b as (select source_name, count(*) as n, row_number() over (order by count(*) desc, source_name)::int as place from preprocessed_items where id % 2 = 1 group by 1) select coalesce(a.source_name, b.source_name) as source_name, case when a.n is null then 'only_after' when b.n is null then 'only_before' else 'both' end as side, a.n as n_before, b.n as n_after, a.place as place_before, b.place as place_after from a full join b on a.source_name = b.source_name",
    "published_articles": "select preprocessed_item_id, article_id, packet_id from packet_articles qualify row_number() over (partition by preprocessed_item_id order by packet_id desc, article_id desc) = 1",
    "packet_index": "select packet_id, count(*) as n_articles, min(article_id) as first_article, arg_min(source_name, article_id) as first_source, row_number() over (order by min(article_id))::int as place from packet_articles group by packet_id",
    "packet_sources": "with o as (select packet_id, url, article_id from packet_articles qualify row_number() over (partition by packet_id, url order by article_id) = 1) select packet_id, article_id, row_number() over (partition by packet_id order by article_id)::int as position from o",
    "every_nth": "select id, source_name from preprocessed_items qualify (row_number() over (partition by source_name order by id) - 1) % 5 = 0 and row_number() over (partition by source_name order by id) <= 50",
    "recency_backstop": "with n as (select max(fetched_at) as now from preprocessed_items) select id, coalesce(published_at < now - interval 30 days, false) as dropped from preprocessed_items, n where fetched_at >= now - interval 720 hours",
}
