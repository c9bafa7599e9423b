"""Queries of aggregates, vectors, graphs, set operations and the star schema, over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import urls as u
from ..operators import ranking as r
from ..operators import vectors as v
from ..runtime import table, written


def source_report(spark, sf):
    """Attempts of each host by status, share of usable texts, upper median of their lengths."""
    a = table(spark, sf, "article_texts").withColumn("best", F.greatest(F.coalesce("text_chars", F.lit(0)), F.coalesce("feed_chars", F.lit(0))))
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("ok", "thin", "blocked", "error", "skipped")]
    g = a.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *counts, (F.count_if(F.col("best") >= 800) / F.count(F.lit(1))).alias("usable"))
    return g.join(upper_medians(a, "host", "best"), "host")


def upper_medians(df, key, value):
    """The upper median of each key: the value of rank n div 2 from 0. Ranks, not lists, so that no key is held in memory."""
    d = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(key).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("upto", F.sum("c").over(w)).withColumn("total", F.sum("c").over(Window.partitionBy(key)))
    return d.where(F.col("upto") > F.floor(F.col("total") / 2)).groupBy(key).agg(F.min(value).alias("upper_median"))


def quantile_stats(spark, sf):
    """Lower nearest-rank quantiles of text lengths by language."""
    d = table(spark, sf, "documents").where("lang is not null").groupBy("lang", "n_chars").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("lang").orderBy("n_chars").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy("lang")))
    at = lambda q: F.min(F.when(F.col("upto") > F.floor(F.lit(q) * (F.col("n") - 1)), F.col("n_chars")))
    return d.groupBy("lang").agg(F.max("n").alias("n"), F.round(F.sum(F.col("n_chars") * F.col("c")) / F.max("n"), 6).alias("mean"), at(0.1).alias("p10"), at(0.5).alias("p50"), at(0.9).alias("p90"))


def class_separation(spark, sf):
    """Gap between the lengths of two kinds of documents, midpoint, and whether they are apart."""
    q = table(spark, sf, "documents").where("n_chars is not null").groupBy("doc_kind").agg(F.percentile_approx("n_chars", 0.1, F.lit(1_000_000)).alias("p10"), F.percentile_approx("n_chars", 0.9, F.lit(1_000_000)).alias("p90"))
    a = q.where("doc_kind = 'live_blog'").select(F.col("p10").alias("low"))
    b = q.where("doc_kind = 'feed_item'").select(F.col("p90").alias("high"))
    both = a.withColumn("k", F.lit(1)).join(b.withColumn("k", F.lit(1)), "k")  # one row each
    return both.select((F.col("low") - F.col("high")).alias("gap"), ((F.col("low") + F.col("high")) / 2).alias("midpoint"), (F.col("low") > F.col("high")).alias("usable"))


BUCKETS = [(0, "0"), (1, "1-299"), (300, "300-799"), (800, "800-1999"), (2000, "2000-4999"), (5000, "5000+")]


def length_buckets(spark, sf):
    """Lengths of bodies in six labelled buckets, empty ones included."""
    n = F.coalesce(F.length("body_text"), F.lit(0))
    label = F.lit(BUCKETS[0][1])
    for least, name in BUCKETS[1:]:
        label = F.when(n >= least, name).otherwise(label)
    got = table(spark, sf, "preprocessed_items").groupBy(label.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return spark.createDataFrame([(b,) for _, b in BUCKETS], "bucket string").join(got, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def skip_reasons(spark, sf):
    """Details of attempts with numbers as one sign, counted."""
    a = table(spark, sf, "article_texts").where("detail is not null")
    return a.groupBy(F.regexp_replace(F.lower("detail"), "[0-9]+", "N").alias("reason"), "status").agg(F.count(F.lit(1)).alias("n"))


def null_poison_sum(spark, sf):
    """Sums that are null where any part is."""
    a = table(spark, sf, "packet_articles").withColumn("b", F.when(F.col("article_id") % 17 != 0, F.col("chars")))
    return a.groupBy("source_name").agg(F.when(F.count("b") == F.count(F.lit(1)), F.sum("b")).cast("bigint").alias("total"), F.count("b").alias("known"))


def call_stats(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.max("value").alias("most"), F.count(F.when(F.col("value") > 50, 1)).alias("n_high"), F.count_distinct("user_id").alias("users"))


def run_spans(spark, sf):
    """Seconds that collector runs took, and their items."""
    c = table(spark, sf, "collector_runs").select("run_id", (F.unix_micros("completed_at") - F.unix_micros("started_at")).alias("us"))
    n = table(spark, sf, "raw_items").groupBy(F.col("collector_run_id").alias("run_id")).agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("source_name").alias("n_sources"))
    return c.join(n, "run_id", "left").select("run_id", (F.col("us") / 1e6).alias("seconds"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_sources", F.lit(0)).alias("n_sources"))


def collector_totals(spark, sf):
    d = run_spans(spark, sf)
    return d.agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("n_items") > 0).alias("succeeded"), F.sum("n_items").alias("items"), F.round(F.sum("seconds"), 3).alias("seconds"))


def drop_counters(spark, sf):
    """Why raw items do not go on: repeated, without a text, or kept; one pass."""
    d = table(spark, sf, "raw_items").select("id", "source_name", "item_guid", "body")
    first = d.groupBy("source_name", "item_guid").agg(F.min("id").alias("first"))
    d = d.join(first, ["source_name", "item_guid"])
    why = F.when(F.col("id") != F.col("first"), "duplicate").when(F.col("body").isNull(), "no text").otherwise("kept")
    return d.groupBy(why.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def refs_per_packet(spark, sf):
    a = table(spark, sf, "packet_articles").groupBy("packet_id").agg(F.sort_array(F.collect_set("member_ref")).alias("refs"))
    return a.select("packet_id", F.array_join("refs", ",").alias("refs"), F.size("refs").alias("n"))


def verdict_split(spark, sf):
    """Items by track and kind of label, one row."""
    d = table(spark, sf, "preprocessed_items").join(table(spark, sf, "sources").select("source_name", "track"), "source_name", "left")
    return d.agg(F.count_if(F.col("track") == "news").alias("news"), F.count_if(F.col("track") == "analysis").alias("analysis"), F.count_if(F.col("track").isNull()).alias("untracked"), F.count_if("is_english").alias("english"), F.count(F.lit(1)).alias("n"))


def edition_totals(spark, sf):
    a = table(spark, sf, "packet_articles")
    return a.agg(F.count_distinct("packet_id").alias("packets"), F.count(F.lit(1)).alias("articles"), F.count_distinct("source_name").alias("sources"), F.sum("chars").cast("bigint").alias("chars"), F.count_if("truncated").alias("truncated"), F.count_if(F.col("text").isNull()).alias("without_text"))


def window_total(spark, sf):
    """Each source's share of all items, the total beside every row."""
    d = table(spark, sf, "preprocessed_items").groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))
    return d.select("source_name", "n", F.sum("n").over(Window.partitionBy()).alias("total"))


def materials_report(spark, sf):
    """Articles, distinct addresses, characters and median length of each source, rounded."""
    a = table(spark, sf, "packet_articles")
    return a.groupBy("source_name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("url").alias("urls"), F.coalesce(F.sum("chars"), F.lit(0)).cast("bigint").alias("chars"), F.floor(F.median("chars") + 0.5).cast("bigint").alias("median_chars"))


# --- vectors and graphs ---------------------------------------------------------------------------------------------

THRESHOLD, K = 0.35, 5


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


def similar_pairs(spark, sf):
    """All pairs of vectors with a cosine of at least 0.35."""
    return v.similar_pairs(_vectors(spark, sf), THRESHOLD).select("a", "b", F.round("similarity", 6).alias("similarity"))


def topk_edges(spark, sf):
    return v.nearest_later(_vectors(spark, sf), THRESHOLD, K).select("a", "b", F.round("similarity", 6).alias("similarity"))


def _edges(spark, sf):
    return written(v.nearest_later(_vectors(spark, sf), THRESHOLD, K).select("a", "b"), "edges")


def components(spark, sf):
    """Connected components of the edges, by their least member."""
    return v.components(_edges(spark, sf)).select(F.col("node").alias("vec_id"), "component")


def component_sizes(spark, sf):
    c = v.components(_edges(spark, sf)).groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return c.groupBy("size").agg(F.count(F.lit(1)).alias("n"))


def cohesion(spark, sf):
    e = _edges(spark, sf)
    labels = written(v.components(e), "labels")
    c = v.cohesion(e, labels, K)
    return c.select("component", "size", "n_edges", F.round("density", 6).alias("density"), F.round("cohesion", 6).alias("cohesion"))


def suspect_groups(spark, sf):
    """Components of three and more that hang together loosely."""
    return cohesion(spark, sf).where("size >= 3 and cohesion < 0.9").select("component", "size")


def proto_groups(spark, sf):
    """Groups, at a lower threshold, of the vectors that no edge holds."""
    edges = _edges(spark, sf)
    held = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    single = _vectors(spark, sf).join(held, "id", "left_anti")
    return v.groups_of(v.linked(single, 0.3)).select(F.col("node").alias("vec_id"), "component")


def max_pairwise_topk(spark, sf):
    """The stated queries, every vector whose id is divisible by 20, against all others: the three labels whose best member is nearest."""
    d = _vectors(spark, sf)
    labels = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("piece"))
    pairs = v.similar_pairs(d.where("id % 20 = 0"), 0.25, d).where("a <> b")
    best = v.best_per_group(pairs, d.where("id % 20 = 0").select("id", F.col("id").alias("row")), labels)
    top = v.top_k(best, "row", [F.round("similarity", 6).desc(), F.col("piece")], 3)
    return top.select(F.col("row").alias("vec_id"), F.col("piece").alias("label"), F.round("similarity", 6).alias("similarity"), F.col("rn").alias("place"))


def continuity_links(spark, sf):
    """Of each vector in the later half the most similar one of the earlier half, if near enough."""
    d = _vectors(spark, sf)
    half = F.col("id") % 2 == 1
    pairs = v.similar_pairs(d.where(half), THRESHOLD, d.where(~half))
    return v.top_k(pairs, "a", [F.round("similarity", 6).desc(), F.col("b")], 1).select("a", "b", F.round("similarity", 6).alias("similarity"))


def attach_singletons(spark, sf):
    """Vectors without an edge go to the component of their most similar member; the lower component wins where several tie."""
    edges = _edges(spark, sf)
    labels = written(v.components(edges), "labels")
    single = _vectors(spark, sf).join(labels.select(F.col("node").alias("id")), "id", "left_anti")
    members = _vectors(spark, sf).join(labels.select(F.col("node").alias("id")), "id", "left_semi")
    return v.best_of_labels(single, members, labels, 0.3).select(F.col("a").alias("vec_id"), "component", F.round("similarity", 6).alias("similarity"))


def vector_norms(spark, sf):
    return _vectors(spark, sf).select(F.col("id").alias("vec_id"), F.round(v.norm(F.col("v")), 5).alias("norm"))


# --- sets and the star schema ---------------------------------------------------------------------------------------


def set_ops(spark, sf):
    """Sources by the tables in which they have rows: union, intersection and differences."""
    a = table(spark, sf, "raw_items").select("source_name").distinct()
    b = table(spark, sf, "packet_articles").select("source_name").distinct()
    part = lambda d, k: d.select("source_name", F.lit(k).alias("part"))
    return part(a.union(b).distinct(), "union").unionByName(part(a.intersect(b), "both")).unionByName(part(a.exceptAll(b), "only raw")).unionByName(part(b.exceptAll(a), "only packets"))


def union_all(spark, sf):
    a = table(spark, sf, "raw_items").select("id", F.lit("raw").alias("kind"))
    return a.unionByName(table(spark, sf, "preprocessed_items").select("id", F.lit("preprocessed").alias("kind"))).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))


def replay_diff(spark, sf):
    """Two sets of links compared: how many are in both or in one."""
    a = table(spark, sf, "packet_articles").select("packet_id", "preprocessed_item_id").where("article_id % 3 <> 0").distinct().withColumn("x", F.lit(1))
    b = table(spark, sf, "packet_articles").select("packet_id", "preprocessed_item_id").where("article_id % 3 <> 1").distinct().withColumn("y", F.lit(1))
    side = F.when(F.col("x").isNull(), "second").when(F.col("y").isNull(), "first").otherwise("both")
    return a.join(b, ["packet_id", "preprocessed_item_id"], "full_outer").groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


def semi_anti(spark, sf):
    """Items with and without an attempt to fetch them, by source."""
    d = table(spark, sf, "preprocessed_items").select("id", "source_name")
    a = table(spark, sf, "article_texts").select(F.col("preprocessed_item_id").alias("id"))
    part = lambda how: d.join(a, "id", how).groupBy("source_name").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(how))
    return part("left_semi").unionByName(part("left_anti"))


def rollup_cube_sets(spark, sf):
    d = table(spark, sf, "orders")
    year = F.year("o_orderdate").alias("year")
    one = d.select(year, "o_orderpriority", "o_orderstatus", "o_totalprice").rollup("year", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    two = d.select(year, "o_orderpriority", "o_orderstatus", "o_totalprice").cube("o_orderstatus", "year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return one.select(F.lit("rollup").alias("kind"), "year", F.col("o_orderpriority").alias("other"), "n", "total").unionByName(two.select(F.lit("cube").alias("kind"), "year", F.col("o_orderstatus").alias("other"), "n", "total"))


def star_revenue(spark, sf):
    """Revenue by region and year over the whole star: the small dimensions are joined as the planner sees fit."""
    li, o, c, n, g = (table(spark, sf, x) for x in ("lineitem", "orders", "customer", "nation", "region"))
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(g, n.n_regionkey == g.r_regionkey)
    return j.groupBy(g.r_name, F.year("o_orderdate").alias("year")).agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


def order_frames(spark, sf):
    """Running totals and neighbours of each customer's orders."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return o.select("o_custkey", "o_orderkey", F.round(F.sum("o_totalprice").over(w.rowsBetween(-2, 0)), 2).alias("last_three"), F.lag("o_orderkey").over(w).alias("before"), F.rank().over(Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc())).alias("by_price"))


def url_hosts_report(spark, sf):
    d = table(spark, sf, "preprocessed_items").withColumn("host", u.host_of("original_url"))
    return d.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source_name").alias("sources"), F.count_if(F.col("canonical_url") != F.col("original_url")).alias("changed"))


QUERIES = {f.__name__: f for f in (
    source_report, quantile_stats, class_separation, length_buckets, skip_reasons, null_poison_sum, call_stats, run_spans, collector_totals, drop_counters, refs_per_packet, verdict_split, edition_totals, window_total, materials_report,
    similar_pairs, topk_edges, components, component_sizes, cohesion, suspect_groups, proto_groups, max_pairwise_topk, continuity_links, attach_singletons, vector_norms,
    set_ops, union_all, replay_diff, semi_anti, rollup_cube_sets, star_revenue, order_frames, url_hosts_report,
)}
QUERIES["upper_median"] = lambda spark, sf: upper_medians(table(spark, sf, "preprocessed_items").withColumn("n", F.length("body_text")), "source_name", "n")

_V = "with recursive e0 as (select vec_id as id, list_transform(embedding, lambda x: x::double) as v from embeddings), e1 as (select id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as v from e0)"
_PAIRS = _V + ", pairs as (select x.id as a, y.id as b, list_dot_product(x.v, y.v) as similarity from e1 x join e1 y on x.id < y.id and list_dot_product(x.v, y.v) >= 0.35)"
_EDGES = _PAIRS + ", edges as (select a, b, similarity from pairs qualify row_number() over (partition by a order by similarity desc, b) <= 5)"
_COMP = _EDGES + ", both_ways as (select a, b from edges union select b, a from edges), reach as (select a as node, a as seen from both_ways union select r.node, w.b from reach r join both_ways w on r.seen = w.a), comp as (select node, min(seen) as component from reach group by node)"
_COHESION = _COMP + ", sizes as (select component, count(*) as size from comp group by 1), ce as (select component, count(*) as n_edges from edges join comp on a = node group by 1), coh as (select component, size, n_edges, n_edges / (size * (size - 1) / 2) as density from sizes join ce using (component))"
_LABEL = "case when coalesce(length(body_text), 0) >= 5000 then '5000+' when coalesce(length(body_text), 0) >= 2000 then '2000-4999' when coalesce(length(body_text), 0) >= 800 then '800-1999' when coalesce(length(body_text), 0) >= 300 then '300-799' when coalesce(length(body_text), 0) >= 1 then '1-299' else '0' end"
_HOST = r"case when regexp_matches(original_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+') then regexp_replace(lower(regexp_extract(original_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') else '(unparseable)' end"

SQL = {
    "source_report": "with a as (select *, greatest(coalesce(text_chars, 0), coalesce(feed_chars, 0)) as best from article_texts) select host, count(*) as n, " + ", ".join(f"count(*) filter (where status = '{s}') as n_{s}" for s in ("ok", "thin", "blocked", "error", "skipped")) + ", count(*) filter (where best >= 800) / count(*) as usable, list_sort(list(best))[count(*) // 2 + 1] as upper_median from a group by host",
    "upper_median": "select source_name, list_sort(list(length(body_text)) filter (where body_text is not null))[count(body_text) // 2 + 1]::int as upper_median from preprocessed_items group by 1 having count(body_text) > 0",
    "quantile_stats": "with d as (select lang, list_sort(list(n_chars)) as l, count(*) as n, round(sum(n_chars) / count(*), 6) as mean from documents where lang is not null group by lang) select lang, n, mean, l[floor(0.1 * (n - 1))::int + 1] as p10, l[floor(0.5 * (n - 1))::int + 1] as p50, l[floor(0.9 * (n - 1))::int + 1] as p90 from d",
    "class_separation": "with q as (select doc_kind, list_sort(list(n_chars)) as l, count(*) as n from documents where n_chars is not null group by 1), a as (select l[ceil(0.1 * n)::int] as low from q where doc_kind = 'live_blog'), b as (select l[ceil(0.9 * n)::int] as high from q where doc_kind = 'feed_item') select (low - high)::bigint as gap, (low + high) / 2 as midpoint, low > high as usable from a, b",
    "length_buckets": f"with b(bucket) as (values ('0'), ('1-299'), ('300-799'), ('800-1999'), ('2000-4999'), ('5000+')), g as (select {_LABEL} as bucket, count(*) as n from preprocessed_items group by 1) select b.bucket, coalesce(n, 0)::bigint as n from b left join g using (bucket)",
    "skip_reasons": "select regexp_replace(lower(detail), '[0-9]+', 'N', 'g') as reason, status, count(*) as n from article_texts where detail is not null group by all",
    "null_poison_sum": "select source_name, (case when count(case when article_id % 17 <> 0 then chars end) = count(*) then sum(chars) end)::bigint as total, count(case when article_id % 17 <> 0 then chars end) as known from packet_articles group by 1",
    "call_stats": "select event_type, count(*) as n, round(sum(value), 4) as total, max(value) as most, count(case when value > 50 then 1 end) as n_high, count(distinct user_id) as users from events group by 1",
    "run_spans": "with n as (select collector_run_id as run_id, count(*) as n_items, count(distinct source_name) as n_sources from raw_items group by 1) select c.run_id, (epoch_us(completed_at) - epoch_us(started_at)) / 1e6 as seconds, coalesce(n_items, 0)::bigint as n_items, coalesce(n_sources, 0)::bigint as n_sources from collector_runs c left join n using (run_id)",
    "collector_totals": "with n as (select collector_run_id as run_id, count(*) as n_items from raw_items group by 1) select count(*) as runs, count(*) filter (where n_items > 0) as succeeded, sum(n_items)::bigint as items, round(sum((epoch_us(completed_at) - epoch_us(started_at)) / 1e6), 3) as seconds from collector_runs left join n using (run_id)",
    "drop_counters": "with d as (select *, min(id) over (partition by source_name, item_guid) as f from raw_items) select case when id <> f then 'duplicate' when body is null then 'no text' else 'kept' end as reason, count(*) as n from d group by 1",
    "refs_per_packet": "select packet_id, array_to_string(list_sort(list(distinct member_ref)), ',') as refs, count(distinct member_ref)::int as n from packet_articles group by 1",
    "verdict_split": "select count(*) filter (where track = 'news') as news, count(*) filter (where track = 'analysis') as analysis, count(*) filter (where track is null) as untracked, count(*) filter (where is_english) as english, count(*) as n from preprocessed_items left join (select source_name, track from sources) using (source_name)",
    "edition_totals": "select count(distinct packet_id) as packets, count(*) as articles, count(distinct source_name) as sources, sum(chars)::bigint as chars, count(*) filter (where truncated) as truncated, count(*) filter (where text is null) as without_text from packet_articles",
    "window_total": "select source_name, count(*) as n, (sum(count(*)) over ())::bigint as total from preprocessed_items group by 1",
    "materials_report": "select source_name, count(*) as n, count(distinct url) as urls, coalesce(sum(chars), 0)::bigint as chars, floor(median(chars) + 0.5)::bigint as median_chars from packet_articles group by 1",
    "similar_pairs": _PAIRS + " select a, b, round(similarity, 6) as similarity from pairs",
    "topk_edges": _EDGES + " select a, b, round(similarity, 6) as similarity from edges",
    "components": _COMP + " select node as vec_id, component from comp",
    "component_sizes": _COMP + " select size, count(*) as n from (select component, count(*) as size from comp group by 1) group by 1",
    "cohesion": _COHESION + " select component, size, n_edges, round(density, 6) as density, round(least(1.0, density / least(1.0, 5.0 / (size - 1))), 6) as cohesion from coh",
    "suspect_groups": _COHESION + " select component, size from coh where size >= 3 and round(least(1.0, density / least(1.0, 5.0 / (size - 1))), 6) < 0.9",
    "proto_groups": _EDGES + ", s as (select * from e1 where id not in (select a from edges union select b from edges)), p as (select x.id as a, y.id as b from s x join s y on x.id < y.id and list_dot_product(x.v, y.v) >= 0.3), w as (select a, b from p union select b, a from p), reach as (select a as node, a as seen from w union select r.node, w.b from reach r join w on r.seen = w.a) select node as vec_id, min(seen) as component from reach group by 1",
    "max_pairwise_topk": _V + ", m as (select x.id as vec_id, l.label, max(list_dot_product(x.v, y.v)) as s from e1 x join e1 y on x.id % 20 = 0 and x.id <> y.id join embeddings l on l.vec_id = y.id where list_dot_product(x.v, y.v) >= 0.25 group by 1, 2) select vec_id, label, round(s, 6) as similarity, row_number() over (partition by vec_id order by round(s, 6) desc, label)::int as place from m qualify place <= 3",
    "continuity_links": _V + " select x.id as a, y.id as b, round(list_dot_product(x.v, y.v), 6) as similarity from e1 x join e1 y on x.id % 2 = 1 and y.id % 2 = 0 and list_dot_product(x.v, y.v) >= 0.35 qualify row_number() over (partition by x.id order by round(list_dot_product(x.v, y.v), 6) desc, y.id) = 1",
    "attach_singletons": _COMP + ", b as (select s.id as vec_id, component, max(list_dot_product(s.v, m.v)) as sim from e1 s join e1 m on list_dot_product(s.v, m.v) >= 0.3 join comp on comp.node = m.id where s.id not in (select node from comp) group by 1, 2) select vec_id, component, round(sim, 6) as similarity from b qualify row_number() over (partition by vec_id order by round(sim, 6) desc, component) = 1",
    "vector_norms": "select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 5) as norm from embeddings",
    "set_ops": "with a as (select distinct source_name from raw_items), b as (select distinct source_name from packet_articles) select source_name, 'union' as part from (select * from a union select * from b) union all select source_name, 'both' from (select * from a intersect select * from b) union all select source_name, 'only raw' from (select * from a except select * from b) union all select source_name, 'only packets' from (select * from b except select * from a)",
    "union_all": "select kind, count(*) as n, max(id) as last from (select id, 'raw' as kind from raw_items union all select id, 'preprocessed' from preprocessed_items) group by 1",
    "replay_diff": "with a as (select distinct packet_id, preprocessed_item_id as i, 1 as x from packet_articles where article_id % 3 <> 0), b as (select distinct packet_id, preprocessed_item_id as i, 1 as y from packet_articles where article_id % 3 <> 1) select case when x is null then 'second' when y is null then 'first' else 'both' end as side, count(*) as n from a full join b on a.packet_id = b.packet_id and a.i = b.i group by 1",
    "semi_anti": "select source_name, count(*) as n, 'left_semi' as kind from preprocessed_items where id in (select preprocessed_item_id from article_texts) group by 1 union all select source_name, count(*), 'left_anti' from preprocessed_items where id not in (select preprocessed_item_id from article_texts) group by 1",
    "rollup_cube_sets": "select 'rollup' as kind, year(o_orderdate)::int as year, o_orderpriority as other, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by rollup (year(o_orderdate), o_orderpriority) union all select 'cube', year(o_orderdate)::int, o_orderstatus, count(*), round(sum(o_totalprice), 2) from orders group by cube (o_orderstatus, year(o_orderdate))",
    "star_revenue": "select r_name, year(o_orderdate)::int as year, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2",
    "order_frames": "select o_custkey, o_orderkey, round(sum(o_totalprice) over (partition by o_custkey order by o_orderkey rows between 2 preceding and current row), 2) as last_three, lag(o_orderkey) over (partition by o_custkey order by o_orderkey) as before, rank() over (partition by o_custkey order by o_totalprice desc)::int as by_price from orders",
    "url_hosts_report": f"select {_HOST} as host, count(*) as n, count(distinct source_name) as sources, count(*) filter (where canonical_url <> original_url) as changed from preprocessed_items group by 1",
}
