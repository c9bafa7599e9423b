"""Queries of the functions on texts and addresses, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..functions import urls as u
from ..runtime import table


def _items(spark, sf):
    return table(spark, sf, "preprocessed_items")


def _q(name, build):
    """A projection of one table."""
    return lambda spark, sf: build(table(spark, sf, name))


QUERIES = {
    "normalize_title_keys": _q("preprocessed_items", lambda d: d.select("id", t.normalize_title("title").alias("title_key"))),
    "clean_title": _q("raw_items", lambda d: d.select("id", t.clean_title(F.concat(F.coalesce("title", F.lit("")), F.lit(" - "), F.regexp_extract("feed_url", r"://([^/]+)", 1))).alias("title"))),
    "synth_guid": _q("raw_items", lambda d: d.select("id", t.synthetic_guid("source_name", "original_url", "title").alias("guid"))),
    "english_fallback": _q("preprocessed_items", lambda d: d.select("id", t.or_else("english_title", "title").alias("title"), t.excerpt(t.or_else("english_body", "body_text"), 200).alias("body"))),
    "embed_text": _q("preprocessed_items", lambda d: d.select("id", t.embedding_text("title", "body_text", 500).alias("text"))),
    "refs_of_text": _q("documents", lambda d: d.select("doc_id", t.normalize_ref("text").alias("first_ref"), F.array_join(t.references("text"), ",").alias("refs"))),
    "nul_strip": _q("documents", lambda d: d.select("doc_id", t.count_nul("text").cast("int").alias("n_nul"), F.length(t.without_nul("text")).alias("n_chars"))),
    "word_counts": _q("documents", lambda d: d.where("text is not null").select("doc_id", t.word_count("text").alias("words"), t.reading_minutes(t.word_count("text")).alias("minutes"))),
    "mid_sentence": _q("preprocessed_items", lambda d: d.where("body_text is not null").select("id", t.ends_mid_sentence("body_text").alias("mid"))),
    "headline_echo": _q("preprocessed_items", lambda d: d.where("body_text is not null and title is not null").select("id", t.is_headline_echo("title", "body_text").alias("echo"))),
    "trim_boundary": _q("documents", lambda d: d.where("text is not null").select("doc_id", F.length(t.trim_to_boundary("text", 400)).alias("kept"))),
    "html_to_text": _q("raw_items", lambda d: d.select("id", t.strip_html("body").alias("text"))),
    "vector_parse": _q("embeddings", lambda d: d.select("vec_id", F.round(F.aggregate(t.parse_vector(F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), ","), F.lit("]"))), F.lit(0.0), lambda a, x: a + x), 4).alias("total"))),
    "title_page_match": lambda spark, sf: (
        table(spark, sf, "article_texts")
        .where("title is not null and text is not null")
        .select("id", t.shares_words("title", "text").alias("matches"), F.size(t.long_words("title", 5)).alias("n_words"))
    ),
    "response_class": _q("article_texts", lambda d: d.select("id", t.response_class("http_status", F.when(F.col("detail") == "not html", "application/pdf"), "text_chars").alias("class"))),
    "failure_kinds": _q("article_texts", lambda d: d.where("status in ('blocked', 'error')").select("id", t.failure_kind(F.concat_ws(" ", "detail", "http_status")).alias("kind"), t.is_retryable(F.concat_ws(" ", "detail", "http_status")).alias("retry"))),
    "host_of": _q("raw_items", lambda d: d.select("id", u.host_of("original_url").alias("host"))),
    "canonical_url": _q("raw_items", lambda d: d.select("id", u.canonical_url("original_url").alias("url"))),
    "unwrap_redirect": _q("raw_items", lambda d: d.select("id", u.unwrap_redirect(F.concat(F.lit("https://redir.example/x/*"), "original_url")).alias("url"))),
    "article_urls": _q("raw_items", lambda d: d.select("id", u.looks_like_article("original_url", ["paper11.example"]).alias("article"), u.has_segment("original_url", LIVE_SEGMENT).alias("live"))),
    "excluded_paths": _q("raw_items", lambda d: d.select("id", u.excluded_path("original_url", ["/", "/news/"]).alias("excluded"))),
    "url_shape_hist": _q("raw_items", lambda d: d.groupBy(u.first_segment("original_url").alias("segment")).agg(F.count(F.lit(1)).alias("n"))),
    "junk_filter": _q("preprocessed_items", lambda d: d.select("id", junk_reason("title", "body_text").alias("reason"))),
    "live_blogs": _q("preprocessed_items", lambda d: d.select("id", F.coalesce(F.col("title").rlike(LIVE), F.lit(False)).alias("live"))),
    "lang_filter": _q("documents", lambda d: d.where("lang is not null").select("doc_id", (F.when(F.col("lang") == "en", True).otherwise(False)).alias("english"), F.substring("text", 1, 200).rlike(r"[\x{0400}-\x{04FF}\x{3040}-\x{30FF}\x{4E00}-\x{9FFF}]").alias("other_script"))),
    "contains_newest": _q("preprocessed_items", lambda d: d.where(F.lower("title").contains("harbour")).select("id", "title", F.unix_millis("fetched_at").alias("fetched_ms")).orderBy(F.col("fetched_ms").desc_nulls_last(), "id").limit(20)),
}


#: Patterns of records without news, by reason, in the order in which they are tried, and of live blogs (fixed values).
MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
CALENDAR = r"(?i)\bcalendar\b"
GALLERY = r"(?i)\bphotos?\s+(of|from)\s+the\s+week\b"
LISTING = r"(?i)^(things\s+to\s+do|what('s|\s+to)\s+(do|see))\s+(this|next|in)\b"
HOUSE_AD = r"(?i)\b(member[\s-]supported|sustaining\s+member|donate\s+today)\b"
DATE_ONLY = rf"(?i)^(?:{MONTHS})[a-z]*\.?\s+[0-9]{{1,2}},?\s+[0-9]{{4}}$|^[0-9]{{1,2}}\s+(?:{MONTHS})[a-z]*\.?\s+[0-9]{{4}}$"
DIGEST = r"(?i)\ba curated\b[\w\s-]{0,20}\b(guide|roundup|list|digest)\b|\bcatch up on (today's|this week's|the week's)\b"
LIVE = r"(?i)^\s*(?:live|en direct|direct)\b\s*[:,\-–—]|^\s*live blog\b|\blive updates?\b"
LIVE_SEGMENT = "live|liveblog|live-blog|live-updates?|live-news"


def junk_reason(title, body):
    """The first rule that a record without news matches; null if none does. A missing body is no sign."""
    title, body = F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))
    short = (body != "") & (F.length(body) <= 400)
    rules = [
        ("event-calendar", title.rlike(CALENDAR) & title.rlike("[0-9]")),
        ("photo-gallery", title.rlike(GALLERY)),
        ("events-listing", title.rlike(LISTING)),
        ("house-ad", short & body.rlike(HOUSE_AD)),
        ("link-dump-digest", F.trim(title).rlike(DATE_ONLY) | F.substring(body, 1, 600).rlike(DIGEST)),
    ]
    return F.coalesce(*[F.when(match, reason) for reason, match in rules])


def _sql(pattern):
    return pattern.replace("'", "''")


_TITLE = r"trim(regexp_replace(lower({}), '[\s\x{{00a0}}]+', ' ', 'g'))"
_TIDY = r"trim(regexp_replace({}, '[\s\x{{00a0}}]+', ' ', 'g'))"
_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
_ISURL = r"regexp_matches({}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+')"
_PART = "regexp_extract({}, '" + _URL + "', {})"
_HOST = f"case when {_ISURL} then regexp_replace(lower(regexp_replace(regexp_replace({_PART.format('{}', 2)}, '^.*@', ''), ':[0-9]*$', '')), '^www\\.', '') else '(unparseable)' end"
_ECHO = r"trim(regexp_replace(regexp_replace(lower(" + _TIDY + r"), '[\s\-–—|]*\b[\w-]+\.(com|org|net|gov|co\.uk|io)\s*$', ''), '\s*[-–—|]\s*[^\-–—|.!?]{{1,30}}\s*$', ''))"
_TRACK = ", ".join(f"'{x}'" for x in u.TRACKING)
_WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: length(w) >= 5))"
_HTML = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '<(script|style|figure|noscript)\b.*?</(script|style|figure|noscript)\s*>', ' ', 'gis'), '<br\s*/?>', chr(10), 'gi'), '</(p|div|h[1-6]|li|tr|blockquote|section|article)\s*>', chr(10) || chr(10), 'gi'), '<[^>]*>', '', 'gs'), '&nbsp;', ' ', 'g')"""
for _e, _s in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&mdash;", "—"), ("&eacute;", "é"), ("&#8220;", "“"), ("&amp;", "&")):
    _HTML = f"replace({_HTML}, '{_e}', '{_s}')"

SQL = {
    "normalize_title_keys": f"select id, {_TITLE.format('title')} as title_key from preprocessed_items",
    "clean_title": r"with x as (select id, trim(coalesce(title, '') || ' - ' || regexp_extract(feed_url, '://([^/]+)', 1)) as t from raw_items), y as (select id, t, trim(regexp_replace(t, '\s+[-–—|]\s+[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)+$', '')) as r from x) select id, case when r <> t and length(r) >= 20 then r else t end as title from y",
    "synth_guid": "select id, 'synth:' || substr(sha256(coalesce(source_name, '') || chr(0) || coalesce(original_url, '') || chr(0) || coalesce(title, '')), 1, 40) as guid from raw_items",
    "english_fallback": "select id, coalesce(nullif(english_title, ''), title) as title, substr(coalesce(nullif(english_body, ''), body_text), 1, 200) as body from preprocessed_items",
    "embed_text": f"with x as (select id, {_TIDY.format('title')} as t, {_TIDY.format('body_text')} as b from preprocessed_items) select id, case when coalesce(t, substr(b, 1, 200)) is not null then concat_ws(chr(10), coalesce(t, substr(b, 1, 200)), substr(b, 1, 500)) end as text from x",
    "refs_of_text": r"with x as (select doc_id, text, list_transform(regexp_extract_all(text, '\b([cstCST][0-9]+)\b', 1), lambda r: upper(r)) as r from documents) select doc_id, case when text is null then null else r[1] end as first_ref, case when text is null then null else array_to_string(list_filter(r, lambda v, i: list_position(r, v) = i), ',') end as refs from x",
    "nul_strip": "select doc_id, (length(text) - length(replace(text, chr(0), '')))::int as n_nul, length(replace(text, chr(0), ''))::int as n_chars from documents",
    "word_counts": r"with x as (select doc_id, len(list_filter(regexp_split_to_array(trim(text), '[\s\x{00a0}]+'), lambda w: w <> ''))::int as words from documents where text is not null) select doc_id, words, case when words >= 100 then greatest(1, round(words / 230)::int) end as minutes from x",
    "mid_sentence": r"""with x as (select id, rtrim(regexp_replace(body_text, '[\s\x{00a0}]+$', '')) as t from preprocessed_items where body_text is not null), y as (select id, t, regexp_replace(t, '([)\]"''”’»›]|[\s\x{00a0}])+$', '') as b from x)
      select id, case when regexp_matches(t, '(\.\.\.|…)[)\]"''”’»›]*$') then true when b = '' then false else not regexp_matches(b, '[.!?。！？؟।]$') end as mid from y""",
    "headline_echo": f"with x as (select id, {_ECHO.format('body_text')} as b, {_ECHO.format('title')} as h from preprocessed_items where body_text is not null and title is not null) select id, case when b = '' then true when h = '' then false else starts_with(b, h) and length(b) - length(h) < 40 end as echo from x",
    "html_to_text": rf"select id, nullif(regexp_replace(regexp_replace(regexp_replace({_HTML}, '[ \t]*\n[ \t]*', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g'), '') as text from raw_items",
    "vector_parse": "select vec_id, round(list_sum(list_transform(embedding, lambda x: x::double)), 4) as total from embeddings",
    "title_page_match": f"with x as (select id, {_WORDS.format('title')} as w, {_WORDS.format('text')} as p from article_texts where title is not null and text is not null) select id, case when len(w) < 3 then true else len(list_intersect(w, p)) / len(w) >= 0.2 end as matches, len(w)::int as n_words from x",
    "response_class": "select id, case when http_status in (401, 403, 429) then 'blocked' when http_status is null or http_status not between 200 and 299 or detail is not distinct from 'not html' then 'error' when coalesce(text_chars, 0) < 1200 then 'thin' else 'ok' end as class from article_texts",
    "failure_kinds": r"with m as (select id, lower(concat_ws(' ', detail, http_status)) as m from article_texts where status in ('blocked', 'error')), k as (select id, case when regexp_matches(m, '\b(401|403)\b|unauthori[sz]ed|forbidden|invalid api key') then 'auth' when regexp_matches(m, '\b429\b|rate.?limit|too many requests|overloaded') then 'rate' when regexp_matches(m, 'max_tokens|budget|length limit') then 'budget' when regexp_matches(m, 'econnreset|econnrefused|socket|network|timed? ?out|\b50[0234]\b') then 'transport' else 'permanent' end as kind from m) select id, kind, kind in ('rate', 'transport') as retry from k",
    "host_of": "select id, " + _HOST.format("original_url", "original_url") + " as host from raw_items",
    "canonical_url": f"""with x as (select id, original_url as o, lower({_PART.format('original_url', 1)}) as s, lower({_PART.format('original_url', 2)}) as h, {_PART.format('original_url', 3)} as p, regexp_replace({_PART.format('original_url', 4)}, '^\\?', '') as q, {_PART.format('original_url', 5)} as f, {_ISURL.format('original_url')} as ok from raw_items
      ), y as (select *, case when s = 'http' then regexp_replace(h, ':80$', '') when s = 'https' then regexp_replace(h, ':443$', '') else h end as h2, regexp_replace(regexp_replace(p, '^/amp/', '/'), '/amp$', '') as p2, array_to_string(list_filter(string_split(q, '&'), lambda v: v <> '' and string_split(v, '=')[1] not in ({_TRACK})), '&') as k from x)
      select id, case when ok then s || '://' || case when h2 like 'amp.%' then case when contains(substr(h2, 5), '.') then 'www.' || substr(h2, 5) else substr(h2, 5) end else h2 end || case when p2 = '' then '/' else p2 end || case when k <> '' then '?' || k else '' end || case when f = '#' then '' else f end else o end as url from y""",
    "unwrap_redirect": "select id, case when original_url is null then null else regexp_replace(original_url, '[?#].*$', '') end as url from raw_items",
    "article_urls": rf"with x as (select id, original_url as o, {_HOST.format('original_url', 'original_url')} as h, {_PART.format('original_url', 3)} as p from raw_items) select id, coalesce(regexp_matches(lower(o), '^https?://[^/?#\s]+') and length(regexp_replace(p, '/+$', '')) > 1 and not regexp_matches(regexp_replace(p, '/+$', ''), '(?i)\.(jpg|jpeg|png|gif|webp|svg|ico|css|js|json|xml|pdf|mp4|mp3|woff2?|ttf)$') and h <> 'paper11.example' and h not like '%.paper11.example', false) as article, coalesce(len(list_filter(string_split(p, '/'), lambda v: regexp_matches(v, '(?i)^(?:live|liveblog|live-blog|live-updates?|live-news)$'))) > 0, false) as live from x",
    "excluded_paths": f"select id, coalesce({_ISURL.format('original_url')} and regexp_replace({_PART.format('original_url', 3)}, '/+$', '') in ('', '/news'), false) as excluded from raw_items",
    "url_shape_hist": f"select coalesce(nullif(string_split({_PART.format('original_url', 3)}, '/')[2], ''), '/') as segment, count(*) as n from raw_items group by 1",
    "junk_filter": f"""with x as (select id, coalesce(title, '') as t, coalesce(body_text, '') as b from preprocessed_items) select id, case when regexp_matches(t, '{CALENDAR}') and regexp_matches(t, '[0-9]') then 'event-calendar'
      when regexp_matches(t, '{GALLERY}') then 'photo-gallery' when regexp_matches(t, '{_sql(LISTING)}') then 'events-listing' when b <> '' and length(b) <= 400 and regexp_matches(b, '{HOUSE_AD}') then 'house-ad'
      when regexp_matches(trim(t), '{DATE_ONLY}') or regexp_matches(substr(b, 1, 600), '{_sql(DIGEST)}') then 'link-dump-digest' end as reason from x""",
    "live_blogs": f"select id, coalesce(regexp_matches(title, '{LIVE}'), false) as live from preprocessed_items",
    "lang_filter": r"select doc_id, lang = 'en' as english, regexp_matches(substr(text, 1, 200), '[\x{0400}-\x{04FF}\x{3040}-\x{30FF}\x{4E00}-\x{9FFF}]') as other_script from documents where lang is not null",
    "contains_newest": "select id, title, (epoch_us(fetched_at) // 1000)::bigint as fetched_ms from preprocessed_items where contains(lower(title), 'harbour') order by fetched_at desc nulls last, id limit 20",
}
