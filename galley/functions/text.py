"""Column functions on texts; all stay in the JVM. A null gives null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, the no-break space included.
SPACE = r"[\s\x{00a0}]"
#: Punctuation that ends a sentence, and what may close after it (fixed values).
TERMINAL = r"[.!?。！？؟।]"
CLOSERS = r"[)\]\"'”’»›]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_title(title: Column | str) -> Column:
    """Lower case, runs of white space as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(col(title)), rf"{SPACE}+", " "))


def clean_title(title: Column | str, least: int = 20) -> Column:
    """Without a last segment that is only a domain name, where at least ``least`` characters remain."""
    t = F.trim(col(title))
    rest = F.trim(F.regexp_replace(t, r"\s+[-–—|]\s+[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)+$", ""))
    return F.when((rest != t) & (F.length(rest) >= least), rest).otherwise(t)


def synthetic_guid(source: Column | str, url: Column | str, title: Column | str) -> Column:
    """An identifier of an item without one: the begin of a digest of source, address and title; nulls count as empty."""
    parts = [F.coalesce(col(c), F.lit("")) for c in (source, url, title)]
    return F.concat(F.lit("synth:"), F.substring(F.sha2(F.concat_ws("\0", *parts), 256), 1, 40))


def or_else(first: Column | str, second: Column | str) -> Column:
    """The first text, or the second where it is null or empty."""
    return F.coalesce(F.nullif(col(first), F.lit("")), col(second))


def excerpt(text: Column | str, most: int) -> Column:
    return F.substring(col(text), 1, most) if most > 0 else F.when(col(text).isNotNull(), F.lit(""))


def embedding_text(title: Column | str, body: Column | str, most: int) -> Column:
    """Title, line feed and the begin of the body, white space reduced; the body's begin stands in for a null title; null if both are."""
    tidy = lambda c: F.trim(F.regexp_replace(col(c), rf"{SPACE}+", " "))
    head = F.coalesce(tidy(title), F.substring(tidy(body), 1, 200))
    return F.when(head.isNotNull(), F.concat_ws("\n", head, F.substring(tidy(body), 1, most)))


def normalize_ref(text: Column | str) -> Column:
    """The first reference (a letter C, S or T and digits) in capitals; null if there is none."""
    return F.upper(F.nullif(F.regexp_extract(col(text), r"(?i)\b([cst]\d+)\b", 1), F.lit("")))


def references(text: Column | str) -> Column:
    """All references of a text, each once, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(col(text), F.lit(r"(?i)\b([cst]\d+)\b"), 1), F.upper))


def without_nul(text: Column | str) -> Column:
    return F.replace(col(text), F.lit("\0"), F.lit(""))


def count_nul(text: Column | str) -> Column:
    return F.length(col(text)) - F.length(without_nul(text))


def word_count(text: Column | str) -> Column:
    """Stretches between white space."""
    return F.size(F.filter(F.split(F.trim(col(text)), rf"{SPACE}+"), lambda w: w != ""))


def long_words(text: Column | str, least: int) -> Column:
    """The distinct words of at least ``least`` letters or digits, lower case."""
    return F.array_distinct(F.filter(F.split(F.lower(col(text)), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) >= least))


def shares_words(title: Column | str, page: Column | str, *, least: int = 5, share: float = 0.2, few: int = 3) -> Column:
    """Whether the page holds enough of the title's long words; titles with fewer than ``few`` of them always pass."""
    words = long_words(title, least)
    both = F.size(F.array_intersect(words, long_words(page, least)))
    return F.when(F.size(words) < few, F.lit(True)).otherwise(both / F.size(words) >= share)


def ends_mid_sentence(text: Column | str) -> Column:
    """Ends in an ellipsis, or, closing signs aside, not in punctuation that ends a sentence; an empty text does not."""
    t = F.rtrim(F.regexp_replace(col(text), rf"{SPACE}+$", ""))
    bare = F.regexp_replace(t, rf"({CLOSERS}|{SPACE})+$", "")
    return F.when(t.rlike(rf"(\.\.\.|…){CLOSERS}*$"), True).when(bare == "", False).otherwise(~bare.rlike(rf"{TERMINAL}$"))


def _for_echo(text: Column | str) -> Column:
    t = F.lower(F.trim(F.regexp_replace(col(text), rf"{SPACE}+", " ")))
    t = F.regexp_replace(t, r"[\s\-–—|]*\b[\w-]+\.(com|org|net|gov|co\.uk|io)\s*$", "")
    return F.trim(F.regexp_replace(t, r"\s*[-–—|]\s*[^\-–—|.!?]{1,30}\s*$", ""))


def is_headline_echo(title: Column | str, text: Column | str, slack: int = 40) -> Column:
    """Whether a text is only its headline again: it begins with it and has less than ``slack`` characters more, or is empty."""
    body, head = _for_echo(text), _for_echo(title)
    return F.when(body == "", True).when(head == "", False).otherwise(body.startswith(head) & (F.length(body) - F.length(head) < slack))


def trim_to_boundary(text: Column | str, most: int) -> Column:
    """At most ``most`` characters: to the last paragraph, else the last sentence, that keeps over half of them, else cut hard."""
    t = col(text)
    cut = F.substring(t, 1, most)
    back = F.reverse(cut)
    paragraph = F.length(cut) - F.locate("\n\n", back) - 1
    sentence = F.length(F.regexp_extract(cut, r"(?s)^(.*[.!?])\s", 1))
    kept = (
        F.when((F.locate("\n\n", back) > 0) & (paragraph > most / 2), F.rtrim(F.substring(cut, F.lit(1), paragraph)))
        .when(sentence > most / 2, F.substring(cut, F.lit(1), sentence))
        .otherwise(cut)
    )
    return F.when(F.length(t) <= most, t).otherwise(kept)


def strip_html(raw: Column | str) -> Column:
    """HTML as plain text: scripts, styles and figures out, blocks and breaks as line feeds, entities of the markup decoded; null if nothing is left."""
    t = F.regexp_replace(col(raw), r"(?is)<(script|style|figure|noscript)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>", "\n")
    t = F.regexp_replace(t, r"(?i)</(p|div|h[1-6]|li|tr|blockquote|section|article)\s*>", "\n\n")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", "")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&mdash;", "—"), ("&eacute;", "é"), ("&#8220;", "“"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(sign))
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t]*\n[ \t]*", "\n"), r"\n{3,}", "\n\n")
    return F.nullif(F.regexp_replace(t, r"^\s+|\s+$", ""), F.lit(""))


def parse_vector(text: Column | str) -> Column:
    """An array of double from a text in brackets; null where it is none."""
    return F.from_json(col(text), "array<double>")


def reading_minutes(words: Column | str, per_minute: int = 230, least: int = 100) -> Column:
    w = col(words)
    return F.when(w >= least, F.greatest(F.lit(1), F.round(w / per_minute).cast("int")))


def response_class(code: Column | str, content_type: Column | str, chars: Column | str, least: int = 1200) -> Column:
    """blocked (401, 403, 429), error (no answer, another failure, or no HTML), thin (less text than ``least``) or ok. A missing content type may be HTML."""
    c, kind = col(code), col(content_type)
    html = F.coalesce(F.lower(kind).rlike(r"^\s*(text/html|application/xhtml\+xml)\b"), F.lit(True))
    return F.when(c.isin(401, 403, 429), "blocked").when(c.isNull() | ~c.between(200, 299) | ~html, "error").when(F.coalesce(col(chars), F.lit(0)) < least, "thin").otherwise("ok")


def failure_kind(message: Column | str) -> Column:
    """auth before rate, then budget, then transport; other failures are permanent. Null is none."""
    m = F.lower(col(message))
    return (
        F.when(m.rlike(r"\b(401|403)\b|unauthori[sz]ed|forbidden|invalid api key"), "auth")
        .when(m.rlike(r"\b429\b|rate.?limit|too many requests|overloaded"), "rate")
        .when(m.rlike(r"max_tokens|budget|length limit"), "budget")
        .when(m.rlike(r"econnreset|econnrefused|socket|network|timed? ?out|\b50[0234]\b"), "transport")
        .when(m.isNotNull(), "permanent")
    )


def is_retryable(message: Column | str) -> Column:
    return F.coalesce(failure_kind(message).isin("rate", "transport"), F.lit(False))
