"""Column functions on addresses; all stay in the JVM and never raise on what is no address."""

from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

#: Query parameters that only track (fixed values).
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "fbclid", "gclid", "mc_cid", "mc_eid", "ref", "referrer", "source", "_r"]
_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
ASSETS = r"(?i)\.(jpg|jpeg|png|gif|webp|svg|ico|css|js|json|xml|pdf|mp4|mp3|woff2?|ttf)$"


def is_url(url: Column | str) -> Column:
    return col(url).rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+")


def _part(url: Column | str, k: int) -> Column:
    return F.regexp_extract(col(url), _URL, k)


def path_of(url: Column | str) -> Column:
    return _part(url, 3)


def host_of(url: Column | str) -> Column:
    """Lower case, without user, port and a leading www.; a fixed text for what is no address."""
    host = F.lower(F.regexp_replace(F.regexp_replace(_part(url, 2), r"^.*@", ""), r":[0-9]*$", ""))
    return F.when(is_url(url), F.regexp_replace(host, r"^www\.", "")).otherwise("(unparseable)")


def unwrap_redirect(url: Column | str) -> Column:
    """The absolute address inside the path of another, if there is one; parameters are not looked at."""
    inner = F.regexp_extract(path_of(url), r".(https?://.+)$", 1)
    return F.when(is_url(url) & is_url(inner), inner).otherwise(col(url))


def canonical_url(url: Column | str) -> Column:
    """One address for the variants of a page: redirects unwrapped, host in lower case, default ports, mobile-page forms and tracking parameters out."""
    u = unwrap_redirect(url)
    scheme, host = F.lower(_part(u, 1)), F.lower(_part(u, 2))
    host = F.when(scheme == "http", F.regexp_replace(host, r":80$", "")).when(scheme == "https", F.regexp_replace(host, r":443$", "")).otherwise(host)
    bare = F.regexp_replace(host, r"^amp\.", "")
    host = F.when(host == bare, host).when(bare.contains("."), F.concat(F.lit("www."), bare)).otherwise(bare)
    path = F.regexp_replace(F.regexp_replace(path_of(u), r"^/amp/", "/"), r"/amp$", "")
    path = F.when(path == "", "/").otherwise(path)
    query = F.regexp_replace(_part(u, 4), r"^\?", "")
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.split(p, "=")[0].isin(TRACKING)), "&")
    query = F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")
    fragment = F.when(_part(u, 5) == "#", "").otherwise(_part(u, 5))
    return F.when(is_url(u), F.concat(scheme, F.lit("://"), host, path, query, fragment)).otherwise(col(url))


def looks_like_article(url: Column | str, not_hosts: list[str] | None = None) -> Column:
    """http(s), a path that is more than the front page, no asset, and none of the given hosts or their subdomains."""
    path = F.regexp_replace(path_of(url), r"/+$", "")
    ok = F.lower(_part(url, 1)).isin("http", "https") & is_url(url) & (F.length(path) > 1) & ~path.rlike(ASSETS)
    for h in not_hosts or []:
        ok &= (host_of(url) != h) & ~host_of(url).endswith(f".{h}")
    return F.coalesce(ok, F.lit(False))


def first_segment(url: Column | str) -> Column:
    """The first segment of the path, or a slash."""
    return F.coalesce(F.nullif(F.split(path_of(url), "/").getItem(1), F.lit("")), F.lit("/"))


def has_segment(url: Column | str, pattern: str) -> Column:
    """Whether a whole segment of the path matches."""
    return F.coalesce(F.exists(F.split(path_of(url), "/"), lambda s: s.rlike(f"(?i)^(?:{pattern})$")), F.lit(False))


def excluded_path(url: Column | str, paths: list[str]) -> Column:
    """Whether the whole path is one of these, trailing slashes aside; what is no address is not excluded."""
    tidy = [p.rstrip("/") or "/" for p in paths]
    path = F.regexp_replace(path_of(url), r"/+$", "")
    return F.coalesce(is_url(url) & F.when(path == "", "/").otherwise(path).isin(tidy), F.lit(False))


def token_url(token: str | None, own_host: str | None = None) -> str | None:
    """The address inside an opaque token: URL-safe base64 of length-delimited fields, one of which, at any depth, is an address; none of ``own_host``."""
    if not token:
        return None
    try:
        data = base64.urlsafe_b64decode(token + "=" * (-len(token) % 4))
    except ValueError:
        return None
    found = _field_url(data, 0)
    if found and own_host and found.split("/")[2].lower().endswith(own_host):
        return None
    return found


def _varint(data: bytes, i: int) -> tuple[int, int] | None:
    value = shift = 0
    while i < len(data) and shift < 64:
        value |= (data[i] & 0x7F) << shift
        i += 1
        if data[i - 1] < 0x80:
            return value, i
        shift += 7
    return None


def _field_url(data: bytes, depth: int) -> str | None:
    i = 0
    while i < len(data) and depth < 4:
        if (key := _varint(data, i)) is None:
            return None
        kind, i = key[0] & 7, key[1]
        if kind == 0:
            if (skipped := _varint(data, i)) is None:
                return None
            i = skipped[1]
        elif kind == 2:
            if (size := _varint(data, i)) is None or size[1] + size[0] > len(data):
                return None
            part, i = data[size[1] : size[1] + size[0]], size[1] + size[0]
            if part.startswith((b"http://", b"https://")):
                return part.decode("utf-8", "replace")
            if (inner := _field_url(part, depth + 1)) is not None:
                return inner
        elif kind in (1, 5):
            i += 8 if kind == 1 else 4
        else:
            return None
    return None


def decoded_token(token: Column | str, own_host: str) -> Column:
    @F.pandas_udf("string")
    def decode(t: pd.Series) -> pd.Series:
        return t.map(lambda x: token_url(x, own_host) if isinstance(x, str) else None)

    return decode(col(token))


def resolved(token: Column | str, redirect: Column | str, page: Column | str, own_host: str) -> Column:
    """The first address that looks like an article: inside the token, where a redirect led, or the first in the page."""
    ok = lambda c: F.when(looks_like_article(c, [own_host]), c)
    inside = F.filter(F.regexp_extract_all(col(page), F.lit(r"(https?://[^\s\"'<>]+)"), 1), lambda x: looks_like_article(x, [own_host]))
    return F.coalesce(ok(decoded_token(token, own_host)), ok(col(redirect)), F.get(inside, F.lit(0)))
