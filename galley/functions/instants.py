"""Reading one written time into a UTC instant (pure Python, no Spark)."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

# Month names and their usual short forms in the nine languages of the feeds.
_MONTHS = {
    "en": "january february march april may june july august september october november december",
    "en3": "jan feb mar apr may jun jul aug sep oct nov dec",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "fr3": "janv févr mars avr mai juin juil août sept oct nov déc",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "de3": "jan feb mär apr mai jun jul aug sep okt nov dez",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "es3": "ene feb mar abr may jun jul ago sep oct nov dic",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "pt3": "jan fev mar abr mai jun jul ago set out nov dez",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "it3": "gen feb mar apr mag giu lug ago set ott nov dic",
    "nl": "januari februari maart april mei juni juli augustus september oktober november december",
    "nl3": "jan feb mrt apr mei jun jul aug sep okt nov dec",
    "ru": "января февраля марта апреля мая июня июля августа сентября октября ноября декабря",
    "ru1": "январь февраль март апрель май июнь июль август сентябрь октябрь ноябрь декабрь",
    "ru3": "янв фев мар апр мая июн июл авг сен окт ноя дек",
}
MONTHS = {name: i % 12 + 1 for row in _MONTHS.values() for i, name in enumerate(row.split())} | {"sept": 9, "janvier": 1, "gennaio": 1, "setiembre": 9}

# Minutes east of UTC of zone abbreviations; one that the row's own zone uses goes first.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "UT": 0, "Z": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "EAT": 180, "IST": 330, "NPT": 345, "JST": 540, "AEST": 600, "AEDT": 660,
    "BRT": -180, "BRST": -120, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
GENERIC = {"ET": "America/New_York", "CT": "America/Chicago", "MT": "America/Denver", "PT": "America/Los_Angeles"}

CANONICAL = re.compile(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z", re.ASCII)
_ZONE = r"(?P<zone>\s*(?:[zZ]|[+\-−]\d{1,2}(?::?\d\d)?(?::?\d\d)?|(?:UTC|GMT)[+\-−]\d{1,2}(?::?\d\d)?|[A-Za-z]{2,5}))?(?P<name>\s*\[[A-Za-z_+\-/0-9]+\])?"
_TIME = r"(?P<half>午前|午後)?\s?(?P<h>\d{1,2})(?::|\s?h\s?|時)(?P<mi>\d\d)分?(?:(?::(?P<s>\d\d)|(?P<s2>\d\d)秒)(?:[.,](?P<f>\d{1,12}))?)?(?:\s*(?P<ap>[aApP]\.?[mM](?![A-Za-z])\.?))?(?:\s*(?:Uhr|uhr)(?![A-Za-z]))?"
_JOIN = r"(?:\s*[Tt]\s*|\s*,\s*|\s+)(?:(?:at|um|à|às|a las|alle|om|в|kl\.?)\s+)?"
_WEEKDAY = r"(?:[^\W\d_]{2,12}\.?,?\s+)?"
_PATTERNS = [
    re.compile(p, re.UNICODE)
    for p in (
        rf"(?P<y>\d{{4}})(?P<sep>[-/.])(?P<mo>\d{{1,2}})(?P=sep)(?P<d>\d{{1,2}}){_JOIN}{_TIME}{_ZONE}",
        rf"(?P<y>\d{{4}})(?P<mo>\d\d)(?P<d>\d\d)[Tt ]?(?P<h>\d\d):?(?P<mi>\d\d)(?::?(?P<s>\d\d)(?:[.,](?P<f>\d{{1,12}}))?)?{_ZONE}",
        rf"{_WEEKDAY}(?P<a>\d{{1,2}})(?P<sep>[-/.])(?P<b>\d{{1,2}})(?P=sep)(?P<y>\d{{4}}|\d\d){_JOIN}{_TIME}{_ZONE}",
        rf"{_WEEKDAY}(?P<d>\d{{1,2}})(?:\.|er|re|st|nd|rd|th|º|°)?[\s-]+(?:de\s+|of\s+)?(?P<mon>[^\W\d_]{{3,12}})\.?,?[\s-]+(?:de\s+)?(?P<y>\d{{4}}|\d\d)(?:\s*г\.?)?{_JOIN}{_TIME}{_ZONE}",
        rf"{_WEEKDAY}(?P<mon>[^\W\d_]{{3,12}})\.?\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}}){_JOIN}{_TIME}{_ZONE}",
        rf"(?P<y>\d{{4}})年\s*(?P<mo>\d{{1,2}})月\s*(?P<d>\d{{1,2}})日(?:\s*[\(（].[\)）])?\s*{_TIME}{_ZONE}",
        # ISO weeks, ordinal days, and hours alone
        rf"(?P<y>\d{{4}})-?W(?P<week>\d\d)-?(?P<wd>[1-7])[Tt ](?P<h>\d\d):?(?P<mi>\d\d)(?::?(?P<s>\d\d)(?:[.,](?P<f>\d{{1,12}}))?)?{_ZONE}",
        rf"(?P<y>\d{{4}})-?(?P<doy>\d{{3}})[Tt ](?P<h>\d\d):?(?P<mi>\d\d)(?::?(?P<s>\d\d)(?:[.,](?P<f>\d{{1,12}}))?)?{_ZONE}",
        rf"(?P<y>\d{{4}})-(?P<mo>\d\d)-(?P<d>\d\d)[Tt](?P<h>\d\d){_ZONE}",
        # the form of C's ctime: Sat Oct 18 09:17:23 [zone] 2025
        rf"[A-Za-z]{{3,9}}\s+(?P<mon>[A-Za-z]{{3,9}})\s+(?P<d>\d{{1,2}})\s+(?P<h>\d\d):(?P<mi>\d\d):(?P<s>\d\d)(?P<zone>\s+[A-Z]{{2,5}}|\s+[+-]\d{{4}})?\s+(?P<y>\d{{4}})",
    )
]
_EPOCH = re.compile(r"([+-]?\d{9,10})(?:[.,](\d{1,12}))?|(\d{13})(?:\.\d+)?|(\d{16})|(\d{19})", re.ASCII)
_OFFSET = re.compile(r"(?:UTC|GMT)?([+\-−])(\d{1,2}):?(\d\d)?(?::?(\d\d))?", re.ASCII)
_DIGITS = str.maketrans("０１２３４５６７８９：", "0123456789:")


@lru_cache(maxsize=512)
def _zone(name: str | None) -> ZoneInfo | None:
    try:
        return ZoneInfo(name) if name else None
    except Exception:
        return None


@lru_cache(maxsize=4096)
def _abbreviated(word: str, home: str | None, year: int):
    """The zone or fixed offset that an abbreviation stands for, as it is used in the home zone."""
    word = word.upper()
    if word in ("UTC", "GMT", "UT", "Z"):
        return UTC
    zone = _zone(home)
    if zone is not None:
        for month in (1, 7, 4, 10):
            at = datetime(year, month, 15, 12, tzinfo=zone)
            if at.tzname() == word:
                return timezone(at.utcoffset())
    if word in GENERIC:
        return _zone(GENERIC[word])
    if word in ABBREVIATIONS:
        return timezone(timedelta(minutes=ABBREVIATIONS[word]))
    return None


def _millis(at: datetime, fraction: str | None) -> int:
    """The instant in milliseconds; the fraction's finer digits are dropped.

    fold=0 takes the earlier of two instants, and in a gap the offset before the change, so that a
    skipped wall time lies as far after the change as it is past it.
    """
    seconds = (at.astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(seconds=1)
    return seconds * 1000 + int(((fraction or "") + "000")[:3])


def instant_ms(raw: str | None, zone: str | None, date_order: str | None) -> int | None:
    """The one instant that ``raw`` names, in milliseconds since 1970 UTC, or None if it names none.

    ``zone`` (IANA) holds for a value without its own zone; without it such a value names no instant.
    ``date_order`` (dmy, mdy, ymd) orders all-digit dates that do not begin with the year; when it is
    missing, such a date is read only if one order alone makes a date. Where a source's order is ymd, such a date
    begins with a year of two digits, or, if it ends in one of four, is read as dmy. A second 60 is read as 59.
    """
    if raw is None:
        return None
    text = raw.translate(_DIGITS).strip().strip("\u200b\ufeff").replace("\u00a0", " ").replace("\u202f", " ")
    if not any(c.isdigit() for c in text):
        return None
    m = _EPOCH.fullmatch(text)
    if m:
        if m[1]:
            whole = int(m[1]) * 1000
            return whole + (-1 if whole < 0 else 1) * int(((m[2] or "") + "000")[:3])
        return int(m[3]) if m[3] else int(m[4]) // 1000 if m[4] else int(m[5]) // 1_000_000
    for pattern in _PATTERNS:
        m = pattern.fullmatch(text)
        if m:
            at = _read(m.groupdict(), zone, date_order)
            if at is not None:
                return at
    return None


def _read(g: dict, home: str | None, order: str | None) -> int | None:
    year = int(g["y"])
    if len(g["y"]) == 2:
        if order == "ymd" and g.get("a"):
            if len(g["a"]) != 2:
                return None
            return _read({**g, "y": "20" + g["a"], "a": None, "mo": g["b"], "d": g["y"]}, home, order)
        year += 2000
    if g.get("mon"):
        month = MONTHS.get(g["mon"].lower())
        if not month:
            return None
        day = int(g["d"])
    elif g.get("a"):
        a, b = int(g["a"]), int(g["b"])
        if order == "mdy":
            month, day = a, b
        elif order in ("dmy", "ymd") or a > 12:
            month, day = b, a
        elif b > 12 or a == b:
            month, day = a, b
        else:
            return None
    elif g.get("week") or g.get("doy"):
        try:
            at = datetime.fromisocalendar(year, int(g["week"]), int(g["wd"])) if g.get("week") else datetime(year, 1, 1) + timedelta(days=int(g["doy"]) - 1)
        except ValueError:
            return None
        if g.get("doy") and at.year != year:
            return None
        year, month, day = at.year, at.month, at.day
    else:
        month, day = int(g["mo"]), int(g["d"])
    hour, minute, second = int(g["h"]), int(g.get("mi") or 0), int(g.get("s") or g.get("s2") or 0)
    if g.get("ap"):
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if g["ap"][0] in "pP" else 0)
    if g.get("half"):
        if hour > 12:
            return None
        hour = hour % 12 + (12 if g["half"] == "午後" else 0)
    try:
        if (hour, minute, second) == (24, 0, 0):
            at = datetime(year, month, day) + timedelta(days=1)
        else:
            at = datetime(year, month, day, hour, minute, min(second, 59) if second == 60 else second)
    except ValueError:
        return None
    name, zone = (g.get("name") or "").strip().strip("[]"), (g.get("zone") or "").strip()
    tz = None
    if zone:
        m = _OFFSET.fullmatch(zone)
        if m:
            minutes = int(m[2]) * 60 + int(m[3] or 0)
            if minutes > 18 * 60 or int(m[3] or 0) > 59:
                return None
            tz = timezone(timedelta(minutes=minutes) * (1 if m[1] == "+" else -1))
        else:
            tz = _abbreviated(zone, home, year)
            if tz is None:
                return None
    elif name:
        tz = _zone(name)
        if tz is None:
            return None
    else:
        tz = _zone(home)
        if tz is None:
            return None
    try:
        return _millis(at.replace(tzinfo=tz), g.get("f"))
    except (ValueError, OverflowError):
        return None
