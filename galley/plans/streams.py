"""Queries that run a stream over a whole table and give its result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import events as s
from ..streaming.memory import remember


def stream_insert_once(spark, sf):
    """The first event of every user and type within 90 days: one row each, whichever comes first."""
    d = s.drained(s.insert_once(s.read_events(spark, sf), ["user_id", "event_type"], "ts", "90 days"), what="once")
    return d.select("user_id", "event_type")


def stream_daily(spark, sf):
    """Events of each type by day."""
    d = s.drained(s.recent(s.read_events(spark, sf), "ts", "400 days", "1 day", "event_type"), "complete", "daily")
    return d.select(F.unix_micros("window.start").alias("day_us"), "event_type", "n")


def stream_sessions(spark, sf):
    """Sittings of each user, six hours apart."""
    d = s.drained(s.sessions(s.read_events(spark, sf), "ts", "user_id", "6 hours", "400 days"), "complete", "sessions")
    return d.select("user_id", F.unix_micros("s.start").alias("start_us"), F.unix_micros("last").alias("end_us"), "n_events")


def stream_cooldowns(spark, sf):
    """Users with two rows and more in a sliding week whose values are all low."""
    d = s.drained(s.cooldowns(s.read_events(spark, sf), "ts", "user_id", "value < 20", "7 days", "1 day", 2), "complete", "cool")
    return d.select(F.unix_micros("window.start").alias("start_us"), "user_id", "n")


def stream_refetch(spark, sf):
    """Events of each user that come at least 20 hours after the last one admitted."""
    d = s.drained(remember(s.read_events(spark, sf).select("event_id", "user_id", "ts"), "user_id", "ts", 20 * 3600, "400 days"), what="memory")
    return d.select("event_id", "user_id")


QUERIES = {f.__name__: f for f in (stream_refetch, stream_insert_once, stream_daily, stream_sessions, stream_cooldowns)}
SQL = {
    "stream_insert_once": "select distinct user_id, event_type from events",
    "stream_daily": "select epoch_us(date_trunc('day', ts))::bigint as day_us, event_type, count(*) as n from events group by all",
    "stream_sessions": "with e as (select user_id, epoch_us(ts)::bigint as t, lag(epoch_us(ts)::bigint) over (partition by user_id order by ts) as b from events), g as (select *, sum((b is null or t - b >= 21600000000)::int) over (partition by user_id order by t) as s from e) select user_id, min(t) as start_us, max(t) as end_us, count(*) as n_events from g group by user_id, s",
    "stream_cooldowns": "with d as (select user_id, value, unnest(range(0, 7)) as k, epoch_us(date_trunc('day', ts))::bigint as day from events) select (day - k * 86400000000)::bigint as start_us, user_id, count(*) as n from d group by 1, 2 having count(*) >= 2 and count(*) = count(*) filter (where value < 20)",
}
