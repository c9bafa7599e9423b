"""Streams with an end to their states, against the rule applied in order."""

from collections import defaultdict

from galley.plans.streams import stream_refetch
from galley.runtime import table
from galley.streaming.memory import admitted_by

SF = "/root/testdata/sf0.001"


def test_admitted_by():
    assert admitted_by([0, 5, 10, 19, 20], None, 10) == ([True, False, True, False, True], 20)
    assert admitted_by([5], 0, 10) == ([False], 0)
    assert admitted_by([], 3, 10) == ([], 3)


def test_refetches_are_suppressed(spark):
    events = defaultdict(list)
    for r in table(spark, SF, "events").select("event_id", "user_id", "ts").collect():
        events[r.user_id].append((r.ts, r.event_id))
    want = set()
    for rows in events.values():
        rows.sort()
        ok, _ = admitted_by([int(t.timestamp() * 1e6) for t, _ in rows], None, 20 * 3600 * 1_000_000)
        want |= {e for (_, e), k in zip(rows, ok, strict=True) if k}
    assert {r.event_id for r in stream_refetch(spark, SF).collect()} == want
