"""Times: notations, zones, and the dictionary that grows."""

from datetime import UTC, datetime

import pytest

from galley.functions.instants import instant_ms
from galley.operators import instants as op


def _ms(*x):
    return int(datetime(*x, tzinfo=UTC).timestamp() * 1000)


@pytest.mark.parametrize(
    "raw, zone, order, want",
    [
        ("2024-01-02T10:00:00Z", None, None, _ms(2024, 1, 2, 10)),
        ("2024-01-02T10:00:00.1239+02:00", None, None, _ms(2024, 1, 2, 8) + 123),
        ("Tue, 02 Jan 2024 10:00:00 EST", "America/New_York", "mdy", _ms(2024, 1, 2, 15)),
        ("02/01/2024 10:00", "Europe/Paris", "dmy", _ms(2024, 1, 2, 9)),
        ("01/02/2024 10:00 PM", "America/Chicago", "mdy", _ms(2024, 1, 3, 4)),
        ("25/10/18 09:17", "Asia/Tokyo", "ymd", _ms(2025, 10, 18, 0, 17)),
        ("2024-W05-3T10:00Z", None, None, _ms(2024, 1, 31, 10)),
        ("2024-045T10:00:00Z", None, None, _ms(2024, 2, 14, 10)),
        ("2024-01-02T10Z", None, None, _ms(2024, 1, 2, 10)),
        ("2024年1月2日 午後3時05分", "Asia/Tokyo", "ymd", _ms(2024, 1, 2, 6, 5)),
        ("1704189600", None, None, _ms(2024, 1, 2, 10)),
        ("2024-10-27 02:30:00", "Europe/Berlin", "dmy", _ms(2024, 10, 27, 0, 30)),  # twice: the earlier
        ("2024-03-31 02:30:00", "Europe/Berlin", "dmy", _ms(2024, 3, 31, 1, 30)),  # skipped: as far after the change
        ("2024-01-02", "Europe/Paris", "dmy", None),
        ("2024-02-30T10:00:00Z", None, None, None),
        ("2024-366T10:00:00Z", None, None, _ms(2024, 12, 31, 10)),
        ("2023-366T10:00:00Z", None, None, None),
        ("yesterday at 10", "Europe/Paris", "dmy", None),
        ("10:00", "Europe/Paris", "dmy", None),
        ("", None, None, None),
        (None, None, None, None),
    ],
)
def test_instants(raw, zone, order, want):
    assert instant_ms(raw, zone, order) == want


def test_the_dictionary_adds_only_what_it_lacks(spark, tmp_path):
    path = f"file://{tmp_path}/d"
    first = spark.createDataFrame([("2024-01-02T10:00:00Z", None, None), ("2024-01-02T10:00:00Z", None, None), (None, "UTC", None)], "raw string, zone string, date_order string")
    assert op.update_dictionary(first, path).count() == 1
    more = first.unionAll(spark.createDataFrame([("03/04/2024 10:00", "Europe/Paris", "dmy"), ("03/04/2024 10:00", "Europe/Paris", "mdy")], first.schema))
    d = op.update_dictionary(more, path)
    assert d.count() == 3 and d.select("raw", "zone", "date_order").distinct().count() == 3
    rows = more.withColumnRenamed("zone", "z").selectExpr("raw", "z", "date_order as o", "'kept' as utc_ms")
    got = op.with_instants(rows, d, "raw", "z", "o", "ms")
    assert got.columns == ["raw", "z", "o", "utc_ms", "ms"] and got.count() == rows.count()
    assert {(r.o, r.ms) for r in got.where("z is not null and raw is not null").collect()} == {("dmy", _ms(2024, 4, 3, 8)), ("mdy", _ms(2024, 3, 4, 9))}
