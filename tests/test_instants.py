from datetime import date, datetime, timezone

import pytest

from tarazi.functions.instants import readings
from tarazi.operators import instants
from tarazi.operators.instants import TimeDictionary


def iso(text, zone=None):
    return [datetime.fromtimestamp(x / 1e6, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S") for x in readings(text, zone)]


@pytest.mark.parametrize(
    ("text", "zone", "want"),
    [
        ("2026-04-16T23:44:03+04:00", None, "2026-04-16T19:44:03"), ("20260416T125803Z", None, "2026-04-16T12:58:03"), ("1776502453340697", None, "2026-04-18T08:54:13"), ("1776532195000", None, "2026-04-18T17:09:55"),
        ("1776457859.5", None, "2026-04-17T20:30:59"), ("17.04.26 03:39:18", "Asia/Baku", "2026-04-16T23:39:18"), ("2026-04-17 13:38:15 GMT+4", None, "2026-04-17T09:38:15"), ("17/04/2026 21:58", "Europe/Athens", "2026-04-17T18:58:00"),
        ("20260417084127", "Europe/Athens", "2026-04-17T05:41:27"), ("17-Apr-2026 10.02", "Europe/Athens", "2026-04-17T07:02:00"), ("2026-03-29 01:48:32 EET", None, "2026-03-28T23:48:32"), ("31 mart 2026, 22:34", "Asia/Baku", "2026-03-31T18:34:00"),
        ("4/17/2026 5:49 PM", "UTC", "2026-04-17T17:49:00"), ("12/9/2025 12:02 AM", "UTC", "2025-12-09T00:02:00"), ("2026-04-13T20:00:00+02:00[Europe/Berlin]", None, "2026-04-13T18:00:00"), ("Sat, 11 Apr 2026 20:35:41 +0200", None, "2026-04-11T18:35:41"),
        ("2026-03-28T12:00:00", "Europe/Berlin", "2026-03-28T11:00:00"), ("2026-03-30T12:00:00", "Europe/Berlin", "2026-03-30T10:00:00"),
    ],
)
def test_readings(text, zone, want):
    assert iso(text, zone)[0] == want


@pytest.mark.parametrize("text", ["31.11.2025 09:10", "25:61", "0000-00-00 00:00:00", "2026-01-32T04:00:00Z", "dünən", "n/a", "2025-13-05T08:00:00", "", "x" * 10000, "9" * 50])
def test_impossible(text):
    assert readings(text, "UTC") == []


def test_a_time_without_zone_in_a_feed_without_one_has_no_reading():
    assert readings("2026-04-16T23:44:03", None) == []


def rows(spark, data):
    return spark.createDataFrame(data, "batch_id long, row_num int, source string, business_date date, time_text string, error string")


def test_rows_take_the_reading_nearest_to_their_date(spark):
    shops = spark.createDataFrame([("a", "Asia/Baku"), ("b", None)], "code string, feed_tz string")
    d = date(2026, 4, 3)
    data = [(1, 1, "a", d, "03/04/2026 10:00", None), (1, 2, "a", date(2026, 3, 4), "03/04/2026 10:00", None), (1, 3, "a", d, None, None), (1, 4, "b", d, "2026-04-03 10:00", None), (1, 5, None, d, "2026-04-03T10:00:00Z", None), (1, 6, "a", None, "03/04/2026 10:00", None), (1, 6, "a", None, "03/04/2026 10:00", None)]
    got = sorted((r.row_num, r.observed_at and r.observed_at.isoformat()) for r in instants.with_instants(rows(spark, data), shops).collect())
    day_first, month_first = "2026-04-03T06:00:00", "2026-03-04T06:00:00"
    assert got == [(1, day_first), (2, month_first), (3, None), (4, None), (5, "2026-04-03T10:00:00"), (6, day_first), (6, day_first)]


def test_empty_table(spark):
    shops = spark.createDataFrame([("a", "UTC")], "code string, feed_tz string")
    assert instants.with_instants(rows(spark, []), shops).count() == 0


def test_dictionary_parses_only_new_texts(spark, tmp_path):
    d = TimeDictionary(spark, str(tmp_path / "dict"))
    make = lambda *t: spark.createDataFrame([("a", "UTC", x) for x in t], "source string, zone string, text string")
    assert d.entries().count() == 0
    first = d.extend(make("2026-01-01", "junk"))
    second = d.extend(make("2026-01-01", "2026-01-02", "2026-01-02"))
    assert spark.read.parquet(f"{d.path}/{first}").count() == 2
    assert [r.text for r in spark.read.parquet(f"{d.path}/{second}").collect()] == ["2026-01-02"]
    assert d.entries().count() == 3
