import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarazi.operators import history


def brute(rows):
    picked = {}
    for e, d, v, at in rows:
        if e is None or d is None:
            continue
        key = (at is not None, at or datetime.min, v is not None, v or "")
        if (e, d) not in picked or picked[(e, d)][0] < key:
            picked[(e, d)] = (key, v)
    out, last = [], {}
    for (e, d), (_, v) in sorted(picked.items()):
        if v is not None and last.get(e) != v:
            out.append((e, v, d))
            last[e] = v
    return sorted(out)


def run(spark, rows, rounds=5):
    df = spark.createDataFrame(rows, "e long, d date, v string, at timestamp")
    snaps = history.latest_snapshots(df, "e", "d", F.col("v"), "at")
    return history.versions(snaps, rounds=rounds)


@pytest.mark.parametrize("rounds", [1, 2, 5])
def test_against_brute_force(spark, rounds):
    rnd = random.Random(rounds)
    day, at = date(2025, 10, 1), datetime(2025, 10, 1)
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice([day + timedelta(rnd.randrange(120)), None]), rnd.choice(["a", "b", None]), rnd.choice([at + timedelta(hours=rnd.randrange(3)), None])) for _ in range(600)]
    out = run(spark, rows, rounds)
    got = sorted((r.entity_id, r.payload, r.valid_from) for r in out.collect())
    assert got == brute(rows)
    for r in out.collect():
        nexts = [v for e, _, v in got if e == r.entity_id and v > r.valid_from]
        assert r.valid_to == (min(nexts) if nexts else None)
        assert r.last_seen >= r.valid_from and (r.valid_to is None or r.last_seen < r.valid_to)


def test_one_entity_with_nearly_all_rows(spark):
    day = date(2000, 1, 1)
    rows = [(7, day + timedelta(i % 3000), "ab"[i % 3000 // 1500], datetime(2020, 1, 1)) for i in range(9000)] + [(8, day, "x", None)]
    assert sorted((r.entity_id, r.payload) for r in run(spark, rows).collect()) == [(7, "a"), (7, "b"), (8, "x")]


def test_empty(spark):
    assert run(spark, []).count() == 0


def test_zone_spelling(spark):
    df = spark.createDataFrame([(" e4 ",), ("E4",), (" ",), (None,), (" E4",)], "price_zone string")
    assert [r[0] for r in df.select(history.zone_payload()).collect()] == ["E4", "E4", None, None, "E4"]
