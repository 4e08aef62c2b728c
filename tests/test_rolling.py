import random
from datetime import date, datetime, timedelta

from tarazi.operators import rolling

SCHEMA = "item long, point string, day date, at timestamp, p int, r int, obs_day string"
ENTITY, MEASURES = ["item", "point"], ["p", "r"]


def windows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return rolling.trailing(rolling.daily_values(df, ENTITY, "day", "at", MEASURES), ENTITY, MEASURES)


def brute(rows):
    daily = {}
    least = lambda v: (v is not None, v or 0)
    for i, pt, d, at, p, r, _ in rows:
        if d is None:
            continue
        key = ((at is not None, at or datetime.min), least(p), least(r))
        old = daily.setdefault((i, pt), {}).get(d)
        if old is None or old[0] < key:
            daily[(i, pt)][d] = (key, p, r)
    out = {}
    for e, days in daily.items():
        d = min(days)
        while d <= max(days):
            row = []
            for m in (1, 2):
                for w in (7, 30):
                    held = [days[x][m] for x in (d - timedelta(k) for k in range(w)) if x in days and days[x][m] is not None]
                    row += [sum(held) if held else None, len(held)]
            out[(*e, d)] = tuple(row)
            d += timedelta(1)
    return out


def got(df):
    return {(r["item"], r["point"], r["obs_day"]): tuple(r[f"{m}_{k}_{w}"] for m in MEASURES for w in (7, 30) for k in ("total", "days")) for r in df.collect()}


def test_against_brute_force(spark):
    rnd = random.Random(1)
    base, at = date(2025, 12, 1), datetime(2025, 12, 1)
    rows = [
        (rnd.choice([1, 2, None]), rnd.choice(["x", "y", None]), rnd.choice([base + timedelta(rnd.choice([0, 1, 2, 5, 40, 41, 90, 130]) + rnd.randrange(3)), None]), rnd.choice([at + timedelta(hours=rnd.randrange(2)), None]), rnd.choice([100, 200, None]), rnd.choice([150, None]), "clash")
        for _ in range(300)
    ]
    out = windows(spark, rows)
    assert got(out) == brute(rows)
    for r in out.collect():
        assert r.p_avg_7 == (r.p_total_7 / r.p_days_7 if r.p_days_7 else None)


def test_cases_compare_whole_numbers(spark):
    d = date(2026, 1, 1)
    rows = [(1, "x", d, None, 85, 100, None), (2, "x", d, None, 84, 100, None), (3, "x", d, None, None, 100, None), (4, "x", d, None, 1, None, None)]
    cases = rolling.below_share(windows(spark, rows), "p", 7, "r", 30, 85)
    assert [r["item"] for r in cases.collect()] == [2]


def test_empty(spark):
    assert windows(spark, []).count() == 0
