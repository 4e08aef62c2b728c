"""Upserts, checks, landing files, the cascade, the ledger, streams and the command line."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tarazi import cli
from tarazi.operators import cascade, quality, upserts
from tarazi.ops.ledger import Ledger
from tarazi.sources import landing
from tarazi.streaming import windows


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_append_new(spark):
    old = spark.createDataFrame([(1, None, "a")], "k long, s long, v string")
    new = spark.createDataFrame([(1, None, "b"), (2, 1, "d"), (2, 1, "c"), (None, None, "e")], "k long, s long, v string")
    assert rows(upserts.append_new(old, new, ["k", "s"]), "k") == [(None, None, "e"), (2, 1, "c")]


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 5, None), (2, None, 3, "x")], "k long, keep string, low long, own string")
    new = spark.createDataFrame([(1, "b", 2, "z"), (2, "c", None, "w"), (3, "d", 9, "n")], "k long, keep string, low long, own string")
    assert rows(upserts.upsert(old, new, ["k"], {"keep": "keep", "low": "least"}), "k") == [(1, "a", 2, None), (2, "c", 3, "x"), (3, "d", 9, "n")]


def test_snapshot(spark):
    day = lambda d: F.lit(d).cast("date")
    current = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k long, v string").withColumn("valid_from", day("2026-01-01")).withColumn("valid_to", F.lit(None).cast("date"))
    out = upserts.snapshot(current, spark.createDataFrame([(1, "b"), (2, None), (4, "d")], "k long, v string"), ["k"], ["v"], day("2026-02-01"))
    a, b = date(2026, 1, 1), date(2026, 2, 1)
    assert rows(out, "k", "valid_from") == [(1, "a", a, b), (1, "b", b, None), (2, None, a, None), (3, "c", a, None), (4, "d", b, None)]
    again = upserts.snapshot(out, spark.createDataFrame([(1, "b")], "k long, v string"), ["k"], ["v"], day("2026-03-01"))
    assert again.count() == out.count()


def test_rewrite_window(spark, tmp_path):
    d = date(2026, 1, 1)
    make = lambda tag, n: spark.createDataFrame([(d + timedelta(i), tag) for i in range(n)], "day date, v string")
    out = rows(upserts.rewrite_window(make("old", 20), make("new", 22), "day", 7), "day")
    assert [v for _, v in out] == ["old"] * 12 + ["new"] * 10
    path = str(tmp_path / "fact")
    upserts.overwrite_days(make("old", 3), path, "day")
    upserts.overwrite_days(make("new", 3).where("day = '2026-01-02'"), path, "day")
    assert [r.v for r in spark.read.parquet(path).orderBy("day").collect()] == ["old", "new", "old"]
    assert upserts.rewrite_window(make("x", 0), make("new", 2), "day", 7).count() == 2


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", 2), (2, None, None), (2, None, None)], "k long, x string, y long")
    assert rows(quality.conflicting(df, "k", ["x", "y"]), "k") == [(1, 2)]
    assert rows(quality.duplicate_keys(df, ["k"]), "k") == [(1, 2), (2, 2)]
    parents = spark.createDataFrame([(1, 2), (2, 5), (3, None), (4, 0)], "k long, n long")
    assert rows(quality.reconciliation(parents, "k", "n", ("c", df.select("k"))), "k") == [(2, 5, 2, 3), (3, None, 0, None)]
    pairs = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 2)], "c long, t long")
    assert tuple(quality.pair_counts(pairs, "c", "t").first())[:3] == (3, 2, 1)
    gates = spark.createDataFrame([(1, 100, None), (1, 200, None), (2, 9, None), (3, 100, "x"), (3, 100, None)], "b long, p long, e string")
    assert [(r.b, r.gate) for r in quality.batch_gates(gates, "b", "p", "e", 0.2, 30, 5000).orderBy("b").collect()] == [(1, None), (2, "median_price"), (3, "reject_ratio")]


@pytest.fixture
def feeds(tmp_path):
    f = tmp_path / "landing" / "shop"
    f.mkdir(parents=True)
    (f / "shop_2026-01-01.jsonl").write_bytes(b'{"b": 1, "a": 2}\n\n[1]\nbroken\n{"x": "\xff"}\n')
    (f / "shop_2026-01-02.csv").write_text('a,b\n1,"x\ny"\n2,3,4\n')
    (f / "shop_stores_2026-01-01.json").write_text('[{"s": 1}, 2]')
    (f / "shop_2026-01-03.json").write_text("{")
    (f / "notes.txt").write_text("x")
    return tmp_path


def test_landing(spark, feeds):
    files = landing.discover(spark, str(feeds / "landing"), "2026-01-02")
    assert rows(files.select("source", "kind", F.col("business_date").cast("string"), "ext"), "kind", "business_date") == [("shop", "prices", "2026-01-01", "jsonl"), ("shop", "prices", "2026-01-02", "csv"), ("shop", "stores", "2026-01-01", "json")]
    got = rows(landing.raw_records(landing.discover(spark, str(feeds / "landing"))).select("kind", F.col("business_date").cast("string"), "row_num", "payload", "unparseable"), "kind", "business_date", "row_num")
    assert got == [
        ("prices", "2026-01-01", 1, '{"a": 2, "b": 1}', False), ("prices", "2026-01-01", 2, "[1]", True), ("prices", "2026-01-01", 3, "broken", True), ("prices", "2026-01-01", 4, '{"x": "�"}', False),
        ("prices", "2026-01-02", 1, '{"a": "1", "b": "x\\ny"}', False), ("prices", "2026-01-02", 2, '{"a": "2", "b": "3"}', True), ("prices", "2026-01-03", 1, "{", True), ("stores", "2026-01-01", 1, '{"s": 1}', False), ("stores", "2026-01-01", 2, "2", True),
    ]


def test_ingest_is_idempotent_by_content(spark, feeds):
    store, folder = str(feeds / "store"), str(feeds / "landing")
    assert cli.ingest(spark, folder, store, "2026-01-02")["files"] == 3
    assert cli.ingest(spark, folder, store, "2026-01-02")["files"] == 0
    (feeds / "landing" / "shop" / "shop_2026-01-04.csv").write_text('a,b\n1,"x\ny"\n2,3,4\n')
    (feeds / "landing" / "shop" / "shop_2026-01-02.csv").write_text("a,b\n7,8\n")
    assert cli.ingest(spark, folder, store, "2026-01-04")["files"] == 2
    assert spark.read.parquet(f"{store}/records").count() == 4 + 2 + 2 + 1 + 1


def test_cascade(spark):
    data = [
        (1, "a", "Milla Süd təzə 1 l", "Milla", "4006381333931", "global"), (2, "b", "Süd", None, "4006381333931", "global"), (3, "a", "Pomidor Çəhrayı Salyan 1kq", None, None, "none"), (4, "b", "POMİDOR ÇƏHRAYI SALYAN 1 KQ", None, None, "none"), (5, "b", "Pomidor Salyan çəhrayı 1 kq", None, None, "none"),
        (6, "c", "Azərsüd Süd 2 l", None, None, "none"), (7, "d", "Azər Süd 2 l", None, None, "none"), (8, "c", "Şokolad qara fındıqlı Demo", "Demo", None, "none"), (9, "d", "Şokolad qara fındqlı Demo", "Demo", None, "none"), (10, "e", "", None, None, "none"),
    ]
    items = spark.createDataFrame([(i, r, n, b, e, k, None, None, None, "x") for i, r, n, b, e, k in data], "id long, retailer_code string, name_raw string, brand string, ean string, ean_kind string, unit_type string, unit_value double, pack int, category string")
    got = {r.id: (r.product, r.method, r.status) for r in cascade.cascade(items).collect()}
    assert got[2] == (1, "ean", "auto") and got[4] == (3, "fingerprint", "auto") and got[7] == (6, "loose_fingerprint", "auto") and got[9] == (8, "fuzzy", "auto")
    assert got[10] == (10, "new", "singleton") and got[1][1] == "new" and len(got) == 10


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "events"), "r1")
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 2:
            raise ValueError("once")
        return {"rows": 3}

    assert ledger.step("load", flaky, attempts=2) == {"rows": 3}
    assert ledger.status() == "succeeded"
    ledger.record("check", "rows", "failed")
    assert ledger.status() == "degraded"
    with pytest.raises(ZeroDivisionError):
        ledger.step("bad", lambda: 1 / 0)
    assert ledger.status() == "failed"
    assert json.loads(ledger.latest().where("name = 'load'").first().detail) == {"rows": 3}


def test_stream_equals_batch(spark, folder, tmp_path):
    events = spark.read.parquet(f"{folder}/events.parquet").select("ts", "event_type", "value")
    events.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = windows.hourly_stream(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), late="1000 days")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("hourly").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("hourly"), "window_start", "event_type") == rows(windows.hourly(events), "window_start", "event_type")
