import json
from datetime import date

import pytest

from tarazi.functions.payloads import COLUMNS, assemble_records, parse_payload
from tarazi.operators import quantities, rejects

GOOD = {"sku": "1", "title": "Süd", "brand": None, "barcode": None, "cat": "x", "price": "2.49", "was": None, "in_stock": True, "scraped_at": "2026-01-01T00:00:00Z"}
LINE = 'S1,"Süd ""X"", 1 l",B,,d,2.10,,Y,2026-01-01T00:00:00Z'


def error(source, payload):
    return dict(zip(COLUMNS, parse_payload(source, payload)))["error"]


@pytest.mark.parametrize(
    ("source", "payload", "want"),
    [
        ("baku_fresh", json.dumps(GOOD), None), ("baku_fresh", json.dumps(GOOD) + "\n", None), ("baku_fresh", json.dumps(GOOD | {"extra": [1]}), None), ("baku_fresh", json.dumps(GOOD) * 2, "malformed_json"),
        ("baku_fresh", "[" + json.dumps(GOOD) + "]", "not_an_object"), ("baku_fresh", json.dumps(GOOD)[:-1] + ",}", "malformed_json"), ("baku_fresh", "", "malformed_json"), ("baku_fresh", None, "missing_payload"), ("nobody", "{}", "unknown_source"), (None, "{}", "unknown_source"),
        ("baku_fresh", json.dumps({k: v for k, v in GOOD.items() if k != "was"}), "missing_field:was"), ("baku_fresh", json.dumps(GOOD | {"sku": " "}), "missing_sku"), ("baku_fresh", json.dumps(GOOD | {"title": None}), "missing_name"),
        ("baku_fresh", json.dumps(GOOD | {"price": None}), "missing_price"), ("baku_fresh", json.dumps(GOOD | {"price": "n/a"}), "invalid_price"), ("baku_fresh", json.dumps(GOOD | {"price": "0"}), "nonpositive_price"), ("baku_fresh", json.dumps(GOOD | {"price": -1}), "nonpositive_price"),
        ("baku_fresh", json.dumps(GOOD | {"price": True}), "invalid_price"), ("baku_fresh", "{" * 100_000, "malformed_json"), ("baku_fresh", '{"sku": NaN}', "malformed_json"),
        ("sumqayit", '{"product":{"code":"1","name":"x"},"offer":null,"meta":{"fetched":1}}', "missing_field:offer.price"),
        ("shirvan", LINE, None), ("shirvan", LINE + "\r\n", None), ("shirvan", LINE.replace("1 l", "1\nl"), None), ("shirvan", LINE + "\n" + LINE, "several_records"), ("shirvan", LINE + ",", "field_count:10"), ("shirvan", 'S1,"Süd,B,,d,2.10,,Y,', "broken_quoting"), ("shirvan", '"a"b' + LINE, "broken_quoting"), ("shirvan", "", "several_records"),
    ],
)
def test_reasons(source, payload, want):
    got = error(source, payload)
    assert got == want or (want == "several_records" and got == "empty_record")


def test_assembly_is_quote_aware():
    assert list(assemble_records(['a,"b', 'c",d', "e", '"f'])) == ['a,"b\nc",d', "e", '"f']


def frame(spark, data):
    return spark.createDataFrame(data, "batch_id long, row_num int, source string, business_date date, payload string, error string, observed_at string")


def classified(spark, data):
    shops = spark.createDataFrame([("baku_fresh", "Asia/Baku"), ("absheron", "Asia/Baku")], "code string, feed_tz string")
    stores = spark.createDataFrame([("absheron", "AB-001"), ("absheron", "AB-001"), ("absheron", None)], "retailer_code string, store_code string")
    return rejects.classify(frame(spark, data), shops, stores)


def test_every_row_is_loaded_or_rejected(spark):
    d = date(2026, 1, 1)
    zoned = {"item_code": "1", "store_code": "AB-001", "description": "x", "price_azn": 2, "old_price_azn": 1, "updated": "2026-01-01 10:00:00"}
    data = [
        (1, 1, "baku_fresh", d, json.dumps(GOOD), "clash", "clash"), (1, 1, "baku_fresh", d, json.dumps(GOOD), None, None), (1, 2, "baku_fresh", d, json.dumps(GOOD | {"scraped_at": "31.11.2025"}), None, None), (1, 3, "baku_fresh", d, json.dumps(GOOD | {"scraped_at": ""}), None, None),
        (1, 4, "absheron", d, json.dumps(zoned), None, None), (1, 5, "absheron", d, json.dumps(zoned | {"store_code": "AB-9"}), None, None), (1, 6, "absheron", d, json.dumps(zoned | {"store_code": None}), None, None), (2, 1, None, None, None, None, None), (2, 2, "baku_fresh", d, "x" * 2_000_000, None, None),
    ]
    out = classified(spark, data)
    assert out.count() == len(data)
    got = sorted((r.batch_id, r.row_num, r.error) for r in rejects.rejected(out).collect())
    assert got == [(1, 2, "impossible_time"), (1, 5, "unknown_store"), (1, 6, "unknown_store"), (2, 1, "unknown_source"), (2, 2, "malformed_json")]
    assert rejects.loaded(out).count() == 4
    assert [(r.batch_id, r.row_num) for r in quantities.old_price_not_above(out).collect()] == [(1, 4)]


def test_empty_table(spark):
    assert classified(spark, []).count() == 0
