"""Landed records read strictly: structure first, typed fields after it.

Pure Python, called once per Arrow batch inside ``mapInPandas``.
"""

from __future__ import annotations

import csv
import json
import sys
from decimal import Decimal

from tarazi.functions.units import money_in_text

#: Paths of the fields that are read, by source.  A CSV source has positions.
LAYOUTS = {
    "baku_fresh": {"sku": "sku", "name": "title", "brand": "brand", "ean": "barcode", "category_raw": "cat", "price": "price", "old_price": "was", "available": "in_stock", "time": "scraped_at"},
    "caspianmart": {"sku": "id", "name": "name", "ean": "ean", "category_raw": "category_path", "price": "current_price_qepik", "old_price": "regular_price_qepik", "available": "stock", "time": "ts"},
    "absheron": {"sku": "item_code", "name": "description", "brand": "brand", "ean": "gtin", "category_raw": "cat_id", "price": "price_azn", "old_price": "old_price_azn", "available": "available", "time": "updated", "store_code": "store_code", "promo_until": "promo_end"},
    "shirvan": {"sku": 0, "name": 1, "brand": 2, "ean": 3, "category_raw": 4, "price": 5, "old_price": 6, "available": 7, "time": 8},
    "sumqayit": {"sku": "product.code", "name": "product.name", "brand": "product.brand", "ean": "product.barcode", "category_raw": "product.group", "price": "offer.price", "old_price": "offer.strike_price", "available": "offer.in_stock", "time": "meta.fetched"},
}
#: The unit of money that a source leaves unmarked; AZN elsewhere.
UNMARKED_MONEY = {"caspianmart": "qəpik"}
#: The fields without which a record does not load.
REQUIRED = ("sku", "name", "price", "old_price", "time", "store_code")
CSV_FIELDS = 9
#: White space of str.strip and characters without width.
BLANK = " \t\r\n\v\f\x1c\x1d\x1e\x1f\x85\xa0                　​‌‍⁠﻿"


#: The largest amount that a column holds.
MOST = 2**63 - 1
csv.field_size_limit(sys.maxsize)  # a long field is no broken one


class Malformed(ValueError):
    """A structural failure; its text is the reason."""


def assemble_records(lines):
    """Physical lines to logical CSV records: a line break inside quotes continues the record.

    An unclosed quote keeps the rest of the input in one record, which then fails in the
    strict reader.
    """
    held: list[str] = []
    open_quote = False
    for line in lines:
        held.append(line)
        open_quote ^= line.count('"') % 2 == 1
        if not open_quote:
            yield "\n".join(held)
            held = []
    if held:
        yield "\n".join(held)


def csv_record(payload: str) -> list[str]:
    """The nine fields of one CSV record."""
    body = payload.rstrip("\r\n")
    records = list(assemble_records(body.split("\n")))
    if len(records) != 1:
        raise Malformed("several_records")
    try:
        rows = [r for r in csv.reader(records[0].splitlines(keepends=True), strict=True)]
    except csv.Error as e:
        raise Malformed("broken_quoting") from e
    if len(rows) != 1:
        raise Malformed("several_records" if rows else "empty_record")
    if len(rows[0]) != CSV_FIELDS:
        raise Malformed(f"field_count:{len(rows[0])}")
    return rows[0]


def _not_json(_):
    raise Malformed("malformed_json")


def json_object(payload: str) -> dict:
    """The one JSON object of a payload; numbers keep their written digits."""
    try:
        o = json.loads(payload, parse_float=Decimal, parse_int=Decimal, parse_constant=_not_json)
    except (ValueError, RecursionError) as e:
        raise Malformed("malformed_json") from e
    if not isinstance(o, dict):
        raise Malformed("not_an_object")
    return o


_MISSING = object()


def _at(obj, path: str):
    for key in path.split("."):
        if not isinstance(obj, dict):
            return _MISSING
        obj = obj.get(key, _MISSING)
    return obj


def text_of(value) -> str | None:
    """A scalar as text, None for null; objects and lists are no text and give their JSON."""
    if value is None or value is _MISSING:
        return None
    if isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, Decimal):
        return format(value, "f") if abs(value.adjusted()) < 40 else str(value)
    return json.dumps(value, default=str, ensure_ascii=False)


def clean(value) -> str | None:
    t = text_of(value)
    t = t.strip(BLANK) if t is not None else None
    return t or None


def money_of(value, unmarked: str) -> int | None:
    """Qepik of a JSON or CSV value; booleans, objects and lists are no money."""
    if value is None or isinstance(value, (bool, dict, list)):
        return None
    t = clean(value)
    return money_in_text(t, unmarked) if t else None


COLUMNS = ("sku", "name", "brand", "ean", "category_raw", "price_qepik", "old_price_qepik", "old_price_text", "available", "store_code", "promo_until", "time_text", "error")


def parse_payload(source: str | None, payload: str | None) -> tuple:
    """One landed record as the values of COLUMNS.

    ``error`` is null for a record whose structure and typed fields are right, else the first
    reason: malformed_json, not_an_object, broken_quoting, several_records, empty_record,
    field_count:N, missing_object or missing_field:NAME, unknown_source, missing_payload,
    missing_sku, missing_name, missing_price, invalid_price, nonpositive_price, amount_out_of_range.  Times and
    store codes are checked against other tables by the operator.
    """
    out: dict = dict.fromkeys(COLUMNS)
    try:
        layout = LAYOUTS.get(source)
        if layout is None:
            raise Malformed("unknown_source")
        if payload is None:
            raise Malformed("missing_payload")
        if source == "shirvan":
            row = csv_record(payload)
            got = {k: row[i] for k, i in layout.items()}
        else:
            o = json_object(payload)
            got = {k: _at(o, p) for k, p in layout.items()}
            for k in REQUIRED:
                if k in layout and got[k] is _MISSING:
                    raise Malformed(f"missing_field:{layout[k]}")
        unmarked = UNMARKED_MONEY.get(source, "azn")
        for k in ("sku", "name", "brand", "ean", "category_raw", "store_code", "promo_until"):
            out[k] = clean(got.get(k))
        out["time_text"] = clean(got["time"])
        out["available"] = _available(source, got.get("available"))
        out["price_qepik"] = money_of(got["price"], unmarked)
        out["old_price_text"] = clean(got["old_price"])
        out["old_price_qepik"] = money_of(got["old_price"], unmarked)
        for k in ("sku", "name"):
            if out[k] is None or isinstance(got[k], (dict, list, bool)):
                raise Malformed(f"missing_{k}")
        if clean(got["price"]) is None:
            raise Malformed("missing_price")
        if out["price_qepik"] is None:
            raise Malformed("invalid_price")
        if out["price_qepik"] <= 0:
            raise Malformed("nonpositive_price")
        if out["price_qepik"] > MOST or abs(out["old_price_qepik"] or 0) > MOST:
            raise Malformed("amount_out_of_range")
    except Malformed as e:
        out["error"] = str(e)
    return tuple(out[c] for c in COLUMNS)


def _available(source: str, value) -> bool | None:
    if value is _MISSING:
        return None
    if source == "shirvan":
        t = clean(value)
        return True if t is None else t.upper() == "Y"
    if source == "caspianmart":
        return isinstance(value, Decimal) and value > 0
    return bool(value)
