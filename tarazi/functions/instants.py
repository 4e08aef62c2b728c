"""Time texts read as UTC instants: every reading that a text allows, in order of preference."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from decimal import Decimal, InvalidOperation
from functools import lru_cache
from zoneinfo import ZoneInfo

# Month names by their first letters in Azerbaijani, English and Russian.
MONTHS = {
    "yan": 1, "fev": 2, "mar": 3, "apr": 4, "may": 5, "iyn": 6, "iyun": 6, "iyl": 7, "iyul": 7, "avq": 8, "sen": 9, "okt": 10, "noy": 11, "dek": 12,
    "jan": 1, "feb": 2, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
    "янв": 1, "фев": 2, "мар": 3, "апр": 4, "май": 5, "мая": 5, "июн": 6, "июл": 7, "авг": 8, "сен": 9, "окт": 10, "ноя": 11, "дек": 12,
}
# Zone abbreviations with their offset in minutes.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "met": 60, "mest": 120, "eet": 120, "eest": 180,
    "msk": 180, "trt": 180, "azt": 240, "azst": 300, "est": -300, "edt": -240,
}
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
#: Epoch numbers are read as seconds, milliseconds, microseconds or nanoseconds by these numbers of integer digits.
EPOCH_SCALE = {9: 10**6, 10: 10**6, 11: 10**6, 12: 10**3, 13: 10**3, 14: None, 15: 1, 16: 1, 18: Decimal("0.001"), 19: Decimal("0.001")}

_CLOCK = r"(?P<H>\d{1,2})[:.](?P<M>\d{2})(?:[:.](?P<S>\d{2})(?:[.,](?P<f>\d{1,9}))?)?\s*(?P<ap>[AaPp]\.?[Mm]\.?)?"
_ZONE = r"\s*(?P<z>Z|(?:(?:GMT|UTC)\s*)?[+-]\d{1,2}(?::?\d{2})?|[A-Za-z]{1,5})?\s*(?:\[(?P<iana>[A-Za-z_]+(?:/[A-Za-z_+\-0-9]+)*)\])?"
_WEEKDAY = r"(?:[^\W\d_]{2,12}\.?,\s*)?"
_PATTERNS = [
    re.compile(p + r"\s*$")
    for p in (
        rf"^\s*(?P<Y>\d{{4}})[-/.](?P<m>\d{{1,2}})[-/.](?P<d>\d{{1,2}})(?:[T\s]+{_CLOCK}{_ZONE})?",
        rf"^\s*(?P<Y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})[T\s]?(?P<H>\d{{2}})(?P<M>\d{{2}})(?P<S>\d{{2}})?(?:[.,](?P<f>\d{{1,9}}))?(?P<ap>\b\B)?{_ZONE}",
        rf"^\s*{_WEEKDAY}(?P<d>\d{{1,2}})[\s\-./]+(?P<mon>[^\W\d_]{{3,9}})\.?[\s\-./]+(?P<Y>\d{{4}})(?:,?\s+{_CLOCK}{_ZONE})?",
        rf"^\s*(?P<a>\d{{1,2}})(?P<sep>[./-])\s?(?P<b>\d{{1,2}})(?P=sep)\s?(?P<Y>\d{{4}}|\d{{2}})(?:,?\s+{_CLOCK}{_ZONE})?",
    )
]


@lru_cache(maxsize=64)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except Exception:
        return None


def _micros(dt: datetime) -> int:
    return (dt - EPOCH) // timedelta(microseconds=1)


def _offset(z: str) -> timedelta | None:
    z = z.strip().lower()
    if z in ABBREVIATIONS:
        return timedelta(minutes=ABBREVIATIONS[z])
    m = re.match(r"^(?:gmt|utc)?\s*([+-])(\d{1,2}):?(\d{2})?$", z)
    if not m or int(m[2]) > 14 or int(m[3] or 0) > 59:
        return None
    d = timedelta(hours=int(m[2]), minutes=int(m[3] or 0))
    return -d if m[1] == "-" else d


def _build(m: re.Match, month: int, day: int, zone: ZoneInfo | None) -> int | None:
    g = m.groupdict()
    year = int(g["Y"])
    year += 2000 if year < 100 else 0
    hour, ap = int(g.get("H") or 0), (g.get("ap") or "").lower()[:1]
    if ap:
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if ap == "p" else 0)
    frac = ((g.get("f") or "") + "000000")[:6]
    try:
        local = datetime(year, month, day, hour, int(g.get("M") or 0), int(g.get("S") or 0), int(frac))
    except ValueError:
        return None
    if g.get("z"):
        off = _offset(g["z"])
        if off is None:
            return None
        return _micros((local - off).replace(tzinfo=timezone.utc))
    where = _zone(g["iana"]) if g.get("iana") else zone
    if where is None:
        return None
    return _micros(local.replace(tzinfo=where).astimezone(timezone.utc))


def readings(text: str, zone: str | None) -> list[int]:
    """Every instant, in microseconds since 1970 UTC, that a time text can mean.

    An offset, a zone abbreviation or a zone name in the text goes before ``zone``, the zone
    of the feed.  A text without a zone in a feed without one has no reading.  A local time
    that the clocks skip is read with the offset before the change, one that occurs twice as
    the first.  Dates with slashes or dots give the day-first reading and, where it differs and
    is possible, the month-first reading; with a 12-hour clock the month-first one comes first.
    The caller decides by what it knows of the row.  Impossible texts give an empty list.
    """
    s = text.strip()
    if re.fullmatch(r"[+-]?\d+(?:\.\d+)?(?:[Ee][+-]?\d+)?", s):
        epoch = _epoch(s)
        if epoch is not None:
            return [epoch]
    where = _zone(zone) if zone else None
    for p in _PATTERNS:
        m = p.match(s)
        if not m:
            continue
        g = m.groupdict()
        if g.get("mon"):
            name = g["mon"].replace("İ", "i").lower()
            month = MONTHS.get(name[:4]) or MONTHS.get(name[:3])
            got = [_build(m, month, int(g["d"]), where)] if month else []
        elif g.get("a"):
            a, b = int(g["a"]), int(g["b"])
            orders = [(b, a), (a, b)]
            if g["sep"] != "/":
                orders = orders[:1]
            elif g.get("ap"):
                orders.reverse()
            got = [_build(m, mo, da, where) for mo, da in dict.fromkeys(orders)]
        else:
            got = [_build(m, int(g["m"]), int(g["d"]), where)]
        got = [x for x in got if x is not None]
        if got:
            return list(dict.fromkeys(got))
    return []


def _epoch(s: str) -> int | None:
    try:
        d = Decimal(s)
    except InvalidOperation:
        return None
    if d <= 0 or d.adjusted() > 20:
        return None
    scale = EPOCH_SCALE.get(d.adjusted() + 1)
    return int(d * scale) if scale is not None else None
