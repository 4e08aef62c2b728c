"""Unit strings read by dynamic programming over tries.

A unit string such as ``кг``, ``kq``, ``cl``, ``sm3`` or ``qəp.`` is cut into
``[prefix] root [exponent]``.  Three tries hold the known prefixes, roots and exponents;
the dynamic program walks the string once, keeps the best score of every reachable
(position, state), and so finds the best of all decompositions.  The score of a root holds
the prior of its dimension for the field at hand: a bare ``q`` is a gram in a size and a
qepik in a price.  Results are scaled to the base units g, ml, pcs and qepik.
"""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation, localcontext
from functools import lru_cache
from typing import NamedTuple

# SI prefixes as written in Azerbaijani, Russian and English.
PREFIXES = {
    "k": "1000", "kilo": "1000", "к": "1000", "кило": "1000",
    "m": "0.001", "milli": "0.001", "mili": "0.001", "м": "0.001", "милли": "0.001", "мили": "0.001",
    "c": "0.01", "s": "0.01", "santi": "0.01", "centi": "0.01", "с": "0.01", "санти": "0.01",
    "d": "0.1", "desi": "0.1", "deci": "0.1", "д": "0.1", "деци": "0.1",
    "h": "100", "hekto": "100", "г": "100", "гекто": "100",
    "µ": "0.000001", "mk": "0.000001", "мк": "0.000001", "mikro": "0.000001",
}
# Roots by dimension, each with its size in the base unit of the dimension.
ROOTS = {
    "mass": {
        "1": ["g", "gr", "gram", "gramm", "grams", "q", "qr", "qram", "г", "гр", "грамм", "грамма", "граммов"],
        "28.349523125": ["oz", "ounce", "unsiya", "унция", "унц"],
        "453.59237": ["lb", "lbs", "pound", "pounds", "funt", "фунт"],
        "1000000": ["t", "ton", "tonn", "т", "тонна"],
    },
    "volume": {
        "1000": ["l", "lt", "ltr", "litr", "liter", "litre", "liters", "litres", "л", "лт", "литр", "литра", "литров"],
        "29.5735295625": ["floz", "fl.oz"],
        "3785.411784": ["gal", "gallon"],
    },
    "count": {
        "1": ["pcs", "pc", "piece", "pieces", "əd", "ədəd", "ed", "eded", "ad", "adad", "шт", "штук", "штуки", "şt", "st", "pk",
              "lu", "lü", "lı", "li", "luq", "lıq"],
    },
    "money": {
        "100": ["azn", "man", "manat", "ман", "манат", "маната", "манатов", "₼", "азн"],
        "1": ["qəp", "qəpik", "qep", "qepik", "qapik", "гяп", "гяпик", "гяпиков", "коп", "q"],
    },
    "length": {"1": ["m", "metr", "meter", "metre", "м", "метр"]},
}
# How exponents are written.
EXPONENTS = {"2": 2, "²": 2, "^2": 2, "kv": 2, "кв": 2, "3": 3, "³": 3, "^3": 3, "kub": 3, "куб": 3}
# Log priors of each dimension by field.
PRIORS = {
    "size": {"mass": 0.0, "volume": 0.0, "count": -0.5, "money": -8.0, "length": -6.0, "area": -6.0},
    "price": {"money": 0.0, "mass": -8.0, "volume": -8.0, "count": -8.0, "length": -8.0, "area": -8.0},
}
PREFIXABLE = {"1": {"g", "gr", "gram", "gramm", "q", "qr", "qram", "г", "гр", "грамм", "грамма", "граммов", "m", "metr", "meter", "metre", "м", "метр"}}
PREFIX_COST, EXPONENT_COST, IMPOSSIBLE = -0.4, -0.2, -7.0


class Unit(NamedTuple):
    """A decomposition: its dimension, size in the base unit, and score."""

    dimension: str
    scale: Decimal
    score: float


def _trie(entries: dict) -> dict:
    root: dict = {}
    for word, value in entries.items():
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node.setdefault("", []).append(value)
    return root


def _root_entries() -> dict:
    out: dict = {}
    for dim, sizes in ROOTS.items():
        for scale, words in sizes.items():
            for w in words:
                out.setdefault(w, []).append((dim, Decimal(scale), _takes_prefix(dim, scale, w)))
    return out


def _takes_prefix(dim: str, scale: str, word: str) -> bool:
    return dim == "volume" and scale == "1000" or dim in ("mass", "length") and word in PREFIXABLE.get(scale, ())


_PREFIX_TRIE = _trie({k: Decimal(v) for k, v in PREFIXES.items()})
_ROOT_TRIE = _trie(_root_entries())
_EXP_TRIE = _trie(EXPONENTS)


def _walk(trie: dict, text: str, start: int):
    node = trie
    for i in range(start, len(text)):
        node = node.get(text[i])
        if node is None:
            return
        for value in node.get("", ()):
            yield i + 1, value


# Cyrillic letters that look like a Latin one, for units that mix both.
LOOKALIKES = str.maketrans("аеорсхуіѕјкмтнг", "aeopcxyisjkmtng")
_LATIN = re.compile("[a-z]")


def fold(text: str) -> str:
    """Lower case with the dotted and dotless i of Azerbaijani kept apart from a combining dot."""
    return text.replace("İ", "i").replace("I", "ı" if re.search("[ƏəÇçŞşĞğÖöÜü]", text) else "i").lower()


@lru_cache(maxsize=65536)
def read_unit(text: str, field: str = "size") -> Unit | None:
    """Best decomposition of a unit string, None if there is none.

    ``field`` is ``size`` or ``price`` and sets the priors.  Dots, blanks and hyphens around
    the unit do not count.  Null, empty and unknown strings give None.
    """
    if not text:
        return None
    s = re.sub(r"[\s ]+", "", fold(text)).strip(".,-–_")
    if not s:
        return None
    if _LATIN.search(s):
        s = s.translate(LOOKALIKES)
    prior = PRIORS[field]
    # best[(position, state)] = (score, dimension, scale, takes prefix); states: 0 start, 1 after prefix, 2 after root, 3 after exponent
    best: dict = {(0, 0): (0.0, None, Decimal(1))}
    for pos in range(len(s)):
        for state in (0, 1, 2):
            here = best.get((pos, state))
            if here is None:
                continue
            score, dim, scale = here
            if state == 0:
                for end, factor in _walk(_PREFIX_TRIE, s, pos):
                    _keep(best, (end, 1), (score + PREFIX_COST, None, factor))
            if state < 2:
                for end, meanings in _walk(_ROOT_TRIE, s, pos):
                    for d, size, prefixable in meanings:
                        if state == 1 and not prefixable:
                            continue
                        _keep(best, (end, 2), (score + prior[d], d, scale * size))
            if state == 2 and dim == "length":
                for end, power in _walk(_EXP_TRIE, s, pos):
                    d = "area" if power == 2 else "volume"
                    size = scale**power * (Decimal(1000000) if power == 3 else 1)  # a cubic metre is 1,000,000 ml
                    _keep(best, (end, 3), (score - prior["length"] + prior[d] + EXPONENT_COST, d, size))
    ends = [best[k] for k in ((len(s), 2), (len(s), 3)) if k in best]
    if not ends:
        return None
    score, dim, scale = max(ends, key=lambda e: e[0])
    return Unit(dim, scale, score) if score > IMPOSSIBLE else None


def _keep(best: dict, key: tuple, value: tuple) -> None:
    if key not in best or best[key][0] < value[0]:
        best[key] = value


BASE = {"mass": "g", "volume": "ml", "count": "pcs"}
_NUM = r"\d+(?:[.,]\d+)?"
_LETTERS = r"[^\W\d_]+"
_MULTI = re.compile(rf"(?<![\w.,])(\d+)\s*[xх*×]\s*({_NUM})\s*(fl\.?\s*oz|{_LETTERS})(?:[23²³]\b)?", re.I)
_AMOUNT = re.compile(rf"(?<![\w.,])({_NUM})\s*-?\s*(fl\.?\s*oz|{_LETTERS}[²³]?)", re.I)
_PACK_SUFFIX = re.compile(r"^(lu|lü|lı|li|luq|lıq|pk)$")


_CHAIN = re.compile(rf"{_NUM}((?:\s*[xх×]\s*{_NUM})+)\s*({_LETTERS})?", re.I)


def bare_of_dimensions(name: str) -> str:
    """A name without lengths joined by x: three numbers or more, or two with a unit of length."""
    def gone(m: re.Match) -> str:
        unit = read_unit(m[2]) if m[2] else None
        return " " if len(re.findall(_NUM, m[1])) > 1 or unit is not None and unit.dimension == "length" else m[0]

    return _CHAIN.sub(gone, name)


def bare_of_sizes(name: str) -> str:
    """A name without its sizes and numbers of pieces."""
    def gone(m: re.Match) -> str:
        unit = read_unit(m[m.lastindex])
        return " " if unit is not None and unit.dimension in BASE else m[0]

    return _AMOUNT.sub(gone, _MULTI.sub(gone, name))


def is_bare_kilogram(word: str) -> bool:
    """Whether a word is the unit of goods sold by weight."""
    unit = read_unit(word)
    return unit is not None and unit.dimension == "mass" and unit.scale == 1000


class Size(NamedTuple):
    """A size of one piece in a base unit (g, ml, pcs) and the number of pieces."""

    value: Decimal | None
    unit: str | None
    pack: int | None


def number(text: str) -> Decimal | None:
    """A decimal with point or comma; None if the text is no number."""
    try:
        d = Decimal(text.strip().replace(",", "."))
    except (InvalidOperation, AttributeError):
        return None
    return d if d.is_finite() else None


@lru_cache(maxsize=16384)
def size_in_text(name: str | None) -> Size:
    """The size of one piece that a product name states.

    ``6X100 ML`` states a piece of 100 ml and six pieces.  A mass or volume goes before a
    count; ``10-lu`` beside a mass or volume is the number of pieces.  Percentages, model
    numbers and words that merely follow a number are no sizes.  Null and empty names, and
    names without a size, give an empty Size.
    """
    if not name:
        return Size(None, None, None)
    m = _MULTI.search(name)
    if m:
        u = read_unit(m[3])
        if u and u.dimension in BASE:
            return Size(number(m[2]) * u.scale, BASE[u.dimension], int(m[1]))
    measures, counts, packs = [], [], []
    for m in _AMOUNT.finditer(name):
        u = read_unit(m[2])
        if u is None or u.dimension not in BASE:
            continue
        v = number(m[1]) * u.scale
        if u.dimension == "count":
            (packs if _PACK_SUFFIX.match(fold(m[2])) else counts).append(v)
        else:
            measures.append((v, BASE[u.dimension]))
    if measures:
        pieces = (packs or counts)[:1]
        return Size(measures[-1][0], measures[-1][1], int(pieces[0]) if pieces else None)
    if counts or packs:
        return Size((counts or packs)[-1], "pcs", None)
    return Size(None, None, None)


def recorded_size(value, unit: str | None) -> tuple[Decimal, str] | None:
    """A recorded value and unit in a base unit; None if either is missing, unknown or not above zero."""
    if value is None or not unit:
        return None
    u = read_unit(unit)
    if u is None or u.dimension not in BASE:
        return None
    v = Decimal(value) * u.scale
    return (v, BASE[u.dimension]) if v > 0 else None


_MONEY_PARTS = re.compile(r"([-+]?\s*(?:\d{1,3}(?:\s\d{3})+(?!\d)|\d+)(?:[.,]\d+)?)|([^\d\s.,+-]+(?:\.(?!\d))?)")


@lru_cache(maxsize=65536)
def money_in_text(text: str, default_unit: str = "azn") -> int | None:
    """An amount of money in qepik, rounded half up; None if the text states none.

    ``3 man 05 qəp`` adds its parts.  A currency mark before or after the number goes before
    ``default_unit``.  Letters that are no currency, two numbers without marks, and numbers
    that are malformed (``1.2.3``) give None.
    """
    s = text.strip()
    if not s:
        return None
    with localcontext() as context:
        context.prec = max(context.prec, len(s) + 10)  # all digits count, however many
        return _money(s, default_unit)


def _money(s: str, default_unit: str) -> int | None:
    numbers: list = []
    marks: list = []
    pos = 0
    order = []
    while pos < len(s):
        if s[pos].isspace():
            pos += 1
            continue
        m = _MONEY_PARTS.match(s, pos)
        if not m:
            return None
        if m[1]:
            raw = re.sub(r"[\s ]+", "", m[1])
            d = number(raw)
            if d is None:
                return None
            numbers.append(d)
            order.append("n")
        else:
            u = read_unit(m[2], "price")
            if u is None or u.dimension != "money":
                return None
            marks.append(u.scale)
            order.append("m")
        pos = m.end()
    shape = "".join(order)
    if shape == "n":
        scale = read_unit(default_unit, "price").scale
        total = numbers[0] * scale
    elif shape in ("nm", "mn"):
        total = numbers[0] * marks[0]
    elif shape == "nmnm" and marks[0] > marks[1]:
        sign = -1 if numbers[0] < 0 else 1
        total = numbers[0] * marks[0] + sign * numbers[1] * marks[1]
    else:
        return None
    return int(total.quantize(Decimal(1), rounding=ROUND_HALF_UP))
