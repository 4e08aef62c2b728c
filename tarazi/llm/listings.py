"""Listings and registered products as terms: pure functions on one row's text."""

from __future__ import annotations

import re
import unicodedata
from decimal import Decimal
from functools import lru_cache

from tarazi.functions.units import _AMOUNT, _MULTI, number, read_unit, recorded_size, size_in_text

# Legal forms and words for no brand.
NO_BRAND = {"mmc", "asc", "llc", "no", "brand", "nobrand", "none", "yoxdur", "нет", "n", "a"}

_TOKEN = re.compile(r"\d+(?:[.,]\d+)?\s*%|(?<![^\W_])\d\s+[^\W\d_]{3,}|[^\W_]+")


# Cyrillic letters that look like a Latin one.
LOOKALIKES = str.maketrans("аеорсхуіѕјһкмтвнқг", "aeopcxyisjhkmtbhqr")
_MIXED = re.compile(r"[^\W\d_]*[a-z][^\W\d_]*")


def fold(text: str) -> str:
    """Lower case without diacritics; ə as a, ı as i, and Cyrillic look-alikes in a word with Latin letters as those."""
    t = text.replace("İ", "i").replace("I", "i").lower().replace("ı", "i").replace("ə", "a")
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    return _MIXED.sub(lambda m: m[0] if m[0].isascii() else m[0].translate(LOOKALIKES), t)


def _spans(name: str) -> str:
    """The name without sizes, numbers of pieces and bare units of weighed goods."""
    def gone(m: re.Match) -> str:
        u = read_unit(m[m.lastindex])
        return " " if u and u.dimension in ("mass", "volume", "count") else m[0]

    return _AMOUNT.sub(gone, _MULTI.sub(gone, name))


@lru_cache(maxsize=8192)
def tokens_of(name: str | None) -> tuple[str, ...]:
    """Folded words, percentages and codes of a name, without its size; a word broken by a hyphen is whole again.

    A lone digit belongs to the word after it (``3 qatli``).
    """
    if not name:
        return ()
    t = fold(_spans(name.replace("×", "x")))
    t = re.sub(r"(?<=[^\W\d_])[-‐](?=[^\W\d_])", "", t)
    return tuple(dict.fromkeys(re.sub(r"\s", "", x).replace(",", ".") for x in _TOKEN.findall(t)))


def whole_words(tokens, known) -> tuple[str, ...]:
    """Tokens with words put together that a stray blank broke; ``known`` tells whether a word belongs to the vocabulary."""
    out, i = [], 0
    while i < len(tokens):
        a, b = tokens[i], tokens[i + 1] if i + 1 < len(tokens) else None
        if b and a.isalpha() and b.isalpha() and not (known(a) and known(b)) and known(a + b):
            out.append(a + b)
            i += 2
            continue
        out.append(a)
        i += 1
    return tuple(dict.fromkeys(out))


def brand_tokens(brand: str | None) -> tuple[str, ...]:
    if not brand:
        return ()
    return tuple(w for w in re.findall(r"[^\W_]+", fold(brand).replace("-", "")) if w not in NO_BRAND and len(w) > 1)


def snapped(value: Decimal) -> Decimal:
    """A size to the nearest twentieth of its power of ten: 899.9 and 900.07 are 900."""
    step = Decimal(10) ** value.adjusted() / 20
    return ((value / step).to_integral_value() * step).normalize()


def size_key(name: str | None, value, unit: str | None, pack) -> tuple[str | None, int]:
    """Size of a piece (None unknown, bulk for weighed goods) and number of pieces; the name goes before the record."""
    named = size_in_text((name or "").replace("×", "x"))
    pieces = named.pack or (int(pack) if pack is not None and pack == pack else 1)
    if unit and fold(unit) == "kg_bulk":
        return "bulk", 1
    got = (named.value, named.unit) if named.value else recorded_size(value, unit)
    if not got or not got[0] or got[0] <= 0:
        return None, pieces
    return f"{snapped(Decimal(got[0])):f}{got[1]}", pieces


def gtin(ean: str | None) -> str | None:
    """A well-formed global barcode without outer blanks and leading zeros, None for in-store, malformed and missing ones."""
    if not ean:
        return None
    digits = ean.strip().split(".")[0].lstrip("0")
    if not digits.isdigit() or not 7 <= len(digits) <= 14 or digits[0] == "2" and len(digits) == 13:
        return None
    total = sum(int(d) * (3 if i % 2 == 0 else 1) for i, d in enumerate(reversed(digits[:-1])))
    return digits if (10 - total % 10) % 10 == int(digits[-1]) else None


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions, ``most`` + 1 where it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            v = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, older[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
    return row[-1]


def neighbours(word: str) -> set[str]:
    """The word and what is left of it without one letter: two words one edit apart share one of these."""
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}


__all__ = ["brand_tokens", "edits", "fold", "gtin", "neighbours", "number", "size_key", "snapped", "tokens_of", "whole_words"]
