from decimal import Decimal

import pytest

from tarazi.functions.units import money_in_text, read_unit, recorded_size, size_in_text


@pytest.mark.parametrize(
    ("text", "dimension", "scale"),
    [("kq", "mass", 1000), ("кг", "mass", 1000), ("cl", "volume", 10), ("qr", "mass", 1), ("мл", "volume", 1), ("sm3", "volume", 1), ("m³", "volume", 1000000), ("Lİ", "count", 1), ("ŞT", "count", 1), ("qrаm", "mass", 1), ("litr", "volume", 1000)],
)
def test_decompositions(text, dimension, scale):
    u = read_unit(text)
    assert (u.dimension, u.scale) == (dimension, scale)


def test_priors_decide_ambiguous_units():
    assert read_unit("q", "size").dimension == "mass"
    assert read_unit("q", "price").dimension == "money"


@pytest.mark.parametrize("text", ["", None, "qatlı", "ci", "kg_bulk", "x" * 500, "kk", "km2g"])
def test_no_unit(text):
    assert read_unit(text) is None


@pytest.mark.parametrize(
    ("name", "value", "unit", "pack"),
    [
        ("Diş pastası 6 X 100 ML nanə", 100, "ml", 6), ("Yumurta C1 30əd.", 30, "pcs", None), ("Batareya 2025 2-lu", 2, "pcs", None), ("Su 1,5 L", 1500, "ml", None), ("Salfet 3 qatlı 72 ŞT", 72, "pcs", None),
        ("Süd 2,5 % 900 ML", 900, "ml", None), ("Şokolad tünd 72%", None, None, None), ("Milla 200qr", 200, "g", None), ("", None, None, None), (None, None, None, None),
    ],
)
def test_sizes_in_names(name, value, unit, pack):
    assert size_in_text(name) == (value, unit, pack)


def test_ounces():
    assert abs(size_in_text("jam 22.93oz").value - 650) < Decimal("0.1")


@pytest.mark.parametrize(("value", "unit", "want"), [("0.5", "kq", (500, "g")), ("0", "g", None), (None, "g", None), ("1", None, None), ("1", "kg_bulk", None)])
def test_recorded(value, unit, want):
    assert recorded_size(None if value is None else Decimal(value), unit) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("3 man 05 qəp", 305), ("9,26 AZN", 926), ("₼8.64", 864), ("AZN 3.70", 370), ("285 qəp", 285), (" 4.13 ", 413), ("-0.29", -29), ("0.005", 1), ("12", 1200), ("1.2.3", None), ("-", None), ("NaN", None), ("zəng edin", None), ("#REF!", None), ("", None), ("5 kg", None), ("5 6", None)],
)
def test_money(text, want):
    assert money_in_text(text) == want


def test_unmarked_unit_of_a_source():
    assert money_in_text("443", "qəpik") == 443
    assert money_in_text("3.55 AZN", "qəpik") == 355
