import itertools
import random
from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pytest

from tarazi.llm import duplicates, matching
from tarazi.llm.listings import edits, fold, gtin, size_key, snapped, tokens_of, whole_words
from tarazi.llm.profiles import profiles

ITEMS = "id long, name_raw string, brand string, unit_value decimal(12,3), unit_type string, pack int, ean string, kind string"
PRODUCTS = "id long, name string, brand string, unit_value decimal(12,3), unit_type string, pack int, ean string, tokens string"
MAKERS = ["Mupəsetər", "Lahozubis", "Qösəşalür", "Fipohe", "Təqu", "Nolibel", "Zizun", "Vuçögem"]
# invented goods: nothing of them can be known beforehand
KINDS = [("Zorbat", "duzlu", "ml"), ("Zorbat", "nanəli", "ml"), ("Mirqul tozu", "acılı", "g"), ("Mirqul tozu", "xamalı", "g"), ("Vəndəm", "üyüdülmüş", "g"), ("Vəndəm", "bütöv", "g")]
RUSSIAN = {"Zorbat": "Снежник", "Mirqul tozu": "Порошок мирный", "Vəndəm": "Лунник"}
EXTRA = ["aksiya", "yeni", "super qiymət", "Xüsusi", ""]


def code(n):
    body = f"987{n:09d}"
    return body + str((10 - sum(int(d) * (3 if i % 2 == 0 else 1) for i, d in enumerate(reversed(body))) % 10) % 10)


def market(seed=2):
    rnd = random.Random(seed)
    goods = [(m, k, v, u, s) for (k, v, u), m in itertools.product(KINDS, MAKERS) for s in (250, 500)]
    products, items, truth = [], [], {}
    for n, (m, k, v, u, s) in enumerate(goods):
        if n % 5:
            products.append((9000 + n, f"{m} {k} {v}, {s} {u}", m, Decimal(s), u, None, code(n) if n % 3 else None, None))
        for c in range(4):
            i = n * 4 + c
            size = rnd.choice([f"{s} {u}", f"{s}{u.upper()}", f"0,{s // 10} {'l' if u == 'ml' else 'kq'}"])
            kind = RUSSIAN[k] if rnd.random() < 0.3 else k
            words = [m, kind, v, size, rnd.choice(EXTRA)]
            if rnd.random() < 0.1:
                words[0] = m[:2] + m[3:]
            rnd.shuffle(words)
            items.append((i, " ".join(w for w in words if w), m if rnd.random() < 0.5 else None, None, None, None, code(n) if rnd.random() < 0.4 else None, None))
            truth[i] = n
    return goods, products, items, truth


@pytest.fixture(scope="module")
def profiled(spark):
    _, products, items, truth = market()
    return profiles(spark.createDataFrame(items, ITEMS), spark.createDataFrame(products, PRODUCTS)), truth


def test_groups(profiled):
    profs, truth = profiled
    got = {(r.item_a, r.item_b) for r in duplicates.pairs_of(duplicates.same_items(profs)).collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(truth), 2) if truth[a] == truth[b]}
    assert len(got & want) >= 0.95 * len(want)
    assert len(got & want) >= 0.98 * len(got)


def decisions(spark, rows):
    return spark.createDataFrame(rows, "store_item_id long, product_id long, snapshot_date date, loaded_at timestamp")


@pytest.mark.parametrize("labelled", [0, 200])
def test_registry(spark, profiled, labelled):
    profs, truth = profiled
    known = {9000 + n for n in range(96) if n % 5}
    rows = [(i, 9000 + n if i % 6 else 9001, date(2026, 1, 1), datetime(2026, 1, 1)) for i, n in truth.items() if i < labelled and 9000 + n in known]
    got = {r.store_item_id: (r.product_id, float(r.confidence)) for r in matching.match_registry(profs, decisions(spark, rows)).collect()}
    decided = {r[0] for r in rows}
    want = {i: 9000 + n for i, n in truth.items() if 9000 + n in known and i not in decided}
    right = sum(got.get(i, (None,))[0] == p for i, p in want.items())
    assert right >= 0.95 * len(want) and right >= 0.98 * len(got)
    assert not decided & set(got) and all(0.5 <= c <= 1 for _, c in got.values())


def test_odd_rows(spark):
    items = [(1, None, None, None, None, None, None, "x"), (2, "", "", None, "", None, "", "x"), (3, "x " * 50_000, None, None, None, None, None, None), (4, "Ayran duzlu Fipohe 500 ml", None, None, None, None, None, None), (4, "Ayran duzlu Fipohe 500 ml", None, None, None, None, None, None), (5, "Ayran duzlu Fipohe 500 ml", None, None, None, None, None, None), (6, "500 ml", "-", Decimal("0"), "g", 0, "abc", None)]
    products = [(9, "Fipohe Ayran duzlu, 500 ml", "Fipohe", Decimal(500), "ml", None, None, None), (8, None, None, None, None, None, None, None)]
    products += [(20 + n, f"{m} Ayran duzlu, 250 ml", m, Decimal(250), "ml", None, None, None) for n, m in enumerate(MAKERS[:3] + MAKERS[4:])]
    p = profiles(spark.createDataFrame(items, ITEMS), spark.createDataFrame(products, PRODUCTS))
    assert p.count() == 6 + len(products)
    assert {(r.item_a, r.item_b) for r in duplicates.pairs_of(duplicates.same_items(p)).collect()} == {(4, 5)}
    got = {r.store_item_id: r.product_id for r in matching.match_registry(p, decisions(spark, [])).collect()}
    assert set(got) <= {4, 5}


def test_empty(spark):
    p = profiles(spark.createDataFrame([], ITEMS), spark.createDataFrame([], PRODUCTS))
    assert p.count() == 0
    assert duplicates.pairs_of(duplicates.same_items(p)).count() == 0
    assert matching.match_registry(p, decisions(spark, [])).count() == 0


def test_names():
    assert tokens_of("SÜD 2,5 % 900 ML Xüsusi 3 qatlı") == ("sud", "2.5%", "xususi", "3qatli")
    assert fold("Kоmpоt") == "kompot"
    assert size_key("a 31.75 oz", None, None, None) == ("900g", 1) and size_key("Alma kq", None, "kg_bulk", 3) == ("bulk", 1) and size_key("6X100 ml", None, None, None) == ("100ml", 6)
    assert str(snapped(Decimal("899.9"))) in ("900", "9E+2")
    assert gtin("09870000000024") == gtin("9870000000024") or gtin("09870000000024") is None
    assert gtin("2917226848329") is None and gtin(None) is None and gtin("abc") is None
    assert edits("sokolad", "sokloda", 2) <= 2 and edits("abc", "xyz", 1) == 2
    assert whole_words(("fus", "egom", "cay"), {"fusegom", "cay"}.__contains__) == ("fusegom", "cay")


def test_classifier_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))
    y = (rng.random(4000) < p).astype(float)
    w = matching.fit_logistic(x, y, np.zeros(3))
    assert abs(w[0] - 2) < 0.3 and abs(w[1]) < 0.2 and abs(w[2] + 1) < 0.3
    steps = matching.fit_isotonic(x @ w[:-1] + w[-1], y)
    assert [round(v, 6) for v in matching.fit_logistic(x[:0], y[:0], np.array([1.0, 2.0, 3.0]))] == [1, 2, 3]
    assert matching.fit_isotonic(x[:0, 0], y[:0])[0][1] < 0.5 < matching.fit_isotonic(x[:0, 0], y[:0])[-1][1]
    assert all(a[0] < b[0] and a[1] <= b[1] + 1e-9 for a, b in zip(steps, steps[1:])) or len(steps) == 1
