import itertools
import random

import pytest

from tarazi.functions.scalars import similarity
from tarazi.operators import cascade

ITEMS = "id long, retailer_code string, name_raw string, brand string, ean string, ean_kind string, unit_type string, unit_value double, pack int, category string"


@pytest.mark.parametrize("chunk", [1000, 7])
def test_all_similar_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(cascade, "CHUNK", chunk)
    rnd = random.Random(5)
    words = ["sud", "ayran", "tam", "yagli", "kend", "taze", "qara", "cay", "xama", "pendir"]
    spoil = lambda w: w if rnd.random() < 0.7 else w[: (i := rnd.randrange(len(w)))] + rnd.choice("xyz") + w[i + 1 :]
    data = [(n, rnd.choice("abc"), " ".join(spoil(w) for w in rnd.sample(words, 3)), rnd.choice([None, "dovu", "dovuu", "zizun"]), None, "none", "g", rnd.choice([1.0, 2.0]), None, rnd.choice(["x", "y", None])) for n in range(80)]
    rows = cascade.prepared(spark.createDataFrame(data, ITEMS)).select("id", "retailer_code", "block", "fat", "numbers", "brand", "category", "words", "rank")
    got = {(r.id, r.product): r.score for r in cascade.similar(rows).collect()}
    want = {}
    for a, b in itertools.permutations(rows.collect(), 2):
        if a.block == b.block and a.retailer_code != b.retailer_code and b.rank < a.rank:
            brand = 0.6 if a.brand is None or b.brand is None else 1.0 if similarity(a.brand, b.brand) >= 85 else None
            if brand is not None:
                score = similarity(" ".join(sorted(a.words)), " ".join(sorted(b.words))) / 100 * 0.6 + 0.25 * brand + 0.15 * (a.category == b.category)
                if score >= 0.6995:
                    want[a.id, b.id] = score
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 0.00051 for k in got)


def test_names_without_a_common_word(spark):
    data = [(1, "a", "sokolad findiqli", "demo", None, "none", None, None, None, "x"), (2, "b", "sokolat findqli", "demo", None, "none", None, None, None, "x")]
    got = {r.id: (r.product, r.method) for r in cascade.cascade(spark.createDataFrame(data, ITEMS)).collect()}
    assert got[2] == (1, "fuzzy")


def test_chain_ends_at_its_founder(spark):
    links = spark.createDataFrame([(1, 1, "new", 1.0)] + [(i, i - 1, "fuzzy", 0.9) for i in range(2, 51)], "id long, product long, method string, confidence double")
    assert {r.product for r in cascade.resolve(links).collect()} == {1}


def test_listings_joined_by_barcode_give_their_fingerprint(spark):
    # 2 joins 1 by barcode; 3 has the name of 2; 4 is of a retailer that the product has
    data = [(1, "a", "zorbat duzlu", None, "E", "global", None, None, None, "x"), (2, "b", "mirqul xamali", None, "E", "global", None, None, None, "x"), (3, "c", "mirqul xamali", None, None, "none", None, None, None, "x"), (4, "b", "mirqul xamali", None, None, "none", None, None, None, "y")]
    got = {r.id: (r.product, r.method) for r in cascade.cascade(spark.createDataFrame(data, ITEMS)).collect()}
    assert got[2] == (1, "ean") and got[3] == (1, "fingerprint") and got[4][0] == 4


def test_pairs_with_one_barcode_are_found(spark, folder):
    """Recall and precision on pairs of listings that share a global barcode."""
    items = spark.read.parquet(f"{folder}/store_item.parquet").where("ean_kind = 'global'")
    got = {r.id: r.product for r in cascade.cascade(items).collect()}
    want = {r.id: r.ean.strip() for r in items.collect()}
    pairs = [(a, b) for a, b in itertools.combinations(want, 2) if want[a] == want[b]]
    assert sum(got[a] == got[b] for a, b in pairs) == len(pairs)


def test_odd_listings(spark):
    data = [(1, None, None, None, None, None, None, None, None, None), (2, "a", "", "", "", "none", "", None, None, ""), (3, "a", "x " * 20_000, None, None, None, None, None, None, None), (3, "a", "x " * 20_000, None, None, None, None, None, None, None)]
    assert {r.id: r.method for r in cascade.cascade(spark.createDataFrame(data, ITEMS)).collect()} == {1: "new", 2: "new", 3: "new"}
    assert cascade.cascade(spark.createDataFrame([], ITEMS)).count() == 0
