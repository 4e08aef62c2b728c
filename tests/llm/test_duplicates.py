import pytest

from tarazi.llm import duplicates

PROFILE = "src string, id long, kind string, variant string, maker string, size string, pack int, ean string, extra array<string>"


def listings(spark, *rows):
    """Listings of (id, variant, maker, size, ean) of one kind."""
    return spark.createDataFrame([("i", i, "tea", v, m, s, 1, e, []) for i, v, m, s, e in rows], PROFILE)


def groups(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.cluster, set()).add(r.id)
    return sorted(map(sorted, out.values()))


def test_all_links_count(spark):
    # 1 and 2 lack the size, 3 to 5 the maker; 3 to 5 are the hub of the barcode and fit 6 alone
    rows = [(i, "black", "Dovu", None, "E") for i in (1, 2)] + [(i, "black", None, "100g", "E") for i in (3, 4, 5)] + [(6, "black", "Dovu", "100g", "F")]
    assert groups(duplicates.same_items(listings(spark, *rows))) == [[1, 2, 3, 4, 5, 6]]


@pytest.mark.parametrize("length", [2, 9])
def test_chain(spark, length):
    nodes = spark.createDataFrame([(f"n{i}", "tea", "black" if i == 0 else None, None, None, 1, 1) for i in range(length)] + [("z", "tea", "green", None, None, 1, 1)], "node string, kind string, variant string, maker string, size string, pack int, n long")
    links = spark.createDataFrame([(f"n{i}", f"n{i + 1}", 0.6 + i / 100) for i in range(length - 1)] + [(f"n{length - 1}", "z", 0.5)], "a string, b string, score double")
    got = {r.node: r.root for r in duplicates.components(nodes, links).collect()}
    assert len({got[f"n{i}"] for i in range(length)}) == 1 and got.get("z", "z") != got["n0"]


def test_equal_attributes_join_by_score(spark):
    # equal in all attributes, but the barcodes differ: a score below 1
    df = listings(spark, (1, "black", "Dovu", "100g", "E"), (2, "black", "Dovu", "100g", "F"), (3, "black", "Dovu", "100g", "F"))
    assert groups(duplicates.same_items(df)) == [[1, 2, 3]]
    assert groups(duplicates.same_items(df, threshold=0.999)) == [[1], [2, 3]]


def test_misplaced_hub_of_a_barcode(spark):
    # 1 is another product with the barcode of 2 to 5; 6 and 7 are a second product with it
    rows = [(1, "green", "Dovu", "100g", "E"), (2, "black", None, "250g", "E"), (3, "black", None, "250g", "E"), (4, "black", "Zizun", None, "E"), (5, "black", "Zizun", None, "E"), (6, "mint", None, "50g", "E"), (7, "mint", "Fipohe", None, "E")]
    assert groups(duplicates.same_items(listings(spark, *rows))) == [[1], [2, 3, 4, 5], [6, 7]]
