import pytest

from tarazi.llm import queries

COLUMNS = {"p5_found": ["store_item_id", "product_id"], "p7_found": ["item_a", "item_b"], "p8_ids": ["doc_id", "ids"], "p9_found": ["item_id", "doc_id"], "p10_found": ["doc_id"]}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, folder, name):
    df = queries.QUERIES[name](spark, folder)
    assert df.columns == COLUMNS.get(name, df.columns)
    assert df.count() >= 0
