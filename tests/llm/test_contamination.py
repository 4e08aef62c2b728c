import random

from tarazi.llm import contamination

ITEM = "Inspectors sampled 637 lots of Rirükan and sealed 457 of them. Which supplier, Qazüvo or Malabe, breaks even after 526 deliveries? During Nefədön week the kiosk hands out 197 coupons worth 27.91 apiece."
OTHER = "Inspectors sampled 111 lots of Fenar and sealed 222 of them. Which supplier, Hutos or Qisi, breaks even after 333 deliveries? During Pucudul week the kiosk hands out 444 coupons worth 55.55 apiece."
ITEMS = [(1, ITEM), (2, OTHER), (3, ""), (4, None), (5, "short")] + [(10 + i, OTHER.replace("111", str(900 + i)).replace("Fenar", f"Maker{i}").replace("222", str(700 + i)).replace("333", str(500 + i))) for i in range(10)]
WORDS = ITEM.split()


def found(spark, docs, items=ITEMS):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    i = spark.createDataFrame(items, "item_id long, text string, doc_id string") if items and len(items[0]) == 3 else spark.createDataFrame(items, "item_id long, text string")
    return sorted((r.item_id, r.doc_id) for r in contamination.leaked(d, i).collect())


def test_passages(spark):
    part = " ".join(WORDS[5:22])
    changed = part.replace("supplier,", "vendor").replace("after", "aftr")
    docs = [
        (1, f"Before. {part} After all.", None), (2, part.upper().replace("Ü", "Ü"), None), (3, "<p>" + part.replace(" ", "</b>\n<b> ") + "</p>", None), (4, changed, None), (5, part.replace("o", "о").replace("a", "а"), None), (6, " ".join(WORDS[5:10]), None),
        (7, "Inspectors sampled 9 lots of Zilo and sealed 8 of them. Which supplier, Ab or Cd, breaks even after 7 deliveries? During Ef week the kiosk hands out 6 coupons worth 5.55 apiece.", None), (8, "", None), (9, None, None), (1, f"Before. {part} After all.", None),
        (10, "word " * 200_000 + part, None), (11, part.encode("ascii", "backslashreplace").decode().replace("\\xfc", "\\u00fc"), None),
    ]
    assert found(spark, docs) == [(1, n) for n in (1, 2, 3, 4, 5, 10, 11)]


def test_whole_items_with_rare_changes(spark):
    rnd = random.Random(1)
    docs, want = [], []
    for n in range(40):
        words = list(WORDS)
        start = rnd.randrange(len(words) - 16)
        words = words[start : start + 16]
        words[7] = "changed"
        docs.append((n, "Filler text here. " * rnd.randrange(5) + " ".join(words) + " and more of the same.", None))
        want.append((1, n))
    assert len(set(found(spark, docs)) & set(want)) >= 38


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = [(1, ITEM, None), (2, OTHER, None)]
    whole = found(spark, docs)
    monkeypatch.setattr(contamination, "BLOCK_WORDS", 40)
    assert found(spark, docs) == whole == [(1, 1), (2, 2)]


def test_empty(spark):
    assert found(spark, []) == []
    assert contamination.leaked(spark.createDataFrame([(1, "x")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_removal(spark):
    docs = spark.createDataFrame([(1, ITEM), (2, "clean")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert [r.doc_id for r in contamination.without_leaks(docs, contamination.leaked(docs, items)).collect()] == [2]
