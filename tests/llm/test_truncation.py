import random

from tarazi.llm import truncation

SENTENCES = ["The taste is fine and the pack is easy to close.", "Keep refrigerated and use within {} days of opening.", "We asked at the counter for a refund.", "The price went from {} to {} AZN last week.", "Ask for it at the counter if the shelf is empty!"]
SCHEMA = "doc_id long, source string, text string, cut string"


def corpus(seed=1, n=400, limit=90):
    rnd = random.Random(seed)
    docs, cut = [], set()
    for i in range(n):
        text = " ".join(rnd.choice(SENTENCES).format(rnd.randrange(10, 99), rnd.randrange(10, 99)) for _ in range(rnd.randrange(2, 6)))
        source = "limited" if i % 2 else "open"
        if i % 7 == 0 and source == "open":
            text += "\nKind regards, the team"
        if source == "limited" and len(text) > limit:
            text = text[:limit]
        elif source == "open" and i % 10 == 4:
            text = text[: rnd.randrange(len(text) // 2, len(text) - 25)]
        if not text.rstrip().endswith((".", "!", "team")):
            cut.add(i)
        docs.append((i, source, text, None))
    return docs, cut


def found(spark, docs):
    return {r.doc_id for r in truncation.truncated(spark.createDataFrame(docs, SCHEMA)).where("cut").collect()}


def test_field_limit_and_transfer(spark):
    docs, cut = corpus()
    got = found(spark, docs)
    assert len(cut) > 100
    assert len(got & cut) >= 0.95 * len(cut)
    assert len(got - cut) <= 0.03 * len(cut)


def test_limits_of_sources(spark):
    docs, _ = corpus()
    limits = truncation.length_spikes(spark.createDataFrame(docs, SCHEMA)).collect()
    assert ("limited", "chars", 90) in {(r.source, r.limit_kind, r.limit) for r in limits}
    assert all(r.source == "limited" for r in limits)


def test_unclear_rows(spark):
    docs, _ = corpus(n=60)
    extra = [(1000, None, None, None), (1001, None, "", None), (1002, "open", " \n", None), (1003, "open", "Half a charac�", None), (1004, "open", "We asked <a href=", None), (1005, None, "We asked at the counter for a refund. 👍", None), (1006, "open", "word " * 100_000 + "end.", None), (1003, "open", "Half a charac�", None)]
    out = truncation.truncated(spark.createDataFrame(docs + extra, SCHEMA))
    rows = {r.doc_id: r.cut for r in out.collect()}
    assert {1000, 1001, 1002}.isdisjoint(rows)
    assert rows[1003] and rows[1004] and not rows[1005] and not rows[1006]
    report = {r.source: r for r in truncation.truncation_report(out).collect()}
    assert report["open"].texts > 0 and 0 <= report["open"].share <= 1


def test_empty(spark):
    assert truncation.truncated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_patterns():
    assert [truncation.pattern(x) for x in ("12", "1234", "32,8", "32.80", "AB-054", "f9477362", "40018972", "500QR", "Word", "2026-01-02")] == ["9", "9999", "9.9", "9.99", "ab-999", "xxxxxxxx", "xxxxxxxx", "9qr", "word", "9999-99-99"]
