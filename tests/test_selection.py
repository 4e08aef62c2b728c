from datetime import date

from pyspark.sql import functions as F

from tarazi.functions.scalars import valid_gtin
from tarazi.operators import selection
from tarazi.session import published


def test_filters(spark):
    rows = spark.createDataFrame([(1, "a", date(2026, 1, 1)), (2, "b", date(2026, 1, 2)), (3, None, date(2026, 1, 3)), (4, "a", None)], "id int, k string, d date")
    ids = lambda **w: sorted(r.id for r in selection.filtered(rows, **w).collect())
    assert ids() == ids(k=None) == [1, 2, 3, 4]
    assert ids(k=["a", "b"]) == [1, 2, 4] and ids(k=[]) == [] and ids(k="a", d=("2026-01-01", None)) == [1]
    assert ids(d=(None, "2026-01-02")) == [1, 2] and ids(d=("2026-01-02", "2026-01-02")) == [2]


def test_page(spark):
    rows = spark.range(7)
    assert [(r.id, r.total) for r in selection.page(rows, [F.desc("id")], 2, 2).collect()] == [(4, 7), (3, 7)]
    assert selection.page(rows.where("id > 9"), [F.col("id")], 0, 5).count() == 0


def test_figures(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    long = lambda v: F.lit(v).cast("long")
    assert one(selection.premium_bp(long(105), long(100))) == 500 and one(selection.premium_bp(long(1), long(0))) is None
    assert one(selection.gap_bp(long(2), long(3))) == 3333 and one(selection.gap_bp(long(2), long(0))) is None
    assert one(valid_gtin(selection.gtin13(long(200500000155)))) is True


def test_published_once_a_state(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "x").write_text("1")
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    assert published(spark, str(source), "m", build).count() == published(spark, str(source), "m", build).count() == 3 and len(built) == 1
    (source / "y").write_text("2")
    published(spark, str(source), "m", build)
    assert len(built) == 2
