from decimal import Decimal

from tarazi.operators import quantities

SCHEMA = "id long, unit_value decimal(12,3), unit_type string, name_raw string, recorded_value string"


def conflicts(spark, data):
    return sorted(r.id for r in quantities.size_conflicts(spark.createDataFrame(data, SCHEMA)).collect())


def test_conflicts(spark):
    d = Decimal
    data = [
        (1, d("0.500"), "kq", "Süd 500 qr", "clash"), (2, d("500"), "kq", "Süd 500 qr", None), (3, d("22.930"), "oz", "Jam 650 g", None), (4, None, "g", "Jam 650 g", None), (5, d("650"), None, "Jam 650 g", None), (6, d("650"), "g", None, None), (7, d("650"), "g", "", None),
        (8, d("97"), "g", "a 100 g", None), (9, d("96.9"), "g", "a 100 g", None), (10, d("10"), "pcs", "a 100 g", None), (11, d("100"), "g", "a 6x100 g", None), (2, d("500"), "kq", "Süd 500 qr", None), (12, d("1"), "g", "x" * 100_000, None),
    ]
    assert conflicts(spark, data) == [2, 2, 9]


def test_empty(spark):
    assert conflicts(spark, []) == []
