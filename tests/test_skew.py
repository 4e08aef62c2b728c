from tarazi.operators.skew import lookup


def test_heavy_light_missing_and_null_keys(spark):
    n = 40_000
    rows = spark.range(n).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('k', id % 1000) end as k", "'kept' as other")
    table = rows.where("k is not null and k <> 'k5'").groupBy("k").count().selectExpr("k", "count as n", "upper(k) as v")
    out = lookup(rows, table, "k", "n", ["id"])
    assert out.columns == ["id", "k", "other", "v"]
    assert out.count() == n
    bad = out.where("not (v <=> case when k = 'k5' then null else upper(k) end)").count()
    assert bad == 0


def test_empty(spark):
    rows = spark.createDataFrame([], "id long, k string")
    table = spark.createDataFrame([], "k string, n long, v int")
    assert lookup(rows, table, "k", "n", ["id"]).count() == 0
    one = spark.createDataFrame([(1, "a")], "id long, k string")
    assert [tuple(r) for r in lookup(one, table, "k", "n", ["id"]).collect()] == [(1, "a", None)]
