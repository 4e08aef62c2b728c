"""Checks over tables, each a DataFrame of the rows or figures that it is about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def reconciliation(parents: DataFrame, key: str, stated: str, *children: tuple[str, DataFrame]) -> DataFrame:
    """Parents whose stated number of rows is not the sum of their rows in the child tables, each counted before the join."""
    out = parents.select(key, F.col(stated).cast("long").alias("stated"))
    total = F.lit(0).cast("long")
    for name, rows in children:
        out = out.join(rows.groupBy(key).agg(F.count(F.lit(1)).alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
        total = total + F.col(name)
    return out.withColumn("difference", F.col("stated") - total).where(F.coalesce(F.col("difference"), F.lit(1)) != 0)


def against_trailing_median(counts: DataFrame, source: str, day: str, n: str, last: int = 8, need: int = 4) -> DataFrame:
    """Each count with the median of up to ``last`` counts before it of its source, null under ``need`` of them, and the ratio."""
    before = Window.partitionBy(source).orderBy(day).rowsBetween(-last, -1)
    listed = counts.withColumn("_prior", F.array_sort(F.collect_list(n).over(before)))
    size = F.size("_prior")
    mid = (F.get("_prior", F.floor((size - 1) / 2).cast("int")) + F.get("_prior", F.floor(size / 2).cast("int"))) / 2.0
    return listed.withColumn("trailing_median", F.when(size >= need, mid)).withColumn("ratio", F.col(n) / F.col("trailing_median")).drop("_prior")


def freshness(sources: DataFrame, rows: DataFrame, source: str, day: str, as_of: Column, never: int = 9999) -> DataFrame:
    """Days since the last row of each source; ``never`` for one without rows."""
    last = rows.groupBy(source).agg(F.max(day).alias("last_day"))
    return sources.select(source).distinct().join(last, source, "left").select(source, "last_day", F.coalesce(F.datediff(as_of, F.col("last_day")), F.lit(never)).alias("lag_days"))


def group_spread(rows: DataFrame, keys: list[str], value: str, percent: int) -> DataFrame:
    """Groups whose largest value is over a percentage of the smallest."""
    return rows.groupBy(*keys).agg(F.min(value).alias("lowest"), F.max(value).alias("highest"), F.count(F.lit(1)).alias("n")).where(F.col("highest") * 100 > F.col("lowest") * percent)


def jumps(rows: DataFrame, keys: list[str], day: str, value: str, up: float = 2.5, down: float = 0.4) -> DataFrame:
    """Rows whose value is over ``up`` times or under ``down`` times the one before of their key."""
    before = F.lag(value).over(Window.partitionBy(*[F.coalesce(F.col(k), F.lit("")) for k in keys]).orderBy(day))
    moved = rows.withColumn("previous", before).where(F.col("previous") > 0)
    ratio = F.col(value) / F.col("previous")
    return moved.where((ratio > up) | (ratio < down)).select(*keys, day, value, "previous")


def conflicting(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys with more than one combination of the columns; a null is a value of its own."""
    return rows.groupBy(key).agg(F.countDistinct(F.struct(*columns)).alias("n")).where(F.col("n") > 1)


def pair_counts(rows: DataFrame, cluster: str, truth: str) -> DataFrame:
    """Pairs of one cluster, of one truth, and of both: n(n-1)/2 of group sizes, without forming pairs."""
    def pairs(*keys: str) -> DataFrame:
        n = F.col("n")
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.call_function("div", n * (n - 1), F.lit(2).cast("long"))), F.lit(0)).alias("pairs"))

    found, real, right = pairs(cluster), pairs(truth), pairs(cluster, truth)
    counts = found.select(F.col("pairs").alias("found"), real.scalar().alias("real"), right.scalar().alias("right"))
    precision, recall = F.col("right") / F.nullif(F.col("found"), F.lit(0)), F.col("right") / F.nullif(F.col("real"), F.lit(0))
    return counts.select("*", precision.alias("precision"), recall.alias("recall"))


def batch_gates(rows: DataFrame, batch: str, price: str, error: str, reject_share: float, lowest: int, highest: int) -> DataFrame:
    """The first gate that stops each batch: reject_ratio or median_price, null where none does.

    The median is that of the rows without an error; a batch without such rows has none.  A
    batch without any rows has none here and does not come out.
    """
    ok = F.col(error).isNull()
    figures = rows.groupBy(batch).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~ok, 1)).alias("rejected"), F.percentile(F.when(ok, F.col(price)), F.lit(0.5)).alias("median"))
    gate = F.when(F.col("rejected") > reject_share * F.col("n"), "reject_ratio").when(F.col("median").isNull() | ~F.col("median").between(lowest, highest), "median_price")
    return figures.withColumn("gate", gate)
