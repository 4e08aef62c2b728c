"""Joins and groupings that stand keys which hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarazi.session import cut_lineage

#: A key with more than a task's share of the rows, by so many parts, is heavy; a key of fewer rows than LEAST never is.
PARTS, LEAST = 2, 10_000


def lookup(rows: DataFrame, table: DataFrame, key: str, count: str, row_id: list[str]) -> DataFrame:
    """Left join of rows to a table with one row a key, safe against heavy and null keys.

    ``table`` has ``key``, ``count`` (the number of rows with the key) and further columns,
    which are added to ``rows``.  Keys with over half of the rows that a task gets on average are
    broadcast, by definition twice as many keys as there are shuffle partitions at most; all
    others are joined by shuffle.  Rows that need no shuffle partner (null
    or heavy key) are spread by a hash of ``row_id`` under a key that matches nothing.  Null
    keys get nulls.  ``table`` is written once to the shared folder.  Columns of ``rows`` that clash with the table's are not allowed.
    """
    table = cut_lineage(table)  # it is read three times below
    added = [c for c in table.columns if c not in (key, count)]
    total = table.agg(F.sum(count)).scalar()
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 32)
    heavy = table.where(F.col(count) > F.greatest(total / (PARTS * tasks), F.lit(LEAST))).select(F.col(key).alias("_hk"), F.struct(*added).alias("_hv"))
    light = table.select(F.lit(-1).alias("_ls"), F.col(key).alias("_lk"), F.struct(*added).alias("_lv"))
    joined = rows.join(F.broadcast(heavy), F.col(key) == F.col("_hk"), "left")
    no_partner = F.col("_hk").isNotNull() | F.col(key).isNull()
    spread = F.pmod(F.xxhash64(*row_id), F.lit(1 << 20)).cast("int")
    joined = joined.withColumn("_js", F.when(no_partner, spread).otherwise(F.lit(-1))).withColumn("_jk", F.when(no_partner, F.lit("")).otherwise(F.col(key)))
    joined = joined.join(light, (F.col("_js") == F.col("_ls")) & (F.col("_jk") == F.col("_lk")), "left")
    value = F.coalesce(F.col("_hv"), F.col("_lv"))
    return joined.select(*rows.columns, *[value[c].alias(c) for c in added])
