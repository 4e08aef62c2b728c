"""Writes without MERGE: append once, upsert, delete and insert, and snapshots with validity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def append_new(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose key ``existing`` lacks; null keys are equal to null keys. The first of equal incoming keys in the order of all columns stays."""
    old = existing.select(*[F.col(k).alias(f"_old_{k}") for k in keys]).distinct()
    cond = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys])
    return first_of_each(incoming.join(old, cond, "left_anti"), keys)


def first_of_each(rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row a key, the first in ``order`` and then in all columns; combined before the shuffle, so a hot key costs one row a task."""
    rest = [c for c in rows.columns if c not in keys]
    first = [c for c in order or [] if c not in keys]
    sort = F.struct(*[F.col(c) for c in [*first, *[c for c in rest if c not in first]]]) if rest else F.struct(F.lit(1).alias("_"))
    kept = rows.groupBy(*keys).agg(F.min(sort).alias("_first"))
    return kept.select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in rows.columns])


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], merge: dict[str, str]) -> DataFrame:
    """Full outer join of two tables with one row a key.

    ``merge`` names a rule for each other column: ``keep`` (existing first), ``take`` (incoming
    first), ``least`` or ``greatest``.  Columns without a rule keep the existing value of an
    existing row, and take the incoming one of a new row.
    """
    rest = [c for c in existing.columns if c not in keys]
    old = existing.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in rest], F.lit(True).alias("_o"))
    new = incoming.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in rest])
    both = old.join(new, keys, "full_outer")

    def rule(c: str) -> Column:
        o, n = F.col(f"_o_{c}"), F.col(f"_n_{c}")
        how = merge.get(c)
        if how == "keep":
            return F.coalesce(o, n)
        if how == "take":
            return F.coalesce(n, o)
        if how in ("least", "greatest"):
            return F.call_function(how, o, n)
        return F.when(F.col("_o"), o).otherwise(n)

    return both.select(*keys, *[rule(c).alias(c) for c in rest])


def rewrite_window(existing: DataFrame, incoming: DataFrame, day: str, days: int) -> DataFrame:
    """``existing`` with its last ``days`` + 1 days replaced by those of ``incoming``, and later ones added.

    The window starts ``days`` before the last existing day; of an empty table all is taken.
    On storage the same is a dynamic overwrite of the day partitions (see ``overwrite_days``).
    """
    start = existing.agg(F.coalesce(F.date_sub(F.max(day), days), F.lit("1900-01-01").cast("date"))).scalar()
    return existing.where(F.col(day) < start).unionByName(incoming.where(F.col(day) >= start))


def overwrite_days(rows: DataFrame, path: str, day: str) -> None:
    """Replace the day partitions that ``rows`` has; a day's files are replaced together, a repeated run writes the same."""
    rows.repartition(day).sortWithinPartitions(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def snapshot(current: DataFrame, incoming: DataFrame, keys: list[str], checked: list[str], at: Column) -> DataFrame:
    """Type 2 history: ``current`` has valid_from and valid_to, open rows a null valid_to.

    A row whose checked columns differ, nulls compared as values, is closed at ``at`` and a new
    version opened; new keys are opened; keys that are gone stay open.
    """
    closed = current.where(F.col("valid_to").isNotNull())
    open_rows = current.where(F.col("valid_to").isNull()).select(*keys, *[F.col(c).alias(f"_o_{c}") for c in checked], F.col("valid_from").alias("_from"), F.lit(True).alias("_o"))
    new = incoming.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in checked], F.lit(True).alias("_n"))
    both = open_rows.join(new, keys, "full_outer")
    changed = F.col("_o") & F.col("_n") & ~reduce(lambda x, y: x & y, [F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}")) for c in checked])
    changed = F.coalesce(changed, F.lit(False))
    kept = both.where(F.col("_o")).select(*keys, *[F.col(f"_o_{c}").alias(c) for c in checked], F.col("_from").alias("valid_from"), F.when(changed, at).alias("valid_to"))
    opened = both.where(F.col("_n") & (F.col("_o").isNull() | changed)).select(*keys, *[F.col(f"_n_{c}").alias(c) for c in checked], at.alias("valid_from"), F.lit(None).cast(dict(current.dtypes)["valid_to"]).alias("valid_to"))
    return closed.select(*keys, *checked, "valid_from", "valid_to").unionByName(kept).unionByName(opened)


def latest_of_each(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last writer of each key, by ``order`` and then all columns."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    kept = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_last"))
    return kept.select(*[F.col(c) if c in keys else F.col("_last")[c].alias(c) for c in rows.columns])
