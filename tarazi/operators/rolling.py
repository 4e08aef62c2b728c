"""Totals and averages over trailing periods, for days without a row too."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Days of one coarse bucket; a trailing window up to this long touches two buckets at most, a longer one as many as it needs.
BUCKET_DAYS = 32


def daily_values(facts: DataFrame, entity: list[str], day: str, latest_by: str, measures: list[str]) -> DataFrame:
    """One row an entity and day: of several rows the one with the latest ``latest_by``.

    Rows with one ``latest_by`` are told apart by their measures, so the result does not depend
    on the order of rows; a null ``latest_by`` is the earliest.  Combined before the shuffle, so
    an entity with a third of all rows sends one row a day and task.  Rows without a day count
    for nothing.
    """
    pick = F.max_by(F.struct(*measures), F.struct(F.col(latest_by), *[F.col(m) for m in measures]))
    return facts.where(F.col(day).isNotNull()).groupBy(*entity, F.col(day).alias("day")).agg(pick.alias("_v")).select(*entity, "day", *[F.col("_v")[m].alias(m) for m in measures])


def trailing(daily: DataFrame, entity: list[str], measures: list[str], windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Totals, counts and averages of each measure over the trailing windows of each calendar day.

    The calendar of an entity runs from its first to its last day, whole, whatever is missing
    in between.  Calendar days and daily values meet by entity and bucket of BUCKET_DAYS days,
    each value sent to its own bucket and those that its windows reach, and are then held to the
    window's bounds; a group of the join is never larger than those buckets, however large its
    entity.  The join is always one of two exchanges, never a broadcast, as the aggregation
    keeps its partitioning: the days that a value is spread to are never shuffled.

    Totals and counts are over days with a value; a window without any has a null total and
    average and the count 0.  Null entity keys form entities like any other.
    """
    e = F.struct(*entity)
    number = F.unix_date("day")
    span = daily.groupBy(*entity).agg(F.min(number).alias("_first"), F.max(number).alias("_last"))
    buckets = span.select(e.alias("_e"), "_first", "_last", F.explode(F.sequence(F.floor(F.col("_first") / BUCKET_DAYS), F.floor(F.col("_last") / BUCKET_DAYS))).alias("_bucket"))
    start = F.greatest("_first", F.col("_bucket") * BUCKET_DAYS).cast("int")
    end = F.least("_last", F.col("_bucket") * BUCKET_DAYS + BUCKET_DAYS - 1).cast("int")
    calendar = buckets.select("_e", "_bucket", start.alias("_start"), end.alias("_end"))
    own, further = F.floor(number / BUCKET_DAYS), -(-(max(windows) - 1) // BUCKET_DAYS)
    held = [F.col(m).cast("long").alias(f"_m{i}") for i, m in enumerate(measures)]
    values = daily.select(e.alias("_e"), F.explode(F.sequence(own, own + further)).alias("_bucket"), number.alias("_day"), *held)
    # a row without a day stands for the calendar itself and keeps days whose windows are empty
    marks = calendar.select("_e", "_bucket", F.lit(None).cast("int").alias("_day"), *[F.lit(None).cast("long").alias(f"_m{i}") for i in range(len(measures))])
    meeting = calendar.hint("merge").join(values.unionByName(marks).hint("merge"), ["_e", "_bucket"])
    since = F.greatest("_start", "_day")
    until = F.least(F.col("_end"), F.col("_day") + (max(windows) - 1))
    pairs = meeting.where(since <= until).withColumn("_at", F.explode(F.sequence(since, until)))
    lag = F.col("_at") - F.col("_day")
    sums = []
    for i, m in enumerate(measures):
        for w in windows:
            inside = F.when(lag < w, F.col(f"_m{i}"))
            sums += [F.sum(inside).alias(f"{m}_total_{w}"), F.count(inside).alias(f"{m}_days_{w}")]
    out = pairs.groupBy("_e", "_bucket", "_at").agg(*sums)
    columns = [*[F.col("_e")[c].alias(c) for c in entity], F.date_from_unix_date("_at").alias("obs_day")]
    for m in measures:
        for w in windows:
            t, n = F.col(f"{m}_total_{w}"), F.col(f"{m}_days_{w}")
            columns += [t, n, (t / F.when(n > 0, n)).alias(f"{m}_avg_{w}")]
    return out.select(*columns)


def below_share(windows: DataFrame, measure: str, short: int, reference: str, long: int, percent: int) -> DataFrame:
    """Days on which the short mean of a measure is below a percentage of the reference's long mean.

    Compared as whole numbers, so no rounding decides; a window without a value makes no case.
    """
    s, n = F.col(f"{measure}_total_{short}"), F.col(f"{measure}_days_{short}")
    r, k = F.col(f"{reference}_total_{long}"), F.col(f"{reference}_days_{long}")
    wide = lambda c: c.cast("decimal(38,0)")
    return windows.where((n > 0) & (k > 0) & (wide(s) * wide(k) * 100 < wide(r) * wide(n) * percent))
