"""History of changing attributes from periodic snapshots, by tree reduction.

A snapshot is a unit interval.  Neighbouring runs of intervals of one entity are merged
pairwise where their payloads are equal; a round halves the number of runs lists, so an entity
with n snapshot dates takes log2(n) rounds.  FAN_IN lists are brought together by a shuffle,
and merged inside it by log2(FAN_IN) pairwise rounds of JVM expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lists of runs that one shuffle brings together; 2 to the power of ROUNDS.
ROUNDS = 5
FAN_IN = 2**ROUNDS


def latest_snapshots(snaps: DataFrame, entity: str, date: str, value: Column, loaded: str) -> DataFrame:
    """One row an entity and snapshot date: of several rows the one loaded last counts.

    Rows loaded at one time are told apart by their value, a null before any other.  Combined
    before the shuffle.  Rows without an entity or date count for nothing.
    """
    rows = snaps.where(F.col(entity).isNotNull() & F.col(date).isNotNull()).select(F.col(entity).alias("entity_id"), F.col(date).alias("day"), F.col(loaded).alias("_at"), value.alias("payload"))
    pick = F.max_by(F.struct("payload"), F.struct("_at", "payload"))
    return rows.groupBy("entity_id", "day").agg(pick.alias("_v")).select("entity_id", "day", F.col("_v.payload").alias("payload"))


def _merge(a: Column, b: Column) -> Column:
    """Two neighbouring lists of runs as one: the seam is merged where the payloads are equal."""
    last, first = F.element_at(a, -1), F.element_at(b, 1)
    seam = F.struct(last["start"].alias("start"), first["until"].alias("until"), last["payload"].alias("payload"))
    joined = F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(seam), F.slice(b, F.lit(2), F.size(b)))
    return F.when(F.size(a) == 0, b).when(F.size(b) == 0, a).when(last["payload"] == first["payload"], joined).otherwise(F.concat(a, b))


def _reduce(lists: Column, rounds: int) -> Column:
    """Lists 1 and 2, 3 and 4, ... merged, round after round; an odd one at the end stays."""
    empty = F.slice(F.get(lists, F.lit(0)), F.lit(1), F.lit(0))

    def half(acc: Column, _: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.ceil(F.size(acc) / 2).cast("int") - 1)
        return F.transform(pairs, lambda i: _merge(F.get(acc, i * 2), F.coalesce(F.get(acc, i * 2 + 1), F.slice(F.get(acc, i * 2), F.lit(1), F.lit(0)))))

    return F.coalesce(F.get(F.reduce(F.sequence(F.lit(1), F.lit(rounds)), lists, half), F.lit(0)), empty)


def versions(snaps: DataFrame, until: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Every version of every entity: entity_id, payload, valid_from, valid_to, last_seen.

    ``snaps`` has entity_id, day and payload, one row an entity and day.  A null payload states
    nothing and a missing snapshot ends nothing.  ``valid_to`` is the start of the next version
    (exclusive), null for the current one; ``last_seen`` is the last snapshot date that shows
    the version.  An empty table gives an empty one.

    One small action finds the first and last date, which give the number of shuffles:
    log(days) to the base FAN_IN.  The list of one entity is bounded by its calendar days, not by its rows, as snapshots are
    one a day by then.
    """
    fan = 2**rounds
    days = snaps.select(F.unix_date("day").cast("long").alias("day"))
    first, last = days.agg(F.min("day"), F.max("day")).first()
    first, last = first or 0, last or 0
    run = F.struct(F.col("day").alias("start"), F.col("day").alias("until"), F.col("payload"))
    level = snaps.where(F.col("payload").isNotNull()).select("entity_id", (F.unix_date("day").cast("long") - first).alias("block"), F.array(run).alias("runs"))
    span = 1
    while span <= last - first:
        span *= fan
        gathered = level.groupBy("entity_id", F.floor(F.col("block") / fan).alias("block")).agg(F.array_sort(F.collect_list(F.struct("block", "runs"))).alias("_lists"))
        gathered = gathered.select("entity_id", "block", F.transform("_lists", lambda x: x["runs"]).alias("_lists"))
        level = gathered.select("entity_id", "block", _reduce(F.col("_lists"), rounds).alias("runs"))
    numbered = level.select("entity_id", "runs", F.posexplode("runs").alias("_n", "_run"))
    return numbered.select(
        "entity_id",
        F.col("_run.payload").alias("payload"),
        F.col("_run.start").alias("valid_from"),
        F.get(F.col("runs"), F.col("_n") + 1)["start"].alias("valid_to"),
        F.col("_run.until").alias("last_seen"),
    )


def zone_payload(zone: str = "price_zone") -> Column:
    """A zone without regard to letter case and outer blanks; a blank one is null."""
    z = F.upper(F.trim(F.regexp_replace(F.col(zone), r"^[\s ]+|[\s ]+$", "")))
    return F.when(z != "", z)
