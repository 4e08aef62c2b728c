"""Mixed timestamp formats and time zones: one UTC instant a row.

The distinct (zone, text) pairs of all rows form a dictionary.  Each text is parsed once, for
every reading it allows; entries already in the persisted dictionary are not parsed again.
The readings are joined back, and each row takes the one nearest to its business date.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarazi.functions.instants import readings
from tarazi.operators.skew import lookup
from tarazi.session import scratch_path

ENTRY = "source string, zone string, text string, readings array<long>"


class TimeDictionary:
    """Readings of distinct time texts, kept as an append-only parquet table.

    ``extend`` parses only the texts that the table lacks.  A write that is repeated after a
    lost executor replaces nothing, as each call writes its own batch folder, and the reader
    takes one entry a key.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        done = [str(s.getPath()) for s in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))] if fs.exists(root) else []
        if not done:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(*done)

    def extend(self, texts: DataFrame) -> str:
        """Parse and append the texts (source, zone, text) that are new.  Returns the name of the batch."""
        have = self.entries()
        new = texts.select("source", "zone", "text").distinct()
        new = new.join(have.select("source", "zone", "text"), (new.source.eqNullSafe(have.source)) & (new.zone.eqNullSafe(have.zone)) & (new.text == have.text), "left_anti")
        batch = scratch_path(self.spark, "batch").rsplit("-", 1)[1]
        parse_texts(new).write.parquet(f"{self.path}/{batch}")
        return batch


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(readings=[readings(t, z) for t, z in zip(pdf["text"], pdf["zone"])])[["source", "zone", "text", "readings"]]


def parse_texts(texts: DataFrame) -> DataFrame:
    """Readings of each (source, zone, text); an impossible text has none."""
    return texts.select("source", "zone", "text").mapInPandas(_read, ENTRY)


def dictionary_of(rows: DataFrame, retailers: DataFrame) -> DataFrame:
    """Distinct (source, zone, text) of the rows with the number of rows of each; nulls have none.

    Rows are counted before the shuffle, so a text on a third of all rows costs one row a task.
    """
    zones = retailers.select(F.col("code").alias("_code"), F.col("feed_tz").alias("zone"))
    counted = rows.where(F.col("time_text").isNotNull()).groupBy("source", F.col("time_text").alias("text")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(zones, F.col("source") == F.col("_code"), "left").drop("_code")


def with_instants(rows: DataFrame, retailers: DataFrame, dictionary: TimeDictionary | None = None) -> DataFrame:
    """``rows`` with ``observed_at``, the UTC instant of ``time_text``.

    Of several readings of a text, such as 03/04/2026, the row takes the one nearest to noon of
    its business date, the first where they are equally near or there is no business date.
    Null for a null or impossible text.  With a dictionary its stored entries are used and new
    ones added to it; without one, one is written below the shared folder for this call.
    """
    spark = rows.sparkSession
    dictionary = dictionary or TimeDictionary(spark, scratch_path(spark, "times"))
    counted_at = scratch_path(spark, "time-counts")
    dictionary_of(rows, retailers).write.parquet(counted_at)
    counted = spark.read.parquet(counted_at)
    dictionary.extend(counted)
    entry_key = F.concat_ws("\u0001", F.coalesce("source", F.lit("")), "text")
    counts = counted.select(F.col("source").alias("_s"), F.col("zone").alias("_z"), F.col("text").alias("_t"), "n")
    entries = dictionary.entries().dropDuplicates(["source", "zone", "text"])
    table = counts.join(entries, F.col("_s").eqNullSafe(F.col("source")) & F.col("_z").eqNullSafe(F.col("zone")) & (F.col("_t") == F.col("text"))).select(
        entry_key.alias("_time_key"), F.col("n").alias("_time_n"), F.col("readings").alias("_readings")
    )
    keyed = rows.withColumn("_time_key", F.when(F.col("time_text").isNotNull(), F.concat_ws("\u0001", F.coalesce("source", F.lit("")), "time_text")))
    found = lookup(keyed, table, "_time_key", "_time_n", ["batch_id", "row_num"])
    noon = F.unix_date("business_date").cast("long") * 86_400_000_000 + F.lit(8 * 3_600_000_000)  # noon in Baku
    distance = F.transform("_readings", lambda x: F.abs(x - noon))
    nearest = F.coalesce(F.element_at("_readings", F.greatest(F.array_position(distance, F.array_min(distance)), F.lit(1)).cast("int")), F.get("_readings", F.lit(0)))
    return found.withColumn("observed_at", F.when(F.size("_readings") > 0, F.timestamp_micros(nearest))).drop("_time_key", "_readings")


def baku_day(instant):
    """Calendar day of a UTC instant in Asia/Baku."""
    return F.to_date(F.from_utc_timestamp(instant, "Asia/Baku"))


def on_another_day(classified: DataFrame) -> DataFrame:
    """Loaded records whose instant falls on another day in Baku than their business date."""
    return classified.where(F.col("error").isNull() & F.col("observed_at").isNotNull() & (baku_day("observed_at") != F.col("business_date")))
