"""Rows that fail to parse: loaded rows and rejected rows with their reason.

Each record goes through a strict reader in ``mapInPandas`` (a partition-wise map over Arrow
batches): quote-aware assembly and Python's strict csv reader for CSV payloads, a strict JSON
decoder for the others.  Structural failures are caught before the typed constructors run.
Two reasons need other tables and are joined on: a time text that is no possible time (from
the dictionary of distinct time texts) and a store code that no store snapshot has.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarazi.functions.payloads import COLUMNS, MOST, parse_payload
from tarazi.operators.instants import TimeDictionary, with_instants
from tarazi.session import cut_lineage

PARSED = (
    "batch_id long, row_num int, source string, business_date date, sku string, name string, brand string, ean string, category_raw string, "
    "price_qepik long, old_price_qepik long, old_price_text string, available boolean, store_code string, promo_until string, time_text string, error string"
)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [parse_payload(s, p) for s, p in zip(pdf["source"], pdf["payload"])]
        out = pd.DataFrame(rows, columns=list(COLUMNS), dtype=object)
        for c in ("price_qepik", "old_price_qepik"):
            out[c] = [None if v is None or abs(v) > MOST else v for v in out[c]]
        keys = pdf[["batch_id", "row_num", "source", "business_date"]].reset_index(drop=True)
        yield pd.concat([keys, out], axis=1)


def parse_records(raw: DataFrame) -> DataFrame:
    """Every landed record with its typed fields, or with the structural or value ``error``.

    Reads batch_id, row_num, source, business_date and payload; other columns of ``raw`` do
    not matter, whatever their names.  A null payload is ``missing_payload``, an unknown or
    null source ``unknown_source``, an empty payload malformed.  Repeated rows come out as
    often as they come in.  An empty table gives an empty table.
    """
    return raw.select("batch_id", "row_num", "source", "business_date", "payload").mapInPandas(_parse, PARSED)


def classify(raw: DataFrame, retailers: DataFrame, stores: DataFrame, zoned: tuple[str, ...] = ("absheron",), dictionary: TimeDictionary | None = None) -> DataFrame:
    """Every landed record with ``observed_at`` (UTC) and ``error``, null for records that load.

    A zoned source's record needs a store code of ``stores``.  A record without a time loads,
    with a null ``observed_at``.
    """
    parsed = cut_lineage(parse_records(raw))  # read twice below, for the times and for the rows
    times = with_instants(parsed, retailers, dictionary)
    known = stores.select(F.col("retailer_code").alias("_rc"), F.col("store_code").alias("_sc")).where(F.col("_sc").isNotNull()).distinct()
    # the store register is a dimension: AQE broadcasts it while it is small and shuffles it beyond that
    joined = times.join(known, (F.col("source") == F.col("_rc")) & (F.col("store_code") == F.col("_sc")), "left")
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("time_text").isNotNull() & F.col("observed_at").isNull(), F.lit("impossible_time"))
        .when(F.col("source").isin(*zoned) & F.col("_sc").isNull(), F.lit("unknown_store"))
    )
    return joined.select(*[c for c in times.columns if c != "error"], reason.alias("error"))


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("error").isNotNull()).select("batch_id", "row_num", "source", "error")


def loaded(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("error").isNull()).drop("error")
