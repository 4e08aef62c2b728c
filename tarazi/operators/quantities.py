"""Quantities recorded in different units, brought to g, ml, pieces and qepik.

Unit strings are segmented by the dynamic program of ``tarazi.functions.units`` inside Arrow
batches, with a cache of distinct strings in each worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarazi.functions.units import recorded_size, size_in_text

SIZES = "id long, recorded_value decimal(38,6), recorded_unit string, named_value decimal(38,6), named_unit string, named_pack int"
_MOST, _STEP = Decimal(10) ** 31, Decimal("0.000001")
#: Two sizes differ when they are more than this share apart.
TOLERANCE = "0.03"


def _held(v: Decimal | None) -> Decimal | None:
    return None if v is None or abs(v) >= _MOST else v.quantize(_STEP)


def _sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for i, v, u, name in zip(pdf["id"], pdf["unit_value"], pdf["unit_type"], pdf["name_raw"]):
            rec = recorded_size(v, u)
            named = size_in_text(name)
            pack = named.pack if named.pack is not None and named.pack < 2**31 else None
            rows.append((i, _held(rec and rec[0]), rec and rec[1], _held(named.value), named.unit, pack))
        yield pd.DataFrame(rows, columns=["id", "recorded_value", "recorded_unit", "named_value", "named_unit", "named_pack"], dtype=object)


def listing_sizes(items: DataFrame) -> DataFrame:
    """Per listing the recorded size and the size in its name, both of one piece, in g, ml or pcs.

    Reads id, unit_value, unit_type and name_raw.  A null or unknown unit, a null value and a
    value that is not above zero give a null recorded size; a name without a size, and a null
    or empty one, a null named size; so does a value from 10^31 on, which the columns cannot
    hold.  Repeated rows come out repeated, an empty table empty.
    """
    return items.select("id", "unit_value", "unit_type", "name_raw").mapInPandas(_sizes, SIZES)


def apart(a: Column, b: Column, tolerance: str = TOLERANCE) -> Column:
    """Whether two positive values differ by more than the tolerance, as a share of the larger one."""
    return F.abs(a - b) > F.greatest(a, b) * F.expr(f"cast({tolerance} as decimal(6,4))")


def size_conflicts(items: DataFrame) -> DataFrame:
    """Listings whose recorded size and named size, in one common unit, differ by over 3 per cent.

    Sizes of different dimensions, a mass beside a volume or a count, have no common unit and
    are no conflict.
    """
    s = listing_sizes(items)
    both = F.col("recorded_value").isNotNull() & F.col("named_value").isNotNull()
    same = F.col("recorded_unit") == F.col("named_unit")
    return s.where(both & same & apart(F.col("recorded_value"), F.col("named_value")))


def old_price_not_above(classified: DataFrame) -> DataFrame:
    """Loaded records that state an old price which is not above the price, in qepik."""
    return classified.where(F.col("error").isNull() & (F.col("old_price_qepik") <= F.col("price_qepik")))
