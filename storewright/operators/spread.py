"""Join to a table of distinct keys when one key may cover much of the other side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys made of one key; the table of keys grows by this factor.
SLICES = 16


def spread_join(
    rows: DataFrame, keys: DataFrame, key: str, how: str, spread_by: list[str], slices: int = SLICES
) -> DataFrame:
    """``rows`` joined to ``keys``, one row per ``key`` there, on (key, slice).

    ``spread_by`` names columns of ``rows`` whose values decide the slice, so
    that task retries agree. ``keys`` comes out of an aggregation as a rule. AQE
    does not split a hot key next to one, as it wants both shuffles directly
    below the join. The slices bring in that shuffle, and cut the hot key by
    themselves where AQE does not act. A small ``keys`` is broadcast as ever.
    """
    in_slice = F.pmod(F.xxhash64(*spread_by), F.lit(slices)).cast("int")
    every_slice = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    return (
        rows.withColumn("_slice", in_slice)
        .join(keys.withColumn("_slice", every_slice), [key, "_slice"], how)
        .drop("_slice")
    )
