"""Repair of wrongly decoded text in tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storewright.functions.text import repair_mojibake
from storewright.operators.spread import spread_join


def repair_columns(df: DataFrame, columns: list[str], on_error: str = "keep") -> DataFrame:
    """``df`` with GBK text that was read as Latin-1 put right in ``columns``.

    Each distinct value is repaired once, over all columns together, so Python
    sees labels and not rows. Only values that change come back, by a join per
    column that spreads a label shared by many rows; Spark broadcasts the list
    where it has measured it as small. NULL stays NULL. Rows keep their other columns.
    """
    each = F.explode(F.array(*[F.col(c) for c in columns]))
    values = df.select(each.alias("_old")).filter(F.col("_old").isNotNull()).distinct()
    repaired = values.select("_old", repair_mojibake(F.col("_old"), on_error).alias("_new"))
    changed = repaired.filter(F.col("_old") != F.col("_new"))
    order = df.columns
    for c in columns:
        spread_by = [o for o in order if o != c] or [c]
        fixed = spread_join(df, changed.withColumnsRenamed({"_old": c}), c, "left", spread_by)
        df = fixed.withColumn(c, F.coalesce("_new", c)).drop("_new")
    return df.select(*order)
