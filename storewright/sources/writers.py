"""Tables out. Every write replaces the whole output, so no rows of an earlier run remain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storewright import fixed_values as fixed


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        writer.csv(path, header=True, encoding="UTF-8")
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def write_accepted(rows: DataFrame, corrupt: str, accepted: str, quarantine: str) -> None:
    """Rows without a line in the column ``corrupt``, without that column, and apart from them the others, whole.

    Both take the same columns, so Spark reads and judges the same cells for both.
    """
    columns = [c for c in rows.columns if c != corrupt]
    good = rows.filter(F.col(corrupt).isNull()).select(*columns)
    write_table(good, accepted)
    write_table(rows.filter(F.col(corrupt).isNotNull()), quarantine)


def write_adjustments(
    adjustments: DataFrame, path: str, source_headers: bool = True, by_title: bool = True
) -> None:
    """One folder of CSV per product title, or without ``by_title`` one table with the title as its last column.

    ``rebalance`` brings a title's rows together, so that small titles give one
    file each, and lets AQE split a title that is too large for one task. For
    millions of titles take the one table: its files hold many titles each, with the
    rows of a title next to each other.
    """
    rows = adjustments.hint("rebalance", F.col("title"))
    if source_headers:
        rows = rows.withColumnsRenamed(fixed.ADJUSTMENT_HEADERS)
    if not by_title:
        columns = [c for c in rows.columns if c != "title"]
        write_table(rows.select(*columns, "title").sortWithinPartitions("title"), path, "csv")
        return
    rows.write.mode("overwrite").partitionBy("title").csv(path, header=True, encoding="UTF-8")


def write_product_pages(product: DataFrame, path: str) -> None:
    """The product list, one folder per list page."""
    rows = product.hint("rebalance", F.col("page_no"))
    rows.write.mode("overwrite").partitionBy("page_no").parquet(path)
