"""Reconcile store stock with shelf stock into adjustment rows.

The quarantine works per product: one unreadable shelf figure among a product's
mismatches rejects all its adjustments. It is an anti join with the short list
of rejected titles, not a window per title, and a title's rows are spread over
several keys in it, so a product with a third of all rows is never gathered in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storewright.config import StockConfig
from storewright.functions.text import clean_code
from storewright.operators.spread import spread_join

ROW_KEY = ["store_code", "sku"]

ADJUSTMENT_COLUMNS = [
    "warehouse_code",
    "store_code",
    "sku",
    "adjust_qty",
    "adjust_type",
    "courier",
    "tracking_no",
    "receiver_contact",
    "remark",
    "sub_order_no",
]


def _figure(name: str) -> Column:
    """A stock figure as double; NaN, or text that is no number, is a missing value."""
    return F.nullif(F.col(name).try_cast("double"), F.lit(float("nan")))


def _whole_units(figure: Column) -> Column:
    """Truncated toward zero; NULL when missing, infinite or out of range."""
    return figure.try_cast("bigint")


def stock_mismatch(stock: DataFrame) -> DataFrame:
    """Rows whose two figures differ or of which one is missing, with a clean store code.

    In an export read as text, rows with an empty store figure are left out.
    """
    if dict(stock.dtypes)["store_stock"] == "string":
        stock = stock.filter(~F.col("store_stock").eqNullSafe(""))
    return (
        stock.withColumns({"store_stock": _figure("store_stock"), "shelf_stock": _figure("shelf_stock")})
        .filter(
            F.col("store_stock").isNull()
            | F.col("shelf_stock").isNull()
            | (F.col("store_stock") != F.col("shelf_stock"))
        )
        .select("title", clean_code(F.col("store_code")).alias("store_code"), "sku", "store_stock", "shelf_stock")
    )


def rejected_products(mismatch: DataFrame) -> DataFrame:
    """Titles with a mismatch whose shelf figure is no number."""
    unreadable = _whole_units(F.col("shelf_stock")).isNull()
    return mismatch.filter(unreadable).select("title").distinct()


def adjustments(
    mismatch: DataFrame, cfg: StockConfig, rejected: DataFrame | None = None
) -> DataFrame:
    """The ten columns of the adjustment sheet, and ``title`` to tell the sheets apart.

    The quantity keeps its sign; it is NULL where the store figure is missing.
    ``rejected`` may pass in the `rejected_products` once they are stored: from
    a file of known size Catalyst can choose a broadcast before it shuffles.
    """
    if rejected is None:
        rejected = rejected_products(mismatch)
    quantity = F.col("store_stock") - _whole_units(F.col("shelf_stock"))
    constants = {"warehouse_code": cfg.warehouse_code, "adjust_type": cfg.adjust_type}
    constants.update(dict.fromkeys(cfg.blank_columns, ""))
    return (
        spread_join(mismatch, rejected.select("title"), "title", "left_anti", ROW_KEY)
        .withColumns({"adjust_qty": quantity, **{name: F.lit(v) for name, v in constants.items()}})
        .select(*ADJUSTMENT_COLUMNS, "title")
    )


def only_products(stock: DataFrame, titles: DataFrame) -> DataFrame:
    """Stock rows of the listed products: the real-stock list or one made by hand."""
    return spread_join(stock, titles.select("title").distinct(), "title", "left_semi", ROW_KEY)
