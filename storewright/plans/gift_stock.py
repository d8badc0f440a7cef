"""Stock adjustments for the listed products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storewright.config import StockConfig
from storewright.operators import catalog, stock as ops
from storewright.sources.writers import write_adjustments, write_product_pages, write_table


def list_real_stock(spark: SparkSession, product: DataFrame, out: str, cfg: StockConfig | None = None) -> dict[str, str]:
    """Write the real-stock products per list page and each of them once."""
    cfg = cfg or StockConfig()
    paths = {name: f"{out}/{name}" for name in ("product_pages", "products")}
    write_product_pages(catalog.real_stock_products(product, cfg), paths["product_pages"])
    pages = spark.read.schema("title string, page_no int").parquet(paths["product_pages"])
    write_table(catalog.distinct_products(pages), paths["products"])
    return paths


def run(
    spark: SparkSession,
    stock: DataFrame,
    titles: DataFrame,
    out: str,
    cfg: StockConfig | None = None,
    source_headers: bool = True,
) -> dict[str, str]:
    """Write ``mismatch``, ``rejected_products`` and ``adjustments`` below ``out``.

    ``titles`` is the real-stock list or a list made by hand.
    """
    cfg = cfg or StockConfig()
    paths = {name: f"{out}/{name}" for name in ("mismatch", "rejected_products", "adjustments")}
    write_table(ops.stock_mismatch(ops.only_products(stock, titles)), paths["mismatch"])

    mismatch = spark.read.parquet(paths["mismatch"])
    write_table(ops.rejected_products(mismatch), paths["rejected_products"])
    rejected = spark.read.parquet(paths["rejected_products"])
    write_adjustments(ops.adjustments(mismatch, cfg, rejected), paths["adjustments"], source_headers)
    return paths
