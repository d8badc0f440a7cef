"""Product lists from stored list pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storewright.config import StockConfig
from storewright.functions.text import page_number

PAGES_PER_RUN = 10_000
ANCHOR = r'<a href="([^"]*)">([^<]*)</a>'


def page_links(
    pages: DataFrame, pattern: str = ANCHOR, link_group: int = 1, name_group: int = 2
) -> DataFrame:
    """One row per link of a page: (page_id, position, href, name).

    ``pattern`` matches one link with its name, for instance a whole table row,
    in the two given groups. Both are cut from the same match, so they cannot
    drift apart.
    """
    match = F.regexp_extract_all(F.col("html"), F.lit(pattern), F.lit(0))
    return pages.select("page_id", F.posexplode(match).alias("position", "match")).select(
        "page_id",
        "position",
        F.regexp_extract("match", pattern, link_group).alias("href"),
        F.regexp_extract("match", pattern, name_group).alias("name"),
    )


def link_names(links: DataFrame) -> DataFrame:
    """Name per link of a page: that of the link's first occurrence."""
    first = F.min(F.struct("position", "name"))
    return links.groupBy("page_id", "href").agg(first.alias("first")).select("page_id", "href", "first.name")


def page_urls(listing: DataFrame, first_page: int = 1) -> DataFrame:
    """All page URLs of a listing: (base_url, page_no, url).

    ``last_href`` is the link to the last page; its number stands after the
    last ``=``. A listing without such a number, or with none left from
    ``first_page`` on, has no pages. A long listing is cut into runs of pages
    that are spread over the tasks before they are written out.
    """
    last_page = page_number(F.col("last_href"))
    run_starts = F.sequence(F.lit(first_page), F.col("last_page"), F.lit(PAGES_PER_RUN))
    run_end = F.least(F.col("start") + PAGES_PER_RUN - 1, F.col("last_page"))
    tasks = int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        listing.select("base_url", last_page.alias("last_page"))
        .filter(F.col("last_page") >= first_page)
        .select("base_url", "last_page", F.explode(run_starts).alias("start"))
        .repartition(tasks, "base_url", "start")
        .select("base_url", F.explode(F.sequence("start", run_end)).alias("page_no"))
        .withColumn("url", F.concat("base_url", F.lit("&page="), F.col("page_no").cast("string")))
    )


def real_stock_products(product: DataFrame, cfg: StockConfig) -> DataFrame:
    """(page_no, title) of the products kept with real stock."""
    return product.filter(F.col("stock_mode") == cfg.real_stock_mode).select("page_no", "title")


def distinct_products(product: DataFrame) -> DataFrame:
    """Each title once, with the first page that lists it."""
    return product.groupBy("title").agg(F.min("page_no").alias("page_no"))
