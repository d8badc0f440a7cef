from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from storewright import fixed_values as fixed
from storewright import schemas
from storewright.config import StockConfig
from storewright.operators import catalog
from storewright.operators import stock as ops

CFG = StockConfig()
NAN, INF = float("nan"), float("inf")
# title, store code, sku, shelf, store
ROWS = [
    ("T1", "''S1", "k", 7.0, 10.0),
    ("T1", "''S2", "k", 5.0, 5.0),
    ("T1", "''S3", "k", 6.0, 2.0),
    ("T1", "''S4", "k", 7.9, 10.0),
    ("T2", "''S1", "k", None, 3.0),
    ("T2", "''S2", "k", 4.0, 9.0),
    ("T3", "''S1", "k", 4.0, None),
    ("T5", "S1", "k", NAN, 1.0),
    ("T6", "S1", "k", INF, 1.0),
    ("T7", "S1", "k", NAN, NAN),
    ("T8", "S1", "k", -1.5, 2.0),
    ("T9", "S1", "k", 0.0, 0.0),
]


@pytest.fixture
def mismatch(spark):
    return ops.stock_mismatch(spark.createDataFrame(ROWS, schemas.STOCK))


def test_mismatch_keeps_missing_figures_and_drops_equal_ones(mismatch):
    kept = {(r.title, r.store_code) for r in mismatch.collect()}
    every = {(t, c.replace("''", "")) for t, c, *_ in ROWS}
    assert kept == every - {("T1", "S2"), ("T9", "S1")}


def test_figures_read_as_text(spark):
    rows = [("T", "a", "k", "1", ""), ("T", "b", "k", "1", None), ("T", "c", "k", "1", "3"), ("U", "d", "k", "x", "3")]
    schema = "title string, store_code string, sku string, shelf_stock string, store_stock string"
    mismatch = ops.stock_mismatch(spark.createDataFrame(rows, schema))
    assert {r.store_code for r in mismatch.collect()} == {"b", "c", "d"}
    assert {(r.store_code, r.adjust_qty) for r in ops.adjustments(mismatch, CFG).collect()} == {("b", None), ("c", 2)}


def test_rejected_products(mismatch):
    assert {r.title for r in ops.rejected_products(mismatch).collect()} == {"T2", "T5", "T6", "T7"}


def test_adjustments(mismatch):
    got = {(r.title, r.store_code): r.adjust_qty for r in ops.adjustments(mismatch, CFG).collect()}
    assert got == {
        ("T1", "S1"): 3,
        ("T1", "S3"): -4,
        ("T1", "S4"): 3,
        ("T3", "S1"): None,
        ("T8", "S1"): 3,
    }


def test_adjustment_columns(mismatch):
    df = ops.adjustments(mismatch, CFG)
    assert df.columns == [*fixed.ADJUSTMENT_HEADERS, "title"]
    row = df.first()
    assert (row.warehouse_code, row.adjust_type, row.sku) == (fixed.WAREHOUSE_CODE, fixed.ADJUST_TYPE, "k")
    assert (row.courier, row.tracking_no, row.receiver_contact, row.remark, row.sub_order_no) == ("",) * 5


def test_stored_rejects_give_the_same_adjustments(mismatch):
    own = ops.adjustments(mismatch, CFG).collect()
    given = ops.adjustments(mismatch, CFG, ops.rejected_products(mismatch)).collect()
    assert sorted(own, key=str) == sorted(given, key=str)


def test_only_listed_products(spark):
    stock = spark.createDataFrame(ROWS, schemas.STOCK)
    titles = spark.createDataFrame([("T1",), ("T1",), ("T3",), ("none",)], "title string")
    assert {r.title for r in ops.only_products(stock, titles).collect()} == {"T1", "T3"}
    assert ops.only_products(stock, titles).count() == 5


def test_page_links(spark):
    html = '<p><a href="/a">A</a> x <a href="/b">B</a><a href="/a">again</a><a href="/c"><b>no</b></a>'
    pages = spark.createDataFrame([(1, "u", html), (2, "u", "none"), (3, "u", None)], schemas.PAGES)
    links = catalog.page_links(pages)
    assert [tuple(r) for r in links.orderBy("position").collect()] == [
        (1, 0, "/a", "A"),
        (1, 1, "/b", "B"),
        (1, 2, "/a", "again"),
    ]
    assert {tuple(r) for r in catalog.link_names(links).collect()} == {(1, "/a", "A"), (1, "/b", "B")}


def test_product_rows_with_the_name_before_the_link(spark):
    row = '<tr class="row"><td><b>{}</b></td><td>\n<a href="{}">edit</a></td></tr>'
    html = "<table>" + row.format("ring box", "/edit/1") + row.format("bag", "/edit/2") + "</table>"
    pages = spark.createDataFrame([(1, "u", html)], schemas.PAGES)
    pattern = r'(?s)<tr class="row">.*?<b>([^<]*)</b>.*?<a href="([^"]*)"'
    rows = catalog.page_links(pages, pattern, link_group=2, name_group=1).orderBy("position").collect()
    assert [(r.href, r.name) for r in rows] == [("/edit/1", "ring box"), ("/edit/2", "bag")]


def test_page_urls(spark):
    listing = spark.createDataFrame(
        [("x?a=", "x?a=&page=11"), ("y", "y&page=2"), ("z", "z&page=last"), ("n", None)],
        "base_url string, last_href string",
    )
    got = catalog.page_urls(listing, first_page=9).collect()
    assert [tuple(r) for r in got] == [("x?a=", n, f"x?a=&page={n}") for n in (9, 10, 11)]
    assert catalog.page_urls(listing).filter("base_url = 'y'").count() == 2
    long = spark.createDataFrame([("b", "b&page=25001")], "base_url string, last_href string")
    pages = catalog.page_urls(long, first_page=3).groupBy("base_url").agg(
        F.count("*"), F.count_distinct("page_no"), F.min("page_no"), F.max("page_no")
    )
    assert tuple(pages.first()) == ("b", 24999, 24999, 3, 25001)


def test_product_lists(spark):
    rows = [
        (1, "T1", "/1", fixed.REAL_STOCK_MODE),
        (1, "T2", "/2", fixed.REAL_STOCK_MODE),
        (1, "T9", "/9", "other"),
        (1, "T8", "/8", None),
        (2, "T2", "/2", fixed.REAL_STOCK_MODE),
        (2, "T3", "/3", fixed.REAL_STOCK_MODE),
    ]
    listed = catalog.real_stock_products(spark.createDataFrame(rows, schemas.PRODUCT), CFG)
    assert listed.count() == 4
    got = {(r.title, r.page_no) for r in catalog.distinct_products(listed).collect()}
    assert got == {("T1", 1), ("T2", 1), ("T3", 2)}
