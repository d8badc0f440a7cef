"""Every registered query against its SQL, on real files."""

from __future__ import annotations

from dataclasses import replace

import parity
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from storewright import standins
from storewright.operators import conversion, stock

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return parity.connect(SF)


RETAIL = entry._retail_queries()


def test_every_retail_query_has_sql():
    assert set(RETAIL) == set(entry._retail_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", RETAIL)
def test_query_equals_sql(spark, db, name):
    got = parity.spark_rows(entry.queries()[name](spark, SF))
    assert got == parity.duck_rows(db, entry.oracle_sql()[name])


def test_page_urls_start_at_the_first_page(spark):
    pages = entry.queries()["page_urls"](spark, SF)
    assert pages.filter("page_no = 1").count() and pages.filter("page_no < 1").isEmpty()


def test_page_numbers_are_read_from_urls(spark):
    numbers = entry.queries()["listing_page_numbers"](spark, SF)
    pages = entry.queries()["page_urls"](spark, SF).select("url", "page_no")
    got = sorted(map(tuple, numbers.collect()))
    assert got and None not in {n for _, n in got} and got == sorted(map(tuple, pages.collect()))


def test_entry_has_regions_and_the_nation(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["level", "region"]
    assert df.count() == 6


def changed(spark, with_config=None, **tables):
    """The query's rows with a predicate taken out, by another config or other tables."""
    names = ("shop", "member", "purchase", "goods", "contact")
    given = [tables.get(n, getattr(standins, n)(spark, SF)) for n in names]
    return sorted(map(tuple, conversion.conversion_detail(*given, with_config or standins.CONFIG).collect()))


def test_stand_ins_have_rows_for_each_predicate(spark):
    plain = changed(spark)
    assert changed(spark, replace(standins.CONFIG, excluded_region="-")) != plain
    purchase = standins.purchase(spark, SF)
    assert changed(spark, purchase=purchase.withColumn("amount", F.abs("amount"))) != plain
    assert purchase.filter("amount IS NULL").count() > 100


def test_stand_ins_have_figures_that_are_cut_and_texts_that_are_left_out(spark):
    mismatch = stock.stock_mismatch(standins.stock(spark, SF))
    whole = stock.adjustments(mismatch.withColumn("shelf_stock", F.round("shelf_stock")), entry.STOCK)
    got = stock.adjustments(mismatch, entry.STOCK)
    assert sorted(map(str, got.collect())) != sorted(map(str, whole.collect()))
    text = standins.text_stock(spark, SF)
    typed = text.withColumns({c: F.col(c).try_cast("double") for c in ("shelf_stock", "store_stock")})
    assert stock.stock_mismatch(text).count() < stock.stock_mismatch(typed).count()
