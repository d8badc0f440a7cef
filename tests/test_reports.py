from __future__ import annotations

from datetime import date

import pytest

from storewright import schemas
from storewright.config import ConversionConfig
from storewright.operators import reports, rollups

CFG = ConversionConfig(date(2024, 3, 1), date(2024, 3, 31))
SCHEMA = ", ".join([f"{c} string" for c in schemas.DETAIL_KEYS] + [f"{c} bigint" for c in schemas.DETAIL_COUNTS])
ROWS = [
    ("R1", "S1", "A1", "North", "own", 10, 4, 4, 2, 6, 2),
    ("R1", "S1", "A2", "North", "agent", 5, 5, 0, 0, 5, 5),
    ("R1", "S2", "A3", "Mid", "own", 20, 2, 10, 0, 8, 2),
    ("R2", "S3", "A4", "South", "own", 4, 1, 4, 1, 0, 0),
]


@pytest.fixture
def detail(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def nine(row):
    return [round(row[c], 6) for c in rollups.rate_columns()]


def by(df, key):
    return {row[key]: nine(row) for row in df.collect()}


R1 = [0.314286, 0.142857, 0.473684, 0.25, 0.25, 0.291667, 1, 0, 1]
R2 = [0.25, 0.25, 0, 0.25, 0.25, 0, 0, 0, 0]
ALL = [0.307692, 0.166667, 0.473684, 0.205882, 0.166667, 0.285714, 1, 0, 1]


def test_region_report_mixes_weighted_overall_and_mean_types(detail):
    assert by(reports.region_report(detail, CFG), "region") == {"R1": R1, "R2": R2, "ALL": ALL}


def test_region_order_puts_the_national_row_last(detail):
    rows = reports.sort_region_report(reports.region_report(detail, CFG)).collect()
    assert [(r.level, r.region) for r in rows] == [("region", "R2"), ("region", "R1"), ("national", "ALL")]


def test_national_row_is_weighted_throughout(detail):
    (row,) = reports.national_row(detail, CFG).collect()
    assert nine(row) == ALL and row.level == "national"


def test_national_row_counts_stores_without_region(spark):
    detail = spark.createDataFrame([*ROWS, (None, "S9", "A9", "X", "own", 9, 9, 0, 0, 0, 0)], SCHEMA)
    rows = by(reports.region_report(detail, CFG), "region")
    assert set(rows) == {"R1", "R2", "ALL"}
    assert rows["ALL"][0] == round(21 / 48, 6)
    assert rows["ALL"] == nine(reports.national_row(detail, CFG).first())


def test_store_report_takes_means_only(detail):
    rows = by(reports.store_report(detail, CFG), "store_name")
    assert rows["North"] == [0.7, 0.25, 0.666667, 0.4, 0.5, 0.333333, 1, 0, 1]
    assert rows["Mid"] == [0.1, 0, 0.25, 0.1, 0, 0.25, 0, 0, 0]
    assert rows["South"] == [0.25, 0.25, 0, 0.25, 0.25, 0, 0, 0, 0]


def test_lagging_subregions(detail):
    rows = reports.lagging_subregions(detail, CFG, k=2).collect()
    assert [(r.subregion, round(r.overall_add_rate, 6)) for r in rows] == [("S2", 0.1), ("S3", 0.25)]


def test_lagging_ties_are_cut_by_name(spark):
    rows = [("R", s, s, s, "own", 4, 1, 0, 0, 0, 0) for s in ("c", "a", "b")]
    got = reports.lagging_subregions(spark.createDataFrame(rows, SCHEMA), CFG, k=2).collect()
    assert [r.subregion for r in got] == ["a", "b"]


def test_null_group_keys_are_dropped(spark):
    rows = [*ROWS, ("R1", None, "A5", None, "own", 1, 1, 0, 0, 0, 0)]
    detail = spark.createDataFrame(rows, SCHEMA)
    assert set(by(reports.subregion_report(detail, CFG), "subregion")) == {"S1", "S2", "S3"}
    assert set(by(reports.store_report(detail, CFG), "store_name")) == {"North", "Mid", "South"}


def test_a_store_type_that_never_occurs_is_zero(spark):
    detail = spark.createDataFrame([r for r in ROWS if r[4] == "own"], SCHEMA)
    for report in (reports.subregion_report, reports.store_report, reports.national_row):
        assert all(nine(r)[6:] == [0, 0, 0] for r in report(detail, CFG).collect())


def test_detail_report_columns_and_rates(detail):
    report = reports.detail_report(detail)
    assert report.columns == [
        *schemas.DETAIL_KEYS,
        *("buyers", "added", "add_rate", "new_buyers", "new_added", "new_add_rate"),
        *("old_buyers", "old_added", "old_add_rate"),
    ]
    rows = {r.store_code: r for r in report.collect()}
    assert (rows["A1"].add_rate, rows["A2"].new_add_rate, rows["A4"].old_add_rate) == (0.4, 0.0, 0.0)


def test_group_totals_keep_every_store(detail):
    rows = {r.store_code: round(r.overall_add_rate, 6) for r in rollups.with_group_totals(detail, "region").collect()}
    assert rows == {"A1": 0.314286, "A2": 0.314286, "A3": 0.314286, "A4": 0.25}


def test_percent_view_formats_every_rate(detail):
    row = reports.percent_view(reports.national_row(detail, CFG)).first()
    assert (row.region, row.overall_add_rate, row.agent_add_rate, row.own_old_add_rate) == (
        "ALL",
        "30.8%",
        "100.0%",
        "28.6%",
    )


def test_national_overall_lies_between_the_regions(detail):
    rows = by(reports.region_report(detail, CFG), "region")
    overall = [rates[0] for name, rates in rows.items() if name != "ALL"]
    assert min(overall) <= rows["ALL"][0] <= max(overall)


def test_unknown_averaging_rule(detail):
    with pytest.raises(ValueError, match="overall"):
        rollups.group_rates(detail, "region", CFG, overall="median")
