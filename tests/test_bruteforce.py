"""Random small inputs against plain Python loops that follow the ledger's rules word by word."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import date

import pytest

from storewright import schemas
from storewright.config import ConversionConfig, StockConfig
from storewright.operators import reports, rollups
from storewright.operators import stock as stock_ops

CFG = ConversionConfig(date(2024, 3, 1), date(2024, 3, 31))
DETAIL = ", ".join([f"{c} string" for c in schemas.DETAIL_KEYS] + [f"{c} bigint" for c in schemas.DETAIL_COUNTS])
MEASURES = ((1, 0), (3, 2), (5, 4))  # positions of (added, buyers), (new …), (old …) among the counts


def random_detail(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(rng.randint(1, 40)):
        keys = (
            f"R{rng.randint(0, 3)}",
            rng.choice([f"S{rng.randint(0, 5)}", None]),
            f"c{i}",
            rng.choice([f"n{rng.randint(0, 9)}", None]),
            rng.choice(["own", "agent"]),
        )
        new, old = rng.choice([0, rng.randint(0, 9)]), rng.choice([0, rng.randint(0, 9)])
        buyers = new + old + rng.randint(0, 2)
        new_added, old_added = rng.randint(0, new), rng.randint(0, old)
        rows.append((*keys, buyers, new_added + old_added, new, new_added, old, old_added))
    return rows


def ratio(part, whole):
    return part / whole if whole > 0 else 0.0


def mean(values):
    return sum(values) / len(values) if values else 0.0


def measures(rows, weighted):
    out = []
    for part, whole in MEASURES:
        counts = [(r[5 + part], r[5 + whole]) for r in rows]
        if weighted:
            out.append(ratio(sum(p for p, _ in counts), sum(w for _, w in counts)))
        else:
            out.append(mean([ratio(p, w) for p, w in counts]))
    return out


def rollup(rows, key, overall_weighted, types_weighted=False):
    groups = defaultdict(list)
    for row in rows:
        if row[key] is not None:
            groups[row[key]].append(row)
    expected = {}
    for name, group in groups.items():
        by_type = [measures([r for r in group if r[4] == t], types_weighted) for t in ("own", "agent")]
        expected[name] = measures(group, overall_weighted) + by_type[0] + by_type[1]
    return expected


def table(df, key):
    return {r[key]: [r[c] for c in rollups.rate_columns()] for r in df.collect()}


def assert_close(got, want):
    assert got.keys() == want.keys()
    for name in want:
        assert got[name] == pytest.approx(want[name], abs=1e-12), name


@pytest.mark.parametrize("seed", range(6))
def test_reports(spark, seed):
    rows = random_detail(seed)
    detail = spark.createDataFrame(rows, DETAIL).repartition(3)
    national = rollup([("ALL", *r[1:]) for r in rows], 0, True, types_weighted=True)
    assert_close(table(reports.region_report(detail, CFG), "region"), {**rollup(rows, 0, True), **national})
    assert_close(table(reports.national_row(detail, CFG), "region"), national)
    assert_close(table(reports.subregion_report(detail, CFG), "subregion"), rollup(rows, 1, True))
    assert_close(table(reports.store_report(detail, CFG), "store_name"), rollup(rows, 3, False))

    worst = sorted(rollup(rows, 1, True).items(), key=lambda item: (round(item[1][0], 12), item[0]))[:2]
    got = reports.lagging_subregions(detail, CFG, k=2).collect()
    assert [r.subregion for r in got] == [name for name, _ in worst]


def missing(x):
    return x is None or math.isnan(x)


def expected_adjustments(rows):
    by_title = defaultdict(list)
    for row in rows:
        by_title[row[0]].append(row)
    out, rejected = [], set()
    for title, group in by_title.items():
        kept = [r for r in group if missing(r[3]) or missing(r[4]) or r[4] - r[3] != 0]
        if any(missing(r[3]) or math.isinf(r[3]) for r in kept):
            rejected.add(title)
            continue
        for _, code, sku, shelf, store in kept:
            quantity = None if missing(store) else store - int(shelf)
            out.append((title, code.replace("''", ""), sku, quantity))
    return out, rejected


@pytest.mark.parametrize("seed", range(6))
def test_stock(spark, seed):
    rng = random.Random(seed)
    figures = [0.0, 1.0, 2.0, 2.5, -1.5, 7.0, 7.9]
    rows = [
        (
            f"T{rng.randint(0, 30)}",
            rng.choice(["''", "", "''''"]) + f"S{rng.randint(0, 5)}",
            f"k{i}",
            rng.choice(figures * 6 + [None, float("nan"), float("inf")]),
            rng.choice(figures * 4 + [None, float("nan")]),
        )
        for i in range(200)
    ]
    mismatch = stock_ops.stock_mismatch(spark.createDataFrame(rows, schemas.STOCK).repartition(3))
    expected, rejected = expected_adjustments(rows)
    got = [(r.title, r.store_code, r.sku, r.adjust_qty) for r in stock_ops.adjustments(mismatch, StockConfig()).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert {r.title for r in stock_ops.rejected_products(mismatch).collect()} == rejected
