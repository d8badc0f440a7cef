from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storewright import fixed_values as fixed
from storewright import schemas
from storewright.config import ConversionConfig
from storewright.operators import conversion as ops

CFG = ConversionConfig(date(2024, 3, 1), date(2024, 3, 31))
OLD, NEW = datetime(2024, 2, 29, 23, 59, 59), datetime(2024, 3, 10)
BOUGHT = datetime(2024, 3, 15, 12)
CHANNEL, CLASS = fixed.CHANNELS[0], "ring"


class World:
    """A small set of source tables; one store and one sellable SKU unless told otherwise."""

    def __init__(self, spark):
        self.spark = spark
        self.shops = [("A1", "North", "x", "R1", "S1")]
        self.goods = [("K1", CLASS)]
        self.members, self.purchases, self.contacts = [], [], []

    def member(self, member_id, store="A1", registered=NEW, union=None, activated="是"):
        self.members.append((member_id, store, registered, union, activated))
        return self

    def buys(self, member_id, sku="K1", channel=CHANNEL, at=BOUGHT, amount="1.00"):
        self.purchases.append((member_id, sku, channel, at, None if amount is None else Decimal(amount)))
        return self

    def tables(self):
        pairs = (
            (self.shops, schemas.SHOP),
            (self.members, schemas.MEMBER),
            (self.purchases, schemas.PURCHASE),
            (self.goods, schemas.GOODS),
            (self.contacts, schemas.CONTACT),
        )
        return [self.spark.createDataFrame(rows, schema) for rows, schema in pairs]

    def detail(self, **options):
        rows = ops.conversion_detail(*self.tables(), CFG, **options).collect()
        return {r.store_code: r for r in rows}


@pytest.fixture
def world(spark):
    return World(spark)


def counts(row):
    return tuple(row[c] for c in schemas.DETAIL_COUNTS)


def test_new_old_and_neither(world):
    world.member("n").member("o", registered=OLD)
    world.member("late", registered=datetime(2024, 4, 1)).member("unknown", registered=None)
    for m in ("n", "o", "late", "unknown"):
        world.buys(m)
    assert counts(world.detail()["A1"]) == (4, 0, 1, 0, 1, 0)


def test_period_bounds(world):
    kept = {
        "first": datetime(2024, 3, 1),
        "last": datetime(2024, 3, 31, 23, 59, 59),
    }
    dropped = {
        "before": datetime(2024, 2, 29, 23, 59, 59),
        "fraction": datetime(2024, 3, 31, 23, 59, 59, 500000),
        "after": datetime(2024, 4, 1),
    }
    for name, at in {**kept, **dropped}.items():
        world.member(name).buys(name, at=at)
    assert world.detail()["A1"].buyers == len(kept)


def test_purchases_that_do_not_count(world):
    world.goods += [("G1", fixed.EXCLUDED_CLASSES[0]), ("G2", None), (fixed.EXCLUDED_SKUS[0], CLASS)]
    for i, options in enumerate(
        (
            {"amount": "0.00"},
            {"amount": None},
            {"channel": "other"},
            {"channel": None},
            {"sku": "G1"},
            {"sku": "G2"},
            {"sku": fixed.EXCLUDED_SKUS[0]},
            {"sku": "not in goods"},
            {"sku": None},
        )
    ):
        world.member(f"m{i}").buys(f"m{i}", **options)
    world.member("none").member("ok").buys("ok")
    assert world.detail()["A1"].buyers == 1


def test_many_purchases_count_once(world):
    world.member("m").buys("m").buys("m").buys("m", amount="9.00")
    assert world.detail()["A1"].buyers == 1


def test_members_that_do_not_count(world):
    world.member("off", activated="否").member("null", activated=None)
    world.member("stray", store="Z9").member("homeless", store=None).member("ok")
    for m in ("off", "null", "stray", "homeless", "ok"):
        world.buys(m)
    detail = world.detail()
    assert set(detail) == {"A1"} and detail["A1"].buyers == 1


def test_contacts(world):
    world.member("a", union="u1").member("b", union="u2").member("c", union=None)
    world.member("d", union="u1", registered=OLD)
    for m in "abcd":
        world.buys(m)
    late = datetime(2024, 4, 1)
    world.contacts += [("u1", NEW), ("u1", late), ("u2", late), (None, NEW)]
    # u1 belongs to a new and to an old member: counted once in total, once in each class.
    assert counts(world.detail()["A1"]) == (4, 1, 3, 1, 1, 1)


def test_member_with_several_rows_is_counted_per_class(world):
    world.member("m", union="u1").member("m", registered=OLD, union="u2").member("m", union="u1")
    world.buys("m")
    world.contacts += [("u1", OLD), ("u2", OLD)]
    assert counts(world.detail()["A1"]) == (1, 2, 1, 1, 1, 1)


def test_store_types_and_regions(world):
    world.shops = [
        ("A", "a", fixed.AGENT_STORE_TYPE, "R1", "S1"),
        ("B", "b", "anything", "R1", "S1"),
        ("C", "c", None, "R1", None),
        ("D", "d", "x", None, "S1"),
        ("E", "e", "x", fixed.EXCLUDED_REGION, "S1"),
    ]
    for code in "ABCDE":
        world.member(code, store=code).buys(code)
    assert {c: r.store_type for c, r in world.detail().items()} == {"A": "agent", "B": "own", "C": "own"}


def test_duplicate_store_code(world):
    world.shops.append(("A1", "North", "x", "R1", "S1"))
    world.member("m", union="u").buys("m")
    world.contacts.append(("u", OLD))
    with pytest.raises(Exception, match="shop.store_code is not unique"):
        world.detail()
    assert counts(world.detail(check_unique=False)["A1"]) == (2, 2, 2, 2, 0, 0)


def test_duplicate_code_with_other_attributes_gives_a_row_each(world):
    world.shops.append(("A1", "North", "x", None, "S1"))
    world.shops.append(("A1", "Nord", "x", "R1", "S1"))
    world.member("m").buys("m")
    rows = ops.conversion_detail(*world.tables(), CFG, check_unique=False).collect()
    assert {(r.store_name, r.buyers) for r in rows} == {("North", 3), ("Nord", 3)}


def test_counts_equal_plain_conditional_distinct_counts(spark, world):
    """Against the inner-join form with one distinct aggregate per measure."""
    world.shops = [(f"A{i}", f"n{i}", "x", "R", "S") for i in range(5)]
    for i in range(300):
        registered = (OLD, NEW, None, datetime(2024, 4, 2))[i * 7 % 4]
        union = None if i % 5 == 0 else f"u{i * 13 % 90}"
        # Ids repeat, in several stores and with several classes.
        world.member(f"m{i % 110}", f"A{i * i % 6}", registered, union)
    for i in range(400):
        world.buys(f"m{i * 31 % 140}", amount=str(i % 3))
    world.contacts = [(f"u{i}", OLD) for i in range(0, 90, 2)] * 2
    shop, member, purchase, goods, contact = world.tables()
    for name, df in zip(("t_shop", "t_member", "t_purchase", "t_goods", "t_contact"), world.tables()):
        df.createOrReplaceTempView(name)
    new = "m.registered_at BETWEEN '2024-03-01' AND '2024-03-31 23:59:59'"
    old = "m.registered_at < '2024-03-01'"
    expected = spark.sql(
        f"""SELECT s.store_code, count(DISTINCT c.member_id), count(DISTINCT q.union_id),
               count(DISTINCT CASE WHEN {new} THEN c.member_id END), count(DISTINCT CASE WHEN {new} THEN q.union_id END),
               count(DISTINCT CASE WHEN {old} THEN c.member_id END), count(DISTINCT CASE WHEN {old} THEN q.union_id END)
            FROM t_member m JOIN t_shop s ON s.store_code = m.service_store
            JOIN t_purchase c ON c.member_id = m.member_id JOIN t_goods g ON g.sku = c.sku
            LEFT JOIN (SELECT DISTINCT union_id FROM t_contact) q ON q.union_id = m.union_id
            WHERE c.amount > 0 GROUP BY s.store_code"""
    ).collect()
    got = ops.conversion_detail(shop, member, purchase, goods, contact, CFG).select(
        "store_code", *schemas.DETAIL_COUNTS
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected))


def test_partitioning_does_not_matter(world):
    for i in range(40):
        world.member(f"m{i}", union=f"u{i % 9}").buys(f"m{i % 25}")
        world.contacts.append((f"u{i % 4}", OLD))
    tables = world.tables()
    plain = ops.conversion_detail(*tables, CFG).collect()
    spread = ops.conversion_detail(*[t.repartition(5).orderBy(F.desc(t.columns[0])) for t in tables], CFG).collect()
    assert plain == spread
    assert plain[0].added <= plain[0].buyers
    assert plain[0].new_buyers + plain[0].old_buyers <= plain[0].buyers


def test_followers(spark):
    start, end, guide = datetime(2024, 3, 1), datetime(2024, 3, 31, 23, 59, 59), "g"
    rows = [
        (" A1", "1", start, guide),
        ("A1 ", "1", end, guide),
        ("A1", "2", end, fixed.EXCLUDED_GUIDES[0]),
        ("A1", "3", end, None),
        ("A2", "4", datetime(2024, 4, 1), guide),
        ("A3\t", "5", end, guide),
        ("A4", None, end, guide),
    ]
    got = ops.new_followers(spark.createDataFrame(rows, schemas.FOLLOWER), CFG).collect()
    assert {(r.store_code, r.new_followers) for r in got} == {("A1", 1), ("A3\t", 1), ("A4", 0)}


def test_empty_sources_give_an_empty_detail(world):
    assert world.detail() == {}
