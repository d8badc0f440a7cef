"""Distinct buyers per store and how many of them were added as channel contacts.

Shape of the plan, from the big end:

* Purchases leave as one row per buying member. The distinct is combined on
  the map side, so a member with a third of all purchases costs one row per
  task in the shuffle.
* Members are joined to that list by a semi join: only distinct ids are counted
  afterwards, so the inner join's fan-out is never produced. The join spreads an
  id that many member rows share.
* A distinct count with a condition is a maximum of a flag per (store, id)
  followed by plain counts per store. That is exact also when an id has several
  rows, and replaces six distinct aggregates, which would multiply the rows by
  six before the first shuffle. Buyers and channel ids are two kinds of ids, so
  each member row becomes two small ones after the semi join, and one grouping by
  (store, kind, id), combined before its shuffle, serves all six counts. It spreads
  a hot store; the counts per store are combined on the map side.
* So members are shuffled twice: for the semi join, and as ids for the grouping.
* The store dimension is joined last, to one row per store.

No side is hinted as broadcast. Catalyst and AQE broadcast a side they measured
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merge, where
AQE splits hot SKU partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storewright.config import ConversionConfig
from storewright.functions.text import trim_blanks
from storewright.operators.spread import spread_join
from storewright.schemas import DETAIL_COUNTS, DETAIL_KEYS, fail_unless_one

# Keys made of one member id. Few, because the list of buyers grows by this
# factor; AQE splits further where one slice is still too large.
MEMBER_SLICES = 4


def store_type_label(store_type: Column, cfg: ConversionConfig) -> Column:
    """Agent stores are 'agent'; anything else, NULL included, is 'own'."""
    return F.when(store_type == cfg.agent_store_type, cfg.agent_label).otherwise(cfg.own_label)


def buying_members(purchase: DataFrame, goods: DataFrame, cfg: ConversionConfig) -> DataFrame:
    """``member_id`` of everyone with at least one counted purchase in the period."""
    # No distinct on the goods: a semi join needs none, and an aggregate between
    # its shuffle and the join would keep AQE from splitting a hot SKU.
    counted_goods = (
        goods.filter(~F.col("goods_class").isin(*cfg.excluded_classes))
        .filter(~F.col("sku").isin(*cfg.excluded_skus))
        .select("sku")
    )
    return (
        cfg.of_period(purchase, "purchased_at")
        .filter(F.col("channel").isin(*cfg.channels))
        .filter(F.col("amount") > 0)
        .filter(~F.col("sku").isin(*cfg.excluded_skus))
        .select("member_id", "sku")
        .join(counted_goods, "sku", "left_semi")
        .select("member_id")
        .distinct()
    )


def _activated_rows(member: DataFrame, cfg: ConversionConfig) -> DataFrame:
    registered = F.col("registered_at")
    return (
        member.filter(F.col("activated") == cfg.activated_flag)
        .filter(F.col("service_store").isNotNull() & F.col("member_id").isNotNull())
        .select(
            F.col("service_store").alias("store_code"),
            "member_id",
            "union_id",
            F.coalesce(cfg.in_period(registered), F.lit(False)).alias("is_new"),
            F.coalesce(registered < cfg.start_ts, F.lit(False)).alias("is_old"),
        )
    )


def activated_members(member: DataFrame, cfg: ConversionConfig) -> DataFrame:
    """Activated members with a service store, and whether they registered in or before the period; each once."""
    return _activated_rows(member, cfg).distinct()


def _who_bought(members: DataFrame, buyers: DataFrame) -> DataFrame:
    return spread_join(members, buyers, "member_id", "left_semi", ["store_code", "union_id"], MEMBER_SLICES)


def qualifying_members(
    member: DataFrame, purchase: DataFrame, goods: DataFrame, cfg: ConversionConfig
) -> DataFrame:
    """Activated members who bought, each once. An id shared by many member rows is spread over several tasks."""
    return _who_bought(activated_members(member, cfg), buying_members(purchase, goods, cfg))


def qualifying_rows(member: DataFrame, purchase: DataFrame, goods: DataFrame, cfg: ConversionConfig) -> DataFrame:
    """The same with repeated rows as they come: enough for distinct counts, and without the shuffle of a distinct."""
    return _who_bought(_activated_rows(member, cfg), buying_members(purchase, goods, cfg))


def contact_ids(contact: DataFrame, cfg: ConversionConfig) -> DataFrame:
    """Distinct channel ids added up to the end of the period."""
    return (
        contact.filter(F.col("added_at") <= cfg.end_ts)
        .filter(F.col("union_id").isNotNull())
        .select("union_id")
        .distinct()
    )


def store_counts(members: DataFrame, contact: DataFrame, cfg: ConversionConfig) -> DataFrame:
    """Six distinct counts per service store; ``members`` as given by `qualifying_members` or `qualifying_rows`.

    Ids are tagged with what they count as, so member and channel ids go through
    one grouping. Only ids tagged as channel ids can be contacts.
    """
    kinds = {dict(members.dtypes)[c] for c in ("member_id", "union_id")}
    kind = kinds.pop() if len(kinds) == 1 else "string"

    def tagged(name: str, column: str) -> Column:
        return F.struct(F.lit(name).alias("counts_as"), F.col(column).cast(kind).alias("id"))

    both = F.explode(F.array(tagged("buyer", "member_id"), tagged("added", "union_id")))
    ids = members.select("store_code", "is_new", "is_old", both.alias("one")).select(
        "store_code", "one.counts_as", "one.id", "is_new", "is_old"
    )
    per_id = (
        ids.filter(F.col("id").isNotNull())
        .groupBy("store_code", "counts_as", "id")
        .agg(F.bool_or("is_new").alias("is_new"), F.bool_or("is_old").alias("is_old"))
    )
    contacts = contact_ids(contact, cfg).select(
        F.lit("added").alias("counts_as"), F.col("union_id").cast(kind).alias("id"), F.lit(True).alias("known")
    )
    is_buyer, is_added = F.col("counts_as") == "buyer", F.col("known").isNotNull()
    return (
        per_id.join(contacts, ["counts_as", "id"], "left")
        .groupBy("store_code")
        .agg(
            F.count_if(is_buyer).alias("buyers"),
            F.count_if(is_added).alias("added"),
            F.count_if(is_buyer & F.col("is_new")).alias("new_buyers"),
            F.count_if(is_added & F.col("is_new")).alias("new_added"),
            F.count_if(is_buyer & F.col("is_old")).alias("old_buyers"),
            F.count_if(is_added & F.col("is_old")).alias("old_added"),
        )
    )


def conversion_detail(
    shop: DataFrame,
    member: DataFrame,
    purchase: DataFrame,
    goods: DataFrame,
    contact: DataFrame,
    cfg: ConversionConfig,
    check_unique: bool = True,
) -> DataFrame:
    """One row per store with buyers: the base table of all reports.

    Stores with the excluded or no region are left out. With ``check_unique``
    a store code that occurs twice in ``shop`` fails the job; without it the
    counts are multiplied by the number of its rows, as an outer join of the
    dimension to the counts would give.
    """
    copies = shop.groupBy("store_code").agg(F.count("*").alias("copies"))
    if check_unique:
        copies = copies.withColumn("copies", fail_unless_one(F.col("copies"), "shop.store_code"))
    stores = (
        shop.filter(F.col("region").isNotNull() & (F.col("region") != cfg.excluded_region))
        .withColumn("store_type", store_type_label(F.col("store_type"), cfg))
        .select(*DETAIL_KEYS)
        .distinct()
    )
    counts = store_counts(qualifying_rows(member, purchase, goods, cfg), contact, cfg)
    return (
        stores.join(counts, "store_code")
        .join(copies, "store_code")
        .select(*DETAIL_KEYS, *[(F.col(c) * F.col("copies")).alias(c) for c in DETAIL_COUNTS])
    )


def new_followers(follower: DataFrame, cfg: ConversionConfig) -> DataFrame:
    """Distinct mobiles first attracted by each store in the period.

    A NULL guide is dropped along with the excluded ones.
    """
    return (
        cfg.of_period(follower, "followed_at")
        .filter(~F.col("guide_no").isin(*cfg.excluded_guides))
        .groupBy(trim_blanks(F.col("first_shop_code")).alias("store_code"))
        .agg(F.count_distinct("mobile").alias("new_followers"))
    )
