"""Explicit schemas of the logical tables and the load-time checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHOP = "store_code string not null, store_name string, store_type string, region string, subregion string"
MEMBER = (
    "member_id string not null, service_store string, registered_at timestamp_ntz, "
    "union_id string, activated string"
)
PURCHASE = "member_id string, sku string, channel string, purchased_at timestamp_ntz, amount decimal(18,2)"
GOODS = "sku string not null, goods_class string"
CONTACT = "union_id string, added_at timestamp_ntz"
FOLLOWER = "first_shop_code string, mobile string, followed_at timestamp_ntz, guide_no string"
SESSION = "session_id string not null, last_agent string, transcript string"
STOCK = "title string, store_code string, sku string, shelf_stock double, store_stock double"
PRODUCT = "page_no int, title string, href string, stock_mode string"
PAGES = "page_id bigint, url string, html string"

DETAIL_KEYS = ["region", "subregion", "store_code", "store_name", "store_type"]
DETAIL_COUNTS = ["buyers", "added", "new_buyers", "new_added", "old_buyers", "old_added"]


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select ``columns`` in this order; a missing one is an error at plan time."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df.select(*columns)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keep and rename the columns of ``names`` (source name -> our name)."""
    require_columns(df, list(names))
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def trim_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Strip blanks around join keys, for sources whose equality ignores them."""
    return df.withColumns({k: F.trim(k) for k in keys})


def fail_unless_one(copies: Column, what: str) -> Column:
    """``copies`` when it is 1, else a task failure: a uniqueness check inside the plan."""
    message = F.concat(F.lit(f"{what} is not unique: "), copies.cast("string"), F.lit(" rows share one key"))
    return F.when(copies == 1, copies).otherwise(F.raise_error(message).cast("bigint"))
