"""The logical tables, derived from the generic test tables of an ``sf_dir``.

Used by ``__spark_entry__.py``, the tests and the benchmark. Every stand-in
reads whole tables. ``ORACLE`` states the same derivations in SQL, one
common table expression each.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from storewright import fixed_values as fixed
from storewright.config import ConversionConfig

CONFIG = ConversionConfig(
    period_start=date(1996, 1, 1),
    period_end=date(1996, 12, 31),
    channels=("F", "O"),
    excluded_classes=("PROMO", "ECONOMY"),
    excluded_skus=(1, 2, 3, 5, 8, 13),
    excluded_guides=("1-URGENT", "5-LOW"),
    activated_flag="Y",
)
BOT = "assistant"
# Topic rules of the offline classifier, in order.
TOPIC_RULES = {"delivery": "keit[ .,]", "coupon": "Que |Les ", "repair": "And |Tion", "quality": "er[.]$", "points": "and[.]"}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table. Its schema is looked up once; each lookup is a Spark job of its own."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    stores = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return stores.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("s_suppkey").alias("store_code"),
        F.col("s_name").alias("store_name"),
        F.when(F.col("s_suppkey") % 3 == 0, fixed.AGENT_STORE_TYPE).otherwise("x").alias("store_type"),
        F.when(F.col("s_suppkey") % 11 != 0, F.col("r_name")).otherwise(CONFIG.excluded_region).alias("region"),
        F.col("n_name").alias("subregion"),
    )


def _service_store(spark: SparkSession, sf_dir: str):
    stores = table(spark, sf_dir, "supplier").select(F.count("*")).scalar()
    return F.col("c_custkey") % stores


def member(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_order = (
        table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("registered_at"))
    )
    customer = table(spark, sf_dir, "customer")
    return customer.join(first_order, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("member_id"),
        _service_store(spark, sf_dir).alias("service_store"),
        "registered_at",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")).alias("union_id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", "Y").otherwise("N").alias("activated"),
    )


def purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("member_id"),
        F.col("l_partkey").alias("sku"),
        F.col("o_orderstatus").alias("channel"),
        F.col("o_orderdate").alias("purchased_at"),
        F.when(F.col("l_linenumber") % 3 == 2, -F.col("l_extendedprice"))
        .when(F.col("l_linenumber") % 4 != 0, F.col("l_extendedprice"))
        .alias("amount"),
    )


def goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku"), F.col("p_type").alias("goods_class")
    )


def contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups, moved back so that 2024-01-26 falls on the day after the period."""
    signup = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    return signup.select(
        F.col("user_id").alias("union_id"), (F.col("ts") - F.expr("INTERVAL 9886 DAYS")).alias("added_at")
    )


def follower(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", _service_store(spark, sf_dir).alias("store")
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("  "), F.col("store").cast("string"), F.lit(" ")).alias("first_shop_code"),
        F.col("c_name").alias("mobile"),
        F.col("o_orderdate").alias("followed_at"),
        F.col("o_orderpriority").alias("guide_no"),
    )


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_partkey")
        .agg(
            F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity") - F.col("l_linenumber") / 4)).alias("shelf"),
            F.sum("l_quantity").alias("store_stock"),
        )
    )
    no_shelf = F.when(F.col("l_partkey") % 10 != 0, F.lit(0.0))
    named = sums.select(
        F.concat(F.lit("T"), (F.col("l_partkey") % 50).cast("string")).alias("title"),
        F.concat(F.lit("''"), F.col("l_suppkey").cast("string")).alias("store_code"),
        F.col("l_partkey").cast("string").alias("sku"),
        F.coalesce("shelf", no_shelf).alias("shelf_stock"),
        "store_stock",
    )
    # Said here, the condition is the same wherever the table is used, and the
    # two sides of the quarantine share one aggregation.
    return named.filter(F.col("title").isNotNull())


def text_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as an export read as text: some cells are empty, some hold words."""
    rows = stock(spark, sf_dir)
    kind = F.col("sku").cast("int") % 13
    return rows.select(
        "title", "store_code", "sku",
        F.when(kind == 1, "none").when(kind == 2, "").otherwise(F.col("shelf_stock").cast("string")).alias("shelf_stock"),
        F.when(kind == 3, "").when(kind == 4, "?").otherwise(F.col("store_stock").cast("string")).alias("store_stock"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of products over 50 pages; titles repeat from page to page."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        (F.floor(key % 2000 / 40) + 1).cast("int").alias("page_no"),
        F.concat(F.lit("T"), (key % 50).cast("string")).alias("title"),
        F.concat(F.lit("/edit?id="), key.cast("string")).alias("href"),
        F.when((F.col("p_size") % 2 == 0) & (key % 50 < 30), fixed.REAL_STOCK_MODE)
        .otherwise("虚拟库存")
        .alias("stock_mode"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One paged product list per brand, with the link to its last page."""
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    base = F.concat(F.lit("https://shop.example/list?brand="), F.replace("p_brand", F.lit("#"), F.lit("%23")))
    last = F.ceil(F.col("n") / 10).cast("string")
    return brands.select(base.alias("base_url"), F.concat(base, F.lit("&page="), last).alias("last_href"))


def session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per turn and the one after it, each under a "name timestamp" line.

    Paired by an equi-join on (conversation, turn), so that a conversation of
    any length is never gathered in one place.
    """
    turns = table(spark, sf_dir, "conversations")
    stamp = " 2024-01-01 10:00:00\n"
    reply = turns.select(
        "conv_id",
        (F.col("turn") - 1).alias("turn"),
        F.col("role").alias("last_agent"),
        F.concat("role", F.lit(stamp), "text").alias("reply"),
    )
    return (
        turns.join(reply, ["conv_id", "turn"], "left")
        .select(
            F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("session_id"),
            "last_agent",
            F.concat("role", F.lit(stamp), "text", F.lit("\n"), "reply").alias("transcript"),
        )
    )


def answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw classifier answer per document, in the nine forms the parser has to tell apart."""
    quality = F.coalesce(F.col("quality").cast("string"), F.lit("0"))
    key = F.col("doc_id") % 9
    pair = F.format_string('{"is_service": "%s", "category": "%s"}', quality, F.col("source"))
    number = F.format_string('{"is_service": %s, "category": "%s"}', quality, F.col("source"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id",
        F.when(key == 0, F.concat(F.lit("\n\n```json\n"), pair, F.lit("\n```")))
        .when(key == 1, number)
        .when(key == 2, F.concat(F.lit("Here you are: ```"), number, F.lit("```")))
        .when(key == 3, F.format_string('{"category": "%s"}', F.col("source")))
        .when(key == 4, F.concat(F.lit("no json: "), F.col("source")))
        .when(key == 5, F.format_string('{"is_service": "%s", "category": null}', quality))
        .when(key == 7, F.concat(pair, F.lit(' or {"is_service": "1", "category": "x"}')))
        .when(key == 8, F.format_string('{"category": "first", "is_service": "x", "category": "%s", "is_service": %s}',
                                        F.col("source"), quality))
        .alias("answer"),
    )


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question per order with a category, in some rows without one: one in a third of them, common ones, rare ones."""
    customer = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderpriority")).alias("category"),
        F.when(F.col("o_orderkey") % 3 == 0, "When will my order arrive?")
        .when(F.col("o_orderkey") % 19 == 0, None)
        .when(customer % 2 == 0, F.concat(F.lit("Is article "), F.floor(F.sqrt(customer)).cast("string"), F.lit(" sold?")))
        .otherwise(F.concat(F.lit("Who is customer "), customer.cast("string"), F.lit("?")))
        .alias("text"),
    )


# The same tables in SQL for DuckDB.
ORACLE = {
    "shop": """
        SELECT s_suppkey AS store_code, s_name AS store_name,
               CASE WHEN s_suppkey % 3 = 0 THEN '代理店' ELSE 'x' END AS store_type,
               CASE WHEN s_suppkey % 11 <> 0 THEN r_name ELSE '营销管理部' END AS region, n_name AS subregion
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "member": """
        SELECT c_custkey AS member_id, c_custkey % (SELECT count(*) FROM supplier) AS service_store,
               (SELECT min(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS registered_at,
               CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS union_id,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'Y' ELSE 'N' END AS activated
        FROM customer""",
    "purchase": """
        SELECT o_custkey AS member_id, l_partkey AS sku, o_orderstatus AS channel,
               o_orderdate AS purchased_at, CASE WHEN l_linenumber % 3 = 2 THEN -l_extendedprice
               WHEN l_linenumber % 4 <> 0 THEN l_extendedprice END AS amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "goods": "SELECT p_partkey AS sku, p_type AS goods_class FROM part",
    "contact": """
        SELECT user_id AS union_id, ts - INTERVAL 9886 DAY AS added_at
        FROM events WHERE event_type = 'signup'""",
    "follower": """
        SELECT '  ' || CAST(c_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) || ' ' AS first_shop_code,
               c_name AS mobile, o_orderdate AS followed_at, o_orderpriority AS guide_no
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "stock": """
        SELECT 'T' || CAST(l_partkey % 50 AS VARCHAR) AS title,
               '''''' || CAST(l_suppkey AS VARCHAR) AS store_code, CAST(l_partkey AS VARCHAR) AS sku,
               coalesce(sum(l_quantity - l_linenumber / 4) FILTER (WHERE l_returnflag = 'N'),
                        CASE WHEN l_partkey % 10 <> 0 THEN 0.0 END) AS shelf_stock,
               sum(l_quantity) AS store_stock
        FROM lineitem GROUP BY l_suppkey, l_partkey""",
    "text_stock": """
        SELECT title, store_code, sku,
               CASE CAST(sku AS INTEGER) % 13 WHEN 1 THEN 'none' WHEN 2 THEN '' ELSE CAST(shelf_stock AS VARCHAR) END AS shelf_stock,
               CASE CAST(sku AS INTEGER) % 13 WHEN 3 THEN '' WHEN 4 THEN '?' ELSE CAST(store_stock AS VARCHAR) END AS store_stock
        FROM stock""",
    "product": """
        SELECT CAST(p_partkey % 2000 // 40 + 1 AS INTEGER) AS page_no,
               'T' || CAST(p_partkey % 50 AS VARCHAR) AS title,
               '/edit?id=' || CAST(p_partkey AS VARCHAR) AS href,
               CASE WHEN p_size % 2 = 0 AND p_partkey % 50 < 30 THEN '真实库存' ELSE '虚拟库存' END AS stock_mode
        FROM part""",
    "listing": """
        SELECT base_url, base_url || '&page=' || CAST(CAST(ceil(n / 10.0) AS BIGINT) AS VARCHAR) AS last_href
        FROM (SELECT 'https://shop.example/list?brand=' || replace(p_brand, '#', '%23') AS base_url,
                     count(*) AS n FROM part GROUP BY p_brand)""",
    "session": """
        SELECT u.conv_id || '-' || u.turn AS session_id, r.role AS last_agent,
               u.role || ' 2024-01-01 10:00:00' || chr(10) || u.text || chr(10)
               || r.role || ' 2024-01-01 10:00:00' || chr(10) || r.text AS transcript
        FROM conversations u LEFT JOIN conversations r ON r.conv_id = u.conv_id AND r.turn = u.turn + 1""",
    "asked": """
        SELECT CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END AS category,
               CASE WHEN o_orderkey % 3 = 0 THEN 'When will my order arrive?'
                    WHEN o_orderkey % 19 = 0 THEN NULL
                    WHEN o_custkey % 2 = 0 THEN 'Is article ' || CAST(CAST(floor(sqrt(o_custkey)) AS BIGINT) AS VARCHAR) || ' sold?'
                    ELSE 'Who is customer ' || CAST(o_custkey AS VARCHAR) || '?' END AS text
        FROM orders""",
    "answer": """
        SELECT doc_id, CASE doc_id % 9
            WHEN 0 THEN chr(10) || chr(10) || '```json' || chr(10) || pair || chr(10) || '```'
            WHEN 1 THEN number
            WHEN 2 THEN 'Here you are: ```' || number || '```'
            WHEN 3 THEN '{"category": "' || source || '"}'
            WHEN 4 THEN 'no json: ' || source
            WHEN 5 THEN '{"is_service": "' || quality || '", "category": null}'
            WHEN 7 THEN pair || ' or {"is_service": "1", "category": "x"}'
            WHEN 8 THEN '{"category": "first", "is_service": "x", "category": "' || source
                        || '", "is_service": ' || quality || '}' END AS answer
        FROM (SELECT doc_id, source, quality,
                     '{"is_service": "' || quality || '", "category": "' || source || '"}' AS pair,
                     '{"is_service": ' || quality || ', "category": "' || source || '"}' AS number
              FROM (SELECT d.doc_id, d.source, coalesce(CAST(l.quality AS VARCHAR), '0') AS quality
                    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id))""",
}


def oracle_tables(*names: str) -> str:
    """``name AS (...)`` items for the WITH clause of an oracle query."""
    return ",\n".join(f"{name} AS ({ORACLE[name]})" for name in names)
