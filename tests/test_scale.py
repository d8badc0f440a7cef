"""What the plans look like, and that hot keys are split or combined."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import datetime

import pytest
from conftest import final_plan
from pyspark.sql import functions as F

import __spark_entry__ as entry
from storewright import fixed_values as fixed
from storewright import schemas, standins
from storewright.config import LabelSpec, StockConfig
from storewright.operators import conversion, reports
from storewright.operators import sessions as session_ops
from storewright.operators import stock as stock_ops
from storewright.operators.spread import SLICES, spread_join
from storewright.sources.writers import write_adjustments

SF = "/root/testdata/sf0.001"
NAMES = ("shop", "member", "purchase", "goods", "contact")
PYTHON_QUERIES = {"mojibake_repair", "repaired_labels", "classified_sessions", "label_failures"}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The stand-ins as files, so that plans show the library's own scans and shuffles."""
    base = tmp_path_factory.mktemp("tables")
    for name in (*NAMES, "stock", "session"):
        getattr(standins, name)(spark, SF).write.parquet(f"{base}/{name}")
    return lambda name: spark.read.parquet(f"{base}/{name}")


@pytest.fixture
def no_broadcast(conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")


@pytest.fixture
def eager_skew_split(conf, no_broadcast):
    """Skew thresholds scaled down to test data; the split itself is Spark's default behaviour."""
    conf(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    )


def scans(plan, column):
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", plan))


def test_detail_reads_each_large_table_once(stored, no_broadcast):
    plan = final_plan(conversion.conversion_detail(*map(stored, NAMES), standins.CONFIG))
    assert scans(plan, "purchased_at") == 1 and scans(plan, "registered_at") == 1 and scans(plan, "added_at") == 1
    semi = [x for x in plan.splitlines() if "LeftSemi" in x and "member_id" in x]
    assert len(semi) == 1, "buyers are looked up once"
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    # Member rows: by (member, slice) for the semi join, the list of buyers next to it, and as ids by (store, kind, id).
    assert len([x for x in shuffles if "_slice" in x]) == 2
    assert len([x for x in shuffles if "counts_as" in x and "store_code" in x]) == 1
    assert "Expand" not in plan, "six distinct aggregates would multiply the rows"
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_period_and_channel_reach_the_purchase_scan(stored, conf):
    conf(spark__sql__maxMetadataStringLength="2000")
    df = conversion.buying_members(stored("purchase"), stored("goods"), standins.CONFIG)
    scan = next(x for x in final_plan(df).splitlines() if "FileScan" in x and "purchased_at" in x)
    pushed = scan.split("PushedFilters")[1]
    for part in ("In(channel", "GreaterThanOrEqual(purchased_at,1996-01-01", "LessThanOrEqual(purchased_at,1996-12-31"):
        assert part in pushed
    assert "GreaterThan(amount" in pushed


def test_timestamp_columns_with_a_zone_are_pushed_down_too(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).selectExpr("timestamp_seconds(id) AS ts").write.parquet(path)
    plan = final_plan(spark.read.parquet(path).filter(standins.CONFIG.in_period(F.col("ts"))))
    assert "GreaterThanOrEqual(ts," in plan.split("PushedFilters")[1]


def test_only_the_days_of_the_period_are_read(spark, stored, tmp_path):
    path = str(tmp_path / "purchase")
    purchase = stored("purchase").withColumn("day", F.trunc("purchased_at", "MM"))
    purchase.write.partitionBy("day").parquet(path)
    cfg = replace(standins.CONFIG, day_partition="day")
    df = conversion.buying_members(spark.read.parquet(path), stored("goods"), cfg)
    scan = next(x for x in final_plan(df).splitlines() if "FileScan" in x and "purchased_at" in x)
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 1996-01-01", scan)
    plain = conversion.buying_members(stored("purchase"), stored("goods"), standins.CONFIG)
    assert sorted(df.collect()) == sorted(plain.collect())


def test_purchases_bucketed_by_member_are_not_shuffled(spark, stored, tmp_path):
    """With a bucketed table the largest input never moves: its buyers are found in place."""
    writer = stored("purchase").write.mode("overwrite").bucketBy(8, "member_id").format("parquet")
    writer.option("path", str(tmp_path / "purchase")).saveAsTable("bucketed_purchase")
    try:
        df = conversion.buying_members(spark.table("bucketed_purchase"), stored("goods"), standins.CONFIG)
        assert "Exchange hashpartitioning" not in final_plan(df)
        plain = conversion.buying_members(*map(stored, ("purchase", "goods")), standins.CONFIG)
        assert sorted(df.collect()) == sorted(plain.collect())
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_purchase")


def test_no_window_gathers_a_group(spark):
    for name, query in entry._retail_queries().items():
        plan = query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan, name
        assert "collect_" not in plan, name


def test_python_only_where_it_is_needed(spark):
    for name, query in entry._retail_queries().items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        has_python = "ArrowEvalPython" in plan or "MapInPandas" in plan
        assert has_python == (name in PYTHON_QUERIES), name
        assert "BatchEvalPython" not in plan, name


def test_no_cross_join(spark):
    for name, query in entry._retail_queries().items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_reports_share_one_pass(stored):
    detail = conversion.conversion_detail(*map(stored, NAMES), standins.CONFIG)
    assert scans(final_plan(reports.region_report(detail, standins.CONFIG)), "purchased_at") == 1
    assert "TakeOrderedAndProject" in final_plan(reports.lagging_subregions(detail, standins.CONFIG, 3))


def test_members_with_one_id_are_combined_before_the_join(spark, no_broadcast):
    """A third of all member rows, and of all purchases, belong to one member."""
    cfg = standins.CONFIG
    rows = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 0, id) AS member_id", "id % 4 AS service_store", "timestamp_ntz '1996-05-05' AS registered_at",
        "if(id % 3 = 0, 0, id % 50) AS union_id", "'Y' AS activated",
    )
    bought = rows.selectExpr(
        "member_id", "100 AS sku", "'F' AS channel", "timestamp_ntz '1996-06-01' AS purchased_at", "1.0D AS amount"
    )
    goods = spark.createDataFrame([(100, "x")], "sku int, goods_class string")
    contact = spark.createDataFrame([(i, datetime(1996, 1, 1)) for i in range(50)], "union_id int, added_at timestamp_ntz")
    by_number = schemas.SHOP.replace("store_code string", "store_code int")
    shop = spark.createDataFrame([(i, f"s{i}", "x", "R", "S") for i in range(4)], by_number)
    detail = conversion.conversion_detail(shop, rows, bought, goods, contact, cfg)
    assert detail.agg(F.sum("buyers")).first()[0] == 2000 + 4
    members = conversion.activated_members(rows, cfg).filter("member_id = 0")
    assert members.count() == 4, "one row per store instead of a thousand"


@pytest.fixture
def hot(spark, tmp_path):
    """A stored table of ``n`` rows, a third of them with key 0."""

    def make(n, *columns):
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        path = str(tmp_path / "hot")
        spark.range(n, numPartitions=6).withColumn("key", key).select(*columns).write.parquet(path)
        return spark.read.parquet(path)

    return make


def test_a_hot_sku_is_split(spark, eager_skew_split, hot, tmp_path):
    purchase = hot(
        60000, F.col("id").alias("member_id"), F.col("key").alias("sku"), F.lit("F").alias("channel"),
        F.expr("timestamp_ntz '1996-06-01'").alias("purchased_at"), F.lit(1.0).alias("amount"),
    )
    path = str(tmp_path / "goods")
    spark.range(0, 60000, 6).select(F.col("id").alias("sku"), F.lit("x").alias("goods_class")).write.parquet(path)
    df = conversion.buying_members(purchase, spark.read.parquet(path), standins.CONFIG)
    assert "SortMergeJoin(skew=true)" in final_plan(df)
    assert df.count() == purchase.filter("sku % 6 = 0").count()


def test_a_member_id_shared_by_many_rows_is_split(spark, eager_skew_split, hot, tmp_path):
    member = hot(
        60000, F.col("key").alias("member_id"), (F.col("id") % 5).alias("service_store"),
        F.expr("timestamp_ntz '1996-05-05'").alias("registered_at"), F.col("id").alias("union_id"),
        F.lit("Y").alias("activated"),
    )
    path = str(tmp_path / "purchase")
    spark.range(0, 60000, 6).select(
        F.col("id").alias("member_id"), F.lit(100).alias("sku"), F.lit("F").alias("channel"),
        F.expr("timestamp_ntz '1996-06-01'").alias("purchased_at"), F.lit(1.0).alias("amount"),
    ).write.parquet(path)
    goods = spark.createDataFrame([(100, "x")], "sku int, goods_class string")
    contact = member.select("union_id", F.expr("timestamp_ntz '1996-01-01'").alias("added_at"))
    members = conversion.qualifying_members(member, spark.read.parquet(path), goods, standins.CONFIG)
    joins = [x for x in final_plan(members).splitlines() if "SortMergeJoin" in x and "member_id" in x]
    assert joins and all("_slice" in x for x in joins)
    rows = conversion.qualifying_rows(member, spark.read.parquet(path), goods, standins.CONFIG)
    assert "skew=true" in final_plan(rows)
    counts = conversion.store_counts(rows, contact, standins.CONFIG)
    assert sorted(counts.collect()) == sorted(conversion.store_counts(members, contact, standins.CONFIG).collect())
    # Member 0 once in each of five stores; the other buyers have one row each; all channel ids are contacts.
    others = member.filter("member_id > 0 AND member_id % 6 = 0").count()
    sums = counts.agg(F.sum("buyers"), F.sum("added")).first()
    assert tuple(sums) == (others + 5, others + 20000)


def test_repeated_member_rows_are_split_and_combined(spark, eager_skew_split, hot, tmp_path):
    """A third of all member rows is one and the same row: its partition is split, and each task keeps one id of it."""
    key = F.col("key")
    member = hot(
        60000, key.alias("member_id"), (key % 5).alias("service_store"),
        F.expr("timestamp_ntz '1996-05-05'").alias("registered_at"), key.alias("union_id"), F.lit("Y").alias("activated"),
    )
    path = str(tmp_path / "purchase")
    member.select(
        "member_id", F.lit(100).alias("sku"), F.lit("F").alias("channel"),
        F.expr("timestamp_ntz '1996-06-01'").alias("purchased_at"), F.lit(1.0).alias("amount"),
    ).write.parquet(path)
    goods = spark.createDataFrame([(100, "x")], "sku int, goods_class string")
    contact = member.select("union_id", F.expr("timestamp_ntz '1996-01-01'").alias("added_at"))
    rows = conversion.qualifying_rows(member, spark.read.parquet(path), goods, standins.CONFIG)
    assert "skew=true" in final_plan(rows)
    sums = conversion.store_counts(rows, contact, standins.CONFIG).agg(F.sum("buyers"), F.sum("added")).first()
    assert tuple(sums) == (40001, 40001)


def test_a_hot_title_is_spread(spark, eager_skew_split, hot):
    stock = hot(
        60000, F.concat(F.lit("T"), F.col("key").cast("string")).alias("title"),
        F.col("id").cast("string").alias("store_code"), F.lit("k").alias("sku"),
        F.when(F.col("key") % 7 != 1, 1.0).alias("shelf_stock"), F.lit(3.0).alias("store_stock"),
    )
    df = stock_ops.adjustments(stock_ops.stock_mismatch(stock), StockConfig())
    (join,) = [x for x in final_plan(df).splitlines() if "SortMergeJoin" in x]
    assert "slice" in join and "LeftAnti" in join
    assert df.count() == stock.filter("shelf_stock IS NOT NULL").count()

    listed = stock_ops.only_products(stock, stock.select("title"))
    (join,) = [x for x in final_plan(listed).splitlines() if "SortMergeJoin" in x]
    assert "slice" in join and "LeftSemi" in join
    assert listed.count() == 60000


def test_slices_are_even_and_aqe_can_split_them(spark, eager_skew_split, hot):
    rows = hot(60000, "id", "key")
    keys = rows.select("key").distinct()
    for how in ("left_semi", "inner"):
        whole = spread_join(rows, keys, "key", how, ["id"], slices=1)
        assert "SortMergeJoin(skew=true)" in final_plan(whole)
        spread = spread_join(rows, keys, "key", how, ["id"])
        assert whole.count() == spread.count() == 60000
    sizes = rows.filter("key = 0").groupBy(F.pmod(F.xxhash64("id"), F.lit(SLICES))).count()
    assert sizes.count() == SLICES and sizes.agg(F.max("count")).first()[0] < 20000 / SLICES * 1.2
    assert spread_join(rows, keys.filter("key > 0"), "key", "left_anti", ["id"]).count() == 20000


def test_a_text_copied_into_a_third_of_the_sessions_is_split(spark, eager_skew_split, conf, hot):
    conf(spark__sql__adaptive__skewJoin__skewedPartitionFactor="0.5")  # equal hashes compress well
    texts = hot(
        60000, F.col("id").cast("string").alias("session_id"),
        F.concat(F.lit("text "), F.col("key").cast("string")).alias("text"),
    )
    spec = LabelSpec()

    def factory():
        head, tail = spec.prompt_parts()
        return lambda prompts: [
            '{"is_service": 1, "category": "%s"}' % p[len(head) : len(p) - len(tail)] for p in prompts
        ]

    df = session_ops.classify(texts, factory, spec)
    assert "SortMergeJoin(skew=true)" in final_plan(df)
    wrong = df.join(texts, "session_id").filter("NOT category <=> text")
    assert df.count() == 60000 and wrong.isEmpty()


def test_transcripts_are_not_shuffled_with_the_labels(stored, no_broadcast):
    texts = session_ops.cleaned_sessions(stored("session"), standins.BOT)
    labels = texts.select(session_ops.text_hash(F.col("text")).alias("text_hash")).distinct().withColumns(
        {"is_service": F.lit("1"), "category": F.lit("c"), "label_status": F.lit("ok")}
    )
    plan = final_plan(session_ops.attach_labels(texts, labels, LabelSpec()))
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "text_hash" in line


def test_sinks_rebalance_a_hot_title(spark, conf, hot, tmp_path):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB")
    rows = hot(
        30000,
        *[F.col("id").cast("string").alias(c) for c in fixed.ADJUSTMENT_HEADERS],
        F.when(F.col("key") == 0, "hot").otherwise("other").alias("title"),
    )
    write_adjustments(rows, str(tmp_path / "out"))
    files = list((tmp_path / "out" / "title=hot").glob("*.csv"))
    assert len(files) > 1, "one task would have written the whole title"
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 30000
