"""Registered queries and their SQL counterparts.

Every query reads whole tables of an ``sf_dir`` through the stand-ins of
``storewright.standins``. The SQL states the plain form of each computation
(inner joins, conditional distinct counts), independent of how Spark is asked
to compute it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storewright import fixed_values as fixed
from storewright import standins
from storewright.config import LabelSpec, StockConfig
from storewright.functions import periods, rates, text
from storewright.operators import catalog, conversion, questions, reports, rollups, sessions
from storewright.operators import stock as stock_ops
from storewright.operators.label_log import LabelLog
from storewright.operators.repair import repair_columns
from storewright.plans import member_conversion
from storewright.session import shared_folder
from storewright.sources import readers, writers
from storewright.sources.publish import published_paths
from storewright.standins import BOT, CONFIG, TOPIC_RULES, oracle_tables

try:  # the folder of the training-data operators may be left out
    import corpus_pipeline
    from storewright.llm import queries as llm
except ImportError:
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

SPEC = LabelSpec()
STOCK = StockConfig()


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to nine places, so that the order of a float sum cannot show."""
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- member conversion -------------------------------------------------------


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("shop", "member", "purchase", "goods", "contact")
    return conversion.conversion_detail(*[getattr(standins, n)(spark, sf_dir) for n in names], CONFIG)


def _qualifying_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("member", "purchase", "goods")
    members = conversion.qualifying_members(*[getattr(standins, n)(spark, sf_dir) for n in names], CONFIG)
    return members.select("store_code", "member_id", "union_id", "is_new", "is_old")


def _store_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = conversion.store_type_label(F.col("store_type"), CONFIG)
    return standins.shop(spark, sf_dir).select("store_code", label.alias("store_type"))


def _safe_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned share of finished lines per part; parts without finished lines give 0."""
    finished = F.col("l_linestatus") == "F"
    counts = (
        standins.table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count_if(finished & (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25)).alias("part"),
            F.count_if(finished & (F.col("l_quantity") > 40)).alias("whole"),
        )
    )
    rate = rates.safe_rate(F.col("part"), F.col("whole"))
    return counts.select(
        "l_partkey",
        rate.alias("rate"),
        rates.rate_of_sums(F.col("part"), F.col("whole")).alias("rate_of_sums"),
        rates.round_half_even(rate, 2).alias("rate_2"),
    )


def _mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as a wrongly decoded source delivers them, and one that is already right."""

    def mangled(label: str) -> Column:
        return F.lit(label.encode("gbk").decode("latin-1"))

    kind = F.col("s_suppkey") % 4
    delivered = (
        F.when(kind == 0, mangled(fixed.OWN_LABEL))
        .when(kind == 1, mangled(fixed.AGENT_LABEL))
        .when(kind == 2, fixed.OWN_LABEL)
    )
    return standins.table(spark, sf_dir, "supplier").select(
        "s_suppkey", text.repair_mojibake(delivered).alias("store_type")
    )


def _misread(df: DataFrame, column: str, labels: tuple) -> DataFrame:
    """``df`` as a source delivers it that takes the bytes of these labels for Latin-1."""
    delivered = F.col(column)
    for label in labels:
        delivered = F.when(F.col(column) == label, label.encode("gbk").decode("latin-1")).otherwise(delivered)
    return df.withColumn(column, delivered)


def _misread_shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both label columns wrongly decoded."""
    shop = _misread(standins.shop(spark, sf_dir), "store_type", (CONFIG.agent_store_type,))
    return _misread(shop, "region", (CONFIG.excluded_region,))


def _source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables with the headers of the sources, everything as text, blanks around the store codes."""
    padded = {"shop": "store_code", "member": "service_store"}
    out = {}
    for name, (names, _, _, _) in member_conversion.SOURCES.items():
        df = _misread_shop(spark, sf_dir) if name == "shop" else getattr(standins, name)(spark, sf_dir)
        df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        if name in padded:
            df = df.withColumn(padded[name], F.concat(F.lit(" "), padded[name], F.lit("  ")))
        out[name] = df.withColumnsRenamed({ours: theirs for theirs, ours in names.items()})
    return out


_SOURCE_CONFIG = replace(CONFIG, excluded_skus=tuple(map(str, CONFIG.excluded_skus)))
_SOURCE_MISREAD = {"shop": ["store_type", "region"]}


def _published_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the whole job, from the headers of the sources to what it has published."""
    out = shared_folder(spark)
    sources = _source_tables(spark, sf_dir)
    member_conversion.run_from_source(spark, sources, _SOURCE_CONFIG, out, misread=_SOURCE_MISREAD)
    return spark.read.parquet(published_paths(spark, out)[name])


def _load_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of which some figures and days are words, and stores of which some are listed twice."""
    sources = _source_tables(spark, sf_dir)
    amount, day, code, customer = "金额", "消费时间", "门店代码", F.col("会员号").cast("long")
    bad = sources["purchase"].withColumn(amount, F.when(customer % 5 == 0, "none").otherwise(F.col(amount)))
    sources["purchase"] = bad.withColumn(day, F.when(customer % 7 == 0, "?").otherwise(F.col(day)))
    twice = sources["shop"].filter(F.trim(code).cast("long") % 4 == 0)
    sources["shop"] = sources["shop"].unionByName(twice)
    return member_conversion.load(sources, _SOURCE_MISREAD)[1]


def _windows(columns) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        days = standins.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
        start, end = columns(F.col("day"))
        return days.select("day", start.alias("period_start"), end.alias("period_end"))

    return query


# --- sessions ----------------------------------------------------------------


def _texts(spark: SparkSession, sf_dir: str, mode: str = "lines") -> DataFrame:
    return sessions.cleaned_sessions(standins.session(spark, sf_dir), BOT, mode)


def _keyword_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.keyword_labels(_texts(spark, sf_dir), TOPIC_RULES, SPEC)


def _rule_classifier(head: str, tail: str, rules: dict[str, str]):
    """Factory of a deterministic stand-in for a remote classifier; refuses texts without a topic."""

    def factory():
        compiled = [(topic, re.compile(pattern)) for topic, pattern in rules.items()]

        def answer(prompt: str) -> str:
            asked = prompt[len(head) : len(prompt) - len(tail)]
            for topic, pattern in compiled:
                if pattern.search(asked):
                    return "\n```json\n" + json.dumps({"is_service": 1, "category": topic}) + "\n```"
            raise ValueError("no topic")

        return lambda prompts: [answer(p) for p in prompts]

    return factory


def _classified_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    factory = _rule_classifier(*SPEC.prompt_parts(), TOPIC_RULES)
    return sessions.classify(_texts(spark, sf_dir), factory, SPEC)


def _labelled_in_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that ends after one round, and one that takes up where it ended."""
    texts, path = _texts(spark, sf_dir), shared_folder(spark)
    factory = _rule_classifier(*SPEC.prompt_parts(), TOPIC_RULES)
    log = LabelLog(spark, f"{path}/log")
    log.complete(texts, factory, SPEC, f"{path}/first", texts_per_round=200, max_rounds=1)
    log.complete(texts, factory, SPEC, f"{path}/rest")
    return sessions.attach_labels(texts, sessions.parse_answers(log.latest(), SPEC), SPEC)


def _frequent_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standins.asked(spark, sf_dir)
    asked = rows.select("category", sessions.text_hash(F.col("text")).alias("question"))
    return questions.top_questions(spark, asked, rows, 5, shared_folder(spark), tracked=256)


def _parsed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.parse_answers(standins.answer(spark, sf_dir), SPEC)


# --- gift stock and product lists --------------------------------------------


def _mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock_ops.stock_mismatch(standins.stock(spark, sf_dir))


def _real_stock_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = catalog.real_stock_products(standins.product(spark, sf_dir), STOCK)
    return stock_ops.stock_mismatch(stock_ops.only_products(standins.stock(spark, sf_dir), titles))


def _quoted_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat("p_name", F.lit(" / "), "p_brand", F.lit("~ *+&=礼品"))
    return standins.table(spark, sf_dir, "part").select("p_partkey", text.quote_url(title).alias("title_sku"))


# --- sources and sinks: written as a job would, read back as the next one would ---


def _report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    report = reports.sort_region_report(reports.region_report(_detail(spark, sf_dir), CONFIG))
    writers.write_table(report, path, "csv")
    schema = ", ".join(f"{name} {kind}" for name, kind in report.dtypes)
    return _rounded(readers.read_table(spark, path, schema, "csv"))


def _stock_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock as exports with the source's whole header, one folder per product."""
    path = shared_folder(spark)
    headers = {ours: theirs for theirs, ours in fixed.STOCK_COLUMNS.items()}
    unused = [F.col("store_stock").alias(name) for name in fixed.UNUSED_STOCK_COLUMNS]
    stock = standins.stock(spark, sf_dir).select(*headers, *unused, "title").withColumnsRenamed(headers)
    stock.hint("rebalance", F.col("title")).write.partitionBy("title").csv(path, header=True)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in stock.dtypes if name != "title")
    return readers.read_stock_exports(spark, path, schema, fixed.STOCK_COLUMNS)


def _landed(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Exports of text figures, landed: rows whose figures are numbers, and apart from them the others."""
    path, out = shared_folder(spark), shared_folder(spark)
    headers = {ours: theirs for theirs, ours in fixed.STOCK_COLUMNS.items()}
    unused = [F.lit(0).alias(name) for name in fixed.UNUSED_STOCK_COLUMNS]
    stock = standins.text_stock(spark, sf_dir).select(*unused, *headers, "title").withColumnsRenamed(headers)
    stock.hint("rebalance", F.col("title")).write.partitionBy("title").option("emptyValue", "").csv(path, header=True)
    figures = {headers["shelf_stock"], headers["store_stock"]}
    schema = ", ".join(f"`{c}` {'double' if c in figures else 'string'}" for c in stock.columns if c != "title")
    rows = readers.read_stock_exports(spark, path, schema, fixed.STOCK_COLUMNS, corrupt="line")
    writers.write_accepted(rows, "line", f"{out}/stock", f"{out}/quarantine")
    return spark.read.parquet(f"{out}/{which}")


def _stacked_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product lists as files with three headers: the columns in order, in another order, and some missing among others."""
    path = shared_folder(spark)
    product = standins.product(spark, sf_dir)
    forms = [
        product.columns,
        [*reversed(product.columns), F.lit("x").alias("remark")],
        [F.lit(1).alias("row"), "title", F.lit("y, z").alias("remark"), "page_no"],
    ]
    for n, columns in enumerate(forms):
        rows = product.filter(F.col("page_no") % len(forms) == n).select(*columns)
        rows.write.mode("append").csv(path, header=True)
    schema = ", ".join(f"{name} {kind}" for name, kind in product.dtypes)
    return readers.read_folder(spark, path, schema, required=["title"]).drop("file_name")


def _adjustment_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheets as written for the upload, read back with our column names."""
    path = shared_folder(spark)
    sheets = stock_ops.adjustments(_mismatch(spark, sf_dir), STOCK)
    writers.write_adjustments(sheets, path)
    kinds = dict(sheets.dtypes)
    schema = ", ".join(f"`{theirs}` {kinds[ours]}" for ours, theirs in fixed.ADJUSTMENT_HEADERS.items())
    names = {theirs: ours for ours, theirs in fixed.ADJUSTMENT_HEADERS.items()}
    return readers.read_stock_exports(spark, path, schema, names, blank_text=True)


def _product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    writers.write_product_pages(catalog.real_stock_products(standins.product(spark, sf_dir), STOCK), path)
    return readers.read_table(spark, path, "title string, page_no int")


def queries() -> dict[str, Query]:
    """Name -> query; each one takes (spark, sf_dir)."""
    return _retail_queries() | (llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {})


def _retail_queries() -> dict[str, Query]:
    return {
        # member conversion
        "safe_rates": lambda s, d: _rounded(_safe_rates(s, d)),
        "store_type_map": _store_type_map,
        "mojibake_repair": _mojibake_repair,
        "repaired_labels": lambda s, d: repair_columns(_misread_shop(s, d), ["store_type", "region"]),
        "source_to_report": lambda s, d: _rounded(_published_table(s, d, "region")),
        "source_to_display": lambda s, d: _published_table(s, d, "region_display"),
        "load_checks": _load_checks,
        "buying_members": lambda s, d: conversion.buying_members(
            standins.purchase(s, d), standins.goods(s, d), CONFIG
        ),
        "contact_ids": lambda s, d: conversion.contact_ids(standins.contact(s, d), CONFIG),
        "qualifying_members": _qualifying_members,
        "conversion_detail": _detail,
        "conversion_detail_rates": lambda s, d: _rounded(reports.detail_report(_detail(s, d))),
        "region_report": lambda s, d: _rounded(reports.region_report(_detail(s, d), CONFIG)),
        "sorted_region_report": lambda s, d: _rounded(
            reports.sort_region_report(reports.region_report(_detail(s, d), CONFIG))
        ),
        "national_row": lambda s, d: _rounded(reports.national_row(_detail(s, d), CONFIG)),
        "subregion_report": lambda s, d: _rounded(reports.subregion_report(_detail(s, d), CONFIG)),
        "lagging_subregions": lambda s, d: _rounded(reports.lagging_subregions(_detail(s, d), CONFIG)),
        "store_report": lambda s, d: _rounded(reports.store_report(_detail(s, d), CONFIG)),
        "percent_view": lambda s, d: reports.percent_view(reports.region_report(_detail(s, d), CONFIG)),
        "group_totals": lambda s, d: _rounded(rollups.with_group_totals(_detail(s, d), "region")),
        "new_followers": lambda s, d: conversion.new_followers(standins.follower(s, d), CONFIG),
        "month_to_date_window": _windows(periods.month_to_date_columns),
        "previous_week_window": _windows(periods.previous_week_columns),
        # sessions
        "bot_sessions": lambda s, d: sessions.bot_sessions(standins.session(s, d), BOT),
        "clean_transcripts": lambda s, d: _texts(s, d),
        "strip_headers": lambda s, d: _texts(s, d, "strip_headers"),
        "transcript_prompts": lambda s, d: _texts(s, d).select(
            "session_id", sessions.build_prompt(F.col("text"), SPEC).alias("prompt")
        ),
        "parsed_labels": _parsed_labels,
        "keyword_labels": _keyword_labels,
        "classified_sessions": _classified_sessions,
        "labelled_in_rounds": _labelled_in_rounds,
        "label_failures": lambda s, d: sessions.failure_counts(_classified_sessions(s, d)),
        "frequent_questions": _frequent_questions,
        "category_frequency": lambda s, d: _rounded(sessions.category_frequency(_keyword_labels(s, d))),
        "top_categories": lambda s, d: _rounded(sessions.category_frequency(_keyword_labels(s, d), k=2)),
        # gift stock
        "stock_mismatch": _mismatch,
        "text_stock_mismatch": lambda s, d: stock_ops.stock_mismatch(standins.text_stock(s, d)),
        "rejected_products": lambda s, d: stock_ops.rejected_products(_mismatch(s, d)),
        "stock_adjustments": lambda s, d: stock_ops.adjustments(_mismatch(s, d), STOCK),
        "real_stock_mismatch": _real_stock_mismatch,
        "real_stock_adjustments": lambda s, d: stock_ops.adjustments(_real_stock_mismatch(s, d), STOCK),
        # product lists
        "real_stock_products": lambda s, d: catalog.real_stock_products(standins.product(s, d), STOCK),
        "distinct_products": lambda s, d: catalog.distinct_products(
            catalog.real_stock_products(standins.product(s, d), STOCK)
        ),
        "page_links": lambda s, d: catalog.page_links(standins.table(s, d, "pages")),
        "link_names": lambda s, d: catalog.link_names(catalog.page_links(standins.table(s, d, "pages"))),
        "page_urls": lambda s, d: catalog.page_urls(standins.listing(s, d), first_page=1),
        "listing_page_numbers": lambda s, d: catalog.page_urls(standins.listing(s, d), first_page=1).select(
            "url", text.page_number(F.col("url")).alias("page_no")
        ),
        "quoted_titles": _quoted_titles,
        # sources and sinks
        "report_table": _report_table,
        "stock_exports": _stock_exports,
        "landed_stock": lambda s, d: _landed(s, d, "stock").drop("file_name"),
        "quarantined_rows": lambda s, d: _landed(s, d, "quarantine").drop("file_name", "line"),
        "stacked_folder": _stacked_folder,
        "adjustment_sheets": _adjustment_sheets,
        "product_pages": _product_pages,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Which region converts worst, own against agent stores: regions and the national row."""
    return queries()["region_report"](spark, "/root/testdata/sf0.001")


# --- the same in SQL ---------------------------------------------------------

_START, _END = f"TIMESTAMP '{CONFIG.period_start} 00:00:00'", f"TIMESTAMP '{CONFIG.period_end} 23:59:59'"
_TYPE = f"CASE WHEN store_type = '{CONFIG.agent_store_type}' THEN 'agent' ELSE 'own' END"


def _in(values: tuple) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_COUNTED = f"""
    FROM member m
    JOIN shop s ON s.store_code = m.service_store
    JOIN purchase c ON c.member_id = m.member_id
    JOIN goods g ON g.sku = c.sku
    LEFT JOIN (SELECT DISTINCT union_id FROM contact WHERE added_at <= {_END}) q ON q.union_id = m.union_id
    WHERE c.channel IN {_in(CONFIG.channels)} AND c.purchased_at BETWEEN {_START} AND {_END}
      AND g.goods_class NOT IN {_in(CONFIG.excluded_classes)} AND c.amount > 0
      AND c.sku NOT IN {_in(CONFIG.excluded_skus)} AND m.activated = '{CONFIG.activated_flag}'"""
_NEW = f"m.registered_at BETWEEN {_START} AND {_END}"
_OLD = f"m.registered_at < {_START}"
_DETAIL = f"""
    SELECT s.region, s.subregion, s.store_code, s.store_name, {_TYPE} AS store_type,
           count(DISTINCT c.member_id) AS buyers,
           count(DISTINCT q.union_id) AS added,
           count(DISTINCT CASE WHEN {_NEW} THEN c.member_id END) AS new_buyers,
           count(DISTINCT CASE WHEN {_NEW} THEN q.union_id END) AS new_added,
           count(DISTINCT CASE WHEN {_OLD} THEN c.member_id END) AS old_buyers,
           count(DISTINCT CASE WHEN {_OLD} THEN q.union_id END) AS old_added
    {_COUNTED} AND s.region IS NOT NULL AND s.region <> '{CONFIG.excluded_region}'
    GROUP BY 1, 2, 3, 4, 5"""
_PAIRS = (("add_rate", "added", "buyers"), ("new_add_rate", "new_added", "new_buyers"),
          ("old_add_rate", "old_added", "old_buyers"))
_RATED = "SELECT *, " + ", ".join(
    f"coalesce(CAST({n} AS DOUBLE) / nullif({d}, 0), 0.0) AS {r}" for r, n, d in _PAIRS
) + " FROM detail"


def _weighted_sql(scope: str, rows: str = "") -> str:
    return ", ".join(
        f"round(coalesce(CAST(sum({n}) {rows} AS DOUBLE) / nullif(sum({d}) {rows}, 0), 0.0), 9) AS {scope}_{r}"
        for r, n, d in _PAIRS
    )


def _mean_sql(scope: str, rows: str = "") -> str:
    return ", ".join(f"round(coalesce(avg({r}) {rows}, 0.0), 9) AS {scope}_{r}" for r, _, _ in _PAIRS)


_OWN, _AGENT = "FILTER (WHERE store_type = 'own')", "FILTER (WHERE store_type = 'agent')"
_MEANS = f"{_mean_sql('own', _OWN)}, {_mean_sql('agent', _AGENT)}"
_NATIONAL = (
    f"SELECT 'national' AS level, 'ALL' AS region, {_weighted_sql('overall')}, "
    f"{_weighted_sql('own', _OWN)}, {_weighted_sql('agent', _AGENT)} FROM rated"
)
_REGION = (
    f"SELECT 'region' AS level, region, {_weighted_sql('overall')}, {_MEANS} FROM rated GROUP BY region "
    f"UNION ALL {_NATIONAL}"
)
_DISPLAY = (
    "SELECT level, region, "
    + ", ".join(f"printf('%.1f%%', round({c} * 100, 1)) AS {c}" for c in rollups.rate_columns())
    + f" FROM ({_REGION})"
)
_SUBREGION = (
    f"SELECT subregion, {_weighted_sql('overall')}, {_MEANS} FROM rated "
    "WHERE subregion IS NOT NULL GROUP BY subregion"
)


def _conversion_sql(select: str) -> str:
    tables = oracle_tables("shop", "member", "purchase", "goods", "contact")
    return f"WITH {tables}, detail AS ({_DETAIL}), rated AS ({_RATED}) {select}"


# The patterns of the SQL are written out, apart from those of the library.
_FENCE = "(?s)```(?:json)?(.*?)```"
_HEADER = "[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
_LINK = '<a href="([^"]*)">([^<]*)</a>'
_CLEAN = "array_to_string(list_filter(string_split(transcript, chr(10)), lambda x: {keep}), chr(10))"
_LINES = _CLEAN.format(keep=f"NOT starts_with(x, '{BOT}')")
_STRIPPED = _CLEAN.format(
    keep=f"NOT starts_with(x, '{BOT}') AND NOT regexp_matches(x, '{_HEADER}')"
)


def _texts_sql(select: str, cleaned: str = _LINES) -> str:
    return (
        f"WITH {oracle_tables('session')}, texts AS (SELECT session_id, {cleaned} AS text FROM session "
        f"WHERE last_agent = '{BOT}' AND transcript IS NOT NULL) {select}"
    )


_TOPIC = "CASE " + " ".join(
    f"WHEN regexp_matches(text, {_quoted(p)}) THEN {_quoted(t)}" for t, p in TOPIC_RULES.items()
) + " END"
_KEYWORDS = f"""
    SELECT session_id, CASE WHEN topic IS NULL THEN '0' ELSE '1' END AS is_service,
           coalesce(topic, '{SPEC.other}') AS category, 'ok' AS label_status
    FROM (SELECT session_id, {_TOPIC} AS topic FROM texts)"""
_CLASSIFIED = f"""
    SELECT session_id, CASE WHEN topic IS NULL THEN '{SPEC.failed_is_service}' ELSE '1' END AS is_service,
           coalesce(topic, '{SPEC.failed_category}') AS category,
           CASE WHEN topic IS NULL THEN 'failed' ELSE 'ok' END AS label_status,
           CASE WHEN text IS NULL THEN 'no text' WHEN topic IS NULL THEN 'ValueError: no topic' END AS failure
    FROM (SELECT session_id, text, {_TOPIC} AS topic FROM texts)"""
_FREQUENCY = f"""
    SELECT category, count(*) AS sessions,
           round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM texts), 9) AS share
    FROM ({_KEYWORDS}) GROUP BY category"""

_MISMATCH = """
    SELECT title, replace(store_code, '''''', '') AS store_code, sku, store_stock, shelf_stock
    FROM stock WHERE (store_stock IS NULL OR shelf_stock IS NULL OR store_stock - shelf_stock <> 0)"""


def _stock_sql(select: str, tables: tuple = ("stock",), where: str = "") -> str:
    return f"""WITH {oracle_tables(*tables)}, mismatch AS ({_MISMATCH} {where}),
        rejected AS (SELECT DISTINCT title FROM mismatch WHERE shelf_stock IS NULL) {select}"""


_TEXT_MISMATCH = """
    SELECT title, replace(store_code, '''''', '') AS store_code, sku, a AS store_stock, b AS shelf_stock
    FROM (SELECT *, TRY_CAST(store_stock AS DOUBLE) AS a, TRY_CAST(shelf_stock AS DOUBLE) AS b FROM text_stock
          WHERE store_stock IS DISTINCT FROM '')
    WHERE a IS NULL OR b IS NULL OR a <> b"""
# A cell that is empty is a missing figure, one that holds a word does not fit.
_TYPED = """typed AS (
    SELECT title, store_code, sku, TRY_CAST(shelf_stock AS DOUBLE) AS shelf_stock, TRY_CAST(store_stock AS DOUBLE) AS store_stock,
           (coalesce(shelf_stock, '') = '' OR TRY_CAST(shelf_stock AS DOUBLE) IS NOT NULL)
           AND (coalesce(store_stock, '') = '' OR TRY_CAST(store_stock AS DOUBLE) IS NOT NULL) AS fits
    FROM text_stock)"""

_ADJUSTMENTS = f"""
    SELECT '{STOCK.warehouse_code}' AS warehouse_code, store_code, sku,
           store_stock - trunc(shelf_stock) AS adjust_qty, '{STOCK.adjust_type}' AS adjust_type,
           '' AS courier, '' AS tracking_no, '' AS receiver_contact, '' AS remark, '' AS sub_order_no, title
    FROM mismatch WHERE title NOT IN (SELECT title FROM rejected)"""

_REAL = f"SELECT page_no, title FROM product WHERE stock_mode = '{STOCK.real_stock_mode}'"
_LISTED = f"AND title IN (SELECT title FROM ({_REAL}))"
_LINKS = f"""
    SELECT page_id, CAST(position - 1 AS INTEGER) AS position,
           regexp_extract(match, '{_LINK}', 1) AS href, regexp_extract(match, '{_LINK}', 2) AS name
    FROM (SELECT page_id, unnest(found) AS match, generate_subscripts(found, 1) AS position
          FROM (SELECT page_id, regexp_extract_all(html, '{_LINK}') AS found FROM pages))"""
_DAYS = "FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"


def oracle_sql() -> dict[str, str]:
    """Name -> DuckDB SQL with the same rows and column names as the query, where SQL can express it."""
    return _retail_sql() | (llm.ORACLE_SQL if llm else {})


def _retail_sql() -> dict[str, str]:
    head, tail = SPEC.prompt_parts()
    finished = "l_linestatus = 'F'"
    return {
        "safe_rates": f"""
            SELECT l_partkey, round(rate, 9) AS rate, round(rate, 9) AS rate_of_sums, round_even(rate, 2) AS rate_2
            FROM (SELECT l_partkey, coalesce(CAST(part AS DOUBLE) / nullif(whole, 0), 0.0) AS rate
                  FROM (SELECT l_partkey,
                          count(*) FILTER (WHERE {finished} AND l_returnflag = 'R' AND l_quantity > 25) AS part,
                          count(*) FILTER (WHERE {finished} AND l_quantity > 40) AS whole
                        FROM lineitem GROUP BY l_partkey))""",
        "store_type_map": f"WITH {oracle_tables('shop')} SELECT store_code, {_TYPE} AS store_type FROM shop",
        "mojibake_repair": f"""
            SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '{fixed.OWN_LABEL}' WHEN 1 THEN '{fixed.AGENT_LABEL}'
                   WHEN 2 THEN '{fixed.OWN_LABEL}' END AS store_type FROM supplier""",
        "repaired_labels": f"WITH {oracle_tables('shop')} SELECT * FROM shop",
        "source_to_report": _conversion_sql(_REGION),
        "source_to_display": _conversion_sql(_DISPLAY),
        "load_checks": f"""
            WITH {oracle_tables('shop', 'purchase', 'member', 'goods', 'contact')}, kinds(name, problem) AS (VALUES
                ('member', 'registered_at does not fit'), ('contact', 'added_at does not fit'), ('shop', 'no key'))
            SELECT name, problem, CAST(0 AS BIGINT) AS rows FROM kinds
            UNION ALL SELECT 'shop', 'repeated key', count(*) FROM shop WHERE store_code % 4 = 0
            UNION ALL SELECT 'purchase', 'amount does not fit', count(*) FROM purchase WHERE member_id % 5 = 0
            UNION ALL SELECT 'purchase', 'purchased_at does not fit', count(*) FROM purchase WHERE member_id % 7 = 0""",
        "buying_members": f"""
            WITH {oracle_tables('purchase', 'goods')}
            SELECT DISTINCT c.member_id FROM purchase c JOIN goods g ON g.sku = c.sku
            WHERE c.channel IN {_in(CONFIG.channels)} AND c.purchased_at BETWEEN {_START} AND {_END}
              AND g.goods_class NOT IN {_in(CONFIG.excluded_classes)} AND c.amount > 0
              AND c.sku NOT IN {_in(CONFIG.excluded_skus)}""",
        "contact_ids": f"""
            WITH {oracle_tables('contact')}
            SELECT DISTINCT union_id FROM contact WHERE added_at <= {_END} AND union_id IS NOT NULL""",
        "qualifying_members": f"""
            WITH {oracle_tables('shop', 'member', 'purchase', 'goods', 'contact')}
            SELECT DISTINCT m.service_store AS store_code, m.member_id, m.union_id,
                   coalesce({_NEW}, FALSE) AS is_new, coalesce({_OLD}, FALSE) AS is_old {_COUNTED}""",
        "conversion_detail": _conversion_sql("SELECT * FROM detail"),
        "conversion_detail_rates": _conversion_sql(
            "SELECT * REPLACE (" + ", ".join(f"round({r}, 9) AS {r}" for r, _, _ in _PAIRS) + ") FROM rated"
        ),
        "region_report": _conversion_sql(_REGION),
        "sorted_region_report": _conversion_sql(
            f"SELECT * FROM ({_REGION}) ORDER BY level = 'national', overall_add_rate, region"
        ),
        "national_row": _conversion_sql(_NATIONAL),
        "subregion_report": _conversion_sql(_SUBREGION),
        "lagging_subregions": _conversion_sql(
            f"SELECT * FROM ({_SUBREGION}) ORDER BY overall_add_rate, subregion "
            f"LIMIT {fixed.LAGGING_SUBREGIONS}"
        ),
        "store_report": _conversion_sql(
            f"SELECT store_name, {_mean_sql('overall')}, {_MEANS} FROM rated "
            "WHERE store_name IS NOT NULL GROUP BY store_name"
        ),
        "percent_view": _conversion_sql(_DISPLAY),
        "group_totals": _conversion_sql(
            "SELECT d.*, t.* EXCLUDE (region) FROM detail d "
            f"JOIN (SELECT region, {_weighted_sql('overall')} FROM detail GROUP BY region) t "
            "ON t.region = d.region"
        ),
        "new_followers": f"""
            WITH {oracle_tables('follower')}
            SELECT trim(first_shop_code) AS store_code, count(DISTINCT mobile) AS new_followers
            FROM follower WHERE followed_at BETWEEN {_START} AND {_END}
              AND guide_no NOT IN {_in(CONFIG.excluded_guides)} GROUP BY 1""",
        "month_to_date_window": f"""
            SELECT day, CAST(CASE WHEN day(day) < 4 THEN date_trunc('month', day - INTERVAL 1 MONTH)
                             ELSE date_trunc('month', day) END AS DATE) AS period_start,
                   day - 1 AS period_end {_DAYS}""",
        "previous_week_window": f"""
            SELECT day, day - CAST(isodow(day) + 6 AS INTEGER) AS period_start,
                   day - CAST(isodow(day) - 1 AS INTEGER) AS period_end {_DAYS}""",
        "bot_sessions": f"""
            WITH {oracle_tables('session')}
            SELECT * FROM session WHERE last_agent = '{BOT}' AND transcript IS NOT NULL""",
        "clean_transcripts": _texts_sql("SELECT * FROM texts"),
        "strip_headers": _texts_sql("SELECT * FROM texts", _STRIPPED),
        "transcript_prompts": _texts_sql(
            f"SELECT session_id, {_quoted(head)} || text || {_quoted(tail)} AS prompt FROM texts"
        ),
        "parsed_labels": f"""
            WITH {oracle_tables('answer')},
            stripped AS (SELECT doc_id, ltrim(answer, chr(10)) AS a FROM answer),
            bodies AS (SELECT doc_id, coalesce(nullif(regexp_extract(a, '{_FENCE}', 1), ''), a) AS body FROM stripped),
            objects AS (SELECT doc_id, body FROM bodies
                        WHERE CASE WHEN json_valid(body) THEN json_type(body) END = 'OBJECT'),
            pairs AS (SELECT doc_id, j.key, j.id, j.value ->> '$' AS value FROM objects, json_each(body) j),
            lasts AS (SELECT doc_id, key, last(value ORDER BY id) AS value FROM pairs
                      WHERE key IN ('is_service', 'category') GROUP BY doc_id, key),
            named AS (SELECT doc_id, max(value) FILTER (WHERE key = 'is_service') AS is_service,
                             max(value) FILTER (WHERE key = 'category') AS category, count(*) = 2 AS ok
                      FROM lasts GROUP BY doc_id)
            SELECT b.doc_id,
                   CASE WHEN n.ok THEN n.is_service ELSE '{SPEC.failed_is_service}' END AS is_service,
                   CASE WHEN n.ok THEN n.category ELSE '{SPEC.failed_category}' END AS category,
                   CASE WHEN n.ok THEN 'ok' ELSE 'failed' END AS label_status,
                   CASE WHEN b.body IS NULL THEN 'no answer' WHEN o.doc_id IS NULL THEN 'not one JSON object'
                        WHEN n.ok THEN NULL ELSE 'missing key' END AS failure
            FROM bodies b LEFT JOIN objects o USING (doc_id) LEFT JOIN named n USING (doc_id)""",
        "keyword_labels": _texts_sql(_KEYWORDS),
        "classified_sessions": _texts_sql(_CLASSIFIED),
        "labelled_in_rounds": _texts_sql(_CLASSIFIED),
        "label_failures": _texts_sql(
            f"SELECT failure, count(*) AS sessions FROM ({_CLASSIFIED}) WHERE label_status = 'failed' GROUP BY failure"
        ),
        "frequent_questions": f"""
            WITH {oracle_tables('asked')},
            counts AS (SELECT category, text AS question, count(*) AS sessions FROM asked WHERE text IS NOT NULL GROUP BY ALL)
            SELECT category, CAST(row_number() OVER (PARTITION BY category ORDER BY sessions DESC, sha256(question)) AS INTEGER)
                   AS rank, question, sessions FROM counts QUALIFY rank <= 5""",
        "category_frequency": _texts_sql(_FREQUENCY),
        "top_categories": _texts_sql(f"{_FREQUENCY} ORDER BY sessions DESC, category LIMIT 2"),
        "stock_mismatch": _stock_sql("SELECT * FROM mismatch"),
        "text_stock_mismatch": f"WITH {oracle_tables('stock', 'text_stock')} {_TEXT_MISMATCH}",
        "rejected_products": _stock_sql("SELECT title FROM rejected"),
        "stock_adjustments": _stock_sql(_ADJUSTMENTS),
        "real_stock_mismatch": _stock_sql("SELECT * FROM mismatch", ("stock", "product"), _LISTED),
        "real_stock_adjustments": _stock_sql(_ADJUSTMENTS, ("stock", "product"), _LISTED),
        "real_stock_products": f"WITH {oracle_tables('product')} {_REAL}",
        "distinct_products": f"""
            WITH {oracle_tables('product')}
            SELECT title, min(page_no) AS page_no FROM ({_REAL}) GROUP BY title""",
        "page_links": _LINKS,
        "link_names": f"""
            SELECT page_id, href, first(name ORDER BY position) AS name FROM ({_LINKS}) GROUP BY page_id, href""",
        "page_urls": f"""
            WITH {oracle_tables('listing')}
            SELECT base_url, page_no, base_url || '&page=' || page_no AS url
            FROM (SELECT base_url, CAST(unnest(generate_series(1, CAST(regexp_extract(last_href, '[0-9]+$') AS INTEGER)))
                                        AS INTEGER) AS page_no FROM listing)""",
        "listing_page_numbers": f"""
            WITH {oracle_tables('listing')},
            last AS (SELECT base_url, CAST(regexp_extract(last_href, '[0-9]+$') AS INTEGER) AS n FROM listing)
            SELECT base_url || '&page=' || page_no AS url, page_no
            FROM (SELECT base_url, CAST(unnest(generate_series(1, n)) AS INTEGER) AS page_no FROM last)""",
        "quoted_titles": """
            SELECT p_partkey, replace(url_encode(p_name || ' / ' || p_brand || '~ *+&=礼品'), '%2F', '/') AS title_sku
            FROM part""",
        "report_table": _conversion_sql(_REGION),
        "stock_exports": f"WITH {oracle_tables('stock')} SELECT * FROM stock",
        "landed_stock": f"WITH {oracle_tables('stock', 'text_stock')}, {_TYPED} SELECT * EXCLUDE (fits) FROM typed WHERE fits",
        "quarantined_rows": f"WITH {oracle_tables('stock', 'text_stock')}, {_TYPED} SELECT * EXCLUDE (fits) FROM typed WHERE NOT fits",
        "stacked_folder": f"""
            WITH {oracle_tables('product')}
            SELECT page_no, title, CASE WHEN page_no % 3 < 2 THEN href END AS href,
                   CASE WHEN page_no % 3 < 2 THEN stock_mode END AS stock_mode FROM product""",
        "adjustment_sheets": _stock_sql(_ADJUSTMENTS),
        "product_pages": f"WITH {oracle_tables('product')} {_REAL}",
    }
