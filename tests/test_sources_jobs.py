from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from storewright import fixed_values as fixed
from storewright import schemas, standins
from storewright.config import LabelSpec
from storewright.operators import reports
from storewright.operators.conversion import conversion_detail
from storewright.plans import gift_stock, member_conversion, session_labels
from storewright.session import shared_folder
from storewright.sources import readers, writers

SF = "/root/testdata/sf0.001"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_table_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, date(2024, 1, 2)), (None, None, None)], "s string, x double, d date")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        writers.write_table(df, path, fmt)
        back = readers.read_table(spark, path, "s string, x double, d date", fmt)
        assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    with pytest.raises(ValueError):
        readers.read_table(spark, str(tmp_path / "csv"), fmt="csv")
    with pytest.raises(ValueError):
        readers.read_table(spark, str(tmp_path / "csv"), fmt="xlsx")


def test_a_shorter_second_run_leaves_no_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(100).repartition(5), path)
    writers.write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_folder_takes_files_by_name(spark, tmp_path):
    put(tmp_path / "第9页.xlsx.csv", "title\nT1\n")
    put(tmp_path / "第10页.xlsx.csv", "title\nT1\nT2\n")
    put(tmp_path / "notes.txt", "title\nno\n")
    got = readers.read_folder(spark, str(tmp_path), "title string", name_contains="xlsx")
    assert sorted(r.title for r in got.collect()) == ["T1", "T1", "T2"]
    assert got.select("file_name").distinct().count() == 2


FOLDER = "title string, page_no int, href string"


def test_files_are_stacked_by_column_name(spark, tmp_path):
    """Columns in another order, missing and further ones, repeated names, a byte order mark, quotes, files without rows or lines."""
    put(tmp_path / "a.csv", "title,page_no,href\nT1,1,/a\n")
    put(tmp_path / "b.csv", "\ufeffhref,other,page_no,title\n/b,9,2,T2\n/c,9,3,T3\n")
    put(tmp_path / "c.csv", 'title,title,"a, b"\nT4,no,x\n')
    put(tmp_path / "d.csv", "title,page_no,href\r\nT5,5,\r\n")
    put(tmp_path / "e.csv", "page_no,title\n")
    put(tmp_path / "f.csv", "")
    rows = readers.read_folder(spark, str(tmp_path), FOLDER)
    assert rows.columns == ["title", "page_no", "href", "file_name"]
    assert sorted(map(tuple, rows.collect())) == [
        ("T1", 1, "/a", "a.csv"), ("T2", 2, "/b", "b.csv"), ("T3", 3, "/c", "b.csv"), ("T4", None, None, "c.csv"),
        ("T5", 5, None, "d.csv"),
    ]
    forms = readers.header_forms(spark, str(tmp_path))
    assert sorted(names for names, _ in forms) == sorted(
        [["title", "page_no", "href"], ["href", "other", "page_no", "title"], ["title", "title.1", "a, b"], ["page_no", "title"]]
    )
    with pytest.raises(ValueError, match="page_no"):
        readers.read_folder(spark, str(tmp_path), FOLDER, required=["title", "page_no"])


def test_folders_without_files_with_lines(spark, tmp_path):
    put(tmp_path / "a.csv", "")
    rows = readers.read_folder(spark, str(tmp_path), FOLDER, corrupt="line")
    assert rows.columns == ["title", "page_no", "href", "file_name", "line"] and rows.collect() == []


def test_first_lines_of_files_in_many_blocks(spark, tmp_path, conf):
    """Files of several blocks and several files to a task: each header is its file's first line."""
    conf(spark__sql__files__maxPartitionBytes="200", spark__sql__files__openCostInBytes="10")
    for n in range(12):
        head = "title,page_no" if n % 2 else "page_no,title"
        lines = [f"T{n}-{i},{i}" if n % 2 else f"{i},T{n}-{i}" for i in range(1, 3 + 20 * (n % 3))]
        put(tmp_path / f"{n}.csv", "\n".join([head, *lines]) + "\n")
    rows = readers.read_folder(spark, str(tmp_path), "title string, page_no int").collect()
    want = {(f"T{n}-{i}", i, f"{n}.csv") for n in range(12) for i in range(1, 3 + 20 * (n % 3))}
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)


def test_rows_that_do_not_fit_go_to_quarantine(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", "title,page_no,href\nT1,1,/a\nT2,two,/b\n,,\n")
    put(tmp_path / "in" / "b.csv", "page_no,more,title\n3.5,x,T3\n4,y,T4\n")
    rows = readers.read_folder(spark, str(tmp_path / "in"), FOLDER, corrupt="line")
    writers.write_accepted(rows, "line", str(tmp_path / "good"), str(tmp_path / "bad"))
    good, bad = spark.read.parquet(str(tmp_path / "good")), spark.read.parquet(str(tmp_path / "bad"))
    assert "line" not in good.columns
    assert sorted((r.title or "", r.page_no) for r in good.collect()) == [("", None), ("T1", 1), ("T4", 4)]
    assert sorted((r.file_name, r.line) for r in bad.collect()) == [("a.csv", "T2,two,/b"), ("b.csv", "3.5,x,T3")]


def test_exports_are_pruned_and_checked(spark, tmp_path):
    head = [*list(fixed.STOCK_COLUMNS), *fixed.UNUSED_STOCK_COLUMNS]
    put(tmp_path / "title=T" / "a.csv", ",".join(head) + "\n" + ",".join(["''S1", "k", "x", "1", *["0"] * 11]) + "\n")
    figures = list(fixed.STOCK_COLUMNS)[2:]
    schema = ", ".join(f"`{c}` {'double' if c in figures else 'string'}" for c in head)
    rows = readers.read_stock_exports(spark, str(tmp_path), schema, fixed.STOCK_COLUMNS, corrupt="line")
    (row,) = rows.collect()
    assert row.shelf_stock is None and row.line.startswith("''S1,k,x,1") and row.file_name.endswith("a.csv")
    plain = readers.read_stock_exports(spark, str(tmp_path), schema, fixed.STOCK_COLUMNS)
    read = plain._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1]
    assert all(name not in read for name in fixed.UNUSED_STOCK_COLUMNS)


def test_columns_in_another_order_are_an_error_where_files_have_one_schema(spark, tmp_path):
    put(tmp_path / "t.csv", "page_no,title\n1,T1\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_table(spark, str(tmp_path / "t.csv"), "title string, page_no int", "csv").collect()


def test_stock_exports(spark, tmp_path):
    head = "门店代码,商品代码,实时上架库存（包含虚拟）,门店实时库存（剔除未核销）,在途数\n"
    put(tmp_path / "title=001" / "a.csv", head + "''S1,k1,7,10,0\n''S2,k1,,3,0\n")
    put(tmp_path / "title=礼品" / "b.csv", head + "''S1,k2,1,1,0\n")
    put(tmp_path / "title=empty" / "c.csv", "")
    schema = "`门店代码` string, `商品代码` string, `实时上架库存（包含虚拟）` double, `门店实时库存（剔除未核销）` double, `在途数` double"
    stock = readers.read_stock_exports(spark, str(tmp_path), schema, fixed.STOCK_COLUMNS)
    assert sorted(map(tuple, stock.collect()), key=str) == [
        ("''S1", "k1", 7.0, 10.0, "001"),
        ("''S1", "k2", 1.0, 1.0, "礼品"),
        ("''S2", "k1", None, 3.0, "001"),
    ]


def test_titles_survive_as_folder_names(spark, tmp_path):
    titles = ["a/b", "k=v", "礼品 1", "100%", "001", 'say "x"', "c:d"]
    rows = [(*(["v"] * 3), 1.5, *(["w"] * 6), t) for t in titles]
    schema = ", ".join(f"{c} {'double' if c == 'adjust_qty' else 'string'}" for c in [*fixed.ADJUSTMENT_HEADERS, "title"])
    writers.write_adjustments(spark.createDataFrame(rows, schema), str(tmp_path / "out"))
    back = spark.read.schema("x string, title string").csv(str(tmp_path / "out"), header=True)
    assert sorted(r.title for r in back.collect()) == sorted(titles)


def test_shared_folder_follows_the_session(spark, tmp_path):
    class Cluster:
        class sparkContext:
            master = "yarn"

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)
    Cluster.conf.get = staticmethod(lambda name, default: {"spark.checkpoint.dir": "hdfs://x/y/"}[name])
    assert shared_folder(Cluster).startswith("hdfs://x/y/")
    assert shared_folder(Cluster) != shared_folder(Cluster)
    assert shared_folder(spark).startswith("/")


def test_rename_and_checks(spark):
    df = spark.createDataFrame([("r", "s", "t", " c ", "n", 1)], ["大区名称", "小区名称", "门店类型", "门店代码", "门店名称", "x"])
    shop = schemas.trim_keys(schemas.rename_columns(df, fixed.SHOP_COLUMNS), "store_code")
    assert shop.first().asDict() == {
        "region": "r", "subregion": "s", "store_type": "t", "store_code": "c", "store_name": "n"
    }
    with pytest.raises(ValueError, match="missing columns"):
        schemas.rename_columns(df, fixed.MEMBER_COLUMNS)


def test_jdbc_options():
    assert readers.jdbc_options("jdbc:x", table="t", user="u") == {"url": "jdbc:x", "user": "u", "dbtable": "t"}
    assert readers.jdbc_options("jdbc:x", query="SELECT 1") == {"url": "jdbc:x", "query": "SELECT 1"}
    split = readers.jdbc_options("jdbc:x", query="SELECT 1 AS k", partition=("k", 0, 100, 8))
    assert split["dbtable"] == "(SELECT 1 AS k) q" and "query" not in split
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "k", "0", "100", "8"
    )
    for both in ({}, {"table": "t", "query": "q"}):
        with pytest.raises(ValueError):
            readers.jdbc_options("jdbc:x", **both)


def test_member_conversion_job(spark, tmp_path):
    names = ("shop", "member", "purchase", "goods", "contact")
    tables = {n: getattr(standins, n)(spark, SF) for n in names}
    paths = member_conversion.run(spark, tables, standins.CONFIG, str(tmp_path), lagging=3)
    detail = conversion_detail(*tables.values(), standins.CONFIG)
    expected = {
        "detail": reports.detail_report(detail),
        "region": reports.region_report(detail, standins.CONFIG),
        "lagging_subregion": reports.lagging_subregions(detail, standins.CONFIG, 3),
        "store": reports.store_report(detail, standins.CONFIG),
    }
    for name, want in expected.items():
        got = spark.read.parquet(paths[name])
        assert got.columns == want.columns
        assert [pytest.approx(tuple(r)) for r in sorted(got.collect())] == [tuple(r) for r in sorted(want.collect())]


def test_session_label_job(spark, tmp_path):
    spec = LabelSpec()
    head, tail = spec.prompt_parts()

    def factory():
        def label(prompt):
            return json.dumps({"is_service": 1, "category": prompt[len(head) : len(prompt) - len(tail)]})

        return lambda prompts: [label(p) for p in prompts]

    rows = [(f"s{i}", "BOT" if i % 4 else "Ann", f"BOT hi\nt{i % 5}") for i in range(40)]
    session = spark.createDataFrame(rows, schemas.SESSION)
    paths = session_labels.run(spark, session, "BOT", factory, str(tmp_path), spec)
    assert spark.read.parquet(paths["text_labels"]).count() == 5
    labels = {r.session_id: r.category for r in spark.read.parquet(paths["labels"]).collect()}
    assert labels == {f"s{i}": f"t{i % 5}" for i in range(40) if i % 4}
    assert spark.read.parquet(paths["category_frequency"]).agg(F.sum("sessions")).first()[0] == 30


def test_gift_stock_job(spark, tmp_path):
    product = standins.product(spark, SF)
    lists = gift_stock.list_real_stock(spark, product, f"{tmp_path}/lists")
    titles = spark.read.parquet(lists["products"])
    real = product.filter(F.col("stock_mode") == fixed.REAL_STOCK_MODE)
    assert titles.count() == real.select("title").distinct().count()

    paths = gift_stock.run(spark, standins.stock(spark, SF), titles, f"{tmp_path}/stock")
    written = spark.read.csv(paths["adjustments"], header=True)
    assert written.columns == [*fixed.ADJUSTMENT_HEADERS.values(), "title"]
    import __spark_entry__ as entry

    expected = entry.queries()["real_stock_adjustments"](spark, SF)
    assert written.count() == expected.count()
    rejected = spark.read.parquet(paths["rejected_products"])
    assert rejected.count() > 0
    assert rejected.join(written, "title").isEmpty()
    sums = written.agg(F.sum(F.col("库存").cast("double"))).first()[0]
    assert sums == expected.agg(F.sum("adjust_qty")).first()[0]
