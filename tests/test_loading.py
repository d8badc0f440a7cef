"""From the headers of the sources to published reports: repair, checks, publication, ranges of a database."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from storewright import schemas, standins
from storewright.operators.repair import repair_columns
from storewright.operators.stock import adjustments
from storewright.plans import member_conversion
from storewright.sources import publish, readers, writers
from storewright.sources.checks import load_checks, refuse, typed

SF = "/root/testdata/sf0.001"


def misread(label):
    return label.encode("gbk").decode("latin-1")


def test_repair_of_columns(spark):
    """Misread, right, plain, empty and missing labels; repeated rows stay; a hot label."""
    right = [("代理店", "华东", 1), ("自营", None, 2), ("", "x", 3), (None, "代理店", 4)] + [("代理店", "华东", 5)] * 200
    wrong = [(t and misread(t), r and (r if n == 1 else misread(r)), n) for t, r, n in right]
    df = spark.createDataFrame(wrong, "store_type string, region string, n int")
    got = repair_columns(df, ["store_type", "region"])
    assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=str) == sorted(right, key=str)
    assert repair_columns(df.limit(0), ["region"]).isEmpty()
    one = repair_columns(df.select("region"), ["region"])
    assert sorted((r.region for r in one.collect()), key=str) == sorted((r[1] for r in right), key=str)


def test_python_sees_each_label_once(spark):
    df = spark.range(1000).select(F.lit(misread("代理店")).alias("label"), "id")
    plan = repair_columns(df, ["label"])._jdf.queryExecution().optimizedPlan().toString()
    python = plan[plan.index("ArrowEvalPython") :]
    assert "Aggregate [_old" in python


RAW = "k string, n string, d string"
WANTED = "k string, n int, d date"


def found(df, key=None):
    return {(r.problem): r.rows for r in load_checks(df, "t", WANTED, key).collect()}


def test_load_checks(spark):
    rows = [("a", "1", "2024-01-01"), ("a", "x", None), ("a", None, "?"), ("b", "", "2024-02-30"), (None, "2", None), (None, "3", None)]
    df = spark.createDataFrame(rows, RAW)
    counts = {"n does not fit": 2, "d does not fit": 2}
    assert found(df) == counts
    assert found(df, ["k"]) == {"repeated key": 2, "no key": 2, **counts}
    assert set(found(df.limit(0), ["k"]).values()) == {0}
    assert load_checks(df.select("k"), "t", "k string").isEmpty()
    assert [r.n for r in typed(df, WANTED).collect()] == [1, None, None, None, 2, 3]


def test_refuse_names_what_is_wrong(spark):
    checks = load_checks(spark.createDataFrame([("a", "x", None)], RAW), "t", WANTED)
    with pytest.raises(ValueError, match="t: n does not fit in 1 rows"):
        refuse(checks)
    refuse(checks, {("t", "n does not fit"): 1})


def test_checks_are_one_scan(spark, tmp_path):
    spark.createDataFrame([("a", "1", None)], RAW).write.parquet(str(tmp_path / "t"))
    plan = load_checks(spark.read.parquet(str(tmp_path / "t")), "t", WANTED, ["k"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_a_failed_run_leaves_the_reports_of_the_one_before(spark, tmp_path):
    out = str(tmp_path)
    assert publish.published_paths(spark, out) == {}
    first = publish.Run(spark, out)
    first.write("a", spark.range(5))
    first.write("b", spark.range(3))
    paths = first.publish()
    failed = publish.Run(spark, out)
    failed.write("a", spark.range(50))
    with pytest.raises(Exception, match="broken"):
        failed.write("b", spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("x")))
    assert publish.published_paths(spark, out) == paths and spark.read.parquet(paths["a"]).count() == 5
    third = publish.Run(spark, out)
    third.write("a", spark.range(0))
    assert publish.published_paths(spark, out) == paths
    third.publish()
    assert publish.published_paths(spark, out) == third.paths and list(third.paths) == ["a"]


def test_a_run_that_lost_rows_is_not_published(spark, tmp_path):
    run = publish.Run(spark, str(tmp_path))
    path = run.write("a", spark.range(5))
    spark.range(2).write.mode("overwrite").parquet(path)
    with pytest.raises(RuntimeError, match="5 rows were written, 2 are there"):
        run.publish()
    assert publish.published_paths(spark, str(tmp_path)) == {}


def test_reports_stay_when_a_later_load_is_refused(spark, tmp_path):
    """Repeated store codes fail the job between two reports' worth of work; the earlier run stands."""
    sources = entry._source_tables(spark, SF)
    settings = {"cfg": entry._SOURCE_CONFIG, "out": str(tmp_path), "misread": entry._SOURCE_MISREAD}
    paths = member_conversion.run_from_source(spark, sources, **settings)
    display = spark.read.parquet(paths["region_display"])
    assert {r.own_add_rate[-1] for r in display.collect()} == {"%"}
    assert spark.read.parquet(paths["load_checks"]).agg(F.sum("rows")).first()[0] == 0
    sources["shop"] = sources["shop"].unionByName(sources["shop"])
    with pytest.raises(ValueError, match="shop: repeated key"):
        member_conversion.run_from_source(spark, sources, **settings)
    assert publish.published_paths(spark, str(tmp_path)) == paths


def test_adjustments_as_one_table(spark, tmp_path):
    rows = adjustments(spark.createDataFrame([(f"T{i % 9}", f"s{i}", "k", 1.0, 3.0) for i in range(90)], schemas.STOCK), entry.STOCK)
    for by_title in (True, False):
        writers.write_adjustments(rows, str(tmp_path / str(by_title)), by_title=by_title)
    both = [spark.read.csv(str(tmp_path / str(b)), header=True) for b in (True, False)]
    assert both[0].columns == both[1].columns
    assert sorted(map(tuple, both[0].collect())) == sorted(map(tuple, both[1].collect()))
    assert not any(p.is_dir() for p in (tmp_path / "False").iterdir())


class Database:
    """Stands in for the JDBC source: notes what is asked for."""

    def __init__(self, least, greatest):
        self.asked, self.bounds = [], (least, greatest)

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.asked.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return self.bounds


def test_jdbc_reads_are_split_between_the_least_and_the_greatest_key():
    db = Database(3, 900)
    readers.read_jdbc(db, url="jdbc:x", query="SELECT * FROM t", key="id", ranges=8, user="u")
    bounds, rows = db.asked
    assert bounds == {"url": "jdbc:x", "user": "u", "query": "SELECT MIN(id) AS least, MAX(id) AS greatest FROM (SELECT * FROM t) q"}
    assert rows == {
        "url": "jdbc:x", "user": "u", "dbtable": "(SELECT * FROM t) q", "partitionColumn": "id", "lowerBound": "3",
        "upperBound": "900", "numPartitions": "8",
    }
    empty = Database(None, None)
    readers.read_jdbc(empty, url="jdbc:x", table="t", key="id", ranges=8)
    assert empty.asked[-1] == {"url": "jdbc:x", "dbtable": "t"}


def test_a_read_in_one_task_has_to_be_asked_for():
    db = Database(0, 1)
    for bad in ({}, {"key": "id"}, {"ranges": 4}, {"key": "id", "ranges": 4, "small": True}):
        with pytest.raises(ValueError, match="small"):
            readers.read_jdbc(db, url="jdbc:x", table="t", **bad)
    assert not db.asked
    readers.read_jdbc(db, url="jdbc:x", table="t", small=True)
    assert db.asked == [{"url": "jdbc:x", "dbtable": "t"}]
