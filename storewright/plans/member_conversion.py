"""Member-conversion report: tables from one pass over the sources, published together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from storewright import fixed_values as fixed
from storewright import schemas
from storewright.config import ConversionConfig
from storewright.operators import reports
from storewright.operators.conversion import conversion_detail
from storewright.operators.repair import repair_columns
from storewright.schemas import DETAIL_COUNTS, DETAIL_KEYS, rename_columns, trim_keys
from storewright.sources.checks import load_checks, refuse, typed
from storewright.sources.publish import Run
from storewright.sources.writers import write_table

TABLES = ("shop", "member", "purchase", "goods", "contact")
# Per table: the names at the source, the types wanted, the keys that are stripped of blanks, the key that has to be unique.
SOURCES = {
    "shop": (fixed.SHOP_COLUMNS, schemas.SHOP, ["store_code"], ["store_code"]),
    "member": (fixed.MEMBER_COLUMNS, schemas.MEMBER, ["member_id", "service_store", "union_id"], None),
    "purchase": (fixed.PURCHASE_COLUMNS, schemas.PURCHASE, ["member_id", "sku"], None),
    "goods": (fixed.GOODS_COLUMNS, schemas.GOODS, ["sku"], None),
    "contact": (fixed.CONTACT_COLUMNS, schemas.CONTACT, ["union_id"], None),
}
MISREAD = {"shop": ["store_type"]}


def load(
    sources: dict[str, DataFrame], misread: dict[str, list[str]] = MISREAD
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables as the sources deliver them -> tables as `run` takes them, and what is wrong with them.

    Columns get our names, keys lose the blanks around them, wrongly decoded
    columns (``misread``) are repaired, values get their types. Values that do not
    fit are NULL; the second table, (name, problem, rows), counts them and repeated
    store codes.
    """
    tables, checks = {}, []
    for name, (names, schema, keys, unique) in SOURCES.items():
        raw = trim_keys(rename_columns(sources[name], names), *keys)
        checks.append(load_checks(raw, name, schema, unique))
        tables[name] = typed(repair_columns(raw, misread[name]) if name in misread else raw, schema)
    return tables, reduce(DataFrame.unionByName, checks)


def run(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    cfg: ConversionConfig,
    out: str,
    lagging: int = fixed.LAGGING_SUBREGIONS,
) -> dict[str, str]:
    """Publish ``detail``, ``region``, ``lagging_subregion`` and ``store`` below ``out``, and each as ``..._display``.

    ``tables`` holds shop, member, purchase, goods and contact. Returns the path
    of each table; `publish.published_paths` gives them again. A run that fails leaves
    those of the run before it.
    """
    return _report(Run(spark, out), tables, cfg, lagging).publish()


def run_from_source(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    cfg: ConversionConfig,
    out: str,
    lagging: int = fixed.LAGGING_SUBREGIONS,
    misread: dict[str, list[str]] = MISREAD,
    allowed: dict[tuple[str, str], int] | None = None,
) -> dict[str, str]:
    """`load` and `run`, with the table ``load_checks``.

    More rows with a problem than ``allowed`` for its (name, problem), none if
    not said, fail the job before any report is made.
    """
    run = Run(spark, out)
    tables, checks = load(sources, misread)
    refuse(spark.read.parquet(run.write("load_checks", checks)), allowed)
    for name in misread:  # a repaired table is read more than once
        write_table(tables[name], f"{run.folder}/loaded/{name}")
        tables[name] = spark.read.parquet(f"{run.folder}/loaded/{name}")
    return _report(run, tables, cfg, lagging).publish()


def _report(run: Run, tables: dict[str, DataFrame], cfg: ConversionConfig, lagging: int) -> Run:
    detail = reports.detail_report(conversion_detail(*[tables[name] for name in TABLES], cfg))
    run.write("detail", detail.orderBy("region", "subregion", "store_code"))
    rows = run.spark.read.parquet(run.paths["detail"])
    stored = rows.select(*DETAIL_KEYS, *DETAIL_COUNTS)
    views = {
        "region": reports.sort_region_report(reports.region_report(stored, cfg)),
        "lagging_subregion": reports.lagging_subregions(stored, cfg, lagging),
        "store": reports.store_report(stored, cfg).orderBy("store_name"),
    }
    for name, view in views.items():
        run.write(name, view)
    for name in ("detail", *views):
        run.write(f"{name}_display", reports.percent_view(run.spark.read.parquet(run.paths[name])))
    return run
