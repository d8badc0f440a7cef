"""What is wrong with a table, told while it is loaded."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def typed(df: DataFrame, schema: str) -> DataFrame:
    """The columns of ``schema`` with its types; a value that does not fit is NULL (and counted by `load_checks`)."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema).fields])


def _misfit(df: DataFrame, schema: str) -> dict[str, Column]:
    """Column -> does a value not fit its type? Columns that have the type already are left out."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return {
        f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in StructType.fromDDL(schema).fields
        if have[f.name] != f.dataType
    }


def load_checks(df: DataFrame, name: str, schema: str, key: list[str] | None = None) -> DataFrame:
    """(name, problem, rows) with a row per check, found or not.

    ``schema`` are the types wanted of the raw ``df``. With a ``key``, "repeated
    key" counts the rows beyond the first of each key and "no key" those with a NULL
    in it. One scan and one grouping serve all checks. The grouping is by key and is
    combined before its shuffle, so a key that fills a third of the table is a row per
    task there; without a key nothing but counts is shuffled.
    """
    misfit = {f"{c} does not fit": wrong for c, wrong in _misfit(df, schema).items()}
    counts = {problem: F.count_if(wrong) for problem, wrong in misfit.items()}
    if key is None:
        found = df.agg(*[n.alias(problem) for problem, n in counts.items()] or [F.lit(0).alias("none")])
    else:
        columns = [n.alias(problem) for problem, n in counts.items()]
        per_key = df.groupBy(*key).agg(F.count("*").alias("rows of key"), *columns)
        no_key = reduce(or_, [F.col(c).isNull() for c in key])
        rows = F.col("rows of key")
        found = per_key.agg(
            F.coalesce(F.sum(F.when(~no_key, rows - 1)), F.lit(0)).alias("repeated key"),
            F.coalesce(F.sum(F.when(no_key, rows)), F.lit(0)).alias("no key"),
            *[F.coalesce(F.sum(f"`{problem}`"), F.lit(0)).alias(problem) for problem in counts],
        )
        counts = {"repeated key": None, "no key": None, **counts}
    rows = [F.struct(F.lit(p).alias("problem"), F.col(f"`{p}`").cast("long").alias("rows")) for p in counts]
    empty = F.array().cast("array<struct<problem:string,rows:bigint>>")
    each = F.explode(F.array(*rows) if rows else empty)
    return found.select(each.alias("check")).select(F.lit(name).alias("name"), "check.problem", "check.rows")


def refuse(checks: DataFrame, allowed: dict[tuple[str, str], int] | None = None) -> None:
    """Fail when a check found more rows than allowed for its (name, problem): none, if not said."""
    bad = [
        f"{r.name}: {r.problem} in {r.rows} rows"
        for r in checks.filter(F.col("rows") > 0).orderBy("name", "problem").collect()
        if r.rows > (allowed or {}).get((r.name, r.problem), 0)
    ]
    if bad:
        raise ValueError("; ".join(bad))
