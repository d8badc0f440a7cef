"""The tables of a job, published together.

A run writes below a folder of its own and, when all its tables stand, adds them to
a list in one append. Readers take the newest run of that list, so a job that fails
half-way leaves the tables of the run before it as they were, and no reader sees
tables of two runs. Nothing is renamed, so this holds on object stores too. Folders
of older runs stay until someone removes them. One job at a time publishes to a
folder.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storewright.sources.writers import write_table

PUBLISHED = "sequence long, name string, path string, rows long"


def _published(spark: SparkSession, out: str) -> DataFrame:
    try:
        return spark.read.schema(PUBLISHED).parquet(f"{out}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISHED)


def published_paths(spark: SparkSession, out: str) -> dict[str, str]:
    """Name -> path of the tables of the newest run; empty before the first."""
    runs = _published(spark, out)
    newest = runs.select(F.max("sequence")).scalar()  # a subquery
    return {r.name: r.path for r in runs.filter(F.col("sequence") == newest).collect()}


class Run:
    """One run of a job. Rows are counted while they are written and compared with what can be read."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out
        self.folder = f"{out}/runs/{uuid.uuid4().hex}"
        self.rows: dict[str, int] = {}
        self.paths: dict[str, str] = {}

    def write(self, name: str, df: DataFrame) -> str:
        """Write a Parquet table of this run; its path."""
        path, counted = f"{self.folder}/{name}", Observation()
        write_table(df.observe(counted, F.count(F.lit(1)).alias("rows")), path)
        self.paths[name], self.rows[name] = path, counted.get["rows"]
        return path

    def publish(self) -> dict[str, str]:
        """Make this run the newest one; name -> path."""
        for name, rows in self.rows.items():
            found = self.spark.read.parquet(self.paths[name]).count()
            if found != rows:
                raise RuntimeError(f"{name}: {rows} rows were written, {found} are there")
        newest = _published(self.spark, self.out).select(F.max("sequence")).first()[0]
        sequence = 0 if newest is None else newest + 1
        entries = [(sequence, name, self.paths[name], rows) for name, rows in self.rows.items()]
        listed = self.spark.createDataFrame(entries, PUBLISHED).coalesce(1)
        listed.write.mode("append").parquet(f"{self.out}/published")
        return dict(self.paths)
