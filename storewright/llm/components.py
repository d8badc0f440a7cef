"""Connected components by alternating stars, on DataFrames.

Each round hangs every node on the smallest node around it; the number of
rounds grows with the logarithm of the size. Hubs are joined on, not gathered:
minima are combined before the shuffle and AQE splits the hub's join. Every
round is written to the shared folder, so lineage stays short and a lost
executor costs one round.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storewright.session import shared_folder


def written(spark: SparkSession, df: DataFrame, by: str | None = None) -> DataFrame:
    """The rows, written to the shared folder; bucketed by a column that they will be joined on."""
    path = shared_folder(spark)
    if by is None:
        df.write.parquet(path)
        return spark.read.parquet(path)
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"written_{uuid.uuid4().hex}"
    df.repartition(buckets, by).write.bucketBy(buckets, by).option("path", path).saveAsTable(name)
    return spark.table(name)


def discard(df: DataFrame) -> None:
    """Remove a table that `written` or `write_chunks` made, once nothing reads it any more: it would count as disk until the end."""
    files = df.inputFiles()
    folder = files[0].rsplit("/", 1)[0] if files else ""
    if re.search(r"/[0-9a-f]{32}$", folder):  # only folders that `shared_folder` named
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.filter(F.col("v") > F.col("u"))
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars already: every node hangs on one other, which hangs on none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    both = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return both.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (u, v); the root is the smallest node of the component."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges = written(spark, edges)
    while not _settled(edges):
        edges = written(spark, _small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
