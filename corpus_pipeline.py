"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last return
the columns of documents; n_chars follows the text.

Stages give the session a bound on the bytes of an Arrow batch, unless it has
one. A result is computed when it is written, so the option stays set.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storewright.llm import decontaminate, jaccard_join, packing, queries, suffix_dedup, toxicity
from storewright.llm.workers import BATCH_BYTES
from storewright.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Spark's 64 MB lie several times over in an executor, for each of its tasks in the JVM and in Python.
MOST_BATCH_BYTES = 4_000_000


def in_small_batches(stage: Stage) -> Stage:
    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_BYTES, None) is None:
            spark.conf.set(BATCH_BYTES, str(MOST_BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic; it is fitted on the labelled ones among them."""
    chain = toxicity.fit_chain(docs, queries.table(spark, sf_dir, "labels"), queries.CHAIN)
    return toxicity.keep_clean(docs, chain)


@in_small_batches
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; texts without words all stay."""
    return jaccard_join.keep_first(spark, docs)


@in_small_batches
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has; a text of which nothing is left goes."""
    cut = suffix_dedup.cut_passages(spark, docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.drop_leaks(docs, queries.table(spark, sf_dir, "benchmark"))


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, **queries.PACKING)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one_of_near_copies),
    ("suffix_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: No SQL: a fitted chain, exact components and byte-level ids are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
