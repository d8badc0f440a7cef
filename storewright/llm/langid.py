"""Language identification by rank-order profiles.

A profile is the list of the most frequent character n-grams (one to three
letters, words bounded by a mark) in order of frequency. The distance of a
document to a language is the sum, over the document's own most frequent
n-grams, of how far each is out of place; one that the language lacks counts as
far as the profile is long. The nearest language wins, ties go to the smaller
name. The score is one minus the distance over the largest possible one.

Profiles are learned from counts over all training rows. Per language only the
``profile_size`` most frequent n-grams reach the driver, and only of up to
``max_languages`` languages, so what tasks receive is bounded. The profiles of
more languages are a written table: the n-grams of documents are joined to it
and the distances summed per document and language, with the same results.

Defined results: a null text or one without a letter gives ``und`` with score 0,
as does every text when nothing can be learned; rows with a null language are
not learned from; a null id is learned from like the empty string's hash says.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storewright.session import shared_folder

BOUND = 1  # stands for everything that is not a letter
BITS = 21  # of a code point
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> itself if it is a letter, else the boundary mark."""
    table = np.full(0x110000, BOUND, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    return table


def text_codes(text: str) -> np.ndarray:
    return _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, as numbers of up to three code points, and their counts."""
    codes = np.concatenate(([BOUND], codes, [BOUND])).astype(np.uint32)
    mark = codes == BOUND
    alphabet = np.unique(codes)
    small = np.searchsorted(alphabet, codes)
    size = len(alphabet)
    kind = np.uint32 if size**3 + size**2 + size < 2**32 else np.uint64
    small = small.astype(kind)
    two = small[:-1] * kind(size) + small[1:]
    three = two[:-1] * kind(size) + small[2:]
    keep_two = ~(mark[:-1] & mark[1:])
    keep_three = ~(mark[1:-1] | mark[:-2] & mark[2:])
    keys = np.concatenate(
        (small[~mark], two[keep_two] + kind(size), three[keep_three] + kind(size + size * size))
    )
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first].astype(np.int64)
    wide = alphabet.astype(np.int64)
    grams = np.empty(len(keys), np.int64)
    one, pair = keys < size, (keys >= size) & (keys < size + size * size)
    grams[one] = wide[keys[one]]
    k = keys[pair] - size
    grams[pair] = wide[k // size] << BITS | wide[k % size]
    rest = ~(one | pair)
    k = keys[rest] - size - size * size
    grams[rest] = (wide[k // size**2] << BITS | wide[k // size % size]) << BITS | wide[k % size]
    return grams, counts


def most_frequent(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    return grams[np.lexsort((grams, -counts))[:size]]


def learn_profiles(
    docs: DataFrame, training: Column, size: int = 300, max_languages: int = 1000
) -> dict[str, list[int]] | DataFrame:
    """Language -> its most frequent n-grams, in order; of many languages a written table of lang, gram and rank."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).extend((text_codes(text), np.array([BOUND], np.uint32)))
            for lang, codes in texts.items():
                grams, counts = gram_counts(np.concatenate(codes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams)), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"]
                )

    learned = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = (
        learned.select("lang", F.col("text").cast("string"))
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    path = shared_folder(docs.sparkSession)
    top.select("lang", "gram", (F.col("rank") - 1).alias("rank")).write.parquet(path)
    table = docs.sparkSession.read.schema("lang string, gram long, rank int").parquet(path)
    if table.select("lang").distinct().limit(max_languages + 1).count() > max_languages:
        return table
    rows = table.collect()
    profiles: dict[str, list[int]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Profiles:
    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size = sorted(profiles), size
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.ranks = np.full((len(self.names), len(self.grams) + 1), size, np.int64)
        for i, name in enumerate(self.names):
            at = np.searchsorted(self.grams, profiles[name])
            self.ranks[i, at] = np.arange(len(at))
        self.missing = len(self.grams)

    def nearest(self, text: str | None) -> tuple[str, float]:
        codes = text_codes(text or "")
        if not self.names or not (codes != BOUND).any():
            return UNKNOWN, 0.0
        grams = most_frequent(*gram_counts(codes), self.size)
        at = np.searchsorted(self.grams, grams)
        at = np.where(self.grams[np.minimum(at, self.missing - 1)] == grams, at, self.missing)
        ranks = self.ranks[:, at]
        out = np.where(at == self.missing, self.size, np.abs(ranks - np.arange(len(grams))))
        out = np.where(ranks == self.size, self.size, out).sum(axis=1)
        best = int(out.argmin())
        return self.names[best], 1.0 - float(out[best]) / (self.size * len(grams))


def identify(docs: DataFrame, profiles: dict[str, list[int]] | DataFrame, size: int = 300) -> DataFrame:
    """The rows with lang_pred and score in place of all but doc_id."""
    if isinstance(profiles, DataFrame):
        return _identify_by_join(docs, profiles, size)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(profiles, size)
        for batch in batches:
            found = [known.nearest(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([n for n, _ in found], pa.string()),
                    pa.array([s for _, s in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        predict, "doc_id long, lang_pred string, score double"
    )


def _identify_by_join(docs: DataFrame, profiles: DataFrame, size: int) -> DataFrame:
    """As above with a table of profiles.

    An n-gram that a language has lies some ranks out of place, which is less
    than the distance ``size`` of a missing one; the sums of what is saved stand
    for the distances. Where no n-gram is shared all languages are equally far,
    and the smallest name wins. Rows are told apart by
    number, so ids may repeat or be null.
    """
    spark = docs.sparkSession

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = []
            for text in batch.column(0):
                codes = text_codes(text.as_py() or "")
                letters = (codes != BOUND).any()
                found.append(most_frequent(*gram_counts(codes), size).tolist() if letters else [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n, n + len(found)), pa.int64()), batch.column(1), pa.array(found, pa.list_(pa.int64()))],
                ["row", "doc_id", "grams"],
            )
            n += len(found)

    path = shared_folder(spark)
    schema = "row long, doc_id long, grams array<long>"
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    rows.mapInArrow(number, schema).write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    asked = rows.select("row", F.posexplode("grams").alias("place", "gram"))
    saved = (
        asked.join(profiles, "gram")
        .groupBy("row", "lang")
        .agg(F.sum(F.lit(size) - F.abs(F.col("rank") - F.col("place"))).alias("saved"))
    )
    best = saved.groupBy("row").agg(F.min(F.struct((-F.col("saved")).alias("less"), "lang")).alias("best"))
    least = profiles.agg(F.min("lang").alias("least"))
    n = F.size("grams")
    distance = F.lit(size) * n - F.coalesce(-F.col("best.less"), F.lit(0))
    return rows.join(best, "row", "left").crossJoin(least).select(
        "doc_id",
        F.when(n == 0, UNKNOWN).otherwise(F.coalesce("best.lang", "least")).alias("lang_pred"),
        F.when(n == 0, 0.0).otherwise(1.0 - distance / (F.lit(size) * n)).alias("score"),
    )
