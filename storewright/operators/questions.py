"""The questions asked most often per category, exactly, without shuffling every question.

Three steps over narrow rows (category, hash of the text):

1. Each task keeps the commonest hashes of a category with their counts, and how
   much a count may have lost by dropping others (Misra-Gries). Such summaries
   add up: the lost parts of all tasks bound what any question can have beyond
   its counted rows.
2. A question whose counted and lost rows together stay below the k-th highest
   counted one cannot be among the first k. The others are the candidates. Where
   the lost part reaches that k-th count a summary proves nothing, and all questions
   of that category are candidates.
3. Candidates, and nothing else, are counted again over all rows.

Texts are looked up last, for the winners alone. The lists of candidates and of
winners are written first, so that Spark knows their size when it plans the
joins to them; none is hinted as broadcast.

Equal counts are ranked by the SHA-256 of the text. A NULL category is one of
its own, a NULL text is no question. An empty table gives an empty report.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storewright.operators.sessions import text_hash
from storewright.sources.writers import write_table

SUMMARY = "kind string, question binary, counted long, lost long"
TRACKED = 1024  # questions of a category that a task keeps
HELD = 200_000  # rows that a task keeps over all categories before it hands them on
LONGEST = 1000  # up to this rank Spark cuts the rows of a category before it shuffles them


def question_keys(asked: DataFrame) -> DataFrame:
    """(kind, question) per row of (category, question): the category with NULL told apart from every text."""
    kind = F.coalesce(F.concat(F.lit("="), F.col("category").cast("string")), F.lit(""))
    return asked.filter(F.col("question").isNotNull()).select(kind.alias("kind"), "question")


def summaries(keys: DataFrame, tracked: int = TRACKED, held: int = HELD) -> DataFrame:
    """Per task and kind at most ``tracked`` questions with their counted rows, and one row with the lost part.

    A task that holds more than ``held`` rows hands them on and starts anew, so
    its memory does not grow with the number of categories.
    """
    group = ["kind", "question"]

    def cut(rows: pd.DataFrame, lost: dict[str, int]) -> pd.DataFrame:
        """Every count less the first one that is beyond ``tracked``; what is not above it goes."""
        rows = rows.sort_values("counted", ascending=False, kind="stable")
        beyond = rows[rows.groupby("kind").cumcount() == tracked].set_index("kind")["counted"]
        for kind, n in beyond.items():
            lost[kind] = lost.get(kind, 0) + int(n)
        less = rows["kind"].map(beyond).fillna(0).astype("int64")
        return rows.assign(counted=rows["counted"] - less)[rows["counted"] > less]

    def told(rows: pd.DataFrame, lost: dict[str, int]) -> Iterator[pd.DataFrame]:
        # As plain objects: pandas holds text in Arrow chunks, and those do not go into a batch.
        plain = {"kind": object, "question": object}
        yield rows.astype(plain).assign(lost=0)
        losses = {"kind": list(lost), "question": None, "counted": 0, "lost": list(lost.values())}
        yield pd.DataFrame(losses).astype(plain)

    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, lost = pd.DataFrame({"kind": [], "question": [], "counted": pd.Series(dtype="int64")}), {}
        for batch in batches:
            rows = pd.concat([rows, batch.assign(counted=1)]).groupby(group, as_index=False, sort=False).sum()
            rows = cut(rows, lost)
            if len(rows) > held:
                yield from told(rows, lost)
                rows, lost = rows[:0], {}
        yield from told(rows, lost)

    return keys.mapInPandas(summary, SUMMARY)


def candidates(summary: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(kind, question) that may be among the first ``k`` of their kind, and the kinds of which nothing is proven."""
    counted = (
        summary.filter(F.col("question").isNotNull()).groupBy("kind", "question").agg(F.sum("counted").alias("counted"))
    )
    first = _first(counted, k, "counted")
    floor = first.groupBy("kind").agg(F.count("*").alias("n"), F.min("counted").alias("least"))
    bounds = (
        summary.groupBy("kind")
        .agg(F.sum("lost").alias("lost"))
        .join(floor, "kind", "left")
        .select("kind", "lost", F.when(F.col("n") >= k, F.col("least")).otherwise(0).alias("floor"))
    )
    proven = (F.col("lost") < F.col("floor")) | (F.col("lost") == 0)
    may_be = counted.join(bounds.filter(proven), "kind").filter(F.col("counted") + F.col("lost") >= F.col("floor"))
    return may_be.select("kind", "question"), bounds.filter(~proven).select("kind")


def _first(rows: DataFrame, k: int, by: str) -> DataFrame:
    """The first ``k`` of each kind. Spark keeps ``k`` of a kind per task before the shuffle of such a window."""
    ranked = W.partitionBy("kind").orderBy(F.desc(by), "question")
    return rows.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def top_questions(
    spark: SparkSession, asked: DataFrame, texts: DataFrame, k: int, out: str, tracked: int = TRACKED
) -> DataFrame:
    """(category, rank, question, sessions): the ``k`` questions asked most often in each category.

    ``asked`` has a row per session with ``category`` and ``question``, the
    `text_hash` of its text; ``texts`` has ``text``, every question at least once.
    Intermediate tables go below ``out``, a folder that all executors see.
    """
    if not 1 <= k <= LONGEST:
        raise ValueError(f"k must be from 1 to {LONGEST}")

    def stored(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{out}/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    keys = stored(question_keys(asked), "question_keys")
    summary = stored(summaries(keys, tracked), "question_summaries")
    may_be, unproven = candidates(summary, k)
    may_be, unproven = stored(may_be, "question_candidates"), stored(unproven, "unproven_kinds")
    again = keys.join(may_be, ["kind", "question"], "left_semi").unionByName(keys.join(unproven, "kind", "left_semi"))
    counts = again.groupBy("kind", "question").agg(F.count("*").alias("sessions"))
    first = stored(_first(counts, k, "sessions"), "question_ranks")

    wanted = first.select("question").distinct()
    hashed = texts.filter(F.col("text").isNotNull()).select(text_hash(F.col("text")).alias("question"), "text")
    named = hashed.join(stored(wanted, "question_hashes"), "question", "left_semi").groupBy("question")
    words = named.agg(F.min("text").alias("text"))
    category = F.when(F.col("kind") != "", F.substring("kind", 2, 2**31 - 1))
    return first.join(words, "question").select(
        category.alias("category"), "rank", F.col("text").alias("question"), "sessions"
    )
