"""An append-only log of classifier answers, so that no text is paid for twice.

Rows are (text_hash, attempt, answer, failure): what came back for a text, or why
nothing did. A round asks for a bounded number of texts and is appended as a
whole when it is done; a job that dies loses the round it was in, and the next
one asks only for texts without a row. Retried tasks within a round are not
visible: a round's files appear when it is committed.

Texts are dealt to rounds by their hash and written once, a folder per round, so
that a round reads its own texts only, however many rounds there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storewright.config import LabelSpec
from storewright.operators import sessions as ops

LOG = "text_hash binary, attempt int, answer string, failure string"
PENDING = "text_hash binary, prompt string, round int"


class LabelLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        # An empty append makes the table exist, with its schema.
        spark.createDataFrame([], LOG).coalesce(1).write.mode("append").parquet(path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(self.path)

    def latest(self) -> DataFrame:
        """(text_hash, answer, failure) per text: its answer if it has one, else its last failure."""
        best = F.struct(F.col("answer").isNotNull().alias("answered"), "attempt", "answer", "failure")
        last = self.rows().groupBy("text_hash").agg(F.max(best).alias("last"))
        return last.select("text_hash", "last.answer", "last.failure")

    def missing(self, prompts: DataFrame, retry_failed: bool = False) -> DataFrame:
        """The prompts whose text has no row, or with ``retry_failed`` no answer."""
        known = self.rows().filter(F.col("answer").isNotNull()) if retry_failed else self.rows()
        return prompts.join(known.select("text_hash"), "text_hash", "left_anti")

    def complete(
        self,
        texts: DataFrame,
        classifier_factory: ops.ClassifierFactory,
        spec: LabelSpec,
        pending_path: str,
        texts_per_round: int = 100_000,
        max_parallel: int | None = None,
        batch_size: int = 1,
        retry_failed: bool = False,
        max_rounds: int | None = None,
    ) -> int:
        """Ask for what is missing, round by round; returns how many rounds are still to do.

        ``max_rounds`` ends a run early, for a budget of calls.
        """
        attempt = (self.rows().agg(F.max("attempt")).first()[0] or 0) + 1
        missing = self.missing(ops.distinct_prompts(texts, spec), retry_failed)
        # The hash is uniform, so its first bytes deal evenly; the count reads hashes, not texts.
        in_round = F.pmod(F.xxhash64("text_hash"), F.lit(1 << 20)).cast("int")
        missing.withColumn("deal", in_round).write.mode("overwrite").parquet(pending_path)
        held = self.spark.read.schema("text_hash binary, prompt string, deal int").parquet(pending_path)
        rounds = -(-held.count() // texts_per_round)
        if rounds == 0:
            return 0
        dealt = f"{pending_path}_rounds"
        numbered = held.select("text_hash", "prompt", (F.col("deal") % rounds).alias("round"))
        numbered.hint("rebalance", F.col("round")).write.mode("overwrite").partitionBy("round").parquet(dealt)
        todo = self.spark.read.schema(PENDING).parquet(dealt)
        tasks = ops._tasks(texts, max_parallel)
        for number in range(rounds if max_rounds is None else min(rounds, max_rounds)):
            asked = ops.ask_classifier(
                todo.filter(F.col("round") == number), classifier_factory, tasks, batch_size
            )
            asked = asked.select("text_hash", F.lit(attempt).alias("attempt"), "answer", "failure")
            asked.write.mode("append").parquet(self.path)
        return rounds - (rounds if max_rounds is None else min(rounds, max_rounds))
