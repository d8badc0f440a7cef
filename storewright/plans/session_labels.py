"""Label the bot's sessions and count the categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storewright.config import LabelSpec
from storewright.operators import sessions as ops
from storewright.operators.label_log import LabelLog
from storewright.operators.questions import top_questions
from storewright.sources.writers import write_table


def run(
    spark: SparkSession,
    session: DataFrame,
    bot: str,
    classifier_factory: ops.ClassifierFactory,
    out: str,
    spec: LabelSpec | None = None,
    mode: str = "lines",
    max_parallel: int | None = None,
    texts_per_round: int = 100_000,
    retry_failed: bool = False,
    max_rounds: int | None = None,
    questions: int | None = None,
) -> dict[str, str]:
    """Write ``text_labels``, ``labels``, ``failures`` and ``category_frequency`` below ``out``.

    Answers are kept in ``label_log`` below ``out`` and survive the run: another
    run over the same or more sessions asks only for texts that have no row there,
    or with ``retry_failed`` no answer. After ``max_rounds`` rounds the tables are
    written from what the log has; sessions still to be asked count as failed. With
    ``questions``, the table ``frequent_questions`` has that many texts of each category.
    """
    spec = spec or LabelSpec()
    names = ("label_log", "text_labels", "labels", "failures", "category_frequency")
    paths = {name: f"{out}/{name}" for name in names}
    texts = ops.cleaned_sessions(session, bot, mode)
    log = LabelLog(spark, paths["label_log"])
    log.complete(
        texts, classifier_factory, spec, f"{out}/pending", texts_per_round, max_parallel,
        retry_failed=retry_failed, max_rounds=max_rounds,
    )
    write_table(ops.parse_answers(log.latest(), spec), paths["text_labels"])

    stored = spark.read.parquet(paths["text_labels"])
    write_table(ops.attach_labels(texts, stored, spec, with_hash=True), paths["labels"])
    labels = spark.read.parquet(paths["labels"])
    write_table(ops.failure_counts(labels), paths["failures"])
    write_table(ops.category_frequency(labels), paths["category_frequency"])
    if questions is not None:
        paths["frequent_questions"] = f"{out}/frequent_questions"
        asked = labels.select("category", F.col("text_hash").alias("question"))
        write_table(top_questions(spark, asked, texts, questions, f"{out}/questions"), paths["frequent_questions"])
    return paths
