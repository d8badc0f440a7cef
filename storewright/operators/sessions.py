"""Chat sessions handled by the bot: cleaning, labelling, category counts.

Labels are attached by text hash, never by position, so they cannot land on
another row. Full texts take part in one shuffle only (the distinct before the
classifier); the join that brings labels back to sessions moves ids and hashes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storewright.config import LabelSpec
from storewright.functions.text import clean_transcript, strip_leading_newlines

# A batch of prompts in, one raw answer per prompt out. The factory runs once
# per task, so clients need not be picklable. Tasks can be retried: calls must
# be idempotent.
Classifier = Callable[[list[str]], list[str]]
ClassifierFactory = Callable[[], Classifier]

FENCED_JSON = r"(?s)```(?:json)?(.*?)```"
# Closes the array in which an answer is parsed; no answer holds this key by chance.
END_MARK = "end of this answer"
ANSWERED = "text_hash binary, answer string, failure string"
FAILURE_CHARS = 500  # of an error message


def bot_sessions(session: DataFrame, bot: str) -> DataFrame:
    """Sessions last handled by the bot that have a transcript."""
    return session.filter(F.col("last_agent") == bot).filter(F.col("transcript").isNotNull())


def cleaned_sessions(session: DataFrame, bot: str, mode: str = "lines") -> DataFrame:
    """``session_id`` and cleaned ``text`` of the bot's sessions."""
    return bot_sessions(session, bot).select(
        "session_id", clean_transcript(F.col("transcript"), bot, mode).alias("text")
    )


def text_hash(text: Column) -> Column:
    """Key of a text: 32 bytes, wide enough that equal hashes mean equal texts."""
    return F.unhex(F.sha2(text, 256))


def build_prompt(text: Column, spec: LabelSpec) -> Column:
    head, tail = spec.prompt_parts()
    return F.concat(F.lit(head), text, F.lit(tail))


def parse_answers(answers: DataFrame, spec: LabelSpec) -> DataFrame:
    """Replace the column ``answer`` by is_service, category, label_status and failure.

    An answer is one JSON object with both keys, bare or in a code fence, and
    nothing behind it; of a repeated key the last value counts. Anything else gives
    the fallback pair, the status 'failed' and the reason; a column ``failure`` of
    the input says why there is no answer. Each step is a column of its own, so
    that Spark parses an answer once.
    """
    stripped = strip_leading_newlines(F.col("answer"))
    fenced = F.nullif(F.regexp_extract(stripped, FENCED_JSON, 1), F.lit(""))
    # The parser stops behind a value and ignores what follows. As an element of an
    # array with a known last element, an answer cannot have anything behind it.
    # A map keeps "key is missing" and "key is null" apart, and repeated keys.
    wrapped = F.concat(F.lit("["), F.col("body"), F.lit(f', {{"{END_MARK}": ""}}]'))
    parsed = F.from_json(wrapped, "array<map<string,string>>", {"allowSingleQuotes": "false"})
    alone = (F.size("parsed") == 2) & F.map_contains_key(F.try_element_at("parsed", F.lit(2)), END_MARK)

    def given(key: str) -> Column:
        return F.filter("entries", lambda e: e["key"] == key)

    def label(key: str, fallback: str) -> Column:
        value = F.try_element_at(given(key), F.lit(-1))["value"]
        return F.when(F.col("complete"), value).otherwise(fallback)

    kept = [c for c in answers.columns if c not in ("answer", "failure")]
    told = F.col("failure") if "failure" in answers.columns else F.lit(None).cast("string")
    complete = (F.size(given("is_service")) > 0) & (F.size(given("category")) > 0)
    reason = (
        F.when(F.col("answer").isNull(), F.coalesce(told, F.lit("no answer")))
        .when(F.col("entries").isNull(), "not one JSON object")
        .when(~F.col("complete"), "missing key")
    )
    return (
        answers.withColumn("body", F.coalesce(fenced, stripped))
        .withColumn("parsed", parsed)
        .withColumn("entries", F.when(alone, F.map_entries(F.try_element_at("parsed", F.lit(1)))))
        .withColumn("complete", F.coalesce(complete, F.lit(False)))
        .select(
            *kept,
            label("is_service", spec.failed_is_service).alias("is_service"),
            label("category", spec.failed_category).alias("category"),
            F.when(F.col("complete"), "ok").otherwise("failed").alias("label_status"),
            reason.alias("failure"),
        )
    )


def _occurs(text: Column, pattern: str) -> Column:
    """Does the pattern occur? Plain words, also several with ``|``, are searched without a regex."""
    words = pattern.split("|")
    if any(not word or re.search(r"[\\^$.?*+()\[\]{}]", word) for word in words):
        return text.rlike(pattern)
    return reduce(or_, [text.contains(word) for word in words])


def keyword_labels(texts: DataFrame, rules: dict[str, str], spec: LabelSpec) -> DataFrame:
    """Offline labels without a classifier: the first topic whose pattern occurs in the text.

    ``rules`` maps topic -> regular expression and is tried in order; a session
    without a text gets the fallback pair, as from a classifier. Column
    expressions only, so no deduplication and no shuffle is needed.
    """
    topic = F.lit(None).cast("string")
    for name, pattern in reversed(list(rules.items())):
        topic = F.when(_occurs(F.col("text"), pattern), name).otherwise(topic)
    told = F.col("told")
    return texts.select("session_id", topic.alias("topic"), F.col("text").isNotNull().alias("told")).select(
        "session_id",
        F.when(~told, spec.failed_is_service).when(F.col("topic").isNotNull(), "1").otherwise("0").alias("is_service"),
        F.when(~told, spec.failed_category).otherwise(F.coalesce("topic", F.lit(spec.other))).alias("category"),
        F.when(told, "ok").otherwise("failed").alias("label_status"),
    )


def distinct_prompts(texts: DataFrame, spec: LabelSpec) -> DataFrame:
    """(text_hash, prompt) of each distinct text; whole texts are shuffled here and nowhere else."""
    return (
        texts.filter(F.col("text").isNotNull())
        .select("text")
        .distinct()
        .select(text_hash(F.col("text")).alias("text_hash"), build_prompt(F.col("text"), spec).alias("prompt"))
    )


def ask_classifier(
    prompts: DataFrame, classifier_factory: ClassifierFactory, tasks: int, batch_size: int = 1
) -> DataFrame:
    """(text_hash, answer, failure) per prompt; exactly one of the two is NULL.

    Each prompt is sent once, also when a call fails. The classifier gets
    ``batch_size`` prompts a call and may return None for some of them. The stage
    is bound by calls and not by bytes, so it has an explicit number of tasks.
    """

    def answers(classifier, asked):
        # One answer or a reason per prompt; what was asked is not asked again.
        out = []
        for i in range(0, len(asked), batch_size):
            some = asked[i : i + batch_size]
            try:
                given, failure = list(classifier(some)), "no answer"
            except Exception as error:
                given, failure = [None] * len(some), f"{type(error).__name__}: {error}"[:FAILURE_CHARS]
            if len(given) != len(some):
                failure = f"{len(given)} answers to {len(some)} prompts"
                given = [None] * len(some)
            out.extend((a, None) if isinstance(a, str) else (None, failure) for a in given)
        return out

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classifier = classifier_factory()
        for batch in batches:
            given = answers(classifier, batch["prompt"].tolist())
            yield batch[["text_hash"]].assign(answer=[a for a, _ in given], failure=[f for _, f in given])

    return prompts.repartition(tasks, "text_hash").mapInPandas(ask, ANSWERED)


def _tasks(df: DataFrame, max_parallel: int | None) -> int:
    return max_parallel or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_labels(
    texts: DataFrame,
    classifier_factory: ClassifierFactory,
    spec: LabelSpec,
    max_parallel: int | None = None,
    batch_size: int = 1,
) -> DataFrame:
    """Labels per distinct text: (text_hash, is_service, category, label_status, failure).

    ``max_parallel`` caps the concurrent callers; without it there are as many
    as shuffle partitions.
    """
    tasks = _tasks(texts, max_parallel)
    return parse_answers(ask_classifier(distinct_prompts(texts, spec), classifier_factory, tasks, batch_size), spec)


def attach_labels(texts: DataFrame, labels: DataFrame, spec: LabelSpec, with_hash: bool = False) -> DataFrame:
    """Labels per session: (session_id, is_service, category, label_status, failure), and ``text_hash`` if asked for.

    A text copied into a third of all sessions makes one hot hash. Both sides
    are narrow here and nothing is computed on the hash afterwards, so AQE can
    split that partition.
    """
    if "failure" not in labels.columns:
        labels = labels.withColumn("failure", F.lit(None).cast("string"))
    sessions = texts.select("session_id", text_hash(F.col("text")).alias("text_hash"))
    return sessions.join(labels, "text_hash", "left").select(
        "session_id",
        F.when(F.col("label_status").isNull(), spec.failed_is_service)
        .otherwise(F.col("is_service"))
        .alias("is_service"),
        F.when(F.col("label_status").isNull(), spec.failed_category)
        .otherwise(F.col("category"))
        .alias("category"),
        F.coalesce("label_status", F.lit("failed")).alias("label_status"),
        F.when(F.col("label_status").isNull(), "no text").otherwise(F.col("failure")).alias("failure"),
        *(["text_hash"] if with_hash else []),
    )


def classify(
    texts: DataFrame,
    classifier_factory: ClassifierFactory,
    spec: LabelSpec,
    max_parallel: int | None = None,
) -> DataFrame:
    """`text_labels` and `attach_labels` in one plan.

    With a paid classifier prefer the job in ``plans.session_labels``: it keeps
    answers in a log, so neither a lost executor nor a killed job costs the calls
    of finished rounds again.
    """
    return attach_labels(texts, text_labels(texts, classifier_factory, spec, max_parallel), spec)


def failure_counts(labels: DataFrame) -> DataFrame:
    """Sessions without a label per reason."""
    return labels.filter(F.col("label_status") == "failed").groupBy("failure").agg(F.count("*").alias("sessions"))


def category_frequency(labels: DataFrame, k: int | None = None) -> DataFrame:
    """Sessions per category and their share of all sessions; with ``k`` the most frequent ones."""
    counts = labels.groupBy("category").agg(F.count("*").alias("sessions"))
    total = counts.select(F.sum("sessions")).scalar()
    shares = counts.withColumn("share", F.col("sessions").cast("double") / total)
    if k is None:
        return shares
    return shares.orderBy(F.desc("sessions"), "category").limit(k)
