"""The questions asked most often, against plain counting."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from storewright import schemas
from storewright.config import LabelSpec
from storewright.operators import questions
from storewright.operators.sessions import text_hash
from storewright.plans import session_labels


def plain(rows, k):
    counts = Counter(r for r in rows if r[1] is not None)
    out = []
    for kind in {c for c, _ in counts}:
        of_kind = [(-n, hashlib.sha256(t.encode()).digest(), t) for (c, t), n in counts.items() if c == kind]
        out += [(kind, i, t, -n) for i, (n, _, t) in enumerate(sorted(of_kind)[:k], 1)]
    return sorted(out, key=str)


def asked(spark, rows, parts=6):
    df = spark.createDataFrame(rows, "category string, text string").repartition(parts)
    return df.select("category", text_hash(F.col("text")).alias("question")), df


def test_equal_to_counting(spark, tmp_path):
    """A hot question, ties, repeated rows, NULL and empty categories and texts, a category with few questions."""
    rng = random.Random(1)
    rows = [(rng.choice("abc"), "hot" if rng.random() < 0.34 else f"q{int(rng.paretovariate(0.7)) % 900}") for _ in range(6000)]
    rows += [(None, f"n{i % 7}") for i in range(90)] + [("", f"n{i % 7}") for i in range(20)] + [("d", None), ("e", "")] * 3
    rows += [("flat", f"once {i}") for i in range(500)] + [("=", "a" * 300_000)]
    for tracked in (3, 40, 1024):
        got = questions.top_questions(spark, *asked(spark, rows), 4, f"{tmp_path}/{tracked}", tracked)
        assert sorted(map(tuple, got.collect()), key=str) == plain(rows, 4)


def test_a_proven_category_is_counted_for_its_candidates_only(spark, tmp_path):
    rows = [("a", f"hot {i % 3}") for i in range(900)] + [("a", f"rare {i}") for i in range(2000)]
    rows += [("b", f"rare {i}") for i in range(2000)]
    keys = questions.question_keys(asked(spark, rows)[0])
    summary = questions.summaries(keys, tracked=50)
    assert summary.filter("question IS NOT NULL").groupBy("kind").count().agg(F.max("count")).first()[0] <= 6 * 50
    may_be, unproven = questions.candidates(summary, 3)
    assert may_be.count() == 3 and {r.kind for r in unproven.collect()} == {"=b"}


def test_counted_and_lost_rows_bound_every_question(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), f"q{int(rng.expovariate(0.02))}") for _ in range(5000)]
    keys = questions.question_keys(asked(spark, rows)[0]).cache()
    for held in (10, 200_000):
        summary = questions.summaries(keys, tracked=20, held=held)
        lost = {r.kind: r.n for r in summary.groupBy("kind").agg(F.sum("lost").alias("n")).collect()}
        counted = summary.filter("question IS NOT NULL").groupBy("kind", "question").agg(F.sum("counted").alias("n"))
        low = {(r.kind, bytes(r.question)): r.n for r in counted.collect()}
        for r in keys.groupBy("kind", "question").count().collect():
            n = low.get((r.kind, bytes(r.question)), 0)
            assert n <= r["count"] <= n + lost[r.kind]
    keys.unpersist()


def test_empty_table_and_bounds_of_k(spark, tmp_path):
    assert questions.top_questions(spark, *asked(spark, []), 3, str(tmp_path)).isEmpty()
    for k in (0, questions.LONGEST + 1):
        with pytest.raises(ValueError):
            questions.top_questions(spark, *asked(spark, []), k, str(tmp_path))


def test_a_window_sends_k_rows_of_a_category_from_each_task(spark, tmp_path):
    rows = spark.range(1000).selectExpr("string(id % 2) AS kind", "id AS question", "id AS sessions")
    plan = questions._first(rows.repartition(4), 3, "sessions")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("hashpartitioning") < plan.index("Partial")


def test_texts_are_not_shuffled(spark, tmp_path, monkeypatch):
    """The winners are broadcast by the size of their file, and only their texts leave the scan."""
    rows = [("a", "hot")] * 300 + [("a", f"rare {i}") for i in range(600)]
    keys, texts = asked(spark, rows)
    texts.write.parquet(f"{tmp_path}/texts")
    got = questions.top_questions(spark, keys, spark.read.parquet(f"{tmp_path}/texts"), 2, f"{tmp_path}/out")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning(question") == 1
    assert got.filter("rank = 1").first().question == "hot"


def test_job_writes_frequent_questions(spark, tmp_path):
    spec = LabelSpec()

    def factory():
        return lambda prompts: [json.dumps({"is_service": 1, "category": "c"}) for _ in prompts]

    rows = [(f"s{i}", "BOT", f"BOT hi\nt{i % 5 % 4}") for i in range(40)]
    session = spark.createDataFrame(rows, schemas.SESSION)
    paths = session_labels.run(spark, session, "BOT", factory, str(tmp_path), spec, questions=1)
    got = spark.read.parquet(paths["frequent_questions"])
    assert [tuple(r) for r in got.collect()] == [("c", 1, "t0", 16)]
