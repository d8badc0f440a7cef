from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from storewright import fixed_values as fixed
from storewright import schemas
from storewright.config import LabelSpec
from storewright.operators import sessions as ops
from storewright.operators.label_log import LabelLog

SPEC = LabelSpec()
FAILED = (fixed.FAILED_IS_SERVICE, fixed.FAILED_CATEGORY, "failed")


def labelled(df):
    return {r.session_id: (r.is_service, r.category, r.label_status) for r in df.collect()}


def test_only_bot_sessions_with_text(spark):
    rows = [("a", "BOT", "x"), ("b", "Ann", "x"), ("c", "BOT", None), ("d", None, "x"), ("e", "BOT", "")]
    got = ops.bot_sessions(spark.createDataFrame(rows, schemas.SESSION), "BOT").collect()
    assert {r.session_id for r in got} == {"a", "e"}


@pytest.mark.parametrize(
    ("answer", "labels"),
    [
        ('```json\n{"is_service": "1", "category": "x"}\n```', ("1", "x", "ok")),
        ('\n\n{"is_service":1,"category":"x"}', ("1", "x", "ok")),
        ('Sure: ```{"is_service":0,"category":"y"}``` bye', ("0", "y", "ok")),
        ('{"is_service":"1","category":null}', ("1", None, "ok")),
        ('{"is_service":"1","category":"x","more":[1]}', ("1", "x", "ok")),
        ('{"category":"x"}', FAILED),
        ('{"is_service":"1"}', FAILED),
        ("no json", FAILED),
        ("", FAILED),
        (None, FAILED),
        ("[1]", FAILED),
        ('{"is_service":"1","category":"x"} and more', FAILED),
        ("{'is_service':'1','category':'x'}", FAILED),
        ('```json\n{"is_service":"1","category":"x"}\n``` or ```{}```', ("1", "x", "ok")),
        ("```json\nnot json\n```", FAILED),
    ],
)
def test_parse_answers(spark, answer, labels):
    df = spark.createDataFrame([(7, answer)], "id int, answer string")
    assert tuple(ops.parse_answers(df, SPEC).first())[:4] == (7, *labels)


def test_prompt_holds_instructions_and_text(spark):
    prompt = spark.range(1).select(ops.build_prompt(F.lit("{coupon} fails"), SPEC).alias("p")).first().p
    head, tail = SPEC.prompt_parts()
    assert prompt == head + "{coupon} fails" + tail
    assert '\t"is_service": string  // ' in head and "```json\n{\n" in head
    assert "{format_instructions}" not in prompt and "{user_input}" not in prompt


def test_keyword_labels_take_the_first_rule(spark):
    rules = {"repair": "broken", "coupon": "coupon|voucher"}
    rows = [("a", "voucher broken"), ("b", "my voucher"), ("c", "hello"), ("d", None)]
    df = spark.createDataFrame(rows, "session_id string, text string")
    assert labelled(ops.keyword_labels(df, rules, SPEC)) == {
        "a": ("1", "repair", "ok"),
        "b": ("1", "coupon", "ok"),
        "c": ("0", fixed.OTHER_CATEGORY, "ok"),
        "d": FAILED,
    }


@pytest.mark.parametrize("pattern", ["a", "a|b c", "[ab]$", "a|", "x.z", "", "会员|a b", r"\\d"])
def test_plain_words_and_patterns_occur_alike(spark, pattern):
    texts = ["a", "b c", "xyz", "x.z", "cab", "", "会员权益", "a\nb", "5", "A"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", ops._occurs(F.col("t"), pattern).alias("found"), F.col("t").rlike(pattern).alias("want"))
    assert [r.found for r in rows.collect()] == [r.want for r in rows.collect()]


def echo_factory(head, tail, slow=None, fails=None, log=None):
    """Answers with the text itself as category; can be slow, fail or log its calls."""

    def factory():
        import time

        def answer(prompt):
            asked = prompt[len(head) : len(prompt) - len(tail)]
            if asked == slow:
                time.sleep(1)
            if asked == fails:
                raise RuntimeError("refused")
            if log is not None:
                with open(log, "a") as f:
                    f.write(asked + "\n")
            return json.dumps({"is_service": 1, "category": asked})

        return lambda prompts: [answer(p) for p in prompts]

    return factory


def texts_of(spark, rows):
    return spark.createDataFrame(rows, "session_id string, text string").repartition(4)


def test_labels_stay_on_their_rows(spark):
    """A slow first text, a failing one and copies; a failure leaves its batch mates alone."""
    rows = [("s0", "slow"), ("s1", "fast"), ("s2", "bad"), ("s3", "fast"), ("s4", ""), ("s5", None)]
    factory = echo_factory(*SPEC.prompt_parts(), slow="slow", fails="bad")
    got = labelled(ops.classify(texts_of(spark, rows), factory, SPEC, max_parallel=2))
    assert got == {
        "s0": ("1", "slow", "ok"),
        "s1": ("1", "fast", "ok"),
        "s2": FAILED,
        "s3": ("1", "fast", "ok"),
        "s4": ("1", "", "ok"),
        "s5": FAILED,
    }


def test_each_distinct_text_is_asked_once(spark, tmp_path):
    log = tmp_path / "calls"
    rows = [(f"s{i}", f"t{i % 3}") for i in range(60)]
    factory = echo_factory(*SPEC.prompt_parts(), log=str(log))
    ops.classify(texts_of(spark, rows), factory, SPEC).collect()
    assert sorted(log.read_text().split()) == ["t0", "t1", "t2"]


def test_failing_texts_cost_one_call_each(spark, tmp_path):
    log = str(tmp_path / "calls")

    def factory():
        def answer(prompts):
            with open(log, "a") as f:
                f.write("call\n" * len(prompts))
            raise RuntimeError("refused")

        return answer

    rows = [(f"s{i}", f"t{i % 20}") for i in range(60)]
    got = labelled(ops.classify(texts_of(spark, rows), factory, SPEC))
    assert set(got.values()) == {FAILED}
    assert len((tmp_path / "calls").read_text().split()) == 20


@pytest.mark.parametrize("answers", [lambda p: [], lambda p: 1 / 0, lambda p: None, lambda p: [7] * len(p)])
def test_a_classifier_that_breaks_its_contract_gives_fallback_labels(spark, answers):
    got = labelled(ops.classify(texts_of(spark, [("a", "x"), ("b", "y")]), lambda: answers, SPEC))
    assert got == {"a": FAILED, "b": FAILED}


def test_category_frequency(spark):
    labels = spark.createDataFrame([("a",), ("a",), ("b",)], "category string")
    got = [(r.category, r.sessions, round(r.share, 6)) for r in ops.category_frequency(labels, k=5).collect()]
    assert got == [("a", 2, 0.666667), ("b", 1, 0.333333)]
    assert [r.category for r in ops.category_frequency(labels, k=1).collect()] == ["a"]
    assert ops.category_frequency(labels).count() == 2


def parsed(spark, answers):
    df = spark.createDataFrame(list(enumerate(answers)), "n int, answer string")
    return [(r.is_service, r.category, r.failure) for r in sorted(ops.parse_answers(df, SPEC).collect())]


@pytest.mark.parametrize(
    "behind", [" junk", ' {"a": 1}', ', {"is_service": "1", "category": "y"}', "]", "], [{}", "}", " }", ",", " //", "\nok"]
)
def test_nothing_may_stand_behind_the_object(spark, behind):
    body = '{"is_service": "1", "category": "x"}'
    fallback = (SPEC.failed_is_service, SPEC.failed_category, "not one JSON object")
    got = parsed(spark, [body + behind, f"```json\n{body}{behind}\n```", body + " \n\t ", f" {body}"])
    assert got == [fallback, fallback, ("1", "x", None), ("1", "x", None)]


def test_of_repeated_keys_the_last_counts(spark):
    got = parsed(
        spark,
        [
            '{"category": "a", "is_service": "0", "category": "b", "is_service": "1"}',
            '{"category": "a", "is_service": 1, "category": null}',
            '{"is_service": true, "category": {"category": "in", "is_service": 5}}',
            '{"category": {"is_service": 5}}',
        ],
    )
    assert got[0] == ("1", "b", None) and got[1] == ("1", None, None)
    assert got[2][0] == "true" and json.loads(got[2][1]) == {"category": "in", "is_service": 5}
    assert got[3][2] == "missing key"


def test_reasons_of_failures(spark):
    bodies = [None, "", "[]", "null", "1", '"x"', "{}", "{'is_service': '1', 'category': 'x'}", '{"is_service": "1"}']
    reasons = [r for _, _, r in parsed(spark, bodies)]
    assert reasons == ["no answer", *["not one JSON object"] * 5, "missing key", "not one JSON object", "missing key"]

    def factory():
        def answer(prompts):
            if "bad" in prompts[0]:
                raise TimeoutError("late")
            return [None] if "mute" in prompts[0] else ["{}", "{}"] if "many" in prompts[0] else ["[]"]

        return answer

    rows = [("a", "bad"), ("b", "mute"), ("c", "many"), ("d", "x"), ("e", None)]
    labels = ops.classify(texts_of(spark, rows), factory, SPEC)
    assert {r.session_id: r.failure for r in labels.collect()} == {
        "a": "TimeoutError: late", "b": "no answer", "c": "2 answers to 1 prompts", "d": "not one JSON object", "e": "no text",
    }
    counts = {r.failure: r.sessions for r in ops.failure_counts(labels).collect()}
    assert len(counts) == 5 and set(counts.values()) == {1}


def counting_factory(log, fails=(), dies=()):
    """Logs every prompt it is asked; fails on some texts, and kills the job on others."""
    head, tail = SPEC.prompt_parts()

    def factory():
        def answer(prompts):
            asked = prompts[0][len(head) : len(prompts[0]) - len(tail)]
            if asked in dies:
                raise KeyboardInterrupt
            with open(log, "a") as f:
                f.write(asked + "\n")
            if asked in fails:
                raise RuntimeError("refused")
            return [json.dumps({"is_service": 1, "category": asked})]

        return answer

    return factory


def calls(log):
    return log.read_text().split() if log.exists() else []


def test_a_killed_job_pays_for_no_text_twice(spark, tmp_path):
    log, texts = tmp_path / "calls", texts_of(spark, [(f"s{i}", f"t{i % 40}") for i in range(120)])
    path = str(tmp_path / "log")

    def run(**options):
        label_log = LabelLog(spark, path)
        left = label_log.complete(texts, pending_path=str(tmp_path / "todo"), spec=SPEC, texts_per_round=8, **options)
        return label_log, left

    with pytest.raises(Exception):
        run(classifier_factory=counting_factory(str(log), fails={"t3"}, dies={"t7"}), max_parallel=1)
    before = LabelLog(spark, path).rows().count()
    done = {bytes(r.text_hash) for r in LabelLog(spark, path).rows().collect()}
    assert before < 40
    lost = len(calls(log)) - before  # of the round that died
    log.unlink(missing_ok=True)
    label_log, left = run(classifier_factory=counting_factory(str(log), fails={"t3"}), max_parallel=2)
    assert left == 0 and lost <= 8
    assert len(calls(log)) == 40 - before == len(set(calls(log)))
    assert done <= {bytes(r.text_hash) for r in label_log.rows().collect()} and label_log.rows().count() == 40
    log.unlink()
    assert run(classifier_factory=counting_factory(str(log)))[1] == 0 and calls(log) == []
    label_log, _ = run(classifier_factory=counting_factory(str(log)), retry_failed=True)
    assert calls(log) == ["t3"]
    labels = labelled(ops.attach_labels(texts, ops.parse_answers(label_log.latest(), SPEC), SPEC))
    assert labels == {f"s{i}": ("1", f"t{i % 40}", "ok") for i in range(120)}


def test_rounds_are_bounded_and_can_be_budgeted(spark, tmp_path):
    log, texts = tmp_path / "calls", texts_of(spark, [(f"s{i}", f"t{i}") for i in range(100)] + [("n", None)])
    label_log = LabelLog(spark, str(tmp_path / "log"))
    args = (texts, counting_factory(str(log)), SPEC, str(tmp_path / "todo"))
    left = label_log.complete(*args, texts_per_round=10, max_rounds=3)
    assert left == 7 and 10 <= len(calls(log)) < 60 and label_log.rows().count() == len(calls(log))
    assert label_log.complete(*args, texts_per_round=1000) == 0 and sorted(calls(log)) == sorted({f"t{i}" for i in range(100)})
