from __future__ import annotations

from datetime import date, timedelta
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storewright.functions import periods, rates, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("today", "window"),
    [
        (date(2024, 3, 3), (date(2024, 2, 1), date(2024, 3, 2))),
        (date(2024, 3, 4), (date(2024, 3, 1), date(2024, 3, 3))),
        (date(2024, 1, 1), (date(2023, 12, 1), date(2023, 12, 31))),
    ],
)
def test_month_to_date(today, window):
    assert periods.month_to_date_window(today) == window


def test_previous_week():
    assert periods.previous_week_window(date(2024, 3, 13)) == (date(2024, 3, 4), date(2024, 3, 11))


def test_column_and_date_forms_agree(spark):
    first = date(2023, 11, 20)
    days = spark.createDataFrame([(first + timedelta(days=i),) for i in range(500)], "d date")
    rows = days.select("d", *periods.month_to_date_columns(F.col("d")), *periods.previous_week_columns(F.col("d")))
    for d, *window in (tuple(r) for r in rows.collect()):
        assert tuple(window) == (*periods.month_to_date_window(d), *periods.previous_week_window(d))


@pytest.mark.parametrize(
    ("part", "whole", "rate"), [(1, 4, 0.25), (0, 0, 0.0), (3, 0, 0.0), (None, 2, 0.0), (2, None, 0.0), (3, 2, 1.5)]
)
def test_safe_rate(spark, part, whole, rate):
    p, w = F.lit(part).cast("bigint"), F.lit(whole).cast("bigint")
    assert value(spark, rates.safe_rate(p, w)) == rate


def test_rate_of_sums_needs_a_positive_denominator(spark):
    assert value(spark, rates.rate_of_sums(F.lit(1), F.lit(-2))) == 0.0
    assert value(spark, rates.rate_of_sums(F.lit(1), F.lit(8))) == 0.125


@pytest.mark.parametrize(
    ("rate", "shown"), [(0.0, "0.0%"), (0.1225, "12.3%"), (1.0, "100.0%"), (12.345, "1234.5%"), (0.00049, "0.0%")]
)
def test_percent_text(spark, rate, shown):
    assert value(spark, rates.percent_text(F.lit(rate))) == shown


def test_round_half_even(spark):
    assert [value(spark, rates.round_half_even(F.lit(x))) for x in (0.125, 0.375, 0.126)] == [0.12, 0.38, 0.13]


def test_mojibake(spark):
    rows = [("自营".encode("gbk").decode("latin-1"),), (None,), ("自营",), ("plain",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.t for r in df.select(text.repair_mojibake(F.col("t")).alias("t")).collect()]
    assert got == ["自营", None, "自营", "plain"]
    with pytest.raises(Exception, match="latin-1"):
        df.select(text.repair_mojibake(F.col("t"), on_error="raise")).collect()
    with pytest.raises(ValueError):
        text.repair_mojibake(F.col("t"), on_error="ignore")


TRANSCRIPT = "Ann 2023-05-01 10:00:00\ncoupon fails\nBOT 2023-05-01 10:00:05\nhello"


@pytest.mark.parametrize(
    ("mode", "transcript", "cleaned"),
    [
        ("lines", TRANSCRIPT, "Ann 2023-05-01 10:00:00\ncoupon fails\nhello"),
        ("strip_headers", TRANSCRIPT, "coupon fails\nhello"),
        ("lines", " BOT 1\nBOT", " BOT 1"),
        ("lines", "a\n\nb\n", "a\n\nb\n"),
        ("lines", "", ""),
        ("lines", "BOT", ""),
        ("lines", None, None),
        ("strip_headers", "at 2023-05-01 10:00:00 sharp", "at 2023-05-01 10:00:00 sharp"),
    ],
)
def test_clean_transcript(spark, mode, transcript, cleaned):
    assert value(spark, text.clean_transcript(F.lit(transcript).cast("string"), "BOT", mode)) == cleaned


def test_clean_transcript_rejects_unknown_mode():
    with pytest.raises(ValueError):
        text.clean_transcript(F.lit("x"), "BOT", "words")


def test_codes_and_numbers(spark):
    assert value(spark, text.clean_code(F.lit("''S1"))) == "S1"
    assert value(spark, text.clean_code(F.lit("'S'1"))) == "'S'1"
    assert value(spark, text.clean_code(F.lit(7))) == "7"
    assert value(spark, text.page_number(F.lit("http://x/list?a=1&page=12"))) == 12
    assert value(spark, text.page_number(F.lit("http://x/list"))) is None
    assert value(spark, text.strip_leading_newlines(F.lit("\n\n a\n"))) == " a\n"
    assert value(spark, text.trim_blanks(F.lit("  a\t "))) == "a\t"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=20), min_size=1, max_size=50))
def test_quote_url_equals_the_standard_encoding(spark, titles):
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = [r.q for r in df.select(text.quote_url(F.col("t")).alias("q")).collect()]
    assert got == [quote(t) for t in titles]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from("BOT ab\n:1-"), max_size=40), min_size=1, max_size=50))
def test_clean_transcript_equals_a_line_loop(spark, transcripts):
    df = spark.createDataFrame([(t,) for t in transcripts], "t string")
    got = [r.c for r in df.select(text.clean_transcript(F.col("t"), "BOT").alias("c")).collect()]
    assert got == ["\n".join(x for x in t.split("\n") if not x.startswith("BOT")) for t in transcripts]
