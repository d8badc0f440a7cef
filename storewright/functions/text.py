"""Text repair, transcript cleaning, codes and URLs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# A "name timestamp" line is told by its end.
HEADER_LINE = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def repair_mojibake(text: Column, on_error: str = "keep") -> Column:
    """Undo GBK bytes that were read as Latin-1. NULL stays NULL.

    ``keep`` leaves text that is not such a misreading (already proper Chinese)
    unchanged; ``raise`` fails the task. An Arrow UDF because the built-in
    charset list of ``decode`` has no GBK unless a session-wide legacy switch
    is set. Apply it to dimension columns, not to the purchase table.
    """
    if on_error not in ("keep", "raise"):
        raise ValueError(f"on_error must be 'keep' or 'raise', not {on_error!r}")

    def repaired(value):
        if value is None:
            return None
        try:
            return value.encode("latin-1").decode("gbk")
        except UnicodeError:
            if on_error == "raise":
                raise
            return value

    @F.pandas_udf("string")
    def repair(batch: pd.Series) -> pd.Series:
        return batch.map(repaired)

    return repair(text)


def clean_transcript(transcript: Column, bot: str, mode: str = "lines") -> Column:
    """Drop the lines that start with the bot's name, and with them its messages' headers.

    ``lines`` keeps everything else, including continuation lines of a bot
    message. ``strip_headers`` also drops lines that are only "name timestamp".
    """
    if mode not in ("lines", "strip_headers"):
        raise ValueError(f"mode must be 'lines' or 'strip_headers', not {mode!r}")
    lines = F.filter(F.split(transcript, "\n"), lambda line: ~line.startswith(bot))
    if mode == "strip_headers":
        lines = F.filter(lines, lambda line: ~line.rlike(HEADER_LINE))
    return F.array_join(lines, "\n")


def clean_code(code: Column) -> Column:
    """Store code as text without pairs of single quotes."""
    return F.replace(code.cast("string"), F.lit("''"), F.lit(""))


def trim_blanks(text: Column) -> Column:
    """Strip spaces at both ends; tabs and newlines stay."""
    return F.trim(text)


def strip_leading_newlines(text: Column) -> Column:
    return F.ltrim(text, F.lit("\n"))


def quote_url(text: Column) -> Column:
    """Percent-encoding for a query value; ``/`` and ``~`` stay and a blank becomes ``%20``."""
    encoded = F.url_encode(text)
    for form, plain in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(form), F.lit(plain))
    return encoded


def page_number(url: Column) -> Column:
    """Number after the last ``=`` of a URL; NULL when that is not a number."""
    return F.substring_index(url, "=", -1).try_cast("int")
