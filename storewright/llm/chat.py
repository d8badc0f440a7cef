"""Chat formatting: a finite-state machine over roles and a declarative template, built-in functions only.

A conversation becomes one string. Its segments carry a loss flag each; the
concatenated segment texts are the formatted string. Control strings inside
roles and texts are escaped and can be restored exactly, so a hostile text
cannot end its turn.

Defined results: a null role or text counts as empty; rows of one conversation
are ordered by (turn, role, text), nulls first; repeated rows are kept; rows
with a null id form one conversation; an empty table gives an empty result.
Columns beyond the four named ones are ignored. The output of a conversation
is one string by definition, so one conversation has to fit into a task; the
turns are escaped before they are shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """How a turn is written, which roles are learned, which role may follow which."""

    start: str = "<|im_start|>"
    separator: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    control_head: str = "<|"  # every control string begins with it; an escaped text never holds it
    loss_roles: tuple[str, ...] = ("assistant",)
    initial: str = "begin"
    transitions: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "begin": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    accepting: tuple[str, ...] = ("assistant",)
    rejected: str = "rejected"


def escape(value: Column, template: ChatTemplate) -> Column:
    head = template.control_head
    doubled = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit(head), F.lit(f"{head[0]}\\{head[1:]}"))


def unescape(value: Column) -> Column:
    return F.regexp_replace(value, r"(?s)\\(.)", "$1")


def final_state(roles: Column, template: ChatTemplate) -> Column:
    """State after the last role; a role that may not follow leads to the rejected state for good."""
    pairs = [f"{state}\n{role}" for state, allowed in template.transitions.items() for role in allowed]

    def step(state: Column, role: Column) -> Column:
        move = F.concat(state, F.lit("\n"), role)
        return F.when(move.isin(pairs), role).otherwise(F.lit(template.rejected))

    return F.aggregate(roles, F.lit(template.initial), step)


def format_conversations(rows: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """conv_id, n_turns, state, valid, segments array<struct<text, loss>>, formatted."""
    t = template or ChatTemplate()
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = rows.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"), role.alias("role"), escape(text, t).alias("text")
        ).alias("one"),
    )
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))

    def segments(one: Column) -> Column:
        opening = F.concat(F.lit(t.start), escape(one["role"], t), F.lit(t.separator))
        return F.array(
            F.struct(opening.alias("text"), F.lit(False).alias("loss")),
            F.struct(one["text"].alias("text"), one["role"].isin(*t.loss_roles).alias("loss")),
            F.struct(F.lit(t.end).alias("text"), F.lit(False).alias("loss")),
        )

    state = final_state(F.transform("turns", lambda x: x["role"]), t)
    return (
        gathered.select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            state.alias("state"),
            F.flatten(F.transform("turns", segments)).alias("segments"),
        )
        .withColumn("valid", F.col("state").isin(*t.accepting))
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    )


def read_turns(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """The turns of a formatted string: array<struct<role, text>>."""
    t = template or ChatTemplate()
    parts = F.split(formatted, re.escape(t.start), -1)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, t.separator, 1)
        body = F.substr(part, F.length(role) + F.lit(len(t.separator) + 1))
        text = F.substr(body, F.lit(1), F.length(body) - F.lit(len(t.end)))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask as it was before escaping, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digests(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation, computed from the formatted output alone."""
    turns = read_turns(F.col("formatted"), template)
    told = F.array_join(
        F.transform(turns, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""
    )
    learned = loss_text(F.col("segments"))
    return formatted.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "state",
        "valid",
    )
