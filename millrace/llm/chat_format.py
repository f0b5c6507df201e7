"""Chat formatting by a finite-state machine over roles. DataFrame functions only.

The machine's state is the role just read, so its verdict on a turn needs only the turn before. The turns
of a conversation are sorted in one task, texts included, as they become one training text. A turn becomes
segments with a loss flag each. Inside roles and texts, ``<|`` gets a backslash between its characters
(and ``<\\|`` one more), so that control strings only occur where the template puts them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Template:
    """Control strings (each starting with ``<|``), the roles to learn from, and the machine.

    ``follows`` names the roles that may follow a role; the empty role is the start. A
    conversation may end after one of ``final``.
    """

    start: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    learn: tuple[str, ...] = ("assistant",)
    follows: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        if not all(c.startswith("<|") for c in (self.start, self.middle, self.end)):
            raise ValueError("control strings must start with <|")


CHAT = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _segment(text: Column, loss: Column | bool) -> Column:
    return F.struct(text.alias("text"), (loss if isinstance(loss, Column) else F.lit(loss)).alias("loss"))


def format_turns(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per turn: conv_id, position (from 0), role, allowed, last, segments (text, loss).

    Turns are in the order of turn, role and text, nulls first, so repeated or tied turns have
    a fixed order. A null role or text counts as empty; a null conv_id is a conversation. ``allowed`` is the machine's
    verdict on the turn, and for the last turn also on ending there. No turns give no rows. Other columns are ignored.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(
        F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")
    )
    numbered = (
        turns.withColumn("position", F.row_number().over(order) - 1)
        .withColumn("before", F.coalesce(F.lag("role").over(order), F.lit("")))
        .withColumn("last", F.lead("role").over(order).isNull())
    )
    allowed = F.lit(False)
    for state, roles in template.follows.items():
        # Only the first turn has no role before it; a turn with an empty role does not restart.
        here = (F.col("before") == state) & ((F.col("position") == 0) == F.lit(state == ""))
        allowed = allowed | (here & F.col("role").isin(*roles))
    ends = ~F.col("last") | F.col("role").isin(*template.final)
    segments = F.array(
        _segment(F.concat(F.lit(template.start), escape(F.col("role")), F.lit(template.middle)), False),
        _segment(escape(F.col("text")), F.col("role").isin(*template.learn)),
        _segment(F.lit(template.end), False),
    )
    return numbered.select(
        "conv_id", "position", "role", (allowed & ends).alias("allowed"), "last", segments.alias("segments")
    )


def assemble(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, valid, first_error (position or null), segments, formatted.

    A conversation is one training text, so here, and only here, its turns come together in one row.
    """
    whole = turns.groupBy("conv_id").agg(
        F.bool_and("allowed").alias("valid"),
        F.min(F.when(~F.col("allowed"), F.col("position"))).alias("first_error"),
        F.array_sort(F.collect_list(F.struct("position", "segments"))).alias("turns"),
    )
    segments = F.flatten(F.transform("turns", lambda t: t["segments"]))
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return whole.select("conv_id", "valid", "first_error", segments.alias("segments")).withColumn(
        "formatted", formatted
    )


def read_back(formatted: Column, template: Template = CHAT) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    pieces = F.split(formatted, rf"\Q{template.end}\E", -1)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(template.start) + 1), F.length(piece))
        role = F.substring_index(body, template.middle, 1)
        text = F.substring(body, F.length(role) + len(template.middle) + 1, F.length(body))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    learnt = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learnt, lambda s: unescape(s["text"])), "")
