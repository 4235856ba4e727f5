"""Chat formatting by a finite-state machine over roles, in DataFrame functions alone.

A ``Template`` declares the control strings, the roles that may follow each
role, and the roles whose text is trained on.  ``segments`` turns conversations
into text segments with a loss flag each: an opening mark, the turn's escaped
text, a closing mark.  The state of the machine after a turn is its role, so a
turn is in order if its role may follow the role before it; turns are numbered
and linked to the turn before by an equi-join, not by a window over a whole
conversation, so one very long conversation spreads like any other rows.

Escaping makes every control string inside a text or role harmless and is
reversible: a backslash is doubled, and a control string gets one backslash
behind its first character.  Control strings begin with ``<`` or ``[``, which
occur nowhere else in one, so no text can complete a mark next to it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut_lineage
from kestrel.plans.ordered import running

START = ""


@dataclass(frozen=True)
class Template:
    """Marks around role and text, roles that may follow (``START``: at the beginning), roles under the loss."""

    open: str = "<|turn|>"
    middle: str = "<|text|>"
    close: str = "<|end|>"
    also_escaped: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
    follows: dict = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if not all(re.fullmatch(r"[<\[][^<\[\\]+", c) for c in self.controls):
            raise ValueError("a control string is < or [ and then other characters without <, [ and backslash")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.middle, self.close, *self.also_escaped)

    def escape(self, text: Column) -> Column:
        strings = "|".join(re.escape(c[1:]) for c in sorted(set(self.controls), key=len, reverse=True))
        doubled = F.regexp_replace(text, r"\\", r"\\\\")
        return F.regexp_replace(doubled, rf"(?<=[<\[])(?={strings})", r"\\")

    @staticmethod
    def unescape(text: Column) -> Column:
        return F.regexp_replace(text, r"\\(\\?)", "$1")

    def in_order(self, before: Column, role: Column) -> Column:
        ok = F.lit(False)
        for b, roles in self.follows.items():
            ok = ok | ((before == b) & role.isin(*roles))
        return ok


def segments(turns: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv_id, position, part, role, segment, loss, in_order): three segments a turn, parts 0, 1, 2 in text order.

    Turns are ordered by turn (null first), then role and text, and numbered from
    1; repeated rows are turns of their own.  A null text or role is empty.  A
    null conversation id is a conversation.  ``loss`` marks the text (part 1) of
    trained roles; ``in_order`` tells whether the machine accepts the turn.
    """
    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # a null conversation gets a key of its own, which joins
    keyed = rows.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    numbered = cut_lineage(running(keyed, ["conv"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], rank_col="position"))
    last = numbered.select("conv", (F.col("position") + 1).alias("position"), F.col("role").alias("before"))
    linked = numbered.join(last, ["conv", "position"], "left")
    role = F.col("role")
    before = F.coalesce("before", F.lit(START))
    parts = F.array(
        F.struct(F.lit(0).alias("part"), F.concat(F.lit(template.open), template.escape(role), F.lit(template.middle)).alias("segment"), F.lit(False).alias("loss")),
        F.struct(F.lit(1).alias("part"), template.escape(F.col("text")).alias("segment"), role.isin(*template.trained).alias("loss")),
        F.struct(F.lit(2).alias("part"), F.lit(template.close).alias("segment"), F.lit(False).alias("loss")))
    return linked.select("conv_id", F.col("position").cast("long").alias("position"), "role", template.in_order(before, role).alias("in_order"),
                         F.inline(parts)).select("conv_id", "position", "part", "role", "segment", "loss", "in_order")


def render(parts: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans, loss_segments, valid) per conversation from ``segments``.

    ``loss_spans`` lists (start, size) in code points of the trained stretches,
    ``loss_segments`` those stretches as they stand in ``formatted``.  A
    conversation is one row here, which is what a formatted conversation is.
    """
    whole = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("position", "part", "segment", "loss"))).alias("s"), F.min("in_order").alias("valid"))
    spans = F.aggregate("s", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,size:int>>").alias("spans")), lambda a, x: F.struct(
        (a["at"] + F.length(x["segment"])).alias("at"),
        F.when(x["loss"], F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), F.length(x["segment"]).alias("size"))))).otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    return whole.select("conv_id", F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("formatted"), spans.alias("loss_spans"),
                        F.transform(F.filter("s", lambda x: x["loss"]), lambda x: x["segment"]).alias("loss_segments"), "valid")


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Adds ``turns`` (role, text) and ``trained`` (what ``loss_spans`` mark of ``formatted``), unescaped, read from the output of ``render``."""
    cut = F.filter(F.split("formatted", re.escape(template.open)), lambda x: x != "")
    turn = F.transform(cut, lambda x: F.struct(
        template.unescape(F.substring_index(x, template.middle, 1)).alias("role"),
        template.unescape(F.substring_index(F.substring_index(x, template.middle, -1), template.close, 1)).alias("text")))
    trained = F.transform("loss_spans", lambda s: template.unescape(F.substring(F.col("formatted"), s["start"] + 1, s["size"])))
    return formatted.withColumn("turns", turn).withColumn("trained", trained)
