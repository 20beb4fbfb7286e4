"""Chat formatting (operator 5): a role automaton and a declarative template.

``format_chats`` turns the rows of each conversation into one training string.
A finite-state machine over the roles, declared as a transition table in the
template, validates the turn order; an escape makes control strings that occur
in the texts harmless and can be undone; and the output carries text segments
with a loss flag each, so a trainer masks everything but the assistant's words.

Defined results
    * null text counts as empty, null role as the empty role;
    * turns are ordered by (turn, role, text), nulls first, so ties and repeated
      rows give the same string in every run; every row is kept;
    * roles that the template does not name get the generic frame and make the
      conversation invalid; invalid conversations are formatted too, with
      ``valid`` false and ``bad_turn`` the 0-based position of the first fault;
    * each row with a null ``conv_id`` is a conversation of its own (they belong to
      no common one, and may be many); an empty table gives no rows; extra columns
      are ignored; a conversation of many or very long turns takes time in
      proportion to its length.

A conversation is one training example and is gathered by its id; that is the
only shuffle.  Everything is built-in SQL functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, let, running


@dataclass(frozen=True)
class Template:
    """Frames by role and the role automaton; every frame string is a control string."""

    bos: str = "<s>"
    frames: dict = field(default_factory=lambda: {
        "system": ("[SYS]", "[/SYS]"),
        "user": ("[INST]", "[/INST]"),
        "assistant": ("[REPLY]", "</s>"),
    })
    #: Open, between role and text, close: for roles without a frame.
    generic: tuple = ("[ROLE]", "[/ROLE]", "[/TURN]")
    loss_roles: tuple = ("assistant",)
    start: str = "start"
    #: state -> {role: next state}; a missing entry is a fault.
    transitions: dict = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    accepting: tuple = ("assistant",)

    def controls(self) -> list[str]:
        found = [self.bos, *(s for pair in self.frames.values() for s in pair), *self.generic]
        if any(len(c) < 2 or c[0] not in "<[" or re.search(r"[<\[\\]", c[1:]) for c in found):
            raise ValueError("a control string starts with < or [, and has no further <, [ or backslash")
        return found

    def _tails(self, first: str) -> str:
        return "|".join(sorted({re.escape(c[1:]) for c in self.controls() if c[0] == first}))

    def escape(self, text: Column) -> Column:
        """One more backslash after the first character of each (escaped) control string."""
        return self._shift(text, r"(\\*)", r"\\$1")

    def unescape(self, text: Column) -> Column:
        return self._shift(text, r"\\(\\*)", "$1")

    def _shift(self, text: Column, slashes: str, by: str) -> Column:
        for first in "<[":
            if tails := self._tails(first):
                text = F.regexp_replace(text, f"{re.escape(first)}{slashes}({tails})", f"{first}{by}$2")
        return text

    def split_pattern(self) -> str:
        """Zero-width: before every control string."""
        return "(?=" + "|".join(sorted(re.escape(c) for c in self.controls())) + ")"


def _segments(turn: Column, t: Template) -> Column:
    """array<struct<text, loss>> of one turn."""

    def seg(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    body = t.escape(turn["text"])
    out = F.array(seg(F.lit(t.generic[0]), False), seg(t.escape(turn["role"]), False), seg(F.lit(t.generic[1]), False),
                  seg(body, False), seg(F.lit(t.generic[2]), False))
    for role, (before, after) in t.frames.items():
        out = F.when(turn["role"] == role, F.array(seg(F.lit(before), False), seg(body, role in t.loss_roles),
                                                   seg(F.lit(after), False))).otherwise(out)
    return out


def format_chats(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments, valid, bad_turn.

    ``segments`` is array<struct<start, length, loss>> over the code points of
    ``formatted``, gapless from 0.
    """
    t = template or Template()
    rows = conversations.select("conv_id", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("alone"), F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("said"))
    turns = rows.groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    table = F.create_map(*(F.lit(x) for s, to in t.transitions.items() for r, n in to.items() for x in (f"{s}\n{r}", n)))
    # state: the automaton's state, or empty after a fault; at: turns read before it
    walked = F.aggregate(
        "turns", F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("at")),
        lambda a, x: F.when(a["state"] == "", a).otherwise(F.struct(
            F.coalesce(F.element_at(table, F.concat(a["state"], F.lit("\n"), x["role"])), F.lit("")).alias("state"),
            (a["at"] + 1).alias("at"))))
    parts = F.flatten(F.transform("turns", lambda x: _segments(x, t)))
    parts = F.concat(F.array(F.struct(F.lit(t.bos).alias("text"), F.lit(False).alias("loss"))), parts)
    lengths = F.transform("parts", lambda x: F.char_length(x["text"]))
    placed = let(running(lengths), lambda start: F.transform("parts", lambda x, i: F.struct(
        F.get(start, i).alias("start"), F.char_length(x["text"]).alias("length"), x["loss"].alias("loss"))))
    return (
        turns.select("conv_id", walked.alias("walked"), parts.alias("parts"))
        .select(
            "conv_id",
            F.array_join(F.transform("parts", lambda x: x["text"]), "").alias("formatted"),
            placed.alias("segments"),
            F.col("walked.state").isin(*t.accepting).alias("valid"),
            F.when(F.col("walked.state") == "", F.col("walked.at") - 1).alias("bad_turn"),
        )
    )


def parse_chats(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Read ``format_chats`` output back: conv_id, turns (array<struct<role, text>>), loss_text.

    Uses the formatted string and the loss segments alone.
    """
    t = template or Template()
    piece = F.filter(F.split("formatted", t.split_pattern(), -1), lambda p: p != "")

    def turn(p: Column, i: Column, pieces: Column) -> Column:
        name = F.lit(None).cast("string")
        body = F.lit(None).cast("string")
        for r, (before, _) in t.frames.items():
            name = F.when(p.startswith(before), F.lit(r)).otherwise(name)
            body = F.when(p.startswith(before), F.substr(p, F.lit(len(before) + 1))).otherwise(body)
        # the generic frame: the role stands in the piece before the one that holds the text
        head = F.element_at(pieces, F.greatest(i, F.lit(1)))
        name = F.when(p.startswith(t.generic[1]), t.unescape(F.substr(head, F.lit(len(t.generic[0]) + 1)))).otherwise(name)
        body = F.when(p.startswith(t.generic[1]), F.substr(p, F.lit(len(t.generic[1]) + 1))).otherwise(body)
        return F.struct(name.alias("role"), t.unescape(body).alias("text"))

    turns = F.filter(F.transform("pieces", lambda p, i: turn(p, i, F.col("pieces"))), lambda x: x["text"].isNotNull())
    # blocks of segments are cut out first: a place in a long string is found by counting from its beginning
    def cut(block: Column) -> Column:
        begin, last = F.get(block, 0)["start"], F.element_at(block, -1)
        return let(F.substring(F.col("formatted"), begin + 1, last["start"] + last["length"] - begin), lambda text: F.transform(
            F.filter(block, lambda s: s["loss"]), lambda s: t.unescape(F.substring(text, s["start"] - begin + 1, s["length"]))))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("segments") - 1) / BLOCK).cast("int")),
                         lambda b: F.slice("segments", b * BLOCK + 1, F.lit(BLOCK)))
    masked = F.flatten(F.transform(blocks, cut))
    return formatted.withColumn("pieces", piece).select(
        "conv_id", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
