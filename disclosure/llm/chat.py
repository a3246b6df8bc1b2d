"""Chat formatting, in DataFrame operations only.

A finite-state machine over roles checks the order of turns, and a declarative template turns
every conversation into text segments, each with a loss flag. Control strings of the template
that occur inside a text are escaped by one backslash after their first character (already
escaped ones get one more), so the output never holds a control string that the template didn't
put there and the texts can be read back from it.

Defined cases: a null text or role is empty; a role that the template doesn't name is written as
a named turn, without loss; turns of one conversation go by turn (null first), then role, then
text, so rows in any order, and repeated rows, give one result; conversations that break the
turn order are formatted like the others and flagged; a null ``conv_id`` is a conversation of its
own; an empty table gives no rows. A conversation is one row of the result, so its turns meet in
one task; everything else is split by conversation. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How a role's turn is written: ``before`` + text + ``after``, and whether the text is learned."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Turns by role, the pieces around any other role's name, and the allowed role changes.

    ``moves`` maps a state to the roles that may come next; the state after a turn is its role.
    Every control string starts with ``<`` or ``[`` and holds neither anywhere else, so that no
    two of them overlap.
    """

    turns: dict[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("[SYS] ", " [/SYS]"),
            "user": Turn("[INST] ", " [/INST]"),
            "assistant": Turn("<s> ", "</s>", loss=True),
        }
    )
    role_before: str = "[ROLE] "
    other: Turn = Turn(" [/ROLE] ", "[END]")
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("user", "assistant")

    def controls(self) -> list[str]:
        pieces = [self.role_before, self.other.before, self.other.after]
        pieces += [p for t in self.turns.values() for p in (t.before, t.after)]
        found = sorted({p.strip() for p in pieces})
        if any(not re.fullmatch(r"[<\[][^<\[\\]+", c) for c in found):
            raise ValueError(f"Control strings start with < or [ and hold neither again: {found}")
        return found


DEFAULT = Template()


def _pattern(template: Template, escapes: str) -> str:
    tails = "|".join(re.escape(c[1:]) for c in template.controls())
    return rf"([<\[]){escapes}({tails})"


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    return F.regexp_replace(text, F.lit(_pattern(template, r"(\\*)")), F.lit(r"$1\\$2$3"))


def unescaped(text: Column, template: Template = DEFAULT) -> Column:
    return F.regexp_replace(text, F.lit(_pattern(template, r"\\(\\*)")), F.lit("$1$2$3"))


def conversations(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``conv_id`` and ``turns``: the conversation's (turn, role, text) in order."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def check_order(turns: Column, template: Template = DEFAULT) -> Column:
    """Runs the state machine: struct of ``valid`` and ``bad_turn`` (0-based place of the first
    turn out of order, the number of turns if the last state isn't final, null if valid)."""
    allowed = [F.lit(f"{state}\n{role}") for state, roles in template.moves.items() for role in roles]
    start = F.struct(
        F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad")
    )

    def step(acc: Column, turn: Column) -> Column:
        move = F.concat(acc["state"], F.lit("\n"), turn["role"])
        return F.struct(
            turn["role"].alias("state"),
            (acc["at"] + 1).alias("at"),
            F.coalesce(acc["bad"], F.when(~move.isin(allowed), acc["at"])).alias("bad"),
        )

    def finish(acc: Column) -> Column:
        bad = F.coalesce(acc["bad"], F.when(~acc["state"].isin(list(template.final)), acc["at"]))
        return F.struct(bad.isNull().alias("valid"), bad.alias("bad_turn"))

    return F.aggregate(turns, start, step, finish)


def _segments(turn: Column, template: Template) -> Column:
    def piece(text, loss: bool) -> Column:
        return F.struct((F.lit(text) if isinstance(text, str) else text).alias("text"), F.lit(loss).alias("loss"))

    text = escaped(turn["text"], template)
    out = F.array(
        piece(template.role_before, False),
        piece(escaped(turn["role"], template), False),
        piece(template.other.before, False),
        piece(text, template.other.loss),
        piece(template.other.after, False),
    )
    for role, kind in template.turns.items():
        out = F.when(
            turn["role"] == role, F.array(piece(kind.before, False), piece(text, kind.loss), piece(kind.after, False))
        ).otherwise(out)
    return out


def format_conversations(convs: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """``conv_id, valid, bad_turn, segments, formatted`` from :func:`conversations`.

    ``segments`` is an array of (text, loss); ``formatted`` is their concatenation.
    """
    segments = F.flatten(F.transform("turns", lambda t: _segments(t, template)))
    return convs.select(
        "conv_id", check_order(F.col("turns"), template).alias("order"), segments.alias("segments")
    ).select(
        "conv_id",
        "order.valid",
        "order.bad_turn",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_back(formatted: Column, template: Template = DEFAULT) -> Column:
    """The (role, text) turns that a formatted conversation was made from."""
    other = template.other
    kinds = [(k.before, k.after) for k in template.turns.values()] + [(template.role_before, other.after)]
    pattern = "(?s)" + "|".join(f"{re.escape(a)}.*?{re.escape(b)}" for a, b in kinds)
    parts = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0))

    def between(part: Column, before: str, after: str) -> Column:
        return F.substr(part, F.lit(len(before) + 1), F.length(part) - len(before) - len(after))

    def turn(role: Column, text: Column) -> Column:
        return F.struct(unescaped(role, template).alias("role"), unescaped(text, template).alias("text"))

    def parse(part: Column) -> Column:
        inner = between(part, template.role_before, other.after)
        at = F.instr(inner, other.before)
        out = turn(
            F.substr(inner, F.lit(1), at - 1), F.substr(inner, at + len(other.before), F.length(inner))
        )
        for role, kind in template.turns.items():
            out = F.when(
                F.startswith(part, F.lit(kind.before)), turn(F.lit(role), between(part, kind.before, kind.after))
            ).otherwise(out)
        return out

    return F.transform(parts, parse)


def digests(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """What the formatted output says when read back, by conversation.

    ``conv_id, n_turns, turns_sha256`` (role, newline, text, newline per turn), ``loss_chars``
    and ``loss_sha256`` (all text under the loss mask, unescaped), ``formatted_chars``,
    ``valid``, ``bad_turn``.
    """
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        formatted.withColumn("turns", read_back(F.col("formatted"), template))
        .withColumn("learned", F.array_join(learned, ""))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
            F.length("learned").cast("long").alias("loss_chars"),
            F.sha2("learned", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
            "bad_turn",
        )
    )
