"""Conversations as marked text with loss flags, by a declarative template.

A template gives each role its opening and closing mark and says whether its text is
learned from; a table of transitions says which turn may follow which. The turns of a
conversation run through that machine, and each becomes three segments: opening, text,
closing. Control strings inside a text are escaped: a backslash goes before the string,
and backslashes already there are doubled, so that reading back gives the text exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mark:
    """What stands before and after a turn, and whether its text counts in the loss."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, marks for the name and text of any other role, and turn order.

    ``order`` holds (state, role) pairs; the state after a turn is its role, the first one
    is "start". A conversation may end after a turn of a role in ``ends``.
    """

    marks: dict[str, Mark]
    other: Mark
    name_end: str
    order: tuple[tuple[str, str], ...]
    ends: tuple[str, ...]

    @property
    def control(self) -> list[str]:
        """Strings that mean something in the output, longest first."""
        marks = [*self.marks.values(), self.other]
        strings = {s for m in marks for s in (m.opening, m.closing)} | {self.name_end}
        return sorted(strings, key=lambda s: (-len(s), s))


INSTRUCT = Template(
    marks={
        "system": Mark("<<SYS>>", "<</SYS>>"),
        "user": Mark("[INST]", "[/INST]"),
        "assistant": Mark("<s>", "</s>", loss=True),
    },
    other=Mark("[ROLE]", "[/TURN]"),
    name_end="[/ROLE]",
    order=(
        ("start", "system"),
        ("start", "user"),
        ("system", "user"),
        ("user", "assistant"),
        ("assistant", "user"),
    ),
    ends=("assistant",),
)


def _any_of(strings: list[str]) -> str:
    return "(" + "|".join(re.sub(r"([\[\]/<>|().*+?^$\\{}])", r"\\\1", s) for s in strings) + ")"


def escaped(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, r"(?<!\\)(\\*+)" + _any_of(template.control), r"$1$1\\$2")


def unescaped(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, r"(?<!\\)(\\*)\1\\" + _any_of(template.control), "$1$2")


def _opening(role: Column, template: Template) -> Column:
    chosen = F.concat(
        F.lit(f"{template.other.opening} "), escaped(role, template), F.lit(f" {template.name_end} ")
    )
    for name, mark in template.marks.items():
        chosen = F.when(role == name, F.lit(f"{mark.opening} ")).otherwise(chosen)
    return chosen


def _closing(role: Column, template: Template) -> Column:
    chosen = F.lit(f" {template.other.closing}\n")
    for name, mark in template.marks.items():
        chosen = F.when(role == name, F.lit(f" {mark.closing}\n")).otherwise(chosen)
    return chosen


def _in_order(roles: Column, template: Template) -> Column:
    """Whether the machine accepts the roles; one step per turn."""

    def step(state: Column, role: Column) -> Column:
        allowed = F.lit(False)
        for before, after in template.order:
            allowed = allowed | ((state == before) & (role == after))
        return F.when(allowed, role).otherwise(F.lit("refused"))

    return F.aggregate(roles, F.lit("start"), step).isin(*template.ends)


def format_conversations(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """``conv_id, n_turns, in_order, formatted, segments`` of every conversation.

    ``conversations`` needs conv_id, turn, role and text; other columns are ignored. Turns
    go by turn (null first), then role and text, so ties have one order and repeated rows
    stay. A null text or role is empty; rows without conv_id are one conversation. Turn
    order is reported, not enforced. Segments are (text, loss) and joined are ``formatted``.
    """
    role = F.coalesce("role", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    turns = F.array_sort(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text"))))
    learned = [name for name, mark in template.marks.items() if mark.loss]

    def segments(turn: Column) -> Column:
        def plain(value: Column) -> Column:
            return F.struct(value.alias("text"), F.lit(False).alias("loss"))

        return F.array(
            plain(_opening(turn["role"], template)),
            F.struct(
                escaped(turn["text"], template).alias("text"),
                turn["role"].isin(learned).alias("loss"),
            ),
            plain(_closing(turn["role"], template)),
        )

    return (
        conversations.groupBy("conv_id")
        .agg(turns.alias("turns"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            _in_order(F.transform("turns", lambda t: t["role"]), template).alias("in_order"),
            F.flatten(F.transform("turns", segments)).alias("segments"),
        )
        .withColumn(
            "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
        )
    )


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    closings = [m.closing for m in [*template.marks.values(), template.other]]
    pieces = F.split(formatted, " " + _any_of(closings) + "\n", -1)
    opening, end = _any_of([template.other.opening]), _any_of([template.name_end])
    named = f"(?s)^{opening} (.*?) {end} (.*)$"

    def turn(piece: Column) -> Column:
        role, text = F.regexp_extract(piece, named, 2), F.regexp_extract(piece, named, 4)
        for name, mark in template.marks.items():
            own = piece.startswith(f"{mark.opening} ")
            role = F.when(own, F.lit(name)).otherwise(role)
            rest = F.substring(piece, F.lit(len(mark.opening) + 2), F.length(piece))
            text = F.when(own, rest).otherwise(text)
        return F.struct(
            unescaped(role, template).alias("role"), unescaped(text, template).alias("text")
        )

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def digest(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """What can be read back from formatted conversations."""
    turns = read_turns(F.col("formatted"), template)
    lines = F.transform(
        turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    learned = F.array_join(
        F.transform(
            F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template)
        ),
        "",
    )
    return formatted.select(
        "conv_id", "formatted", lines.alias("lines"), learned.alias("learned"), "in_order"
    ).select(
        "conv_id",
        F.size("lines").cast("long").alias("n_turns"),
        F.sha2(F.array_join("lines", ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "in_order",
    )
