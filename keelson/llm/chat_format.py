"""Chat formatting (native): role machine, declarative template, segments with loss flags.

A conversation's turns are ordered and joined into one training text. Every turn is
``open + escaped text + close``; which control strings open a role's turn and whether its
text is trained on comes from the ``Template`` alone. Control strings inside texts (and
role names) are made harmless by one backslash after their first character, and one more
for each that already stands there, so unescaping restores every text exactly.

The turn order is checked by a finite-state machine over roles, folded over the turns with
SQL's ``aggregate``: it reports the first turn that has no transition. Invalid
conversations are formatted as well and marked; a caller filters on ``valid``.

Defined results: NULL text counts as empty; a NULL role as the empty name; roles without
an own opening are written as ``[ROLE]name[/ROLE]``; rows with equal turn numbers stand in
the order of (turn, role, text), NULL turn first; repeated rows are repeated turns; rows
with NULL conv_id form one conversation. An empty table gives an empty result. Extra
columns are ignored. A conversation is one output text, so it has to fit in one row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    opens: tuple[tuple[str, str], ...] = (
        ("system", "<s>[SYS] "), ("user", "<s>[INST] "), ("assistant", "[/INST] "))
    named_open: tuple[str, str] = ("[ROLE]", "[/ROLE] ")  # for any other role
    close: str = "</s>"
    trained: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = ("<s>", "</s>", "[SYS]", "[INST]", "[/INST]", "[ROLE]",
                                 "[/ROLE]")
    #: state -> {role: next state}; the machine starts in "start" and may end in "accept".
    machine: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "primed"), ("start", "user", "asked"),
        ("primed", "user", "asked"), ("asked", "assistant", "answered"),
        ("answered", "user", "asked"))
    accept: tuple[str, ...] = ("answered",)


DEFAULT_TEMPLATE = Template()


def _groups(t: Template, slashes: str) -> str:
    heads = "".join(sorted({re.escape(c[0]) for c in t.controls}))
    rests = "|".join(re.escape(c[1:]) for c in t.controls)
    return f"([{heads}]){slashes}({rests})"


def escape(text: Column, t: Template = DEFAULT_TEMPLATE) -> Column:
    return F.regexp_replace(text, _groups(t, r"(\\*)"), r"$1\\$2$3")


def unescape(text: Column, t: Template = DEFAULT_TEMPLATE) -> Column:
    return F.regexp_replace(text, _groups(t, r"\\(\\*)"), r"$1$2$3")


def _open(role: Column, t: Template) -> Column:
    known = None
    for name, control in t.opens:
        hit = role == name
        known = F.when(hit, control) if known is None else known.when(hit, control)
    named = F.concat(F.lit(t.named_open[0]), escape(role, t), F.lit(t.named_open[1]))
    return known.otherwise(named) if known is not None else named


def _steps(t: Template) -> Column:
    keys = [F.lit(f"{state}\n{role}") for state, role, _ in t.machine]
    ends = [F.lit(to) for _, _, to in t.machine]
    return F.map_from_arrays(F.array(*keys), F.array(*ends))


def format_chats(rows: DataFrame, t: Template = DEFAULT_TEMPLATE, conv: str = "conv_id",
                 turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, segments, formatted, valid, first_bad_turn): one row per conversation.

    ``segments`` is an array of (text, loss); joined they are ``formatted``.
    ``first_bad_turn`` is the 1-based place of the first turn without a transition.
    """
    turns = (rows.select(F.col(conv).alias("conv_id"),
                         F.struct(F.col(turn).alias("turn"),
                                  F.coalesce(F.col(role), F.lit("")).alias("role"),
                                  F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    segment = lambda s, loss: F.struct(s.alias("text"), loss.alias("loss"))
    never = F.lit(False)
    segments = F.flatten(F.transform("turns", lambda x: F.array(
        segment(_open(x["role"], t), never),
        segment(escape(x["text"], t), x["role"].isin(*t.trained)),
        segment(F.lit(t.close), never))))
    steps = _steps(t)
    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("seen"), F.lit(0).alias("bad"))
    walked = F.aggregate(
        "turns", start,
        lambda acc, x: F.struct(
            F.coalesce(F.try_element_at(steps, F.concat(acc["state"], F.lit("\n"), x["role"])),
                       F.lit("lost")).alias("state"),
            (acc["seen"] + 1).alias("seen"),
            F.when((acc["bad"] == 0) & F.try_element_at(
                steps, F.concat(acc["state"], F.lit("\n"), x["role"])).isNull(),
                acc["seen"] + 1).otherwise(acc["bad"]).alias("bad")))
    out = turns.select("conv_id", segments.alias("segments"), walked.alias("walk"))
    return out.select(
        "conv_id", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.col("walk.state").isin(*t.accept).alias("valid"),
        F.nullif(F.col("walk.bad"), F.lit(0)).alias("first_bad_turn"))


def read_turns(formatted: Column, t: Template = DEFAULT_TEMPLATE) -> Column:
    """The turns (role, text) of a formatted text: the inverse of ``format_chats``."""
    parts = F.filter(F.split(formatted, re.escape(t.close), -1), lambda p: p != "")
    head, tail = t.named_open

    def turn(part: Column) -> Column:
        role, rest = None, None
        for name, control in t.opens:
            hit = part.startswith(control)
            body = F.substring(part, F.lit(len(control) + 1), F.length(part))
            role = F.when(hit, name) if role is None else role.when(hit, name)
            rest = F.when(hit, body) if rest is None else rest.when(hit, body)
        at = F.instr(part, F.lit(tail))
        named = F.substring(part, F.lit(len(head) + 1), at - len(head) - 1)
        role = role.otherwise(unescape(named, t))
        rest = rest.otherwise(F.substring(part, at + len(tail), F.length(part)))
        return F.struct(role.alias("role"), unescape(rest, t).alias("text"))

    return F.transform(parts, turn)


def read_trained(segments: Column, t: Template = DEFAULT_TEMPLATE) -> Column:
    """The text under the loss mask, unescaped, in order."""
    own = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(own, lambda s: unescape(s["text"], t)), "")
