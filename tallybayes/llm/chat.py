"""Chat formatting with a role state machine and per-segment loss flags (native).

A declarative ``Template`` names the control strings around each role's text and
the roles that are trained on.  ``format_conversations`` sorts a conversation's
turns, runs the state machine over their roles, and emits the segments
(text, loss) whose concatenation is the formatted conversation.

Escaping: inside texts every control string gets one more backslash after its
first character ('</s>' becomes '<\\/s>', '<\\/s>' becomes '<\\\\/s>'), and reading
back takes one away, so formatted text holds a control string only where the
template put it and any text is restored exactly.

State machine: a system turn may come first only; then user and assistant turns
alternate, beginning with user and ending with assistant.  ``valid`` tells whether a
conversation keeps to it, ``bad_turn`` the first turn (from 0) that doesn't (the number of
turns if it ends too early).  Invalid conversations are formatted as well.

Defined cases: a null text is empty; a null role or one that the template doesn't
know is written by name between ``other`` strings (a null as an empty
name) and is never trained on; rows of equal turn are ordered by role and text,
a null turn first; repeated rows are turns of their own; rows without a conv_id
form one conversation; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    begin: str = "<s>"
    #: role -> (before the text, after the text, trained on)
    roles: dict = field(default_factory=lambda: {
        "system": ("[SYS]", "[/SYS]", False),
        "user": ("[INST]", "[/INST]", False),
        "assistant": ("[ANS]", "</s>", True),
    })
    #: around another role's name, and after its text
    other: tuple = ("[ROLE]", "[/ROLE]", "[/TURN]")

    def controls(self) -> list[str]:
        found = {self.begin, *self.other}
        for before, after, _ in self.roles.values():
            found |= {before, after}
        return sorted(found)


#: (state, role) -> state; missing: not allowed.  A conversation may end in state "answered".
TRANSITIONS = {
    ("start", "system"): "told", ("start", "user"): "asked", ("told", "user"): "asked",
    ("asked", "assistant"): "answered", ("answered", "user"): "asked",
}


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|/" else c for c in s)


def _pattern(controls: list[str], slashes: str) -> str:
    """The control strings with ``slashes`` after their first character."""
    heads: dict[str, list[str]] = {}
    for c in controls:
        heads.setdefault(c[0], []).append(_quoted(c[1:]))
    return "|".join(f"(?<={_quoted(h)}){slashes}(?=\\\\*(?:{'|'.join(t)}))" for h, t in sorted(heads.items()))


def escape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, _pattern(template.controls(), ""), r"\\")


def unescape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, _pattern(template.controls(), r"\\"), "")


def _machine(roles: Column) -> tuple[Column, Column]:
    """``(valid, bad_turn)`` of an array of roles."""
    table = F.create_map(*[F.lit(x) for (s, r), to in TRANSITIONS.items() for x in (f"{s} {r}", to)])
    state = F.aggregate(
        roles, F.struct(F.lit("start").alias("at"), F.lit(0).alias("turn"), F.lit(-1).alias("bad")),
        lambda a, role: F.struct(
            F.coalesce(F.when(a["bad"] < 0, F.try_element_at(table, F.concat_ws(" ", a["at"], role))), a["at"]).alias("at"),
            (a["turn"] + 1).alias("turn"),
            F.when((a["bad"] < 0) & F.try_element_at(table, F.concat_ws(" ", a["at"], role)).isNull(), a["turn"])
            .otherwise(a["bad"]).alias("bad")))
    bad = F.when(state["bad"] >= 0, state["bad"]).when(state["at"] != "answered", F.size(roles))
    return bad.isNull(), bad


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """``(conv_id, valid, bad_turn, segments, formatted)`` from ``(conv_id, turn, role, text)``."""
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("known"), "turn", "role", F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))

    def segments(t: Column) -> Column:
        text = escape(t["text"], template)
        other = F.array(
            F.struct(F.concat(F.lit(template.other[0]), escape(F.coalesce(t["role"], F.lit("")), template),
                              F.lit(template.other[1])).alias("text"), F.lit(False).alias("loss")),
            F.struct(text.alias("text"), F.lit(False).alias("loss")),
            F.struct(F.lit(template.other[2]).alias("text"), F.lit(False).alias("loss")))
        out = None
        for role, (before, after, loss) in template.roles.items():
            known = F.array(
                F.struct(F.lit(before).alias("text"), F.lit(False).alias("loss")),
                F.struct(text.alias("text"), F.lit(loss).alias("loss")),
                F.struct(F.lit(after).alias("text"), F.lit(False).alias("loss")))
            out = F.when(t["role"] == role, known) if out is None else out.when(t["role"] == role, known)
        return out.otherwise(other)

    valid, bad = _machine(F.transform("turns", lambda t: t["role"]))
    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    return turns.select("conv_id", valid.alias("valid"), bad.alias("bad_turn"),
                        F.concat(begin, F.flatten(F.transform("turns", segments))).alias("segments")) \
        .withColumn("formatted", F.concat_ws("", F.transform("segments", lambda s: s["text"])))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    ends = "|".join(_quoted(a) for a in sorted({a for _, a, _ in template.roles.values()} | {template.other[2]}))
    starts = sorted({b for b, _, _ in template.roles.values()} | {template.other[0]})
    body = F.substring(formatted, len(template.begin) + 1, 2**31 - 1)
    pieces = F.filter(F.split(body, f"(?<=(?:{ends}))"), lambda p: p != "")

    def turn(p: Column) -> Column:
        text = F.regexp_replace(F.regexp_replace(p, f"^(?:{'|'.join(map(_quoted, starts))})", ""), f"(?:{ends})$", "")
        cut = F.instr(text, template.other[1])
        out = None
        for role, (before, _, _) in template.roles.items():
            known = F.struct(F.lit(role).alias("role"), unescape(text, template).alias("text"))
            out = F.when(p.startswith(before), known) if out is None else out.when(p.startswith(before), known)
        return out.otherwise(F.struct(
            unescape(F.substring(text, F.lit(1), cut - 1), template).alias("role"),
            unescape(F.substring(text, cut + len(template.other[1]), F.length(text)), template).alias("text")))

    return F.transform(pieces, turn)


def conversation_digests(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """What ``formatted`` and ``segments`` hold, read back from them."""
    chats = chats.withColumn("_turns", read_turns(F.col("formatted"), template))
    each = F.concat_ws("", F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = F.concat_ws("", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template)))
    return chats.select(
        "conv_id", F.size("_turns").cast("bigint").alias("n_turns"), F.sha2(each, 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"), "valid", F.col("bad_turn").cast("bigint").alias("bad_turn"))
