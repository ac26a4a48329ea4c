"""Chat formatting with DataFrame functions only.

A template names, for each role, the mark that opens its turns and whether its text counts for the loss, and the
state machine of roles: which role may follow which. The output is segments (text, loss): mark, body and end of each
turn. Control strings inside a text are broken up with the escape character and can be restored exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``open`` + label + ``colon`` + body + ``end``. A role that ``labels`` lacks is written as ``other`` with its
    UTF-8 bytes in hex, so that any role can be read back. ``moves``: state -> roles that may come next; the state after a turn
    is the turn's role, ``start`` before the first; ``final`` are the roles that may come last."""

    open: str = "### "
    colon: str = ": "
    end: str = "</turn>\n"
    control: tuple[str, ...] = ("### ", "</turn>")
    escape: str = "\\"
    other: str = "Other"
    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant", "user")

    def __post_init__(self) -> None:
        if len(self.escape) != 1 or any(self.escape in c or len(c) < 2 for c in self.control):
            raise ValueError("the escape is one character that no control string holds")
        for c in self.control:
            for k in range(1, len(c)):
                tail = c[k:]
                for mark in (self.end, self.open, *(self.control)):
                    if mark.startswith(tail) or tail.startswith(mark):
                        raise ValueError(f"{c!r} could begin in a text and end in {mark!r}")
        if not any(self.open.startswith(c) for c in self.control) or not any(self.end.startswith(c) for c in self.control):
            raise ValueError("open and end must begin with control strings")


DEFAULT = Template()


def escaped(text: Column, t: Template = DEFAULT) -> Column:
    """Double the escape character, then put one after the first character of each control string."""
    out = F.replace(text, F.lit(t.escape), F.lit(t.escape * 2))
    for c in t.control:
        out = F.replace(out, F.lit(c), F.lit(c[0] + t.escape + c[1:]))
    return out


def unescaped(text: Column, t: Template = DEFAULT) -> Column:
    """Undo ``escaped``: drop each escape character that isn't itself escaped."""
    return F.regexp_replace(text, "(?s)" + "\\" + t.escape + "(.)", "$1")


def _mark(role: Column, t: Template) -> Column:
    label = reduce(lambda c, kv: c.when(role == kv[0], F.lit(kv[1])), list(t.labels.items())[1:], F.when(role == next(iter(t.labels)), F.lit(next(iter(t.labels.values())))))
    return F.concat(F.lit(t.open), label.otherwise(F.concat(F.lit(t.other + "("), F.lower(F.hex(F.encode(role, "UTF-8"))), F.lit(")"))), F.lit(t.colon))


def format_chats(turns: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> conv_id, n_turns, valid, bad_turn, segments array<struct<text, loss>>, formatted.

    Turns are ordered by turn, then role, then text, so that ties have one result; nulls come first; a null role or
    text is empty. ``valid``: each role may follow the one before and the last may end; ``bad_turn`` is the position of
    the first that may not (n_turns if the end is wrong), else null. Invalid conversations are formatted like the
    others. Rows with a null conv_id are one conversation. No rows give no rows; other columns are ignored.
    A conversation is the unit of output, so its turns meet in one row.
    """
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("row"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    allowed = F.create_map(*[F.lit(x) for state, nexts in t.moves.items() for x in (state, ",".join(nexts))])
    fsm = F.aggregate(
        "rows",
        F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("i"), F.lit(-1).alias("bad")),
        lambda s, r: F.struct(
            r["role"].alias("state"),
            (s["i"] + 1).alias("i"),
            F.when((s["bad"] < 0) & ~F.array_contains(F.split(F.coalesce(F.try_element_at(allowed, s["state"]), F.lit("")), ","), F.coalesce(F.nullif(r["role"], F.lit("")), F.lit("?"))), s["i"]).otherwise(s["bad"]).alias("bad"),
        ),
    )
    last = F.element_at("rows", -1)["role"]
    no = F.lit(False).alias("loss")
    segments = F.flatten(
        F.transform(
            "rows",
            lambda r: F.array(
                F.struct(_mark(r["role"], t).alias("text"), no),
                F.struct(escaped(r["text"], t).alias("text"), r["role"].isin(*t.loss_roles).alias("loss")),
                F.struct(F.lit(t.end).alias("text"), no),
            ),
        )
    )
    out = convs.select("conv_id", F.size("rows").cast("long").alias("n_turns"), fsm["bad"].alias("bad"), last.isin(*t.final).alias("ends"), segments.alias("segments"))
    return out.select(
        "conv_id",
        "n_turns",
        ((F.col("bad") < 0) & F.col("ends")).alias("valid"),
        F.when(F.col("bad") >= 0, F.col("bad").cast("long")).when(~F.col("ends"), F.col("n_turns")).alias("bad_turn"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def parse_chats(formatted: Column, t: Template = DEFAULT) -> Column:
    """Read ``formatted`` back: array<struct<role, text>>. No control string is inside a body, so the text splits at
    the ends of turns."""
    import re

    pieces = F.slice(F.split(formatted, "\\Q" + t.end + "\\E", -1), 1, F.size(F.split(formatted, "\\Q" + t.end + "\\E", -1)) - 1)
    head = "(?s)^\\Q" + t.open + "\\E(\\w+)(?:\\(([0-9a-f]*)\\))?\\Q" + t.colon + "\\E"
    roles = F.create_map(*[F.lit(x) for role, label in t.labels.items() for x in (label, role)])
    assert all(re.fullmatch(r"\w+", x) for x in (*t.labels.values(), t.other))
    role = lambda p: F.when(F.regexp_extract(p, head, 1) == t.other, F.decode(F.unhex(F.regexp_extract(p, head, 2)), "UTF-8")).otherwise(F.try_element_at(roles, F.regexp_extract(p, head, 1)))
    return F.transform(pieces, lambda p: F.struct(role(p).alias("role"), unescaped(F.regexp_replace(p, head, ""), t).alias("text")))


def chat_digests(formatted: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """Digests of what can be read back from ``format_chats``: from the formatted text its turns, from the segments the loss."""
    parsed = formatted.select("*", parse_chats(F.col("formatted"), t).alias("turns"))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], t)), "")
    turns = F.array_join(F.transform("turns", lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))), "")
    rows = parsed.select("conv_id", F.size("turns").cast("long").alias("n_turns"), turns.alias("turns"), loss.alias("loss"), "formatted", "valid", "bad_turn")
    return rows.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
