"""Chat formatting with Catalyst expressions only.

A declarative template gives every role its opening and closing mark and says
whether its text bears loss. A finite-state machine over the roles checks the
order of turns. Each turn becomes three segments (opening, text, closing) with
a loss flag each; the formatted conversation is their concatenation.

Texts may contain the template's marks: an escape character is put behind the
first character of every string that looks like a mark, with or without escape
characters already in it, so unescaping is exact and a mark in the output is
always the template's own.

A null text is the empty text, a null role the empty role; roles the template
doesn't name get a mark that spells the role out. Rows of one conversation are
ordered by turn, then role and text; repeated rows stay separate turns and make
the conversation invalid, as does a null turn, which comes first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of the roles, the mark of other roles, and the machine's moves.

    All marks begin with "<" or "[" and contain no escape character; ``other`` is cut at
    its gap for the role's name. ``moves`` has state -> role -> next state.
    """

    roles: dict[str, Role]
    other: tuple[str, str, str]
    moves: dict[str, dict[str, str]]
    start: str
    final: tuple[str, ...]
    escape: str = "\\"

    def marks(self) -> list[str]:
        found = [m for r in self.roles.values() for m in (r.opening, r.closing)] + list(self.other)
        return sorted(set(found), key=lambda m: (-len(m), m))


INSTRUCT = Template(
    roles={
        "system": Role("<<SYS>>", "<</SYS>>"),
        "user": Role("[INST]", "[/INST]"),
        "assistant": Role("<s>", "</s>", loss=True),
    },
    other=("[ROLE=", "[:]", "[/ROLE]"),
    moves={
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    },
    start="start",
    final=("assistant",),
)


def escape(text: Column, template: Template) -> Column:
    """One escape character more behind the first character of every lookalike."""
    out = text
    e = re.escape(template.escape)
    for mark in template.marks():
        out = F.regexp_replace(out, F.lit(f"{_quoted(mark[0])}({e}*){_quoted(mark[1:])}"),
                               F.lit(_literal(mark[0] + template.escape) + "$1" + _literal(mark[1:])))
    return out


def unescape(text: Column, template: Template) -> Column:
    """One escape character less in every lookalike that has one."""
    out = text
    e = re.escape(template.escape)
    for mark in template.marks():
        out = F.regexp_replace(out, F.lit(f"{_quoted(mark[0])}{e}({e}*){_quoted(mark[1:])}"),
                               F.lit(_literal(mark[0]) + "$1" + _literal(mark[1:])))
    return out


def _quoted(text: str) -> str:
    return rf"\Q{text}\E"


def _literal(text: str) -> str:
    """For the replacement side, where backslash and dollar are special."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def _check(template: Template) -> None:
    """Marks must not contain each other, overlap, or hold escape characters."""
    marks = template.marks()
    for m in marks:
        if len(m) < 2 or template.escape in m or m[0] not in "<[":
            raise ValueError(f"mark {m!r}: two characters or more, beginning with < or [, no {template.escape}")
        for other in marks:
            for k in range(1, len(m)):
                if other.startswith(m[k:]) or m[k:].startswith(other):
                    raise ValueError(f"marks {m!r} and {other!r} can overlap")


def _walk(rows: Column, template: Template) -> Column:
    """struct<state, bad>: where the machine ends and the first turn it refuses (-1: none).

    It refuses a role that its state has no move for, a turn without a number, and one with
    the number of the turn before it.
    """
    turns = F.transform(rows, lambda r, i: F.struct(r["role"].alias("role"), (r["turn"].isNotNull() & ~F.coalesce(
        F.get(rows, i - 1)["turn"] == r["turn"], F.lit(False))).alias("numbered")))
    moves = F.create_map(*[F.lit(x) for s, to in template.moves.items() for r, t in to.items() for x in (f"{s} {r}", t)])

    def step(now: Column, turn: Column) -> Column:
        to = F.when(turn["numbered"], F.element_at(moves, F.concat(now["state"], F.lit(" "), turn["role"])))
        return F.when((now["bad"] >= 0) | to.isNull(), F.struct(
            now["state"].alias("state"), now["at"].alias("at"),
            F.when(now["bad"] >= 0, now["bad"]).otherwise(now["at"]).alias("bad"))).otherwise(F.struct(
                to.alias("state"), (now["at"] + 1).alias("at"), now["bad"].alias("bad")))

    return F.aggregate(turns, F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("bad")),
                       step)


def format_chats(turns: DataFrame, template: Template = INSTRUCT, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_col, formatted, segments, valid, error_turn.

    segments: array of struct(text, loss) that concatenate to ``formatted``. A
    conversation is valid if the machine accepts its roles and turn numbers; error_turn is the
    position of the first turn it refuses, or the number of turns if they end in
    a state that isn't final. Invalid conversations are formatted all the same.
    Columns beyond the four named are not read.
    """
    _check(template)
    named = F.create_map(*[x for r, s in template.roles.items() for x in (
        F.lit(r), F.struct(F.lit(s.opening).alias("opening"), F.lit(s.closing).alias("closing"), F.lit(s.loss).alias("loss")))])
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = escape(F.coalesce(F.col(text_col), F.lit("")), template)
    other = F.struct(F.concat(F.lit(template.other[0]), escape(role, template), F.lit(template.other[1])).alias("opening"),
                     F.lit(template.other[2]).alias("closing"), F.lit(False).alias("loss"))
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
                 F.coalesce(F.element_at(named, role), other).alias("marks")).alias("row"))
    # A conversation is one output value, so its turns meet in one task; the number of
    # turns of a conversation is what bounds this, not the number of conversations.
    grouped = rows.groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    segments = F.flatten(F.transform("rows", lambda r: F.array(
        F.struct(r["marks"]["opening"].alias("text"), F.lit(False).alias("loss")),
        F.struct(r["text"].alias("text"), r["marks"]["loss"].alias("loss")),
        F.struct(r["marks"]["closing"].alias("text"), F.lit(False).alias("loss")))))
    end = _walk(F.col("rows"), template)
    made = grouped.select("conv", segments.alias("segments"), end.alias("end"), F.size("rows").alias("n"))
    error = F.when(F.col("end.bad") >= 0, F.col("end.bad")).when(~F.col("end.state").isin(*template.final), F.col("n"))
    return made.select(
        F.col("conv").alias(conv_col), F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments", error.isNull().alias("valid"), error.alias("error_turn"))


def read_back(formatted: DataFrame, template: Template = INSTRUCT, text_col: str = "formatted") -> DataFrame:
    """``formatted`` with ``turns``: array of struct(role, text) parsed from its text.

    In escaped text a mark never appears, so each opening mark begins a turn, which
    ends at the next closing mark.
    """
    openings = [(r, s.opening) for r, s in template.roles.items()] + [(None, template.other[0])]
    closings = {s.closing for s in template.roles.values()} | {template.other[2]}
    begin = "|".join(_quoted(o) for _, o in openings)
    stop = "|".join(_quoted(c) for c in sorted(closings))
    # A turn: an opening mark, anything up to a closing mark.
    found = F.regexp_extract_all(F.col(text_col), F.lit(rf"(?s)(?:{begin}).*?(?:{stop})"), F.lit(0))

    def parse(turn: Column) -> Column:
        mark = F.regexp_extract(turn, f"^({begin})", 1)
        inner = F.regexp_replace(F.regexp_replace(turn, f"^(?:{begin})", ""), f"(?:{stop})$", "")
        cut = F.instr(inner, template.other[1])
        known = F.create_map(*[F.lit(x) for r, o in openings if r is not None for x in (o, r)])
        is_other = mark == template.other[0]
        role = F.when(is_other, unescape(F.substring(inner, F.lit(1), cut - 1), template)).otherwise(F.element_at(known, mark))
        text = F.when(is_other, F.substring(inner, cut + len(template.other[1]), F.length(inner))).otherwise(inner)
        return F.struct(role.alias("role"), unescape(text, template).alias("text"))

    return formatted.withColumn("turns", F.transform(found, parse))


def contract_rows(chats: DataFrame, template: Template = INSTRUCT, conv_col: str = "conv_id") -> DataFrame:
    """Counts and digests, read back from the formatted text and its loss flags."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
    return read_back(chats, template).select(
        conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid", "error_turn")
