"""Chat formatting by a finite-state machine over roles (DataFrame functions only).

A template names the roles' markers, which texts count for the loss, and the
machine's transitions.  Every turn gives three text segments - opening marker,
escaped text, closing marker - each with a loss flag.

Escaping: every backslash is doubled, then a backslash is put after the first
character of each control string, so that no control string is left inside a
text.  Reading drops one backslash before any character.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``roles``: markers of the known roles.  Any other role is written as
    ``other_open`` role ``other_sep`` text ``other_close``.  ``moves`` maps
    (state, role) to the next state; the states in ``accept`` may end a conversation."""

    begin: str = "<s>"
    roles: dict[str, Role] = field(default_factory=lambda: {
        "system": Role("<<SYS>>", "<</SYS>>"),
        "user": Role("[INST]", "[/INST]"),
        "assistant": Role("[ANS]", "</s>", loss=True),
    })
    other_open: str = "[ROLE]"
    other_sep: str = "[/ROLE]"
    other_close: str = "[END]"
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "briefed", ("start", "user"): "asked", ("briefed", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
    })
    accept: tuple[str, ...] = ("answered",)

    def controls(self) -> list[str]:
        marks = [self.begin, self.other_open, self.other_sep, self.other_close]
        for r in self.roles.values():
            marks += [r.open, r.close]
        if any(len(m) < 2 or "\\" in m for m in marks) or len(set(marks)) < len(marks):
            raise ValueError("markers need two characters or more, must differ and must not contain a backslash")
        return marks


LLAMA_LIKE = Template()


def _quote(s: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", s)


def escape(text: Column, template: Template) -> Column:
    first = "|".join(f"{_quote(c[0])}(?={_quote(c[1:])})" for c in sorted(template.controls(), key=len, reverse=True))
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({first})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, template: Template = LLAMA_LIKE, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, valid, bad_turn, segments``.

    ``segments`` is an array of (text, loss) in order: the begin marker, then
    three for each turn.  Turns go by ``turn``; equal numbers by role, then
    text (nulls first), and repeated rows stay.  Null text and role count as
    empty; rows with a null id form one conversation.  ``valid`` says whether
    the machine accepts the roles, ``bad_turn`` is the 0-based place of the
    first role without a move (the number of turns if only the end is wrong).
    Invalid conversations are formatted like the others; callers filter on
    ``valid``.  An empty table gives no rows; other columns are ignored.

    The rows of a conversation meet in one row, as its text must; the lists are
    gathered on the map side first.
    """
    t = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    convs = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(t)).alias("turns"))

    dead = "?"
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)])
    walk = F.aggregate(
        "turns", F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("n")),
        lambda acc, x: F.when(acc["state"] == dead, acc).otherwise(F.struct(
            F.coalesce(moves[F.concat(acc["state"], F.lit("\n"), x["role"])], F.lit(dead)).alias("state"),
            F.when(moves[F.concat(acc["state"], F.lit("\n"), x["role"])].isNull(), acc["n"]).otherwise(acc["n"] + 1).alias("n"))))

    def marks(role: Column, known: str) -> Column:
        out = F.concat(F.lit(template.other_open), escape(role, template), F.lit(template.other_sep)) \
            if known == "open" else F.lit(template.other_close)
        for name, r in template.roles.items():
            out = F.when(role == name, F.lit(getattr(r, known))).otherwise(out)
        return out

    trained = [name for name, r in template.roles.items() if r.loss]
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    body = F.flatten(F.transform("turns", lambda x: F.array(
        segment(marks(x["role"], "open"), F.lit(False)),
        segment(escape(x["text"], template), x["role"].isin(*trained) if trained else F.lit(False)),
        segment(marks(x["role"], "close"), F.lit(False)))))
    return convs.withColumn("walk", walk).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.col("walk.state").isin(*template.accept).alias("valid"),
        F.when(~F.col("walk.state").isin(*template.accept), F.col("walk.n").cast("long")).alias("bad_turn"),
        F.concat(F.array(segment(F.lit(template.begin), F.lit(False))), body).alias("segments"))


def formatted_text(segments: Column) -> Column:
    """The segments joined to the text that a model would see."""
    return F.concat_ws("", F.transform(segments, lambda s: s["text"]))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, escapes undone, nothing between the parts."""
    return F.concat_ws("", F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])))


def read_turns(text: Column, template: Template = LLAMA_LIKE) -> Column:
    """Array of (role, text) parsed back from a formatted text alone."""
    pairs = [(r.open, r.close) for r in template.roles.values()] + [(template.other_open, template.other_close)]
    turn = "(?s)" + "|".join(f"{_quote(a)}.*?{_quote(b)}" for a, b in pairs)

    def one(m: Column) -> Column:
        inner = lambda a, b: F.substring(m, F.lit(len(a) + 1), F.length(m) - len(a) - len(b))
        rest = inner(template.other_open, template.other_close)
        out = F.struct(unescape(F.substring_index(rest, template.other_sep, 1)).alias("role"),
                       unescape(F.substring(rest, F.locate(template.other_sep, rest) + len(template.other_sep), F.length(rest))).alias("text"))
        for name, r in template.roles.items():
            out = F.when(m.startswith(r.open), F.struct(F.lit(name).alias("role"), unescape(inner(r.open, r.close)).alias("text"))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(text, F.lit(turn), F.lit(0)), one)
