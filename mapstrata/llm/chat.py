"""Chat formatting from a declarative template, in DataFrame operations only.

A finite-state machine over roles checks the order of turns.  Conversations
are assembled in blocks of turns: a block emits its segments and, for every
state, the state that it leads to, so blocks are combined without reading
their turns again and a very long conversation is formatted in parallel.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks, escapes, states and loss roles.

    ``escapes`` replaces, in texts and roles, each control character by the
    escape sign and a letter.  The first pair is the escape sign itself.  As a
    mark starts with a control character, no text can contain one.  ``states``
    lists the roles that may follow a state; a state is named after the role of
    the last turn, the start is the empty name.
    """

    opening: str = "<turn>"
    role_end: str = "\n"
    closing: str = "</turn>\n"
    escapes: tuple = (("\\", "\\b"), ("<", "\\l"), ("\n", "\\n"))
    text_escapes: tuple = (("\\", "\\b"), ("<", "\\l"))
    loss_roles: tuple = ("assistant",)
    states: dict = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )


WRONG = "!"
BLOCK_TURNS = 64


def escape(value: Column, escapes) -> Column:
    for plain, coded in escapes:
        value = F.replace(value, F.lit(plain), F.lit(coded))
    return value


def unescape(value: Column, escapes) -> Column:
    for plain, coded in reversed(escapes):
        value = F.replace(value, F.lit(coded), F.lit(plain))
    return value


def _read(roles: Column, start: str, template: Template) -> Column:
    """(state, good) after ``roles``, from ``start``: the state is WRONG once a role is
    out of order, and ``good`` counts the turns before that one."""
    allowed = F.array(*[F.lit(f"{s}>{r}") for s, follow in template.states.items() for r in follow])

    def step(at: Column, role: Column) -> Column:
        fits = F.array_contains(allowed, F.concat(at["state"], F.lit(">"), role))
        return F.struct(
            F.when(fits, role).otherwise(F.lit(WRONG)).alias("state"),
            (at["good"] + fits.cast("long")).alias("good"),
        )

    return F.aggregate(roles, _at(F.lit(start), F.lit(0)), step)


def _at(state: Column, good: Column) -> Column:
    return F.struct(state.alias("state"), good.cast("long").alias("good"))


def format_chats(
    turns: DataFrame, template: Template | None = None, id_col="conv_id", block_turns=BLOCK_TURNS
) -> DataFrame:
    """One row per conversation: ``id_col``, n_turns, valid, first_fault, segments, formatted.

    segments is an array of (text, loss); formatted is their concatenation.
    first_fault is the place (from 0) of the first turn whose role may not follow
    the turns before it, NULL in a valid conversation.
    Turns are ordered by turn, then role, then text, so ties and repeated rows
    give one result.  Null text is the empty text; a null role is the empty role,
    which makes the conversation invalid; null turns come first; rows without a
    conversation id form one conversation.  An invalid conversation is formatted
    like any other and marked.  Other columns are not read.
    """
    t = template or Template()
    rows = turns.select(
        F.col(id_col).alias("conv"),
        F.floor(F.col("turn") / F.lit(block_turns)).alias("block"),
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("said"),
    )

    def segments(said: Column) -> Column:
        role = said["role"]
        return F.array(
            F.struct(
                F.concat(F.lit(t.opening), escape(role, t.escapes), F.lit(t.role_end)).alias("text"),
                F.lit(False).alias("loss"),
            ),
            F.struct(
                escape(said["text"], t.text_escapes).alias("text"),
                role.isin(*t.loss_roles).alias("loss"),
            ),
            F.struct(F.lit(t.closing).alias("text"), F.lit(False).alias("loss")),
        )

    states = list(t.states)
    blocks = (
        rows.groupBy("conv", "block")
        .agg(F.sort_array(F.collect_list("said")).alias("said"))
        .select(
            "conv",
            F.struct(
                "block",
                F.size("said").cast("long").alias("n"),
                F.array(*[_read(F.col("said.role"), s, t) for s in states]).alias("ends"),
                F.flatten(F.transform("said", segments)).alias("segments"),
            ).alias("part"),
        )
    )
    names = F.array(*[F.lit(s) for s in states])

    def follow(at: Column, ends: Column) -> Column:
        end = F.try_element_at(ends, F.nullif(F.array_position(names, at["state"]), F.lit(0)).cast("int"))
        return F.when(end.isNull(), at).otherwise(_at(end["state"], at["good"] + end["good"]))

    read = F.aggregate(F.col("parts.ends"), _at(F.lit(""), F.lit(0)), follow)
    return (
        blocks.groupBy("conv")
        .agg(F.sort_array(F.collect_list("part")).alias("parts"))
        .select(
            F.col("conv").alias(id_col),
            F.aggregate(F.col("parts.n"), F.lit(0).cast("long"), lambda a, n: a + n).alias("n_turns"),
            read.alias("read"),
            F.flatten("parts.segments").alias("segments"),
        )
        .select(
            id_col, "n_turns",
            (F.col("read.state") != F.lit(WRONG)).alias("valid"),
            F.when(F.col("read.state") == F.lit(WRONG), F.col("read.good")).alias("first_fault"),
            "segments",
        )
        .withColumn("formatted", F.array_join(F.col("segments.text"), ""))
    )


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    t = template or Template()

    def turn(part: Column) -> Column:
        role = F.substring_index(part, t.role_end, 1)
        start = F.char_length(role) + F.lit(len(t.role_end) + 1)
        length = F.char_length(part) - start + F.lit(1 - len(t.closing))
        return F.struct(
            unescape(role, t.escapes).alias("role"),
            unescape(F.substring(part, start, length), t.text_escapes).alias("text"),
        )

    opening = t.opening.replace("<", "\\<")
    return F.transform(F.slice(F.split(formatted, opening), 2, 1 << 30), turn)


def loss_text(segments: Column, template: Template | None = None) -> Column:
    """The text under the loss mask, with its escapes undone."""
    t = template or Template()
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape(s["text"], t.text_escapes)), "")
