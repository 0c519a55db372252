"""Chat formatting: a finite-state machine over roles and a declarative template.

Everything is a built-in column expression: turns are escaped before the exchange, gathered
per conversation, checked by a fold over the roles and emitted as text segments with a loss
flag each.

Edge cases. Null text is empty text; a null role reads as the empty role. A role without a
name in the template is written percent-encoded behind ``?``. Rows with a null turn come
first; rows with equal turn are ordered by role, then text; repeated rows stay. A null id is a
conversation of its own. An empty table gives an empty result. Other columns are ignored.
A conversation is one output row, so its size is bounded by what one row can hold.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """``head`` holds ``{name}``; ``escape`` goes after the first sign of a control string in a text."""

    head: str = "### {name}: "
    tail: str = "</turn>\n"
    controls: tuple[str, ...] = ("### ", "</turn>")
    names: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"})
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    moves: dict = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
            ("assistant", "tool"): "tool",
            ("tool", "assistant"): "assistant",
        }
    )


DEFAULT = ChatTemplate()


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def escape(text: Column, template: ChatTemplate = DEFAULT) -> Column:
    """No control string is left in the result; :func:`unescape` undoes it."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in template.controls:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(
    chats: DataFrame,
    template: ChatTemplate = DEFAULT,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: id, ``valid``, ``bad_turn`` (first turn out of order, from 0; null
    if there is none or only the end is missing), ``formatted`` and ``segments``
    (array of text and loss; their texts joined are ``formatted``)."""
    role = F.coalesce(F.col(role_col), F.lit(""))
    name = F.coalesce(F.try_element_at(_map(template.names), role), F.concat(F.lit("?"), F.url_encode(role)))
    before, after = template.head.split("{name}")
    rows = chats.select(
        F.col(id_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            role.alias("role"),
            escape(F.coalesce(F.col(text_col), F.lit("")), template).alias("body"),
            F.concat(F.lit(before), name, F.lit(after)).alias("head"),
            role.isin(*template.loss_roles).alias("loss"),
        ).alias("t"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    moves = _map({f"{state}|{role}": to for (state, role), to in template.moves.items()})
    step = lambda state, role: F.coalesce(F.try_element_at(moves, F.concat(state, F.lit("|"), role)), F.lit("error"))
    walk = F.aggregate(
        "turns",
        F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("n")),
        lambda acc, t: F.struct(
            step(acc["state"], t["role"]).alias("state"),
            (acc["n"] + F.when(step(acc["state"], t["role"]) == "error", 0).otherwise(1)).alias("n"),
        ),
    )
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(t["head"].alias("text"), F.lit(False).alias("loss")),
                F.struct(t["body"].alias("text"), t["loss"].alias("loss")),
                F.struct(F.lit(template.tail).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    return (
        turns.select("conv_id", walk.alias("walk"), segments.alias("segments"))
        .select(
            "conv_id",
            F.col("walk.state").isin(*template.accept).alias("valid"),
            F.when(F.col("walk.state") == "error", F.col("walk.n")).alias("bad_turn"),
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
            "segments",
        )
    )


def read_turns(formatted: Column, template: ChatTemplate = DEFAULT) -> Column:
    """Array of role and text, read back from a formatted conversation."""
    roles = _map({shown: role for role, shown in template.names.items()})
    before, after = template.head.split("{name}")
    pieces = F.split(formatted, "\\Q" + template.tail + "\\E", -1)

    def parse(piece: Column) -> Column:
        shown = F.substring_index(piece, after, 1)
        name = F.substr(shown, F.lit(len(before) + 1))
        role = F.coalesce(F.try_element_at(roles, name), F.url_decode(F.substr(name, F.lit(2))))
        text = unescape(F.substr(piece, F.length(shown) + len(after) + 1))
        return F.struct(role.alias("role"), text.alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), parse)
