"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What a conversation looks like.

    ``open_turn`` + role + ``close_head`` + text + ``close_turn`` is one turn; ``loss_roles`` are the roles whose
    texts are trained on.  Every control string begins with a character of ``lead``; in roles and texts these
    characters and the backslash itself are written as a backslash and a digit, so texts never hold a control
    string and ``unescaped`` gets them back.  ``moves`` is the machine: (state, role) -> next state from "start";
    a conversation is valid when every turn has a move and the last state is in ``final``.
    """

    open_turn: str = "<s>[INST:"
    close_head: str = "]"
    close_turn: str = "</s>"
    lead: str = "<[]"
    loss_roles: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})
    final: tuple[str, ...] = ("user", "assistant")


def escaped(text: Column, t: Template) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\0"))
    for k, c in enumerate(t.lead, 1):
        out = F.replace(out, F.lit(c), F.lit(f"\\{k}"))
    return out


def unescaped(text: Column, t: Template) -> Column:
    out = text
    for k, c in enumerate(t.lead, 1):
        out = F.replace(out, F.lit(f"\\{k}"), F.lit(c))
    return F.replace(out, F.lit("\\0"), F.lit("\\"))


def formatted(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text", template: Template | None = None) -> DataFrame:
    """Per conversation: id_col, segments, formatted, valid, first_bad_turn.

    ``segments`` is array<struct<text, loss>> in order, ``formatted`` their texts together.  A turn gives three
    segments: head, escaped text (loss: whether its role is trained on) and end.  ``valid`` and ``first_bad_turn``
    (0-based, the number of turns if only the last state is not final, null if valid) are the machine's verdict; invalid
    conversations are formatted all the same and nothing is dropped.

    Turns are ordered by (turn, role, text), a null turn number first.  Null roles and texts count as empty; rows
    repeated whole are turns of their own; rows with a null conversation id form one conversation; other columns
    are ignored; an empty table gives no rows.  A conversation's turns meet in one row, as its text has to.
    """
    t = template or Template()
    rows = turns.select(F.col(id_col).alias("id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("row"))
    conv = rows.groupBy("id").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def of_turn(x):
        return F.array(
            F.struct(F.concat(F.lit(t.open_turn), escaped(x["role"], t), F.lit(t.close_head)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(x["text"], t).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
            F.struct(F.lit(t.close_turn).alias("text"), F.lit(False).alias("loss")))

    def move(was, x):
        to = F.lit("stuck")
        for (state, role), nxt in t.moves.items():
            to = F.when((was["state"] == state) & (x["role"] == role), nxt).otherwise(to)
        return F.struct(to.alias("state"), (was["n"] + 1).alias("n"),
                        F.when(was["bad"].isNull() & (to == "stuck"), was["n"]).otherwise(was["bad"]).alias("bad"))

    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("bad"))
    end = conv.withColumn("segments", F.flatten(F.transform("rows", of_turn))).withColumn("fsm", F.aggregate("rows", start, move))
    fine = F.col("fsm.bad").isNull() & F.col("fsm.state").isin(*t.final)
    return end.select(F.col("id").alias(id_col), "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias(
        "formatted"), fine.alias("valid"), F.when(~fine, F.coalesce("fsm.bad", F.size("rows"))).alias("first_bad_turn"))


def _pattern(t: Template) -> str:
    import re

    inside = "([^" + "".join("\\" + c for c in t.lead) + "]*)"
    return re.escape(t.open_turn) + inside + re.escape(t.close_head) + inside + re.escape(t.close_turn)


def read_back(out: DataFrame, id_col: str = "conv_id", template: Template | None = None) -> DataFrame:
    """What a trainer sees in the output of ``formatted``, with digests: id_col, n_turns, turns_sha256 (role, newline,
    text, newline of every turn), loss_chars and loss_sha256 (all text under the loss mask), formatted_chars, valid.

    Turns are parsed from the formatted text and unescaped; the loss mask is read from the segments' flags.
    """
    t = template or Template()
    pattern = F.lit(_pattern(t))
    parsed = out.withColumns({
        "roles": F.regexp_extract_all("formatted", pattern, F.lit(1)), "texts": F.regexp_extract_all("formatted", pattern, F.lit(2)),
        "loss": F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], t)), "")})
    turns = F.array_join(F.zip_with("roles", "texts", lambda r, x: F.concat(
        unescaped(r, t), F.lit("\n"), unescaped(x, t), F.lit("\n"))), "")
    return parsed.select(
        id_col, F.size("roles").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid", "first_bad_turn")
