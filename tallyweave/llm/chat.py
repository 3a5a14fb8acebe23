"""Chat formatting with a grammar round trip.

A conversation is rendered as a sequence of turns between marks; a deterministic parser
reads the rendered text back. Where the turns read back differ from the source, the
conflicting texts are escaped and the conversation is rendered and parsed again: first
only the turns that do not survive on their own, then all turns. Escaping breaks every
control string and doubles every backslash, so the last round is always identical.

Everything here is DataFrame functions. A conversation is one row, as its rendered text
is one value.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Marks around a turn by role; any other role is named between marks.
MARKS = {"system": ("<<SYS>>\n", "\n<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
CONTROL = [m.strip() for pair in MARKS.values() for m in pair] + [ROLE, TEXT, END]

_ANY_CONTROL = "|".join(re.escape(c) for c in CONTROL)
_PIECE = "(?s)" + "|".join(
    f"{re.escape(a)}.*?{re.escape(b)}" for a, b in [*MARKS.values(), (ROLE, END)]
).replace("\\\n", "\n").replace("\\ ", " ")


def escape(text: Column) -> Column:
    """Doubles backslashes and puts one behind the first character of each control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    """The inverse: of two backslashes one stays, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _marks(role: Column) -> tuple[Column, Column]:
    before, after = F.concat(F.lit(ROLE), role, F.lit(TEXT)), F.lit(END)
    for name, (a, b) in MARKS.items():
        before = F.when(role == name, F.lit(a)).otherwise(before)
        after = F.when(role == name, F.lit(b)).otherwise(after)
    return before, after


def _piece(turn: Column, escaped: Column) -> Column:
    """A rendered turn: the mark before, the text and the mark after, each on its own."""
    role = F.when(escaped, escape(turn["role"])).otherwise(turn["role"])
    text = F.when(escaped, escape(turn["text"])).otherwise(turn["text"])
    before, after = _marks(F.when(turn["role"].isin(*MARKS), turn["role"]).otherwise(role))
    return F.struct(before.alias("before"), text.alias("text"), after.alias("after"), turn["role"].alias("role"))


def _joined(pieces: Column | str) -> Column:
    return F.array_join(F.transform(pieces, lambda p: F.concat(p["before"], p["text"], p["after"])), "")


def parse(formatted: Column | str) -> Column:
    """Turns ``(role, text)`` of a rendered conversation, unescaped.

    The text of a turn that holds a bare control string is null: it is no sentence of
    the grammar. So is everything if marks and texts do not cover the whole string.
    """
    formatted = F.col(formatted) if isinstance(formatted, str) else formatted
    pieces = F.regexp_extract_all(formatted, F.lit(_PIECE), F.lit(0))

    def plain(text: Column) -> Column:
        return F.when(~text.rlike(_ANY_CONTROL), unescape(text))

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(ROLE) + 1), F.length(piece) - len(ROLE) - len(END))
        cut = F.instr(inner, TEXT)
        role = plain(F.substring(inner, F.lit(1), cut - 1))
        text = plain(F.substring(inner, cut + len(TEXT), F.length(inner)))
        for name, (a, b) in MARKS.items():
            here = F.startswith(piece, F.lit(a))
            role = F.when(here, F.lit(name)).otherwise(role)
            text = F.when(here, plain(F.substring(piece, F.lit(len(a) + 1), F.length(piece) - len(a) - len(b)))).otherwise(text)
        return F.struct(role.alias("role"), text.alias("text"))

    whole = F.array_join(pieces, "") == formatted
    return F.when(whole, F.transform(pieces, turn))


def conversations(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows ``(key, turns)``: the turns ``(role, text)`` of each conversation in order.

    Null roles and texts count as empty. A null turn number comes first, equal ones go by
    role, then text. A null key is a conversation of its own; other columns are left out.
    """
    row = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ordered = F.sort_array(F.collect_list(row))
    grouped = df.groupBy(key).agg(ordered.alias("rows"))
    return grouped.select(key, F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("turns"))


def render(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Adds ``formatted``, ``loss_spans`` and ``rounds`` to rows with an array of turns.

    ``loss_spans`` are ``(start, length)`` in UTF-8 bytes of ``formatted``: the text of
    each assistant turn. ``rounds`` tells how often the conversation was rendered: 1 with
    no escapes, 2 with conflicting turns escaped, 3 with all.
    """

    def rounds(source: DataFrame, name: str, escaped) -> DataFrame:
        pieces = F.transform(turns, lambda t: _piece(t, escaped(t)))
        return source.withColumn(f"_{name}", pieces).withColumn(f"_{name}_text", _joined(f"_{name}"))

    def conflicts(t: Column) -> Column:
        alone = _piece(t, F.lit(False))
        back = parse(F.concat(alone["before"], alone["text"], alone["after"]))
        return ~back.eqNullSafe(F.array(F.struct(t["role"].alias("role"), t["text"].alias("text"))))

    out = rounds(df, "plain", lambda t: F.lit(False))
    out = out.withColumn("_same", parse("_plain_text").eqNullSafe(F.col(turns)))
    some = F.when(F.col("_same"), F.col("_plain")).otherwise(F.transform(turns, lambda t: _piece(t, conflicts(t))))
    out = out.withColumn("_some", some).withColumn("_some_text", _joined("_some"))
    out = out.withColumn("_second", F.col("_same") | parse("_some_text").eqNullSafe(F.col(turns)))
    every = F.when(F.col("_second"), F.col("_some")).otherwise(F.transform(turns, lambda t: _piece(t, F.lit(True))))
    out = out.withColumn("_pieces", every)

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(so_far: Column, p: Column) -> Column:
        before, inner, after = (F.octet_length(p[x]) for x in ("before", "text", "after"))
        span = F.array(F.struct((so_far["at"] + before).alias("start"), inner.alias("length")))
        spans = F.when(p["role"] == "assistant", F.concat(so_far["spans"], span)).otherwise(so_far["spans"])
        return F.struct((so_far["at"] + before + inner + after).alias("at"), spans.alias("spans"))

    spans = F.aggregate("_pieces", start, step, lambda end: end["spans"])
    count = F.when(F.col("_same"), 1).when(F.col("_second"), 2).otherwise(3)
    return out.select(*df.columns, _joined("_pieces").alias("formatted"), spans.alias("loss_spans"), count.alias("rounds"))


def read_back(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """What ``formatted`` and ``loss_spans`` alone say: turns, and the text under the mask."""
    raw = F.col("formatted").cast("binary")
    under = F.transform("loss_spans", lambda s: unescape(F.decode(F.substring(raw, s["start"] + 1, s["length"]), "UTF-8")))
    return df.select(key, "formatted", parse("formatted").alias("turns"), F.array_join(under, "").alias("loss_text"))
