"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of one role are merged
into a block; blocks are concatenated:

    <|turn|>role<|text|>first text<|next|>second text<|end|><|turn|>...

Every control string of the template, and of common chat templates, begins with ``<`` or ``[``.  Inside
roles and texts each ``<`` and ``[`` gets a backslash after it, so no control string can occur there,
and taking that backslash away restores the text exactly.

Defined cases: null roles and texts count as empty; a null ``conv_id`` is a conversation of its own;
turns sort by (turn, role, text), null turns first, and repeated rows stay; an empty table gives an
empty result; other input columns are not carried.

A conversation is one row of the result, so its turns meet in one task; conversations are spread by
``conv_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of the template.
TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<")), F.lit("[\\"), F.lit("["))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_col`` and ``formatted``."""
    rows = turns.select(
        F.col(conv_col).alias("_chat_conv"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                 F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("_chat_turn"))
    conv = rows.groupBy("_chat_conv").agg(F.array_sort(F.collect_list("_chat_turn")).alias("turns"))
    # a turn sees the role before it as the second array of zip_with; the arrays are scanned once
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform("turns", lambda t: t["role"]))

    def piece(t: Column, last: Column) -> Column:
        head = F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
        return (F.when(t.isNull(), F.lit(END))  # the place after the last turn
                .when(last.isNull(), F.concat(head, escape(t["text"])))
                .when(last == t["role"], F.concat(F.lit(NEXT), escape(t["text"])))
                .otherwise(F.concat(F.lit(END), head, escape(t["text"]))))

    merged = F.array_join(F.zip_with("turns", before, piece), "")
    return conv.select(F.col("_chat_conv").alias(conv_col), merged.alias("formatted"))


def _literal(control: str) -> str:
    return control.replace("|", r"\|")


def blocks(formatted: Column) -> Column:
    """Blocks of a formatted conversation: arrays of the role and then its texts, unescaped."""
    inner = F.split(formatted, _literal(END) + f"(?:{_literal(TURN)})?", -1)
    cut = f"{_literal(TEXT)}|{_literal(NEXT)}"
    whole = F.slice(inner, F.lit(1), F.size(inner) - 1)
    return F.transform(whole, lambda b: F.transform(
        F.split(F.regexp_replace(b, "^" + _literal(TURN), ""), cut, -1), unescape))


def read_chats(formatted: DataFrame) -> DataFrame:
    """Read ``formatted`` back: adds ``turns`` (structs of role and text, in order)."""
    turn = F.transform("_chat_blocks", lambda b: F.transform(
        F.slice(b, F.lit(2), F.size(b) - 1), lambda t: F.struct(F.element_at(b, 1).alias("role"), t.alias("text"))))
    return (formatted.withColumn("_chat_blocks", blocks(F.col("formatted")))
            .withColumn("turns", F.flatten(turn)).drop("_chat_blocks"))


def loss_mask(formatted: Column, role: str = "assistant") -> Column:
    """The texts under the loss mask, read from the formatted string: those of ``role``'s blocks."""
    own = F.filter(blocks(formatted), lambda b: F.element_at(b, 1) == F.lit(role))
    return F.flatten(F.transform(own, lambda b: F.slice(b, F.lit(2), F.size(b) - 1)))
