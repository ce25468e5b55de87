"""Conversations as training text with a loss mask, by relational operations and Spark expressions only.

A run of turns of one role is one message ``<turn role="...">text</turn>`` and a line end; texts that a run has merged are
parted by ``<next/>``. ``&`` and ``<`` inside texts become ``&amp;`` and ``&lt;``, so no text can hold a control string and
reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.llm.common import pick

OPEN, NEXT, CLOSE = '<turn role="', "<next/>", "</turn>\n"


def _escape(c: Column, quote: bool = False) -> Column:
    c = F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit('"'), F.lit("&quot;")) if quote else c


def _unescape(c: Column, quote: bool = False) -> Column:
    c = F.replace(c, F.lit('&quot;'), F.lit('"')) if quote else c
    return F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, segments`` for every conversation of ``conv_id, turn, role, text``.

    ``segments`` is the text in pieces with a ``loss`` flag each, the mask in run-length form: exactly the
    texts of ``trained_role`` are flagged. Turns go by ``turn`` (nulls first), then role and text, so ties and
    repeated rows have one order. A null role or text is empty; rows of a null ``conv_id`` are one
    conversation. A conversation is one output row, so its turns meet in one task by definition.
    """
    turns = pick(turns, "conv_id", "turn", "role", "text")
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    got = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    got = got.withColumn(
        "starts",
        F.expr("filter(sequence(0, size(turns) - 1), i -> i = 0 OR turns[i].role <> turns[i - 1].role)"),
    )
    got = got.withColumn(
        "messages",
        F.expr(
            """transform(starts, (s, k) -> named_struct('role', turns[s].role, 'texts',
            transform(slice(turns, s + 1, coalesce(get(starts, k + 1), size(turns)) - s), t -> t.text)))"""
        ),
    )

    def pieces(m: Column) -> Column:
        head = F.concat(F.lit(OPEN), _escape(m["role"], True), F.lit('">'))
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        texts = F.transform(
            m["texts"],
            lambda t, i: F.array(
                piece(F.when(i == 0, head).otherwise(F.lit(NEXT)), F.lit(False)),
                piece(_escape(t), m["role"] == trained_role),
            ),
        )
        return F.concat(F.flatten(texts), F.array(piece(F.lit(CLOSE), F.lit(False))))

    got = got.select("conv_id", F.flatten(F.transform("messages", pieces)).alias("segments"))
    return got.select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of ``role, text``."""
    messages = F.filter(F.split(formatted, CLOSE), lambda m: m != "")

    def turns(m: Column) -> Column:
        role = _unescape(F.regexp_extract(m, '^<turn role="([^"]*)">', 1), True)
        body = F.substr(m, F.locate('">', m) + 2)
        return F.transform(F.split(body, NEXT), lambda t: F.struct(role.alias("role"), _unescape(t).alias("text")))

    return F.flatten(F.transform(messages, turns))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: _unescape(s["text"])), "")
