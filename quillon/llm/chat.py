"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted. Adjacent turns of one role share a block:
`<turn>role`, newline, the texts with `<part>` between them, `</turn>`, newline. Every control string
starts with `<`, which texts and roles can't hold: a backslash is written `\\b`, `<` is `\\l` and, in
roles, a newline is `\\e`, so what was formatted can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, PART, END = "<turn>", "<part>", "</turn>\n"
TRAINED_ROLE = "assistant"
#: Turns that one fold goes over.
CHUNK = 256


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\e"))


def _unrole(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\e"), F.lit("\n")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text, ...) -> (conv_id, formatted, segments array<struct<text, loss>>).

    segments joined give formatted; loss marks the segments that are trained on, the texts of the
    role `assistant` in their escaped form. Turns are sorted by turn (null first), then role and text.
    Null roles and texts count as empty; a null conv_id is a conversation of its own; repeated rows
    are repeated turns; other columns are ignored; an empty table gives no rows. A conversation is
    one value of the result, so its turns are what one group holds.
    """
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)

    def parts(b: Column) -> Column:
        opens = F.concat(F.lit(TURN), _role(b["role"]), F.lit("\n"))
        said = F.transform(b["texts"], lambda t, i: F.array(segment(F.when(i == 0, opens).otherwise(PART), no), segment(escape(t), b["role"] == TRAINED_ROLE)))
        return F.concat(F.flatten(said), F.array(segment(F.lit(END), no)))

    out = grouped.select("conv_id", F.flatten(F.transform(merge_turns(F.col("turns")), parts)).alias("segments"))
    return out.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def merge_turns(turns: Column) -> Column:
    """array<struct<role, texts>>: adjacent turns of one role as one block, by aggregating the sorted turns.

    A fold adds each turn to the last block or opens one; it goes over CHUNK turns at a time and then over the chunks'
    blocks, so that a conversation of very many turns doesn't copy all blocks for each of them.
    """
    empty = F.array().cast("array<struct<role:string,texts:array<string>>>")
    block = lambda role, texts: F.array(F.struct(role.alias("role"), texts.alias("texts")))

    def joined(done: Column, more: Column) -> Column:
        """done and more, the last block of the one and the first of the other merged if they have one role."""
        last, first = F.get(done, F.size(done) - 1), F.get(more, F.lit(0))
        merged = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), block(last["role"], F.concat(last["texts"], first["texts"])), F.slice(more, F.lit(2), F.size(more)))
        return F.when((F.size(done) > 0) & (last["role"] == first["role"]), merged).otherwise(F.concat(done, more))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(turns) - 1) / CHUNK).cast("int")), lambda i: F.slice(turns, i * CHUNK + 1, F.lit(CHUNK)))
    folded = F.transform(chunks, lambda c: F.aggregate(c, empty, lambda done, x: joined(done, block(x["role"], F.array(x["text"])))))
    return F.aggregate(folded, empty, joined)


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != "")

    def of_block(b: Column) -> Column:
        role = _unrole(F.substring_index(F.substring(b, len(TURN) + 1, 2**31 - 1), "\n", 1))
        body = F.substring(b, F.lit(len(TURN) + 2) + F.length(F.substring_index(b, "\n", 1)) - len(TURN), F.lit(2**31 - 1))
        return F.transform(F.split(body, PART, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, of_block))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
