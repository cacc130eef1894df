"""Relational chat formatting, in Spark expressions only.

A conversation's turn structs are collected and sorted by (turn, role, text), adjacent turns of one role
merge to one block by array aggregation, and blocks are concatenated:

    <s>role[INST]text<|turn|>text[/INST]</s>

Roles and texts are escaped: a backslash is doubled, and each control string in them gets a backslash
after its first character, so that no marker can appear inside a text and reading back gives every text
as it was.

Defined cases: a null text or role is empty; a null conv_id is one conversation; repeated rows are turns
of their own; a null turn number sorts first, and equal ones by role, then text; a conversation is one row, with
texts and turns of any number, and its spans take time by turns and their root; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START, ROLE_END, TURN, TEXT_END = "<s>", "[INST]", "<|turn|>", "[/INST]</s>"
#: What may not appear inside a text.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|turn|>", "<<SYS>>", "<</SYS>>")
_PATTERN = r"(<|\[)(/?s>|/?INST\]|\|turn\|>|</?SYS>>)"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _PATTERN, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, and spans: array of (start, length), in code points from 1, of the assistant
    texts in formatted: the loss mask."""
    clean = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = clean.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    # Each turn with what goes before its text and after it: a merged turn only adds the turn marker.
    def piece(x: Column, i: Column) -> Column:
        turn = F.col("turns")
        same_before = (i > 0) & (F.get(turn, i - 1)["role"] == x["role"])
        same_after = F.coalesce(F.get(turn, i + 1)["role"] == x["role"], F.lit(False))
        opening = F.concat(F.lit(START), escape(x["role"]), F.lit(ROLE_END))
        return F.struct(
            F.when(same_before, F.lit(TURN)).otherwise(opening).alias("head"),
            escape(x["text"]).alias("body"),
            F.when(same_after, F.lit("")).otherwise(F.lit(TEXT_END)).alias("tail"),
            (x["role"] == "assistant").alias("loss"),
        )

    pieces = turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    formatted = F.concat_ws("", F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])))

    def span(state: Column, p: Column) -> Column:
        start, size = state["at"] + F.length(p["head"]), F.length(p["body"])
        found = F.when(p["loss"], F.array(F.struct(start.alias("start"), size.alias("length")))).otherwise(F.array())
        return F.struct(
            (start + size + F.length(p["tail"])).alias("at"),
            F.concat(state["spans"], found.cast("array<struct<start:int,length:int>>")).alias("spans"),
        )

    # Positions add up by chunks of the root of the number of turns, so no array of all spans is copied turn by turn.
    none = F.array().cast("array<struct<start:int,length:int>>")
    step = F.ceil(F.sqrt(F.size("pieces"))).cast("int")
    chunks = F.transform(F.sequence(F.lit(1), F.size("pieces"), step), lambda i: F.slice("pieces", i, step))
    long = lambda c: F.aggregate(c, F.lit(0), lambda s, p: s + F.length(p["head"]) + F.length(p["body"]) + F.length(p["tail"]))
    cut = pieces.select("conv_id", formatted.alias("formatted"), chunks.alias("chunks"), F.transform(chunks, long).alias("sizes"))
    before = lambda i: F.aggregate(F.slice("sizes", 1, i), F.lit(1), lambda s, n: s + n)
    spans = F.transform("chunks", lambda c, i: F.aggregate(c, F.struct(before(i).alias("at"), none.alias("spans")), span)["spans"])
    return cut.select("conv_id", "formatted", F.flatten(spans).alias("spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """From format_conversations' rows: conv_id, formatted, turns (array of role, text) and loss_texts."""
    blocks = F.filter(F.split("formatted", r"\[/INST\]</s>"), lambda b: b.startswith(START))

    def turns(block: Column) -> Column:
        cut = F.instr(block, ROLE_END)
        role = unescape(block.substr(F.lit(len(START) + 1), cut - 1 - len(START)))
        texts = F.split(block.substr(cut + len(ROLE_END), F.length(block)), r"<\|turn\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return formatted.select(
        "conv_id",
        "formatted",
        F.flatten(F.transform(blocks, turns)).alias("turns"),
        F.transform("spans", lambda s: unescape(F.col("formatted").substr(s["start"], s["length"]))).alias("loss_texts"),
    )


def trick_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts are made of control strings."""
    text = F.lit("</s>[INST] ok [/INST]")
    rows = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"))
    return rows.select("conv_id", "turn", F.when(F.col("turn") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))


def digests(read: DataFrame) -> DataFrame:
    """The digest columns from what was read back."""
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = F.concat_ws("", F.col("loss_texts"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
