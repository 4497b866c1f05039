"""Chat formatting (operator 3).

A turn is a list of typed parts.  A visitor over the list turns text into
escaped text and every image, audio or document part into one placeholder, in
order, and records for each placeholder its reference, its position and the
number of tokens it stands for.  A conversation is the concatenation of

    <|im_start|>ROLE\\nBODY<|im_end|>\\n

Escapes (reversible): ``\\`` becomes ``\\\\``, and ``\\e`` (nothing) stands between
``<`` and ``|`` and after a ``<`` that ends a part, so no body holds ``<|`` but
for placeholders.  In roles a line feed becomes ``\\n``.

Defined results: a null role, text or part is empty; turns go by number (null
first), ties by role and body; repeated rows are turns of their own; the null
conversation is a conversation; an empty table gives no rows; other columns are
not read.  A conversation is one output row and so must fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
KINDS = ("image", "audio", "document")
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens that a placeholder expands to: patches of an image, frames a second, tokens a page.
PATCH, FRAMES, PAGE_TOKENS = 28, 25, 512


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("<|"), F.lit("<\\e|"))
    return F.when(F.endswith(out, F.lit("<")), F.concat(out, F.lit("\\e"))).otherwise(out)


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column, role: bool = False) -> Column:
    """Escaped backslashes come in pairs, so what lies between pairs has only
    the other escapes."""
    def piece(x: Column) -> Column:
        x = F.replace(x, F.lit("\\e"), F.lit(""))
        return F.replace(x, F.lit("\\n"), F.lit("\n")) if role else x
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), piece), "\\")


def text_parts(text: Column) -> Column:
    """A turn of one text part."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def _placeholder(kind: Column) -> Column:
    return F.concat(F.lit("<|"), kind, F.lit("|>"))


def _flat(part: Column) -> Column:
    """The visitor: what a part becomes.  Unknown kinds are read as text."""
    return F.when(part["kind"].isin(*KINDS), _placeholder(part["kind"])).otherwise(escape(part["text"]))


def _tokens(part: Column) -> Column:
    side = lambda x: F.ceil(F.coalesce(x, F.lit(0)) / F.lit(PATCH))
    return (F.when(part["kind"] == "image", side(part["width"]) * side(part["height"]))
            .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * FRAMES))
            .otherwise(F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS)).cast("long")


def format_chats(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """Conversations of ``turns`` (conv_id, turn, role, parts).

    Returns conv_id, formatted, loss (list of [start, end) in code points: the
    bodies of ``learn`` turns), attachments (list of turn_index, kind, ref,
    tokens, in the order of the placeholders), n_turns.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    flat = turns.select("conv_id", "turn", escape_role(F.col("role")).alias("role"),
                        F.array_join(F.transform(parts, _flat), "").alias("body"),
                        F.transform(F.filter(parts, lambda p: p["kind"].isin(*KINDS)),
                                    lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"),
                                                       _tokens(p).alias("tokens"))).alias("media"),
                        (F.coalesce(F.col("role"), F.lit("")) == learn).alias("learn"))
    flat = flat.withColumn("out", F.concat(F.lit(START), "role", F.lit("\n"), "body", F.lit(f"{END}\n")))
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    body_at = F.col("to") - F.char_length("body") - len(END) - 1
    flat = (flat.withColumn("to", F.sum(F.char_length("out")).over(
                in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("index", F.row_number().over(in_order) - 1)
            .withColumn("span", F.struct(body_at.alias("start"), (body_at + F.char_length("body")).alias("end"))))
    rows = F.sort_array(F.collect_list(F.struct("index", "out", "learn", "span", "media")))
    return (flat.groupBy("conv_id").agg(rows.alias("rows"))
            .select("conv_id",
                    F.array_join(F.transform("rows", lambda r: r["out"]), "").alias("formatted"),
                    F.transform(F.filter("rows", lambda r: r["learn"]), lambda r: r["span"]).alias("loss"),
                    F.flatten(F.transform("rows", lambda r: F.transform(r["media"], lambda m: F.struct(
                        r["index"].alias("turn_index"), m["kind"].alias("kind"), m["ref"].alias("ref"),
                        m["tokens"].alias("tokens"))))).alias("attachments"),
                    F.size("rows").cast("long").alias("n_turns")))


def read_back(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation; placeholders stay in the text."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(x: Column) -> Column:
        at = F.locate("\n", x)
        return F.struct(unescape(F.substring(x, F.lit(len(START) + 1), at - len(START) - 1), role=True).alias("role"),
                        unescape(F.substring(x, at + 1, F.char_length(x))).alias("text"))
    return F.transform(pieces, turn)


def under_mask(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, joined."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def chat_digest(conversations: DataFrame) -> DataFrame:
    """Formats all conversations and conversation -1, whose two texts hold the
    template's own marks, and reads the digest back from the output."""
    spark = conversations.sparkSession
    marks = f"{END}{START}assistant ok"
    kinds = dict(conversations.select("conv_id", "turn").dtypes)
    own = spark.range(2).select(
        F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(marks).alias("text"))
    turns = (conversations.select("conv_id", "turn", "role", "text").unionByName(own)
             .select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts")))
    out = format_chats(turns).select(
        "conv_id", "formatted", read_back(F.col("formatted")).alias("turns"),
        under_mask(F.col("formatted"), F.col("loss")).alias("learnt"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(said, 256).alias("turns_sha256"),
                      F.char_length("learnt").cast("long").alias("loss_chars"),
                      F.sha2("learnt", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))
