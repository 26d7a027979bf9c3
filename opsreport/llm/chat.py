"""Chat formatting by prefix-target expansion, in DataFrame functions.

A conversation is written as ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a newline for
each turn. Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so a
control string can only come from the template; one pass that drops one backslash before each
escaped character restores the original.

Every assistant turn becomes an example of its own: all turns before it as context, and the
escaped reply as the only trainable span. A conversation that does not end with an assistant
turn also yields one row without a trainable span (``example`` is null), so that its last turns
are in the output too. The last row of each conversation thus holds all of it.

Turns are put in order by turn, then role and text, nulls first; a null role or text counts as
empty; repeated rows are repeated turns; rows without ``conv_id`` form one conversation of
their own. An empty table gives an empty result. Other columns are ignored.

Size: the examples of a conversation of k turns hold O(k squared) turns by definition; one
conversation is one string, so it must fit in a row of Spark (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TARGET = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _turn(t: Column) -> Column:
    return F.concat(F.lit(START), t["role"], F.lit(SEP), t["text"], F.lit(f"{END}\n"))


def conversations_of(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its escaped turns in order."""
    said = lambda n: F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n)
    turn = F.struct("turn", said("role"), said("text"))
    # Put in order as they are; escapes would change the order.
    escaped = lambda t: F.struct(
        t["turn"].alias("turn"), escape(t["role"]).alias("role"), escape(t["text"]).alias("text")
    )
    ordered = F.transform(F.array_sort(F.collect_list(turn)), escaped)
    return turns.groupBy("conv_id").agg(ordered.alias("turns"))


def prefix_examples(turns: DataFrame) -> DataFrame:
    """conv_id, example (from 0, or null), text, loss_start (from 0) and loss_length.

    The span counts code points of ``text``.
    """
    convs = conversations_of(turns)
    last = F.size("turns") - 1
    targets = F.filter(
        F.transform("turns", lambda t, i: F.struct(i.alias("at"), t["role"].alias("role"))),
        lambda x: x["role"] == TARGET,
    )
    ends = F.concat(
        F.transform(
            targets,
            lambda x, i: F.struct(i.alias("example"), x["at"].alias("at")),
        ),
        F.when(
            F.element_at("turns", -1)["role"] != TARGET,
            F.array(F.struct(F.lit(None).cast("int").alias("example"), last.alias("at"))),
        ).otherwise(F.array().cast("array<struct<example:int,at:int>>")),
    )
    rows = convs.select("conv_id", "turns", F.explode(ends).alias("e"))
    upto = F.slice("turns", F.lit(1), F.col("e.at") + 1)
    text = F.concat_ws("", F.transform(upto, _turn))
    reply = F.element_at("turns", F.col("e.at") + 1)["text"]
    length = F.when(F.col("e.example").isNull(), 0).otherwise(F.length(reply))
    return rows.select(
        "conv_id", F.col("e.example").alias("example"), text.alias("text"), length.alias("n")
    ).select(
        "conv_id",
        "example",
        "text",
        F.when(F.col("example").isNull(), 0)
        .otherwise(F.length("text") - len(END) - 1 - F.col("n"))
        .cast("long")
        .alias("loss_start"),
        F.col("n").cast("long").alias("loss_length"),
    )


def turns_of(text: Column) -> Column:
    """The turns of a formatted text, unescaped: array of (role, text)."""
    parts = F.split(text, r"<\|im_end\|>\n")
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(x: Column) -> Column:
        at = F.instr(x, SEP)
        role = F.substring(x, F.lit(len(START) + 1), at - 1 - len(START))
        return F.struct(
            unescape(role).alias("role"),
            unescape(F.substring(x, at + len(SEP), F.length(x))).alias("text"),
        )

    return F.transform(whole, turn)


def loss_text(text: Column, start: Column, length: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescape(F.substring(text, (start + 1).cast("int"), length.cast("int")))


def digests(examples: DataFrame) -> DataFrame:
    """One row per conversation, read back from its examples alone."""
    trained = F.col("example").isNotNull()
    reply = loss_text(F.col("text"), F.col("loss_start"), F.col("loss_length"))
    per = examples.select(
        "conv_id",
        F.length("text").cast("long").alias("n"),
        "text",
        F.when(trained, F.struct("example", reply.alias("reply"))).alias("reply"),
    )
    conv = per.groupBy("conv_id").agg(
        F.max_by("text", "n").alias("whole"),
        F.sum("n").alias("formatted_chars"),
        F.array_sort(F.collect_list("reply")).alias("replies"),
    )
    turns = conv.select(
        "conv_id", "formatted_chars", "replies", turns_of(F.col("whole")).alias("turns")
    )
    loss = F.concat_ws("", F.transform("replies", lambda r: r["reply"]))
    said = F.concat_ws(
        "",
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
    )
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
