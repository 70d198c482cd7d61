"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context,
and only its text is trainable. Turns behind the last assistant turn are an example
without a target, so that nothing of a conversation is lost.

A turn is rendered as ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line
feed. In roles and texts ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|``, in roles also
a line feed ``&#10;``; so no text holds a control string, and the way back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def rendered_head(role: Column) -> Column:
    safe = F.replace(escaped(role), F.lit("\n"), F.lit("&#10;"))
    return F.concat(F.lit(START), safe, F.lit("\n"))


def parsed_role(head: Column) -> Column:
    own = F.substring(head, len(START) + 1, 2**31 - 1)
    return unescaped(F.replace(own, F.lit("&#10;"), F.lit("\n")))


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, n_examples, formatted, loss_from, loss_chars) per assistant turn.

    ``formatted`` is the context, the target's head, its text and end. The loss mask covers
    ``loss_chars`` code points from ``loss_from`` (counted from 0) on: the target's text and
    nothing else. ``loss_from`` is NULL in an example without a target.

    Turns are in order of ``turn`` (NULL first), then of role and text; a NULL role or text
    is an empty one. Rows without a conv_id are one conversation; repeated rows are turns
    of their own. A conversation is one row here, as the digest over it asks for; an
    empty table gives no rows. Other columns are left out.
    """
    turn = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    gathered = conversations.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    rendered = gathered.select(
        "conv_id",
        F.transform(
            "turns",
            lambda x: F.struct(
                (x["role"] == TARGET_ROLE).alias("is_target"),
                rendered_head(x["role"]).alias("head"),
                escaped(x["text"]).alias("body"),
            ),
        ).alias("turns"),
    )
    count = F.size("turns")
    targets = F.filter(
        F.sequence(F.lit(1), count), lambda k: F.element_at("turns", k)["is_target"]
    )
    rest = F.when(~F.element_at("turns", -1)["is_target"], F.array(count)).otherwise(
        F.array().cast("array<int>")
    )
    tail = F.lit(f"{END}\n")
    exploded = (
        rendered.withColumn("ends", F.concat(targets, rest))
        .select("conv_id", "turns", F.size("ends").alias("n_examples"), F.posexplode("ends").alias("example", "upto"))
        .withColumn("last", F.element_at("turns", F.col("upto")))
        .withColumn(
            "context",
            F.array_join(
                F.transform(
                    F.slice("turns", F.lit(1), F.col("upto") - 1),
                    lambda x: F.concat(x["head"], x["body"], tail),
                ),
                "",
            ),
        )
    )
    before = F.concat("context", F.col("last.head"))
    return exploded.select(
        "conv_id",
        "example",
        "n_examples",
        F.concat(before, F.col("last.body"), tail).alias("formatted"),
        F.when(F.col("last.is_target"), F.length(before)).alias("loss_from"),
        F.when(F.col("last.is_target"), F.length("last.body")).otherwise(0).alias("loss_chars"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, replies, formatted_chars) from the examples alone.

    ``turns`` are (role, text) of the whole conversation, from its last example, which has
    all of them. ``replies`` are the texts under the loss masks, in order.
    """
    is_last = F.col("example") == F.col("n_examples") - 1
    own = formatted.select(
        "conv_id",
        "example",
        F.length("formatted").cast("long").alias("chars"),
        F.when(
            F.col("loss_from").isNotNull(),
            unescaped(F.substring("formatted", F.col("loss_from") + 1, F.col("loss_chars"))),
        ).alias("reply"),
        F.when(is_last, F.col("formatted")).alias("whole"),
    )
    gathered = own.groupBy("conv_id").agg(
        F.max("whole").alias("whole"),
        F.sort_array(
            F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply")))
        ).alias("replies"),
        F.sum("chars").alias("formatted_chars"),
    )
    # What stands behind the last end is empty.
    parts = F.split("whole", r"<\|im_end\|>\n", -1)
    rendered = F.slice(parts, F.lit(1), F.size(parts) - 1)
    turns = F.transform(
        rendered,
        lambda x: F.struct(
            parsed_role(F.substring_index(x, "\n", 1)).alias("role"),
            unescaped(F.substring(x, F.instr(x, F.lit("\n")) + 1, F.length(x))).alias("text"),
        ),
    )
    return gathered.select("conv_id", turns.alias("turns"), "replies.reply", "formatted_chars").withColumnRenamed(
        "reply", "replies"
    )
