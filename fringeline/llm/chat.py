"""Chat formatting by prefix-target expansion, in DataFrame and SQL functions only.

Every assistant turn becomes an example of its own: all turns before it are the context, and only the reply is
trainable. Turns that no reply follows go into one more example without a trainable part, so that the output holds
every turn and can be read back.

A turn is ``<turn ROLE>``, a line feed, the text, ``</turn>`` and a line feed. Inside texts and roles each control
string, ``<turn`` or ``</turn`` behind any number of backslashes after its ``<``, gets one more backslash there; in roles
``&`` and line feeds become ``&amp;`` and ``&#10;``. Both are undone exactly.

Rows are ordered by (turn, role, text), nulls first; repeated rows are turns of their own. A null text or role is empty.
A null conv_id is a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?turn)", r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?turn)", r"<$1$2")


def _role_in(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("&"), F.lit("&amp;")), F.lit("\n"), F.lit("&#10;")))


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("&#10;"), F.lit("\n")), F.lit("&amp;"), F.lit("&"))


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, last, formatted, loss_start, loss_chars): the trainable span is in code points from 0.

    A conversation is one row from the grouping on; its examples are made one after another from it, in the same
    partition.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    talks = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    parts = F.transform("turns", lambda t: F.concat(F.lit("<turn "), _role_in(t["role"]), F.lit(">\n"), escape(t["text"]), F.lit(END)))
    replies = F.transform(F.filter(F.transform("turns", lambda t, i: F.struct((i + 1).alias("n"), t["role"].alias("role"))), lambda x: x["role"] == "assistant"), lambda x: F.struct(x["n"].alias("n"), F.lit(True).alias("reply")))
    rest = F.when(F.get("replies", F.size("replies") - 1)["n"].eqNullSafe(F.size("turns")), F.array().cast("array<struct<n:int,reply:boolean>>")).otherwise(F.array(F.struct(F.size("turns").alias("n"), F.lit(False).alias("reply"))))
    cut = talks.select("conv_id", "turns", parts.alias("parts"), replies.alias("replies")).select("conv_id", "turns", "parts", F.posexplode(F.concat("replies", rest)).alias("example", "cut"))
    n = F.col("cut.n")
    text = F.char_length(escape(F.element_at("turns", n)["text"]))
    made = cut.select("conv_id", "example", (n == F.size("turns")).alias("last"), "cut.reply", F.array_join(F.slice("parts", F.lit(1), n), "").alias("formatted"), text.alias("chars"))
    return made.select(
        "conv_id",
        "example",
        "last",
        "formatted",
        F.when(F.col("reply"), F.char_length("formatted") - len(END) - F.col("chars")).alias("loss_start"),
        F.when(F.col("reply"), F.col("chars")).otherwise(F.lit(0)).alias("loss_chars"),
    )


def turns_of(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted example."""
    pieces = F.split(formatted, END)
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            F.transform(F.array(F.substring_index(p, "\n", 1)), lambda h: _role_out(F.substr(h, F.lit(7), F.char_length(h) - 7)))[0].alias("role"),
            unescape(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
        ),
    )


def read_back(made: DataFrame) -> DataFrame:
    """What formatted examples say: per conversation n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    target = F.when(F.col("loss_start").isNotNull(), unescape(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_chars"))))
    told = made.select("conv_id", "example", target.alias("target"), F.char_length("formatted").alias("chars"), F.when(F.col("last"), F.col("formatted")).alias("whole"))
    one = told.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("example", "target")))).alias("targets"),
        F.max("whole").alias("whole"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("targets", lambda t: t["target"]), "")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return one.select("conv_id", turns_of(F.col("whole")).alias("turns"), loss.alias("loss"), "formatted_chars").select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
