"""Chat formatting of reply trees, with DataFrame operations only.

A message answers its parent. Self-joins that double their reach each time (a message's
jump goes 1, 2, 4 ... messages up; only messages below that depth still take part) give every message its depth and the score of its path;
the leaves of a tree are ranked by that score, and the same jumps, largest first, list the
messages of each chosen root-to-leaf path exactly once. Each path becomes one text:

    ### <role>: <text></turn>\\n      for every message

Inside texts a backslash, a pair of ``#`` and ``</turn>`` are escaped, so no text can hold
a control string; ``read_back`` undoes it. Roles are URL-encoded. ``loss_spans`` marks what
a model learns from: the assistant's texts, as code-point spans in their turn's piece of
the output.

Defined results: null turns come first; null texts and roles count as empty; a parent that does not exist makes a
root; messages in a cycle have no root and so no path; repeated ids of one tree keep the
smallest row; rows of a null conversation id form one conversation; an empty table gives
no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage

TURN, ROLE_END, END = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    """Text without any control string."""
    c = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit("##"), F.lit("#\\#"))
    return F.replace(c, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#/])", "$1")


def linear(conversations: DataFrame) -> DataFrame:
    """Rows by turn as trees without branches: every row answers the one before.

    Rows of one turn follow each other by role and text.
    """
    c = conversations.select(
        F.col("conv_id").alias("conv_id"), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("tree"),
        F.col("turn").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    at = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    return c.select("conv_id", "tree", at.alias("id"), "role", "text").withColumn(
        "parent", F.when(F.col("id") > 1, F.col("id") - 1)).withColumn("score", F.lit(0.0))


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """``tree, path, id, depth`` of the ``best`` root-to-leaf paths of every tree.

    ``messages`` has tree (string), id, parent (long) and score; a path's score is the sum
    over its messages, ties go to the smaller leaf id, ``path`` counts from 1.
    """
    one = (messages.where("tree IS NOT NULL AND id IS NOT NULL").groupBy("tree", "id")
           .agg(F.min(F.struct("parent", "score")).alias("m")).select("tree", "id", "m.parent", F.coalesce("m.score", F.lit(0.0)).alias("score")))
    one = stage(one, "messages")
    parents = one.select("tree", F.col("id").alias("parent"), F.lit(True).alias("known"))
    up = stage(one.join(parents, ["tree", "parent"], "left").select(
        "tree", "id", F.when(F.col("known"), F.col("parent")).alias("jump"), "score", F.lit(1).cast("long").alias("depth")), "jumps")
    # open: messages that have not reached their root yet; whole: those that have
    whole, opened, jumps, open_before = up.where("jump IS NULL"), up.where("jump IS NOT NULL"), [], None
    while True:
        still = opened.count()
        if still == 0 or still == open_before:  # what is left goes round in cycles
            break
        open_before = still
        jumps.append(opened.select("tree", "id", "jump"))
        further = opened.union(whole).select(
            "tree", F.col("id").alias("jump"), F.col("jump").alias("jump2"), F.col("score").alias("score2"), F.col("depth").alias("depth2"))
        now = stage(opened.join(further, ["tree", "jump"]).select(
            "tree", "id", F.col("jump2").alias("jump"), (F.col("score") + F.col("score2")).alias("score"),
            (F.col("depth") + F.col("depth2")).alias("depth")), "jumps")
        whole, opened = whole.union(now.where("jump IS NULL")), now.where("jump IS NOT NULL")
    answered = up.where("jump IS NOT NULL").select("tree", F.col("jump").alias("id")).distinct()
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "id"))
    chosen = (whole.join(answered, ["tree", "id"], "left_anti").withColumn("path", rank)
              .where(F.col("path") <= best).select("tree", "path", "id"))
    for level in reversed(jumps):
        chosen = stage(chosen.union(chosen.join(level, ["tree", "id"]).select("tree", "path", F.col("jump").alias("id"))), "paths")
    return chosen.join(whole.select("tree", "id", "depth"), ["tree", "id"])


def format_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """``conv_id, path, formatted, loss_spans`` of every chosen path.

    ``messages`` has conv_id, tree, id, parent, role, text and score.
    """
    messages = stage(messages.select("conv_id", "tree", "id", "parent", "role", "text", "score"), "chat")
    head = F.concat(F.lit(TURN), F.url_encode(F.coalesce("role", F.lit(""))), F.lit(ROLE_END))
    body = escape(F.coalesce("text", F.lit("")))
    texts = (messages.groupBy("tree", "id").agg(F.min(F.struct("parent", "score", "role", "text", "conv_id")).alias("m"))
             .select("tree", "id", "m.role", "m.text", "m.conv_id")
             .select("tree", "id", "conv_id", F.coalesce("role", F.lit("")).alias("role"), head.alias("head"), body.alias("body")))
    turns = (paths(messages, best).join(texts, ["tree", "id"])
             .groupBy("tree", "path").agg(F.first("conv_id").alias("conv_id"),
                                          F.sort_array(F.collect_list(F.struct("depth", "role", "head", "body"))).alias("turns")))
    spans = F.transform("turns", lambda t, i: F.struct(
        i.alias("turn"), F.length(t["head"]).alias("start"), (F.length(t["head"]) + F.length(t["body"])).alias("end"), t["role"].alias("role")))
    return turns.select(
        "conv_id", "path",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["role"] == "assistant"),
                    lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["end"].alias("end"))).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role, text) and ``loss_texts``, parsed from the output alone."""
    role = lambda p: F.substring_index(F.substring(p, len(TURN) + 1, 1 << 30), ROLE_END, 1)
    pieces = F.split("formatted", END, -1)
    return (formatted.withColumn("_pieces", F.slice(pieces, F.lit(1), F.size(pieces) - 1))
            .withColumn("turns", F.transform("_pieces", lambda p: F.struct(
                F.url_decode(role(p)).alias("role"),
                unescape(F.substr(p, F.length(role(p)) + F.lit(len(TURN) + len(ROLE_END) + 1))).alias("text"))))
            .withColumn("loss_texts", F.transform("loss_spans", lambda s: unescape(
                F.substr(F.element_at("_pieces", s["turn"] + 1), s["start"] + 1, s["end"] - s["start"]))))
            .drop("_pieces"))


def op3_chat(conversations: DataFrame) -> DataFrame:
    """Counts and digests of all conversations, read back from the formatted text."""
    back = read_back(format_paths(linear(conversations)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
