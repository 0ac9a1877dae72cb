"""Reply trees as edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def replies_of(messages: DataFrame) -> DataFrame:
    """Replies with the message they belong to, which becomes their top id.

    One row per reply instead of a list per message, so a message with very
    many replies stays spread. Input: channel, message_id, reply_to, date, text.
    """
    parents = messages.select("channel", F.col("message_id").alias("top_id"))
    replies = messages.where(F.col("reply_to").isNotNull()).withColumnRenamed("reply_to", "top_id")
    return replies.join(parents, ["channel", "top_id"])


def reply_counts(replies: DataFrame) -> DataFrame:
    return replies.groupBy("channel", "top_id").agg(
        F.count("*").alias("replies"), F.max("message_id").alias("last_reply")
    )


def thread_table(comments: DataFrame, id_: str = "id", parent: str = "parent_id") -> DataFrame:
    """Depth and root of each comment, with its number of direct replies.

    Every round lets each comment jump as far again as it has come, so depth d
    takes about log2(d) joins. Comments that reached their root leave the
    join, and orphans of unknown parents are dropped with their replies.
    """
    nodes = comments.select(F.col(id_).alias("id"), F.col(parent).alias("up"))
    known = nodes.select(F.col("id").alias("up"))
    done = nodes.where(F.col("up").isNull()).select("id", F.col("id").alias("root"), F.lit(0).alias("depth"))
    open_ = nodes.join(known, "up", "left_semi").withColumn("steps", F.lit(1))
    done, open_ = stored(done), stored(open_)
    left = open_.count()
    while left:
        at_root = done.select(F.col("id").alias("up"), "root", "depth")
        onward = open_.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        step = open_.join(at_root, "up", "left").join(onward, "up", "left")
        step = stored(step)
        reached = step.where(F.col("root").isNotNull()).select(
            "id", "root", (F.col("depth") + F.col("steps")).alias("depth")
        )
        reached = stored(reached)  # a part for each round, so finished rows are written once
        done = done.unionByName(reached)
        open_ = step.where(F.col("root").isNull() & F.col("next").isNotNull()).select(
            "id", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps")
        )
        open_ = stored(open_)
        remaining = open_.count()
        if remaining == left and reached.isEmpty():
            break
        left = remaining
    answers = comments.where(F.col(parent).isNotNull()).groupBy(F.col(parent).alias("id")).agg(
        F.count("*").alias("replies")
    )
    table = done.join(nodes, "id").withColumnRenamed("up", "parent")
    table = table.join(answers, "id", "left").withColumn("replies", F.coalesce("replies", F.lit(0)))
    return table.select("id", "parent", "root", "depth", "replies")
