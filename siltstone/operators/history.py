"""Conversation history by windows over (conv_id, turn)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.keys import strip

def by_turn() -> WindowSpec:
    return Window.partitionBy("conv_id").orderBy("turn")


def last_messages(conversations: DataFrame, n: int) -> DataFrame:
    """conv_id, turn, history: the n messages before each, oldest first, as labelled lines."""
    line = F.concat(F.col("role"), F.lit(': "'), F.col("text"), F.lit('"'))
    before = F.collect_list(line).over(by_turn().rowsBetween(-n, -1))
    return conversations.select("conv_id", "turn", F.array_join(before, "\n").alias("history"))


def domain_history(conversations: DataFrame, flagged: Column) -> DataFrame:
    """Turns without blank ones, flagged user turns and the assistant turns that answer those."""
    rows = conversations.where(strip(F.col("text")) != "").withColumn("flagged", F.coalesce(flagged & (F.col("role") == "user"), F.lit(False)))
    asked = F.last(F.when(F.col("role") == "user", F.col("flagged")), ignorenulls=True).over(by_turn().rowsBetween(Window.unboundedPreceding, -1))
    first_reply = F.lag("role").over(by_turn()) == "user"
    skipped = (F.col("role") == "assistant") & F.coalesce(asked, F.lit(False)) & F.coalesce(first_reply, F.lit(False))
    return rows.withColumn("skipped", skipped).where(~F.col("flagged") & ~F.col("skipped")).drop("flagged", "skipped")


def previous_exchange(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, question, answer: for each user turn the latest user turn that was answered at once before it."""
    is_pair = (F.col("role") == "user") & (F.lead("role").over(by_turn()) == "assistant")
    pair = F.when(is_pair, F.struct(F.col("text").alias("question"), F.lead("text").over(by_turn()).alias("answer")))
    rows = conversations.withColumn("pair", pair)
    last = F.last("pair", ignorenulls=True).over(by_turn().rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("last", last).where("role = 'user'").select("conv_id", "turn", "last.question", "last.answer")


def previous_questions(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, previous: the user's earlier questions."""
    own = conversations.where("role = 'user'")
    earlier = F.collect_list("text").over(by_turn().rowsBetween(Window.unboundedPreceding, -1))
    return own.select("conv_id", "turn", F.array_join(earlier, "\n").alias("previous"))


def chat_prompt(conversations: DataFrame, documents: Column, system: str) -> DataFrame:
    """conv_id, prompt: turn-marked history of up to 6 messages, then system text, documents and the last user turn."""
    mark = F.concat(F.lit("<start_of_turn>"), F.when(F.col("role") == "assistant", "model").otherwise(F.col("role")), F.lit("\n"), F.col("text"), F.lit("<end_of_turn>"))
    rows = conversations.where("role <> 'system'").withColumn("history", F.array_join(F.collect_list(mark).over(by_turn().rowsBetween(-6, -1)), "\n"))
    final = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("turn")))
    last = rows.where("role = 'user'").withColumn("r", final).where("r = 1")
    parts = [F.col("history"), F.concat(F.lit("<start_of_turn>user\n"), F.lit(system), F.lit("\n\n"), documents, F.lit("\n\n"), F.col("text"), F.lit("<end_of_turn>\n<start_of_turn>model\n"))]
    return last.select("conv_id", F.concat_ws("\n", F.nullif(parts[0], F.lit("")), parts[1]).alias("prompt"))


def valid_requests(conversations: DataFrame) -> DataFrame:
    """conv_id, valid: whether a conversation's last message is a user turn with content."""
    last = F.max_by(F.struct("role", "text"), F.col("turn"))
    rows = conversations.groupBy("conv_id").agg(last.alias("m"))
    return rows.select("conv_id", ((F.col("m.role") == "user") & (strip(F.col("m.text")) != "")).alias("valid"))


def trailing(events: DataFrame, key: str, at: str, seconds: int) -> DataFrame:
    """Rows with n (rows of the key in the ``seconds`` up to each) and first (the earliest of them); ``at`` is in whole seconds.

    Time is cut into buckets of ``seconds``; a row counts in its own bucket and is context in the next, so a task holds
    two buckets of a key however many rows the key has.
    """
    bucket = F.floor(F.col(at) / seconds)
    rows = events.withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False))))
    rows = rows.withColumn("_bucket", F.when(F.col("_own"), bucket).otherwise(bucket + 1))
    before = Window.partitionBy(key, "_bucket").orderBy(at).rangeBetween(1 - seconds, 0)
    return rows.withColumns({"n": F.count(F.lit(1)).over(before), "first": F.min(at).over(before)}).where("_own").drop("_own", "_bucket")


def positional_pairs(conversations: DataFrame) -> DataFrame:
    """conv_id, n, question, answer by position; conversations whose counts differ are dropped."""
    rows = conversations.where("role IN ('user', 'assistant')")
    n = F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn"))
    rows = rows.select("conv_id", "role", "text", n.alias("n"))
    counts = rows.groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("u"), F.count_if(F.col("role") == "assistant").alias("a")).where("u = a")
    wide = rows.groupBy("conv_id", "n").agg(
        F.max(F.when(F.col("role") == "user", F.col("text"))).alias("question"), F.max(F.when(F.col("role") == "assistant", F.col("text"))).alias("answer")
    )
    return wide.join(counts.select("conv_id"), "conv_id", "left_semi")
