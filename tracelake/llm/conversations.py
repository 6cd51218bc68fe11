"""Rebuilding conversations from message rows.

The rows of a session are what was saved of it: most once, some again, some late. Each row becomes a message hash of (session,
role, instant, call id, calls, content), and rows with one hash are one message. This is de-duplication by message hashes, not
a matching of suffixes and prefixes: the rows carry no fragment that could overlap another one (the README has the figures).
The order is that of the instants, a tool message without a later time of its own right behind the call it answers.
Conversations with a gap are dropped: a call without its one result, a result without its call, a user without a visible
reply, a foreign role or a start that isn't a user's.

No step brings a session into one task: call links are joined on (session, call), running counts go over ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.text import block_text, instant, read_calls, visible
from tracelake.operators.ordered import running_counts
from tracelake.session import written

ROLES = ("user", "assistant", "tool")


def _framed(*names: str):
    """The fields as one text from which each can be told."""
    return F.concat(*(F.coalesce(F.concat(F.octet_length(n).cast("string"), F.lit(":"), F.col(n).cast("string")), F.lit("-")) for n in names))


def messages(events: DataFrame) -> DataFrame:
    """One row per message hash: ``session_key, event_id`` (the smallest), ``role, at, call_id, calls, seen``."""
    rows = events.select(
        "session_key",
        "event_id",
        F.lower(F.regexp_replace("role", r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")).alias("role"),
        instant(F.col("timestamp_iso")).alias("at"),
        F.col("tool_call_id").alias("call_id"),
        "tool_calls",
        "content",
    ).where("session_key is not null and event_id is not null")
    calls = read_calls(F.col("tool_calls"))
    rows = rows.select("session_key", "event_id", "role", "at", "call_id", F.unhex(F.md5(_framed("role", "at", "call_id", "tool_calls", "content"))).alias("hash"), calls.alias("calls"), "content")
    seen = F.when((F.col("role") == "assistant") & F.col("calls").isNull(), visible(block_text(F.col("content")))).otherwise(F.lit(False))
    rows = rows.withColumn("seen", seen).drop("content")
    return rows.groupBy("session_key", "hash").agg(F.min("event_id").alias("event_id"), *(F.first(c).alias(c) for c in ("role", "at", "call_id", "calls", "seen")))


def conversations(events: DataFrame) -> DataFrame:
    """Messages of the conversations kept: ``session_key, turn_no`` (from 1), ``event_id, role``.

    A row without session or event id is left out. A message other than a tool's without a readable time can't be
    ordered, its conversation is dropped as broken. Equal instants follow the event id. Two calls with one id in a
    session can't be told apart, the conversation is dropped. Repeated rows count once; further columns are ignored.
    An empty table gives an empty result.
    """
    every = written(messages(events.select("session_key", "event_id", "role", "content", "tool_calls", "tool_call_id", "timestamp_iso")), "messages")
    broken = F.coalesce(~F.col("role").isin(*ROLES), F.lit(True)) | (F.col("at").isNull() & (F.col("role") != "tool")) | ((F.col("role") == "tool") & F.col("call_id").isNull()) | F.exists("calls", lambda x: x.isNull())
    asks = (F.col("role") == "user").cast("int")
    sound = every.groupBy("session_key").agg(F.max(F.coalesce(broken, F.lit(False)).cast("int")).alias("broken"), F.max(asks).alias("asked"), F.max(F.col("seen").cast("int")).alias("answered")).where("broken = 0 and asked = 1 and answered = 1")

    # calls and their results, one row for each (session, call)
    made = every.where("calls is not null").select("session_key", F.posexplode("calls").alias("ix", "call_id"), F.struct(F.col("at").alias("at"), F.col("event_id").alias("event_id")).alias("by"))
    ends = made.select("session_key", "call_id", F.struct("by", "ix").alias("call"), F.lit(0).alias("result")).unionByName(every.where("role = 'tool'").select("session_key", "call_id", F.lit(None).cast("struct<by: struct<at: bigint, event_id: bigint>, ix: int>").alias("call"), F.lit(1).alias("result")))
    links = written(ends.groupBy("session_key", "call_id").agg(F.count("call").alias("n_calls"), F.sum("result").alias("n_results"), F.min("call").alias("call")), "links")
    gaps = links.where("n_calls <> 1 or n_results <> 1").select("session_key").distinct()
    kept = every.join(sound.select("session_key"), "session_key", "left_semi").join(gaps, "session_key", "left_anti")

    # a tool message without a later time of its own stands behind the message that made its call
    anchor = links.where("n_calls = 1 and n_results = 1").select("session_key", "call_id", "call")
    tools = kept.where("role = 'tool'").join(anchor, ["session_key", "call_id"])
    moved = F.col("at").isNull() | (F.col("at") <= F.col("call.by.at"))
    own = F.struct(F.col("at").alias("at"), F.col("event_id").alias("after"), F.lit(0).alias("sub"), F.lit(0).alias("ix"))
    behind = F.struct(F.col("call.by.at").alias("at"), F.col("call.by.event_id").alias("after"), F.lit(1).alias("sub"), F.col("call.ix").alias("ix"))
    place = F.when(moved, behind).otherwise(own)
    ordered = kept.where("role <> 'tool'").select("session_key", "event_id", "role", "seen", own.alias("place")).unionByName(tools.select("session_key", "event_id", "role", "seen", place.alias("place")))
    numbered = running_counts(ordered, "session_key", [F.col("place.at"), F.col("place.after"), F.col("place.sub"), F.col("place.ix"), F.col("event_id")], {"turn_no": F.lit(1), "question": asks})
    replied = numbered.groupBy("session_key", "question").agg(F.max(F.col("seen").cast("int")).alias("replied")).where("question = 0 or replied = 0").select("session_key").distinct()
    return numbered.join(replied, "session_key", "left_anti").select("session_key", F.col("turn_no").cast("int").alias("turn_no"), "event_id", "role")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return conversations(spark.read.parquet(f"{folder}/session_events.parquet")).select("session_key", "turn_no", "event_id")


def p2_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations with their texts: ``session_key, turn_no, role, content, tool_call_id, timestamp_iso``."""
    events = spark.read.parquet(f"{folder}/session_events.parquet")
    kept = written(conversations(events), "conversations")
    # of the texts only those of kept messages are brought together
    texts = events.select("event_id", "content", "tool_call_id", "timestamp_iso").join(kept.select("event_id"), "event_id", "left_semi").dropDuplicates(["event_id"])
    return kept.join(texts, "event_id").select("session_key", "turn_no", "role", "content", "tool_call_id", "timestamp_iso")
