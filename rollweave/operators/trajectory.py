"""Trajectories: agent events folded into steps, their usage, and thinking tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.functions.text import stripped

BREAKS = ("user.message", "tool.result")


def _buffer(events: Column, delta: str, done: str) -> Column:
    """What a turn's delta and done events of one kind leave: the last whole text and the deltas after it; null if none came."""
    whole = F.filter(events, lambda e: (e["type"] == done) & e["text"].isNotNull())
    last = F.coalesce(F.array_max(F.transform(whole, lambda e: e["seq"])), F.lit(-1))
    parts = F.filter(events, lambda e: ((e["type"] == delta) & (e["seq"] > last)) | ((e["type"] == done) & (e["seq"] == last)))
    return F.when(F.size(parts) > 0, F.array_join(F.transform(parts, lambda e: F.coalesce(F.when(e["type"] == delta, e["delta"]).otherwise(e["text"]), F.lit(""))), ""))


def fold(events: DataFrame, key: str = "session") -> DataFrame:
    """Agent events (key, seq, type and data columns) -> steps (key, turn, part, kind, text, reasoning, tool_calls, tool_call_id, exit_code).

    User messages and tool results end the assistant's turn and are steps of their own (part 1, after the turn's part 0).
    A turn is a step if any text, reasoning or call came in it; blank texts are null. Data columns that events lacks are
    null. Turns are numbered by the breaks before them: a window over a session, then one group for each turn.
    """
    fields = ("text", "delta", "call_id", "tool", "args", "result_summary", "exit_code")
    have = set(events.columns)
    rows = events.select(key, "seq", "type", *((F.col(c) if c in have else F.lit(None)).cast("int" if c == "exit_code" else "string").alias(c) for c in fields))
    is_break = F.col("type").isin(*BREAKS)
    order = Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("turn", F.coalesce(F.sum(is_break.cast("int")).over(order), F.lit(0)))
    turns = rows.where(~is_break).groupBy(key, "turn").agg(
        F.array_sort(F.collect_list(F.struct("seq", "type", "text", "delta", "call_id", "tool", "args"))).alias("e")
    )
    calls = F.transform(
        F.filter("e", lambda e: e["type"] == "tool.request"),
        lambda e: F.struct(F.coalesce(e["call_id"], F.lit("")).alias("id"), F.coalesce(e["tool"], F.lit("")).alias("name"), F.coalesce(e["args"], F.lit("{}")).alias("arguments")),
    )
    text, thought = _buffer(F.col("e"), "message.delta", "message.done"), _buffer(F.col("e"), "thinking.delta", "thinking.done")
    blank = lambda x: F.nullif(stripped(x), F.lit(""))
    assistant = turns.select(key, "turn", text.alias("t"), thought.alias("r"), calls.alias("tool_calls")).where("t is not null or r is not null or size(tool_calls) > 0")
    assistant = assistant.select(
        key, "turn", F.lit(0).alias("part"), F.lit("assistant").alias("kind"), blank(F.col("t")).alias("text"), blank(F.col("r")).alias("reasoning"), "tool_calls",
        F.lit(None).cast("string").alias("tool_call_id"), F.lit(None).cast("int").alias("exit_code"),
    )
    user = F.col("type") == "user.message"
    none = F.lit(None).cast("string")
    breaks = rows.where(is_break).select(
        key, "turn", F.lit(1).alias("part"), F.when(user, "user").otherwise("tool_result").alias("kind"),
        F.coalesce(F.when(user, F.col("text")).otherwise(F.col("result_summary")), F.lit("")).alias("text"), none.alias("reasoning"),
        F.array().cast("array<struct<id:string,name:string,arguments:string>>").alias("tool_calls"),
        F.when(~user, F.coalesce("call_id", F.lit(""))).alias("tool_call_id"), F.when(~user, F.coalesce("exit_code", F.lit(0))).alias("exit_code"),
    )
    return assistant.unionByName(breaks)


def with_prompt(steps: DataFrame, prompts: DataFrame, key: str = "session") -> DataFrame:
    """Adds the prompt (key, prompt) as a first user step where a session has no user step."""
    missing = prompts.join(steps.where("kind = 'user'").select(key).distinct(), key, "left_anti")
    first = missing.select(
        key, F.lit(-1).alias("turn"), F.lit(1).alias("part"), F.lit("user").alias("kind"), F.col("prompt").alias("text"), F.lit(None).cast("string").alias("reasoning"),
        F.array().cast("array<struct<id:string,name:string,arguments:string>>").alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"), F.lit(None).cast("int").alias("exit_code"),
    )
    return steps.unionByName(first)


def usage(events: DataFrame, key: str = "session") -> DataFrame:
    """Summed tokens, model calls (every message.done) and error texts in order."""
    of = lambda kind, x: F.when(F.col("type") == kind, x)
    have = set(events.columns)
    col = lambda c, kind: F.col(c) if c in have else F.lit(None).cast(kind)
    errors = F.array_sort(F.collect_list(of("error", F.struct("seq", F.coalesce(col("message", "string"), F.lit("")).alias("m")))))
    return events.groupBy(key).agg(
        F.coalesce(F.sum(of("usage", col("input_tokens", "long"))), F.lit(0)).alias("tokens_in"),
        F.coalesce(F.sum(of("usage", col("output_tokens", "long"))), F.lit(0)).alias("tokens_out"),
        F.count_if(F.col("type") == "message.done").alias("model_calls"),
        F.transform(errors, lambda e: e["m"]).alias("errors"),
    )


def thinking(text: Column) -> Column:
    """struct<content, reasoning>: <thinking> parts go to reasoning; what is left is stripped only if there were any. Blank becomes null."""
    tag = "(?is)<thinking>(.*?)</thinking>"
    parts = F.filter(F.transform(F.regexp_extract_all(text, F.lit(tag), F.lit(1)), stripped), lambda x: x != "")
    found = F.regexp_count(text, F.lit(tag)) > 0
    rest = F.when(found, stripped(F.regexp_replace(text, tag, ""))).otherwise(text)
    return F.struct(F.nullif(rest, F.lit("")).alias("content"), F.nullif(F.array_join(parts, "\n"), F.lit("")).alias("reasoning"))
