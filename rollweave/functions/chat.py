"""Chat requests and responses as JSON, by native expressions, and the fields a rollout takes from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def request_messages(messages: Column) -> Column:
    """array<MESSAGE> as a JSON array of the wire's messages: null content is empty, calls go with assistants, ids with tools."""

    def one(m: Column) -> Column:
        tool, assistant = m["role"] == "tool", m["role"] == "assistant"
        calls = F.transform(
            m["tool_calls"],
            lambda c: F.struct(c["id"].alias("id"), F.lit("function").alias("type"), F.struct(c["name"].alias("name"), F.coalesce(F.try_parse_json(c["arguments"]), F.parse_json(F.lit("{}"))).alias("arguments")).alias("function")),
        )
        return F.struct(
            m["role"].alias("role"), F.coalesce(m["content"], F.lit("")).alias("content"), F.when(tool, m["tool_call_id"]).alias("tool_call_id"),
            F.when(assistant & (F.size(m["tool_calls"]) > 0), calls).alias("tool_calls"),
        )

    return F.to_json(F.transform(messages, one))


def response(body: Column) -> Column:
    """struct<text, finish_reason, tokens_in, tokens_out> of a response; what it lacks is null."""
    at = lambda p: F.get_json_object(body, p)
    return F.struct(
        at("$.choices[0].message.content").alias("text"), at("$.choices[0].finish_reason").alias("finish_reason"),
        at("$.usage.prompt_tokens").try_cast("long").alias("tokens_in"), at("$.usage.completion_tokens").try_cast("long").alias("tokens_out"),
    )


def usage_object(usage: Column) -> Column:
    """A usage text as a JSON object; {} for anything else."""
    return F.when(F.schema_of_variant(F.try_parse_json(usage)).startswith("OBJECT"), usage).otherwise(F.lit("{}"))


def rollout_input(task_id: Column, meta: Column) -> Column:
    """struct<prompt, answer, info, example_id> from a task's meta JSON; example_id defaults to the task's id."""
    at = lambda p: F.get_json_object(meta, p)
    return F.struct(
        at("$.prompt").alias("prompt"), at("$.answer").alias("answer"), F.coalesce(at("$.info"), F.lit("{}")).alias("info"),
        F.coalesce(at("$.example_id").try_cast("long"), task_id.cast("long")).alias("example_id"),
    )


def draws(key: Column, low: float, high: float, seed: int = 0) -> Column:
    """struct<temperature, seed>: uniform in [low, high) and in 0..2**31-1, from a hash of key, so that retries draw alike."""
    share = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 52)) / float(1 << 52)
    return F.struct((F.lit(low) + share * (high - low)).alias("temperature"), F.pmod(F.xxhash64(F.lit(seed + 1), key), F.lit(1 << 31)).alias("seed"))
