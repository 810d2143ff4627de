from __future__ import annotations

import json

from pyspark.sql import functions as F

from rollweave.functions import chat, config
from rollweave.operators import cells
from rollweave.schemas import MESSAGE


def test_requests_and_responses(spark):
    rows = [([("user", None, None, [], None), ("assistant", "a", "r", [("1", "f", '{"x": 1}', False)], None), ("tool", "t", None, [], "1")],)]
    body = spark.createDataFrame(rows, f"m array<{MESSAGE}>").select(chat.request_messages(F.col("m")).alias("b")).first()["b"]
    assert json.loads(body) == [
        {"role": "user", "content": ""},
        {"role": "assistant", "content": "a", "tool_calls": [{"id": "1", "type": "function", "function": {"name": "f", "arguments": {"x": 1}}}]},
        {"role": "tool", "content": "t", "tool_call_id": "1"},
    ]
    got = spark.createDataFrame([('{"choices":[{"message":{"content":"hi"},"finish_reason":"stop"}],"usage":{"prompt_tokens":3}}',), ("{}",)], "b string").coalesce(1)
    assert [tuple(r["r"]) for r in got.select(chat.response(F.col("b")).alias("r")).collect()] == [("hi", "stop", 3, None), (None, None, None, None)]
    usage = spark.createDataFrame([('{"a":1}',), ("[1]",), ("x",), (None,)], "u string").coalesce(1)
    assert [r["o"] for r in usage.select(chat.usage_object(F.col("u")).alias("o")).collect()] == ['{"a":1}', "{}", "{}", "{}"]
    assert tuple(spark.range(7, 8).select(chat.rollout_input(F.col("id"), F.lit('{"answer": "4"}')).alias("r")).first()["r"]) == (None, "4", "{}", 7)
    drawn = spark.range(500).select(chat.draws(F.col("id"), 0.7, 1.2).alias("d")).select("d.*").collect()
    assert all(0.7 <= r["temperature"] < 1.2 and 0 <= r["seed"] < 1 << 31 for r in drawn) and len({r["seed"] for r in drawn}) > 490


def test_settings():
    assert config.merged({"a": {"b": 1, "c": 2}, "d": 1}, {"a": {"b": 3}, "d": {"x": 1}}) == {"a": {"b": 3, "c": 2}, "d": {"x": 1}}
    assert config.from_variables({"RW_DB__HOST": "h", "RW_DB__PORT": "1", "RW_X": "y", "OTHER": "z"}) == {"db": {"host": "h", "port": "1"}, "x": "y"}


def test_environment_rows(spark):
    tasks = spark.createDataFrame([("e", 2, "hard"), ("e", 1, "easy"), ("f", 1, "easy")], "env_name string, task_id int, difficulty string")
    row = cells.environment(tasks, "e", "{}", F.expr("timestamp_ntz'2024-01-01 00:00:00'")).first()
    assert tuple(row["task_id_range"]) == (0, 2)
    assert [r["task_id"] for r in cells.tasks_in_order(tasks, "e").collect()] == [1, 2]
    assert cells.tasks_in_order(tasks, "e", "hard").count() == 1
