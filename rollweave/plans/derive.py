"""Rollout tables derived from the sample tables, in Spark and in the SQL that states the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.sources.scratch import new_folder

__all__ = ["new_folder"]
AS_OF = "2024-01-31 00:00:00"
TARGET = 3


def as_of() -> Column:
    return F.expr(f"timestamp_ntz'{AS_OF}'")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    status = F.when(k % 10 <= 6, "ok").when(k % 10 == 7, "env_error").when(k % 10 == 8, "teacher_error").otherwise("empty_completion")
    order = Window.partitionBy("env_name", "task_id", "teacher_name").orderBy("created_at", "rollout_id")
    return (
        table(spark, sf_dir, "events")
        .select(
            F.col("event_id").alias("rollout_id"),
            F.when(F.col("event_type") == "error", "swe-rebench").otherwise(F.concat(F.lit("verifiers:"), "event_type")).alias("env_name"),
            F.col("user_id").alias("task_id"),
            F.concat(F.lit("t"), (F.col("event_id") % 3).cast("string")).alias("teacher_name"),
            F.col("ts").alias("created_at"),
            status.alias("status"),
            F.when((k % 10 <= 6) & (k != 0), F.floor(F.least("value", F.lit(199.0)) / 50.0) / 4.0).cast("double").alias("reward"),
        )
        .withColumn("sample_idx", F.row_number().over(order) - 1)
    )


ROLLOUTS = """
rollouts AS (
  SELECT *, (row_number() OVER (PARTITION BY env_name, task_id, teacher_name ORDER BY created_at, rollout_id) - 1)::INTEGER AS sample_idx
  FROM (
    SELECT event_id AS rollout_id,
      CASE WHEN event_type = 'error' THEN 'swe-rebench' ELSE 'verifiers:' || event_type END AS env_name,
      user_id AS task_id, 't' || (event_id % 3) AS teacher_name, ts AS created_at,
      CASE WHEN k % 10 <= 6 THEN 'ok' WHEN k % 10 = 7 THEN 'env_error' WHEN k % 10 = 8 THEN 'teacher_error' ELSE 'empty_completion' END AS status,
      CASE WHEN k % 10 <= 6 AND k <> 0 THEN floor(least(value, 199.0) / 50.0) / 4.0 END::DOUBLE AS reward
    FROM (SELECT *, cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)))"""


def progress(rolls: DataFrame) -> DataFrame:
    task = F.col("task_id")
    return (
        rolls.groupBy("env_name", "task_id", "teacher_name")
        .agg(
            F.count(F.lit(1)).alias("attempts"),
            F.count_if(F.col("status") == "ok").alias("collected"),
            F.max("created_at").alias("last_updated"),
        )
        .withColumns(
            {
                "list_name": F.concat(F.lit("list-"), (task % 2).cast("string")),
                "target_samples": F.lit(TARGET).cast("long"),
                "published_at": F.when(task % 7 == 0, F.col("last_updated")),
                "promoted_at": F.when(task % 14 == 0, F.col("last_updated")),
            }
        )
    )


PROGRESS = f"""
progress AS (
  SELECT env_name, task_id, teacher_name, count(*) AS attempts, count(*) FILTER (status = 'ok') AS collected, max(created_at) AS last_updated,
    'list-' || (task_id % 2) AS list_name, {TARGET}::BIGINT AS target_samples,
    CASE WHEN task_id % 7 = 0 THEN max(created_at) END AS published_at,
    CASE WHEN task_id % 14 = 0 THEN max(created_at) END AS promoted_at
  FROM rollouts GROUP BY env_name, task_id, teacher_name)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "queued").otherwise("running")
    return o.select(
        F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("student"), F.lit("r1").alias("revision"),
        F.col("o_orderpriority").alias("pair_set"), F.col("o_totalprice").alias("mean_score"), status.alias("status"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")).alias("started_at"), F.col("o_orderdate").alias("finished_at"),
    )


SCORES = """
scores AS (
  SELECT o_orderkey AS run_id, o_custkey AS student, 'r1' AS revision, o_orderpriority AS pair_set, o_totalprice AS mean_score,
    CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'queued' ELSE 'running' END AS status,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS started_at, o_orderdate AS finished_at FROM orders)"""


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent events: session, seq, type, and the data fields that the type has."""
    kind = F.create_map(*(F.lit(x) for x in (
        "view", "message.delta", "click", "message.done", "signup", "tool.request", "purchase", "tool.result", "error", "usage")))
    e = table(spark, sf_dir, "events")
    word = F.concat(F.lit(" w"), F.col("event_id").cast("string"), F.lit(" "))
    return e.select(
        F.col("user_id").alias("session"),
        F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("seq"),
        kind[F.col("event_type")].alias("type"),
        F.when(F.col("event_type") == "view", word).alias("delta"),
        F.when((F.col("event_type") == "click") & (F.col("event_id") % 5 != 0), word).when(F.col("event_type") == "purchase", word).alias("text"),
        F.when((F.col("event_type") == "purchase") & (F.col("event_id") % 4 != 0), F.concat(F.lit("r"), F.col("event_id").cast("string"))).alias("result_summary"),
        F.col("event_id").cast("string").alias("call_id"),
        F.when(F.col("event_type") == "error", F.col("event_id") % 100).alias("input_tokens"),
    )


TRACE = """
trace AS (
  SELECT user_id AS session, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq,
    CASE event_type WHEN 'view' THEN 'message.delta' WHEN 'click' THEN 'message.done' WHEN 'signup' THEN 'tool.request'
      WHEN 'purchase' THEN 'tool.result' ELSE 'usage' END AS type,
    CASE WHEN event_type = 'view' THEN ' w' || event_id || ' ' END AS delta,
    CASE WHEN event_type = 'click' AND event_id % 5 <> 0 THEN ' w' || event_id || ' ' WHEN event_type = 'purchase' THEN ' w' || event_id || ' ' END AS text,
    CASE WHEN event_type = 'purchase' AND event_id % 4 <> 0 THEN 'r' || event_id END AS result_summary,
    event_id::VARCHAR AS call_id, CASE WHEN event_type = 'error' THEN event_id % 100 END AS input_tokens
  FROM events)"""


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("docs:"), F.col("lang")).alias("env_name"), F.col("doc_id").alias("task_id"), F.col("text").alias("problem")
    )


TASKS = "tasks AS (SELECT 'docs:' || lang AS env_name, doc_id AS task_id, text AS problem FROM documents)"


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    messages = F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content")))
    return c.groupBy("conv_id").agg(messages.alias("messages"))


def sql(body: str, *views: str) -> str:
    return f"WITH {', '.join(views)}\n{body}"
