"""What a rollout is made from: a claimed cell with its task and its teacher."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _needed(found: Column, value: Column, *message: Column) -> Column:
    return F.when(found.isNotNull(), value).otherwise(F.raise_error(F.concat(*message)).cast("string"))


def with_task_and_teacher(claimed: DataFrame, tasks: DataFrame, teachers: DataFrame) -> DataFrame:
    """claimed cells with ``task`` and ``teacher``, structs of the other columns of their rows; a missing one is an error.

    tasks has a row for each env_name and task_id, teachers for each teacher_name.
    """
    task = tasks.select("env_name", "task_id", F.struct(*(c for c in tasks.columns if c not in ("env_name", "task_id"))).alias("task"))
    teacher = teachers.select("teacher_name", F.struct(*(c for c in teachers.columns if c != "teacher_name")).alias("teacher"))
    found = claimed.join(task, ["env_name", "task_id"], "left").join(teacher, "teacher_name", "left")
    checked = _needed(F.col("task"), F.col("env_name"), F.lit("unknown task: "), F.col("env_name"), F.lit(":"), F.col("task_id").cast("string"))
    named = _needed(F.col("teacher"), F.col("teacher_name"), F.lit("unknown teacher: "), F.col("teacher_name"))
    return found.withColumns({"env_name": checked, "teacher_name": named}).select(*claimed.columns, "task", "teacher")
