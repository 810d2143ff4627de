"""Filters, ordered lists and point lookups over the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.operators.cells import within
from rollweave.schemas import KEYS

#: How each table is listed.
ORDER = {
    "environments": (F.asc, "env_name"), "tasks": (F.asc, "task_id"), "rollouts": (F.asc, "sample_idx"), "student_scores": (F.desc_nulls_last, "started_at"),
    "pairs": (F.desc, "created_at"), "student_submissions": (F.desc, "submitted_at"), "student_deployments": (F.desc, "created_at"),
}


def active_teachers(teachers: DataFrame) -> DataFrame:
    return teachers.where(F.coalesce(F.col("active"), F.lit(False)))


def valid_submissions(submissions: DataFrame) -> DataFrame:
    return submissions.where(F.coalesce(F.col("is_valid"), F.lit(False)))


def with_status(rows: DataFrame, *statuses: str) -> DataFrame:
    """Rows of any of the statuses; of all without any."""
    return within(rows, status=statuses)


def by_key(table: str, rows: DataFrame, *values) -> DataFrame:
    """The row of a table's key; none if there is no such row."""
    if len(values) != len(KEYS[table]):
        raise ValueError(f"{table} has the key {', '.join(KEYS[table])}")
    for column, value in zip(KEYS[table], values, strict=True):
        rows = rows.where(F.col(column) == value)
    return rows


def by_model_hash(submissions: DataFrame, model_hash: str | Column) -> DataFrame:
    """Submissions of a model, whoever made them."""
    return submissions.where(F.col("model_hash") == model_hash)


def listed(table: str, rows: DataFrame, limit: int | None = None) -> DataFrame:
    """A table in its order, equal places by key; with ``limit`` its first rows, without sorting the rest."""
    way, column = ORDER[table]
    ordered = rows.orderBy(way(column), *KEYS[table])
    return ordered if limit is None else ordered.limit(limit)
