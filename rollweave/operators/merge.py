"""Writes as plans: each returns the table's new content, which a store then swaps in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.schemas import KEYS


def last_of(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """For each key the last row by ``order``, which should be total."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*(c.desc() for c in order)))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of incoming replace those of current with their key, except the columns of ``keep``, which a present row keeps.

    incoming has a row for each key at most (see last_of). Columns that incoming lacks stay, or are null in new rows.
    """
    there = [c for c in incoming.columns if c not in keys]
    new = incoming.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in there)).withColumn("_in", F.lit(True))
    both = current.withColumn("_at", F.lit(True)).join(new, list(keys), "full_outer")

    def value(c: str) -> Column:
        if c not in there:
            return F.col(c)
        take = F.col("_in") & F.col("_at").isNull() if c in keep else F.col("_in")
        return F.when(take, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return both.select(*(F.col(c) if c in keys else value(c) for c in current.columns))


def upsert_into(table: str, current: DataFrame, incoming: DataFrame, *order: Column) -> DataFrame:
    """upsert by a table's own key and the columns that it keeps; with ``order`` the last row of each key counts."""
    keys = KEYS[table]
    return upsert(current, last_of(incoming, keys, *order) if order else incoming, keys, KEPT.get(table, ()))


def insert_ignore(current: DataFrame, incoming: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The rows of incoming to append: their keys aren't in current. Of rows with one key the first by ``order``; without an
    order, that with the least values, so that the choice doesn't depend on partitions."""
    new = incoming.join(current.select(*keys), list(keys), "left_anti")
    by = order or [F.to_json(F.struct(*(c for c in incoming.columns if c not in keys)))] if len(incoming.columns) > len(keys) or order else [F.lit(0)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return new.withColumn("_place", place).where("_place = 1").drop("_place")


def update(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets the columns of changes in the rows with its keys; nulls of changes leave a column as it is."""
    columns = [c for c in changes.columns if c not in keys]
    new = changes.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in columns))
    out = current.join(new, list(keys), "left")
    return out.withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns}).select(*current.columns)


def mark_latest(scores: DataFrame, order: str = "finished_at") -> DataFrame:
    """is_latest for the last done run of each student, revision and set; false for all others."""
    done = F.col("status") == "done"
    w = Window.partitionBy("student", "revision", "pair_set").orderBy(done.desc(), F.col(order).desc_nulls_last(), F.desc("run_id"))
    return scores.withColumn("is_latest", (F.row_number().over(w) == 1) & done)


RUN = ("run_id", "student", "revision")


def mark_failed(scores: DataFrame, failures: DataFrame, as_of: Column) -> DataFrame:
    """Ends the runs that failures (run_id, student, revision, error) name: status failed, finished_at, and the error's first 2000 characters in config.

    All other members of config keep their JSON types; a config that is null or no object becomes one. A failure whose
    run, student or revision doesn't fit changes nothing; one without an error text notes an empty one.
    """
    named = failures.select(*RUN, F.left(F.coalesce("error", F.lit("")), F.lit(2000)).alias("_error")).dropDuplicates(list(RUN))
    joined = scores.join(named, list(RUN), "left")
    old = F.coalesce(F.from_json("config", "map<string,variant>"), F.from_json(F.lit("{}"), "map<string,variant>"))
    members = F.map_filter(old, lambda k, _: k != "error")
    text = F.to_json(members)
    noted = F.to_json(F.struct(F.col("_error").alias("error")))
    config = F.when(F.size(members) > 0, F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(","), F.substring(noted, 2, 1 << 30))).otherwise(noted)
    failed = F.col("_error").isNotNull()
    return joined.withColumns(
        {
            "status": F.when(failed, "failed").otherwise(F.col("status")), "config": F.when(failed, config).otherwise(F.col("config")),
            "finished_at": F.when(failed, as_of).otherwise(F.col("finished_at")),
        }
    ).select(*scores.columns)


#: Columns that a conflicting upsert leaves as they are.
KEPT = {
    "rollouts": ("group_label",),
    "student_submissions": ("submitted_by",),
    "student_scores": ("pair_set", "triggered_by", "started_at"),
    "student_deployments": ("student", "revision", "host", "gpu_indices"),
    "service_heartbeats": ("service", "started_at"),
}
