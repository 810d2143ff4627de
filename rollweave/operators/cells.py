"""Cells (env, task, teacher) of a sampling list: predicates, counts, claims and freezing.

``as_of`` stands for the present, so that results repeat. Every predicate is a filter that reaches the scan; nothing but
the claim of a single producer orders the whole table, and that is a top-k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.schemas import CELL, LISTED_CELL

CELL_TTL_S = 21_600
SETTLE_S = 300
IN_FLIGHT_SLACK = 4
FREEZE_LATEST = 4
MOST_TEACHERS = 10_000


def before(as_of: Column, seconds: int | Column) -> Column:
    return as_of - F.make_dt_interval(secs=seconds if isinstance(seconds, Column) else F.lit(seconds))


def open_(target: str = "target_samples") -> Column:
    """Below target and within the attempt budget."""
    return (F.col("collected") < F.col(target)) & (F.col("attempts") < 2 * F.col(target))


def is_active(as_of: Column, ttl_s: int | Column = CELL_TTL_S) -> Column:
    return F.col("published_at").isNull() & open_() & (F.col("last_updated") >= before(as_of, ttl_s))


def is_zombie(as_of: Column, ttl_s: int = CELL_TTL_S) -> Column:
    return open_() & (F.col("last_updated") < before(as_of, ttl_s))


def is_pending(as_of: Column, ttl_s: int = CELL_TTL_S, settle_s: int = SETTLE_S) -> Column:
    """Frozen but not marked: complete, out of attempts and settled, or a zombie."""
    spent = (F.col("attempts") >= 2 * F.col("target_samples")) & (F.col("last_updated") < before(as_of, settle_s))
    return F.col("published_at").isNull() & ((F.col("collected") >= F.col("target_samples")) | spent | is_zombie(as_of, ttl_s))


def within(df: DataFrame, **allowed: Sequence | None) -> DataFrame:
    """Rows whose columns are in the given values; an empty or missing list allows all."""
    for column, values in allowed.items():
        if values:
            df = df.where(F.col(column).isin(list(values)))
    return df


def active(progress: DataFrame, as_of: Column, ttl_s: int = CELL_TTL_S, list_name: str | None = None) -> DataFrame:
    return within(progress, list_name=[list_name] if list_name else None).where(is_active(as_of, ttl_s))


def active_by_env(progress: DataFrame, as_of: Column, ttl_s: int = CELL_TTL_S, list_name: str | None = None) -> DataFrame:
    return active(progress, as_of, ttl_s, list_name).groupBy("env_name").agg(F.count(F.lit(1)).alias("n_active"))


def active_by_list(progress: DataFrame, pool: DataFrame, as_of: Column) -> DataFrame:
    """(list_name, env_name, n_active) of the pool's environments, each list by its own cell_ttl_s. pool: a row for each list and environment."""
    found = progress.join(pool.select("list_name", "env_name", "cell_ttl_s"), ["list_name", "env_name"]).where(is_active(as_of, F.col("cell_ttl_s")))
    return found.groupBy("list_name", "env_name").agg(F.count(F.lit(1)).alias("n_active"))


def pending(progress: DataFrame, as_of: Column, ttl_s: int = CELL_TTL_S, lists=None, envs=None, teachers=None) -> DataFrame:
    """Pending cells with ``zombie``. Order them by pending_order() where an order is needed."""
    found = within(progress, list_name=lists, env_name=envs, teacher_name=teachers).where(is_pending(as_of, ttl_s))
    return found.withColumn("zombie", open_())


def pending_order() -> list[Column]:
    return [F.col(c) for c in ("last_updated", *LISTED_CELL)]


def open_progress(progress: DataFrame) -> DataFrame:
    return progress.where("collected < target_samples")


def claimable(
    progress: DataFrame, list_name: str | None = None, envs=None, teachers=None, like: str | None = None, not_like: str | None = None,
    slack: int = IN_FLIGHT_SLACK,
) -> DataFrame:
    found = within(progress, list_name=[list_name] if list_name else None, env_name=envs, teacher_name=teachers)
    found = found.where(F.col("published_at").isNull() & open_() & (F.col("attempts") - F.col("collected") < slack))
    if like:
        found = found.where(F.col("env_name").like(like))
    if not_like:
        found = found.where(~F.col("env_name").like(not_like))
    return found


def _claim_order() -> list[Column]:
    """Nearly complete cells first. The last two make the order total."""
    return [F.desc("collected"), F.asc("attempts"), F.asc("task_id"), F.asc("env_name"), F.asc("teacher_name")]


def _claimed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("attempts", F.col("attempts") + 1).withColumn("slot", F.col("attempts") - 1)


def claim(progress: DataFrame, batch: int, **filters) -> DataFrame:
    """The cells that one producer takes: attempts counted, ``slot`` is the sample index to produce."""
    return _claimed(claimable(progress, **filters).orderBy(*_claim_order()).limit(batch))


def claim_each(progress: DataFrame, batch: int, by: Sequence[str] = ("list_name",), **filters) -> DataFrame:
    """The same for a producer for each value of ``by``, in one pass."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*_claim_order()))
    return _claimed(claimable(progress, **filters).withColumn("place", place).where(F.col("place") <= batch).drop("place"))


def with_claims(progress: DataFrame, claimed: DataFrame) -> DataFrame:
    """progress with the claimed cells' attempts; the others as they were."""
    new = claimed.select(*LISTED_CELL, F.col("attempts").alias("new_attempts"))
    joined = progress.join(new, LISTED_CELL, "left")
    return joined.withColumn("attempts", F.coalesce("new_attempts", "attempts")).drop("new_attempts")


def degenerate(rollouts: DataFrame, latest: int = FREEZE_LATEST) -> DataFrame:
    """Cells whose latest ``latest`` ok rollouts don't differ in reward. Rollouts without reward count as rollouts."""
    recent = Window.partitionBy(*CELL).orderBy(F.desc("created_at"), F.desc("sample_idx"))
    last = rollouts.where("status = 'ok'").withColumn("place", F.row_number().over(recent)).where(F.col("place") <= latest)
    spread = last.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n_recent"), F.coalesce(F.stddev_samp("reward"), F.lit(0.0)).alias("sd"))
    return spread.where((F.col("n_recent") >= latest) & (F.col("sd") == 0)).select(*CELL, "n_recent")


def freeze(progress: DataFrame, rollouts: DataFrame, as_of: Column, latest: int = FREEZE_LATEST) -> DataFrame:
    """progress with published_at set for unpublished degenerate cells, and ``frozen``."""
    joined = progress.join(degenerate(rollouts, latest), CELL, "left")
    frozen = F.col("n_recent").isNotNull() & F.col("published_at").isNull()
    return joined.withColumn("frozen", frozen).withColumn("published_at", F.when(F.col("frozen"), as_of).otherwise(F.col("published_at"))).drop("n_recent")


def backfill(progress: DataFrame, rollouts: DataFrame) -> DataFrame:
    """collected from the ok rollouts; cells without any keep what they have."""
    counted = rollouts.where("status = 'ok'").groupBy(*CELL).agg(F.count(F.lit(1)).alias("counted"))
    return progress.join(counted, CELL, "left").withColumn("collected", F.coalesce("counted", "collected")).drop("counted")


def increment(progress: DataFrame, deltas: DataFrame, as_of: Column) -> DataFrame:
    """Adds the summed ``delta`` of each listed cell to collected and touches last_updated."""
    sums = deltas.groupBy(*LISTED_CELL).agg(F.sum("delta").alias("delta_sum"))
    joined = progress.join(sums, LISTED_CELL, "left")
    touched = F.col("delta_sum").isNotNull()
    return joined.withColumns(
        {"collected": F.col("collected") + F.coalesce("delta_sum", F.lit(0)), "last_updated": F.when(touched, as_of).otherwise(F.col("last_updated"))}
    ).drop("delta_sum")


def sampling_list(environments: DataFrame, teachers: DataFrame, list_name: str, target: int, as_of: Column, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """A cell for each task of each environment's range, clipped to [lo, hi), and each teacher.

    The teachers' names come as one row of at most MOST_TEACHERS names, more are an error; it goes beside every task: an
    explode makes the product, no shuffle.
    """
    first = F.col("task_id_range.lo") if lo is None else F.greatest(F.col("task_id_range.lo"), F.lit(lo))
    last = F.col("task_id_range.hi") if hi is None else F.least(F.col("task_id_range.hi"), F.lit(hi))
    cells = environments.withColumns({"first": first, "last": last}).where("first < last")
    cells = cells.select("env_name", F.explode(F.expr("sequence(first, last - 1)")).alias("task_id"))
    names = teachers.select("teacher_name").distinct().limit(MOST_TEACHERS + 1).agg(F.array_sort(F.collect_set("teacher_name")).alias("names"))
    names = names.select(F.when(F.size("names") <= MOST_TEACHERS, F.col("names")).otherwise(F.raise_error(F.lit("too many teachers for one list"))).alias("names"))
    cells = cells.crossJoin(F.broadcast(names)).select("env_name", "task_id", F.explode("names").alias("teacher_name"))
    return cells.select(
        F.lit(list_name).alias("list_name"), *CELL, F.lit(target).alias("target_samples"), F.lit(0).alias("collected"), F.lit(0).alias("attempts"),
        as_of.alias("last_updated"),
    )


def environment(tasks: DataFrame, env_name: str, config: str, as_of: Column) -> DataFrame:
    """The environments row of a task set: its ids are 0 to the number of tasks."""
    n = tasks.where(F.col("env_name") == env_name).agg(F.count(F.lit(1)).cast("int").alias("n"))
    return n.select(F.lit(env_name).alias("env_name"), F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi")).alias("task_id_range"), F.lit(config).alias("config"), as_of.alias("created_at"))


def tasks_in_order(tasks: DataFrame, env_name: str, difficulty: str | None = None) -> DataFrame:
    return within(tasks, env_name=[env_name], difficulty=[difficulty] if difficulty else None).orderBy("task_id")


def ordered(table: DataFrame, *newest_first: str, then: str) -> DataFrame:
    """A listing: the given times descending, then a key, so that the order is total."""
    return table.orderBy(*(F.desc(c) for c in newest_first), then)
