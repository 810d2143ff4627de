"""Reward statistics of rollouts: yields, coverage, advantages, groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from rollweave.operators.cells import within
from rollweave.schemas import CELL

MIN_STD = 0.05


def env_yield(rollouts: DataFrame, since: Column, min_std: float = MIN_STD, envs=None) -> DataFrame:
    """For each environment its cells of two or more rewarded rollouts, those whose rewards vary, and their share."""
    recent = within(rollouts, env_name=envs).where((F.col("status") == "ok") & F.col("reward").isNotNull() & (F.col("created_at") > since))
    cells = recent.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("reward").alias("sd")).where("n >= 2")
    out = cells.groupBy("env_name").agg(F.count(F.lit(1)).alias("n_cells"), F.count_if(F.col("sd") >= min_std).alias("n_varied"))
    return out.withColumn("yield", F.col("n_varied") / F.col("n_cells"))


def coverage(rollouts: DataFrame, env_name: str | None = None) -> DataFrame:
    """Ok rollouts by teacher and task, of one environment if it is named: environments use the same task ids for other tasks."""
    rows = rollouts if env_name is None else rollouts.where(F.col("env_name") == env_name)
    return rows.where("status = 'ok'").groupBy("teacher_name", "task_id").agg(F.count(F.lit(1)).alias("n"))


def coverage_by_env(rollouts: DataFrame) -> DataFrame:
    """coverage() of every environment in one pass."""
    return rollouts.where("status = 'ok'").groupBy("env_name", "teacher_name", "task_id").agg(F.count(F.lit(1)).alias("n"))


def coverage_matrix(rollouts: DataFrame, teachers: list[str]) -> DataFrame:
    """A row for each task, a column for each named teacher."""
    return rollouts.where("status = 'ok'").groupBy("task_id").pivot("teacher_name", teachers).count()


def cell_rewards(rollouts: DataFrame) -> DataFrame:
    """For each cell its ok rollouts, and mean and population deviation of their rewards: 0 without, or for the deviation below two, rewards."""
    sums = rollouts.where("status = 'ok'").groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("n_rollouts"), F.count("reward").alias("n_rewards"), F.avg("reward").alias("m"), F.stddev_pop("reward").alias("s")
    )
    std = F.when(F.col("n_rewards") >= 2, F.col("s")).otherwise(0.0)
    return sums.select(*CELL, "n_rollouts", "n_rewards", F.coalesce("m", F.lit(0.0)).alias("reward_mean"), std.alias("reward_std"))


def advantages(rollouts: DataFrame, by_teacher: bool = False, by_env: bool = False) -> DataFrame:
    """Rewarded rollouts with the z-score of their reward within the task (and teacher, and environment): 0 in groups of one or of equal rewards.

    Groups are summed where their rows lie and joined back, so a task with a third of all rollouts is never sorted in one place.
    """
    group = [*(["env_name"] if by_env else []), "task_id", *(["teacher_name"] if by_teacher else [])]
    rewarded = rollouts.where("reward is not null")
    sums = rewarded.groupBy(*(F.col(c).alias(f"_{c}") for c in group)).agg(
        F.count(F.lit(1)).alias("group_n"), F.avg("reward").alias("group_mean"), F.stddev_pop("reward").alias("group_std")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
    rewarded = rewarded.join(sums, same).drop(*(f"_{c}" for c in group))
    varied = (F.col("group_n") >= 2) & (F.col("group_std") > 0)
    return rewarded.withColumn("advantage", F.when(varied, (F.col("reward") - F.col("group_mean")) / F.col("group_std")).otherwise(0.0))


def group_stats(rollouts: DataFrame, by_teacher: bool = True) -> DataFrame:
    group = ["task_id", *(["teacher_name"] if by_teacher else [])]
    return rollouts.where("reward is not null").groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg("reward").alias("mean"), F.stddev_pop("reward").alias("std"), F.min("reward").alias("min"), F.max("reward").alias("max")
    )


def mining_groups(rollouts: DataFrame, envs=None, teachers=None, since: Column | None = None) -> DataFrame:
    """For each cell its ok rollouts in order of sample_idx, as one array; a cell holds some target_samples of them."""
    found = within(rollouts, env_name=envs, teacher_name=teachers).where("status = 'ok'")
    if since is not None:
        found = found.where(F.col("created_at") >= since)
    members = F.array_sort(F.collect_list(F.struct("sample_idx", "rollout_id", "reward")))
    return found.groupBy(*CELL).agg(members.alias("rollouts"))


def group_labels(rollouts: DataFrame) -> DataFrame:
    """A cell's kind of rewarded group: singleton, all_win, all_lose, degenerate or paired. Names are given; these rules are this engine's own."""
    sums = rollouts.where("status = 'ok' and reward is not null").groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("n"), F.min("reward").alias("low"), F.max("reward").alias("high")
    )
    label = (
        F.when(F.col("n") == 1, "singleton").when(F.col("low") >= 1, "all_win").when(F.col("high") <= 0, "all_lose")
        .when(F.col("low") == F.col("high"), "degenerate").otherwise("paired")
    )
    return sums.select(*CELL, "n", label.alias("group_label"))


def with_group_labels(rollouts: DataFrame, labels: DataFrame) -> DataFrame:
    new = labels.select(*CELL, F.col("group_label").alias("new_label"))
    old = F.col("group_label") if "group_label" in rollouts.columns else F.lit(None).cast("string")
    return rollouts.join(new, CELL, "left").withColumn("group_label", F.coalesce("new_label", old)).drop("new_label")
