"""Preference pairs and students' scores. Names and contracts are given; how pairs are picked is this engine's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.operators.cells import within
from rollweave.schemas import CELL


def best_and_worst(rollouts: DataFrame, min_gap: float = 0.0) -> DataFrame:
    """For each cell its best and worst rewarded rollout, ties to the smaller id, where the gap is above min_gap."""
    best = F.max_by("rollout_id", F.struct("reward", -F.col("rollout_id")))
    worst = F.min_by("rollout_id", F.struct("reward", "rollout_id"))
    sums = rollouts.where("status = 'ok' and reward is not null").groupBy(*CELL).agg(
        best.alias("win_rollout_id"), worst.alias("lose_rollout_id"), (F.max("reward") - F.min("reward")).alias("reward_gap")
    )
    key = F.concat_ws("|", "env_name", F.col("task_id").cast("string"), "teacher_name")
    return sums.where(F.col("reward_gap") > min_gap).select(F.md5(key).alias("pair_id"), *CELL, "win_rollout_id", "lose_rollout_id", "reward_gap")


def best_against_each(rollouts: DataFrame, min_gap: float = 0.0) -> DataFrame:
    """For each cell its best rewarded rollout, ties to the smaller id, against each of the others that is worse by more than min_gap."""
    rewarded = rollouts.where("status = 'ok' and reward is not null").select(*CELL, "rollout_id", "reward")
    best = rewarded.groupBy(*CELL).agg(F.max_by("rollout_id", F.struct("reward", -F.col("rollout_id"))).alias("win_rollout_id"), F.max("reward").alias("most"))
    gap = F.col("most") - F.col("reward")
    key = F.concat_ws("|", "env_name", F.col("task_id").cast("string"), "teacher_name", F.col("rollout_id").cast("string"))
    return rewarded.join(best, CELL).where(gap > min_gap).select(F.md5(key).alias("pair_id"), *CELL, "win_rollout_id", F.col("rollout_id").alias("lose_rollout_id"), gap.alias("reward_gap"))


#: Ways to pick pairs of a cell's rollouts, by name; add to it to extend. Each takes (rollouts, min_gap) and returns PAIR columns.
PAIR_STRATEGIES: dict[str, Callable[[DataFrame, float], DataFrame]] = {"best_and_worst": best_and_worst, "best_against_each": best_against_each}


def select_pairs(rollouts: DataFrame, min_gap: float = 0.0, strategy: str = "best_and_worst") -> DataFrame:
    """Pairs of a cell's rollouts: pair_id, the cell, win_rollout_id, lose_rollout_id and reward_gap."""
    return named(PAIR_STRATEGIES, strategy, "pair strategy")(rollouts, min_gap)


def named(registry: dict, name: str, kind: str):
    if name not in registry:
        raise ValueError(f"unknown {kind} {name!r}; known: {', '.join(sorted(registry))}")
    return registry[name]


def page(pairs: DataFrame, after: str | None, limit: int, envs=None, teachers=None, min_gap: float | None = None) -> DataFrame:
    """A keyset page: the next ``limit`` pairs by pair_id."""
    found = within(pairs, env_name=envs, teacher_name=teachers)
    if min_gap is not None:
        found = found.where(F.col("reward_gap") >= min_gap)
    if after is not None:
        found = found.where(F.col("pair_id") > after)
    return found.orderBy("pair_id").limit(limit)


def latest_scores(scores: DataFrame) -> DataFrame:
    w = Window.partitionBy("student", "revision", "pair_set").orderBy(F.desc("finished_at"), F.desc("run_id"))
    return scores.where("status = 'done'").withColumn("place", F.row_number().over(w)).where("place = 1").drop("place")


def leaderboard(scores: DataFrame, pair_set: str, limit: int = 50) -> DataFrame:
    found = latest_scores(scores.where(F.col("pair_set") == pair_set))
    return found.orderBy(F.desc("mean_score"), "student").limit(limit).select("student", "revision", "mean_score", "run_id")


def next_run(scores: DataFrame) -> DataFrame:
    """The queued run that is next: never started ones first, then the oldest."""
    return scores.where("status = 'queued'").orderBy(F.asc_nulls_first("started_at"), "run_id").limit(1)


def claim_next(scores: DataFrame, as_of: Column) -> DataFrame:
    """scores with its next run running since as_of; without a queued run as they were. One query is the table's only writer."""
    chosen = next_run(scores).select("run_id", F.lit(True).alias("_next"))
    found = scores.join(chosen, "run_id", "left")
    took = F.coalesce(F.col("_next"), F.lit(False))
    return found.withColumns({"status": F.when(took, "running").otherwise(F.col("status")), "started_at": F.when(took, as_of).otherwise(F.col("started_at"))}).select(*scores.columns)


def latest_by(rows: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(at), F.desc(tie))
    return rows.withColumn("place", F.row_number().over(w)).where("place = 1").drop("place")
