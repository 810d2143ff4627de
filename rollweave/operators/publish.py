"""Publishing and promoting cells: what a cycle decides, as plans over the pending cells and the manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.operators.cells import pending_order
from rollweave.operators.stats import MIN_STD
from rollweave.schemas import CELL, LISTED_CELL, MANIFEST, SHARD, struct

MAX_NEW = 200
MAX_PER_CYCLE, MAX_PER_DAY, STAGE_DAYS = 200, 100, 1


def cell_rollouts(cells: DataFrame, rollouts: DataFrame) -> DataFrame:
    """The ok rollouts of the cells within their attempts: one join for all cells. A rollout counts for every list of its cell."""
    bounds = cells.select(*LISTED_CELL, F.col("attempts").alias("upto"))
    return rollouts.where("status = 'ok'").join(bounds, CELL).where("sample_idx < upto").drop("upto")


def classify(pending: DataFrame, rollouts: DataFrame, known: DataFrame, min_std: float = MIN_STD) -> DataFrame:
    """pending cells with n_rollouts, reward_mean, reward_std and action: recovered, empty, degenerate or commit, in this precedence.

    recovered: the manifest has the cell, only the mark was lost. Deviations are of the population, over non-null rewards.
    """
    sums = cell_rollouts(pending, rollouts).groupBy(*LISTED_CELL).agg(
        F.count(F.lit(1)).alias("n"), F.count("reward").alias("n_rewards"), F.avg("reward").alias("m"), F.stddev_pop("reward").alias("s")
    )
    seen = known.select(*LISTED_CELL).distinct().withColumn("seen", F.lit(True))
    rows = pending.join(sums, LISTED_CELL, "left").join(seen, LISTED_CELL, "left")
    mean, std = F.coalesce("m", F.lit(0.0)), F.coalesce(F.when(F.col("n_rewards") >= 2, F.col("s")), F.lit(0.0))
    action = F.when(F.col("seen"), "recovered").when(F.col("n").isNull(), "empty").when(std < min_std, "degenerate").otherwise("commit")
    return rows.withColumns(
        {"n_rollouts": F.coalesce("n", F.lit(0)), "reward_mean": F.bround(mean, 6), "reward_std": F.bround(std, 6), "action": action}
    ).drop("n", "n_rewards", "m", "s", "seen")


def plan_cycle(classified: DataFrame, next_idx: int, cap: int = MAX_NEW) -> DataFrame:
    """The cells that a cycle handles, with the dense task_idx of those that it commits.

    A cycle goes through the cells in pending order and stops right after its cap-th commit. The first ``cap`` commits
    are a distributed top-k; only they are numbered in one task, and the last of them bounds the cells handled.
    """
    order = pending_order()
    commits = classified.where("action = 'commit'").orderBy(*order).limit(cap)
    numbered = commits.select(*LISTED_CELL, (F.row_number().over(Window.orderBy(*order)) - 1 + next_idx).cast("long").alias("task_idx"))
    place = F.struct(*order)
    end = commits.agg(F.count(F.lit(1)).alias("n"), F.max(place).alias("last"))
    handled = classified.crossJoin(F.broadcast(end)).where((F.col("n") < cap) | (place <= F.col("last"))).drop("n", "last")  # end: one row
    return handled.join(numbered, LISTED_CELL, "left")


def object_key(task_idx: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(f"{prefix.rstrip('/')}/" if prefix else ""), F.lit("tasks/"), F.format_string("%08d", task_idx), F.lit(".parquet"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def manifest_entries(plan: DataFrame, committed_at: Column, root_uri: str, prefix: str = "", mature_after_s: int = 0) -> DataFrame:
    """The manifest's new lines as columns."""
    key = object_key(F.col("task_idx"), prefix)
    rows = plan.where("action = 'commit' and task_idx is not null").withColumns(
        {
            "committed_at": iso(committed_at), "mature_at": iso(committed_at + F.make_dt_interval(secs=F.lit(mature_after_s))),
            "object_key": key, "object_uri": F.concat(F.lit(root_uri.rstrip("/") + "/"), key),
        }
    )
    return rows.select(*(F.col(f.name).cast(f.dataType) for f in struct(MANIFEST)))


def manifest_lines(entries: DataFrame) -> DataFrame:
    """One JSON text for each entry, keys sorted, nulls kept; ``task_idx`` orders them."""
    return entries.select("task_idx", F.to_json(F.struct(*sorted(entries.columns)), {"ignoreNullFields": "false"}).alias("value"))


def shard_rows(plan: DataFrame, rollouts: DataFrame) -> DataFrame:
    """task_idx and the shard's columns of every rollout that the plan commits; missing columns are null."""
    cells = plan.where("task_idx is not null")
    rows = cell_rollouts(cells, rollouts).join(cells.select(*LISTED_CELL, "task_idx"), LISTED_CELL)
    have = set(rows.columns)
    return rows.select("task_idx", *((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in struct(SHARD)))


def marked(progress: DataFrame, handled: DataFrame, at: Column, column: str = "published_at") -> DataFrame:
    """progress with ``column`` set for the handled cells."""
    done = handled.select(*LISTED_CELL).distinct().withColumn("done", F.lit(True))
    return progress.join(done, LISTED_CELL, "left").withColumn(column, F.when(F.col("done"), at).otherwise(F.col(column))).drop("done")


def promotable(private: DataFrame, public: DataFrame, now: Column) -> DataFrame:
    """Private entries that the public manifest hasn't and that are mature; a bad or missing mature_at is committed_at."""
    rows = private.join(public.select(*LISTED_CELL).distinct(), LISTED_CELL, "left_anti")
    at = F.coalesce(F.try_to_timestamp("mature_at"), F.try_to_timestamp("committed_at"))
    return rows.where(at <= now.cast("timestamp"))


def promoted_since(progress: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    return progress.where(F.col("promoted_at") > now - F.make_dt_interval(hours=F.lit(hours))).agg(F.count(F.lit(1)).alias("n_promoted"))


def promotion_budget(promoted_today: int, max_per_cycle: int = MAX_PER_CYCLE, max_per_day: int = MAX_PER_DAY) -> int:
    """0 a day means no daily limit."""
    return min(max_per_cycle, max(0, max_per_day - promoted_today)) if max_per_day > 0 else max_per_cycle


def promote(candidates: DataFrame, budget: int, order: str = "line_no") -> DataFrame:
    """The first ``budget`` candidates in the manifest's order."""
    return candidates.orderBy(order).limit(budget)


def unmarked_promotions(progress: DataFrame, public: DataFrame) -> DataFrame:
    """Cells that the public manifest has and progress hasn't marked: what a lost mark leaves behind."""
    return progress.where("promoted_at is null").join(public.select(*LISTED_CELL).distinct(), LISTED_CELL, "left_semi")


def staged_released(completed: int, staged: int, max_per_day: int = MAX_PER_DAY, stage_days: int = STAGE_DAYS) -> int:
    """The public front plus a look-ahead of stage_days windows, no further than what is staged."""
    return min(completed + max(1, stage_days) * (max_per_day if max_per_day > 0 else 100), staged)
