"""Pool configuration, reweighting by yield, and each environment's number of active cells."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.operators.cells import CELL_TTL_S, active_by_list
from rollweave.schemas import LISTED_CELL

CUT_YIELD, ALPHA, MIN_CELLS, FLOOR = 0.10, 2.0, 30, 0.03
TARGET_ACTIVE, TARGET_SAMPLES, MIN_ACTIVE = 16, 8, 1
DEFAULT_PINS = {"swe-rebench": 0.10}

_POOL = (
    "struct<pool:struct<envs:array<string>,teachers:array<string>,task_id_pool:map<string,array<int>>,env_weights:map<string,double>,"
    "cell_ttl_s:int,min_active_per_env:int>,target_active_cells:int,target_samples:int,cell_ttl_s:int,min_active_per_env:int>"
)


def _need(ok: Column, message: str) -> Column:
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def parse_pool(lists: DataFrame, config: str = "config") -> DataFrame:
    """sampling_lists -> a row for each list and environment: pos, env_name, weight, task_ids and the list's settings.

    Environments keep their first place; explicit weights count (negative ones as 0, missing ones as 0), or else how
    often an environment is listed. Settings at the top come before those of the pool. A pool without environments,
    teachers or an environment's tasks is an error.
    """
    c = F.from_json(config, _POOL)
    rows = lists.withColumn("c", c).withColumn("p", F.col("c.pool"))
    some = lambda x: F.coalesce(F.size(x), F.lit(0)) > 0
    fine = (
        _need(F.col("p").isNotNull(), "config.pool is missing or no object") & _need(some("p.envs"), "pool.envs is empty") & _need(some("p.teachers"), "pool.teachers is empty")
    )
    weighted = F.coalesce(F.size(F.map_keys("p.env_weights")), F.lit(0)) > 0
    rows = rows.where(fine).select("*", F.posexplode(F.array_distinct("p.envs")).alias("pos", "env_name"))
    tasks = F.try_element_at("p.task_id_pool", F.col("env_name"))
    named = F.greatest(F.lit(0.0), F.coalesce(F.try_element_at("p.env_weights", F.col("env_name")), F.lit(0.0)))
    times = F.expr("size(filter(p.envs, x -> x = env_name))").cast("double")
    return rows.where(_need(some(tasks), "an environment of the pool has no tasks")).select(
        "list_name", "pos", "env_name", F.when(weighted, named).otherwise(times).alias("weight"), tasks.alias("task_ids"), F.col("p.teachers").alias("teachers"),
        F.coalesce("c.target_active_cells", F.lit(TARGET_ACTIVE)).alias("target_active_cells"),
        F.coalesce("c.target_samples", F.lit(TARGET_SAMPLES)).alias("target_samples"),
        F.coalesce("c.cell_ttl_s", "p.cell_ttl_s", F.lit(CELL_TTL_S)).alias("cell_ttl_s"),
        F.coalesce("c.min_active_per_env", "p.min_active_per_env", F.lit(MIN_ACTIVE)).alias("min_active_per_env"),
    )


def env_targets(pool: DataFrame) -> DataFrame:
    """pool rows with ``n_target``: the share of the active cells by weight, rounded half to even, and the floor at least."""
    total = F.sum("weight").over(Window.partitionBy("list_name"))
    share = F.bround(F.try_divide("weight", total) * F.col("target_active_cells"), 0).cast("int")
    return pool.withColumn("n_target", F.greatest("min_active_per_env", F.coalesce(F.when(total > 0, share), F.lit(0))))


def warmup_yield(yields: DataFrame, min_cells: int = MIN_CELLS, cut_yield: float = CUT_YIELD) -> DataFrame:
    """One row: the median yield of environments with enough cells, or cut_yield if none has."""
    return yields.agg(F.coalesce(F.median(F.when(F.col("n_cells") >= min_cells, F.col("yield"))), F.lit(cut_yield)).alias("warmup"))


def env_weights(
    envs: DataFrame, yields: DataFrame, pins: dict[str, float] | None = None,
    cut_yield: float = CUT_YIELD, alpha: float = ALPHA, min_cells: int = MIN_CELLS, floor: float = FLOOR,
) -> DataFrame:
    """env_name -> weight and label. Environments without enough cells sample at the median rate; poor ones keep the floor; pins raise."""
    rows = envs.select("env_name").distinct().join(yields, "env_name", "left").crossJoin(warmup_yield(yields, min_cells, cut_yield))  # one row
    n, y = F.coalesce("n_cells", F.lit(0)), F.coalesce("yield", F.lit(0.0))
    fresh, cut = n < min_cells, y < cut_yield
    score = F.when(fresh, F.pow(F.greatest("warmup", F.lit(cut_yield)), F.lit(alpha))).when(cut, 0.0).otherwise(F.pow(y, F.lit(alpha)))
    percent = F.format_string("%d%%", F.bround(y * 100, 0).cast("int"))
    label = (
        F.when(fresh, F.format_string(f"warmup(n=%d<{min_cells})", n)).when(cut, F.concat(F.lit("CUT(yield="), percent, F.lit(")"))).otherwise(F.concat(F.lit("yield="), percent))
    )
    pinned = F.lit(None).cast("double")
    for env, least in (pins or {}).items():
        pinned = F.when(F.col("env_name") == env, F.lit(float(least))).otherwise(pinned)
    raw = F.lit(floor) + score
    raised = F.coalesce(pinned > raw, F.lit(False))
    label = F.when(raised, F.concat(label, F.lit(" pinned>="), F.regexp_replace(pinned.cast("string"), r"\.0$", ""))).otherwise(label)
    return rows.select("env_name", F.bround(F.when(raised, pinned).otherwise(raw), 6).alias("weight"), label.alias("label"))


def with_weights(config: Column, weights: Column) -> Column:
    """A list's configuration, JSON text, with new pool.env_weights (a map); all other members stay, in the order of their names."""
    members = lambda v: F.try_variant_get(v, "$", "map<string,variant>")
    whole = members(F.try_parse_json(config))
    pool = F.coalesce(members(F.try_element_at(whole, F.lit("pool"))), F.create_map().cast("map<string,variant>"))
    pool = F.map_concat(F.map_filter(pool, lambda k, _: k != "env_weights"), F.create_map(F.lit("env_weights"), F.to_variant_object(weights)))
    out = F.map_concat(F.map_filter(whole, lambda k, _: k != "pool"), F.create_map(F.lit("pool"), F.to_variant_object(pool)))
    return F.to_json(F.to_variant_object(out))


def with_env(config: str, env: str, task_ids: list[int]) -> str:
    """A list's configuration with one more environment and its tasks; one that is there keeps its place."""
    found = json.loads(config)
    pool = found.setdefault("pool", {})
    if env not in pool.setdefault("envs", []):
        pool["envs"].append(env)
    pool.setdefault("task_id_pool", {})[env] = task_ids
    return json.dumps(found, sort_keys=True)


def reweight(lists: DataFrame, yields: DataFrame, pins: dict[str, float] | None = None, **knobs) -> DataFrame:
    """sampling_lists with new weights for their environments, any number of lists in one plan; all other columns stay.

    Each environment is weighed once, whichever lists name it. A list that parse_pool refuses is an error.
    """
    pool = parse_pool(lists).select("list_name", "env_name").distinct()
    found = env_weights(pool, yields, DEFAULT_PINS if pins is None else pins, **knobs).select("env_name", "weight")
    entries = F.array_sort(F.collect_list(F.struct("env_name", "weight")))
    weights = pool.join(found, "env_name").groupBy("list_name").agg(F.map_from_entries(entries).alias("_weights"))
    return lists.join(weights, "list_name").withColumn("config", with_weights(F.col("config"), F.col("_weights"))).select(*lists.columns)


def needs(targets: DataFrame, progress: DataFrame, as_of: Column) -> DataFrame:
    """targets (parse_pool with n_target) with n_active, by list and environment and the list's own TTL, ``need`` and ``turn``.

    Environments with the largest deficit of their list have the first turn; those without one have none.
    """
    active = active_by_list(progress, targets, as_of)
    found = targets.join(active, ["list_name", "env_name"], "left").withColumn("n_active", F.coalesce("n_active", F.lit(0)))
    found = found.withColumn("need", F.greatest(F.col("n_target") - F.col("n_active"), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("list_name").orderBy(F.desc("need"), "pos"))
    return found.withColumn("turn", F.when(F.col("need") > 0, place))


def top_up(targets: DataFrame, progress: DataFrame, tasks: DataFrame, as_of: Column, seed: int = 0) -> DataFrame:
    """New cells that bring each environment of each list to its target: tasks that exist, cells that don't.

    Cells are drawn in the order of an MD5 of seed, list, environment, task and teacher, so that a repeated cycle draws
    alike. An environment without enough fresh cells gets what there is (see top_up_report).
    """
    cells = needs(targets, progress, as_of).where("need > 0")
    cells = cells.withColumn("task_id", F.explode(F.array_distinct("task_ids"))).withColumn("teacher_name", F.explode(F.array_distinct("teachers")))
    cells = cells.join(tasks.select("env_name", "task_id").distinct(), ["env_name", "task_id"], "left_semi").join(progress.select(*LISTED_CELL), LISTED_CELL, "left_anti")
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "list_name", "env_name", F.col("task_id").cast("string"), "teacher_name"))
    draw = Window.partitionBy("list_name", "env_name").orderBy(key, "task_id", "teacher_name")
    cells = cells.withColumn("place", F.row_number().over(draw)).where("place <= need")
    return cells.select(*LISTED_CELL, "target_samples", F.lit(0).alias("collected"), F.lit(0).alias("attempts"), as_of.alias("last_updated"), "turn")


def top_up_report(targets: DataFrame, progress: DataFrame, added: DataFrame, as_of: Column) -> DataFrame:
    """A row for each list: cells inserted, active cells afterwards, and the environments that had too few fresh cells."""
    n = added.groupBy("list_name", "env_name").agg(F.count(F.lit(1)).alias("n"))
    found = needs(targets, progress, as_of).join(n, ["list_name", "env_name"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return found.groupBy("list_name").agg(
        F.sum("n").alias("inserted"), F.sum(F.col("n_active") + F.col("n")).alias("active_after"),
        F.array_sort(F.collect_list(F.when(F.col("n") < F.col("need"), F.col("env_name")))).alias("saturated"),
    )
