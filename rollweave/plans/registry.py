"""Named queries over the derived tables, each beside the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.functions import chat, codecs, text
from rollweave.operators import cells, environments, lookups, merge, metrics, normalisers, pairs, publish, requests, scoring, stats, trajectory, weights
from rollweave.plans import derive
from rollweave.plans.derive import PROGRESS, ROLLOUTS, SCORES, TASKS, TRACE, as_of, sql, table
from rollweave.sources import buckets, files, store
from rollweave.sources.scratch import dense
from rollweave.streaming import metrics as streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WEEK_S = 7 * 86_400
AS_OF = f"TIMESTAMP '{derive.AS_OF}'"
SINCE = "TIMESTAMP '2024-01-10 00:00:00'"
OPEN = "collected < target_samples AND attempts < 2 * target_samples"
ZOMBIE = f"({OPEN} AND last_updated < {AS_OF} - INTERVAL 21600 SECOND)"
PENDING = (
    f"published_at IS NULL AND (collected >= target_samples OR (attempts >= 2 * target_samples AND last_updated < {AS_OF} - INTERVAL 5 MINUTE) OR {ZOMBIE})"
)
CELL = "list_name, env_name, task_id, teacher_name"


def since():
    return F.expr("timestamp_ntz'2024-01-10 00:00:00'")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return put


def _rolls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.rollouts(spark, sf_dir)


def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.progress(_rolls(spark, sf_dir))


# -- yields and weights ---------------------------------------------------------------------------------------------------

YIELDS = f"""
yields AS (
  SELECT env_name, count(*) AS n_cells, count(*) FILTER (sd >= 0.05) AS n_varied, count(*) FILTER (sd >= 0.05)::DOUBLE / count(*) AS yield
  FROM (SELECT env_name, task_id, teacher_name, stddev_pop(reward) AS sd FROM rollouts
        WHERE status = 'ok' AND reward IS NOT NULL AND created_at > {SINCE} GROUP BY ALL HAVING count(*) >= 2)
  GROUP BY env_name)"""


@query("env_yield", sql("SELECT env_name, n_cells, n_varied, yield FROM yields", ROLLOUTS, YIELDS))
def env_yield(spark, sf_dir):
    return stats.env_yield(_rolls(spark, sf_dir), since())


@query("warmup_median", sql("SELECT round(coalesce(median(yield) FILTER (n_cells >= 30), 0.1), 9) AS warmup FROM yields", ROLLOUTS, YIELDS))
def warmup_median(spark, sf_dir):
    return weights.warmup_yield(env_yield(spark, sf_dir)).select(F.round("warmup", 9).alias("warmup"))


@query(
    "env_weights",
    sql(
        """SELECT e.env_name, round_even(greatest(0.03 + CASE WHEN coalesce(n_cells, 0) < 30 THEN pow(greatest((SELECT coalesce(median(yield) FILTER (n_cells >= 30), 0.1) FROM yields), 0.1), 2.0)
             WHEN yield < 0.1 THEN 0.0 ELSE pow(yield, 2.0) END, CASE WHEN e.env_name = 'swe-rebench' THEN 0.9 ELSE 0 END), 6) AS weight
           FROM (SELECT DISTINCT env_name FROM rollouts) e LEFT JOIN yields USING (env_name)""",
        ROLLOUTS, YIELDS,
    ),
)
def env_weights(spark, sf_dir):
    rolls = _rolls(spark, sf_dir)
    return weights.env_weights(rolls, stats.env_yield(rolls, since()), {"swe-rebench": 0.9}).select("env_name", "weight")


POOL = """{"pool":{"envs":["swe-rebench","swe-rebench","verifiers:view","verifiers:click","verifiers:view","swe-rebench","verifiers:purchase"],
"teachers":["t0","t9"],"task_id_pool":{"swe-rebench":[1,2,3],"verifiers:view":[4,5],"verifiers:click":[6],"verifiers:purchase":[7,8]}},"target_active_cells":25,"target_samples":3}"""


#: Another list: its own weights, target, TTL and floor.
OTHER_POOL = """{"pool":{"envs":["verifiers:purchase","swe-rebench","verifiers:view"],"teachers":["t1","t8","t9"],
"task_id_pool":{"swe-rebench":[1,2,3,4,5],"verifiers:view":[4,5,9,11],"verifiers:purchase":[7,8,8]},"env_weights":{"swe-rebench":8,"verifiers:view":1.5},"cell_ttl_s":5,
"min_active_per_env":4},"target_active_cells":40,"target_samples":5,"cell_ttl_s":2592000}"""


def _lists(spark):
    return spark.createDataFrame([("list-0", POOL), ("list-1", OTHER_POOL)], "list_name string, config string")


def _line(x: str) -> str:
    return x.replace("\n", "")


TARGETS = f"""
lists AS (SELECT * FROM (VALUES ('list-0', '{_line(POOL)}'::JSON), ('list-1', '{_line(OTHER_POOL)}'::JSON)) v(list_name, config)),
listed AS (
  SELECT list_name, config, env_name, min(pos) AS pos, count(*)::DOUBLE AS times
  FROM (SELECT list_name, config, unnest(json_extract_string(config, '$.pool.envs[*]')) AS env_name, generate_subscripts(json_extract_string(config, '$.pool.envs[*]'), 1) AS pos FROM lists)
  GROUP BY ALL),
weighed AS (
  SELECT *, CASE WHEN json_extract(config, '$.pool.env_weights') IS NULL THEN times
      ELSE greatest(0.0, coalesce(json_extract_string(config, '$.pool.env_weights."' || env_name || '"')::DOUBLE, 0.0)) END AS weight,
    coalesce(json_extract_string(config, '$.min_active_per_env'), json_extract_string(config, '$.pool.min_active_per_env'), '1')::INTEGER AS floor,
    coalesce(json_extract_string(config, '$.cell_ttl_s'), json_extract_string(config, '$.pool.cell_ttl_s'), '21600')::INTEGER AS ttl,
    json_extract_string(config, '$.target_active_cells')::INTEGER AS cells
  FROM listed),
targets AS (
  SELECT *, greatest(floor, coalesce(round_even(weight / nullif(sum(weight) OVER (PARTITION BY list_name), 0) * cells, 0), 0)::INTEGER) AS n_target FROM weighed)"""

NEEDS = f"""
needs AS (
  SELECT t.*, coalesce(a.n, 0) AS n_active, greatest(n_target - coalesce(a.n, 0), 0) AS need
  FROM targets t LEFT JOIN (
    SELECT p.list_name, p.env_name, count(*) AS n FROM progress p JOIN targets t ON t.list_name = p.list_name AND t.env_name = p.env_name
    WHERE published_at IS NULL AND {OPEN} AND last_updated >= {AS_OF} - to_seconds(ttl) GROUP BY ALL) a ON a.list_name = t.list_name AND a.env_name = t.env_name),
drawn AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY list_name, env_name ORDER BY md5('0|' || list_name || '|' || env_name || '|' || task_id || '|' || teacher_name), task_id, teacher_name) AS place
    FROM (
      SELECT DISTINCT n.list_name, n.env_name, n.need, turn, task_id, teacher_name
      FROM (SELECT *, row_number() OVER (PARTITION BY list_name ORDER BY need DESC, pos) AS turn FROM needs) n,
        LATERAL (SELECT unnest(json_extract(config, '$.pool.task_id_pool."' || env_name || '"')::INTEGER[]) AS task_id) i,
        LATERAL (SELECT unnest(json_extract_string(config, '$.pool.teachers[*]')) AS teacher_name) e) c
    WHERE EXISTS (SELECT 1 FROM rollouts r WHERE r.env_name = c.env_name AND r.task_id = c.task_id)
      AND NOT EXISTS (SELECT 1 FROM progress p WHERE p.list_name = c.list_name AND p.env_name = c.env_name AND p.task_id = c.task_id AND p.teacher_name = c.teacher_name))
  WHERE place <= need)"""


def _topped_up(spark, sf_dir):
    rolls, targets = _rolls(spark, sf_dir), weights.env_targets(weights.parse_pool(_lists(spark)))
    progress = derive.progress(rolls)
    return targets, progress, weights.top_up(targets, progress, rolls.select("env_name", "task_id"), as_of())


@query("pool_top_up", sql("SELECT list_name, env_name, task_id, teacher_name, turn FROM drawn", ROLLOUTS, PROGRESS, TARGETS, NEEDS))
def pool_top_up(spark, sf_dir):
    return _topped_up(spark, sf_dir)[2].select(*CELL.split(", "), "turn")


REWEIGHED = """
fresh AS (
  SELECT env_name, round_even(greatest(0.03 + CASE WHEN coalesce(n_cells, 0) < 30 THEN pow(greatest((SELECT coalesce(median(yield) FILTER (n_cells >= 30), 0.1) FROM yields), 0.1), 2.0)
      WHEN yield < 0.1 THEN 0.0 ELSE pow(yield, 2.0) END, CASE WHEN env_name = 'swe-rebench' THEN 0.1 ELSE 0 END), 6) AS weight
  FROM (SELECT DISTINCT env_name FROM listed) LEFT JOIN yields USING (env_name))"""


@query(
    "reweight",
    sql(
        """SELECT list_name, env_name, weight, json_extract_string(config, '$.target_active_cells')::INTEGER AS cells, json_extract_string(config, '$.pool.teachers[1]') AS teacher,
             coalesce(json_extract_string(config, '$.pool.cell_ttl_s'), '-') AS ttl, len(json_extract_string(config, '$.pool.envs[*]'))::INTEGER AS n_envs FROM listed JOIN fresh USING (env_name)""",
        ROLLOUTS, YIELDS, TARGETS, REWEIGHED,
    ),
)
def reweight(spark, sf_dir):
    """Both lists weighed anew in one plan: the new weights, and members of the configuration that stay."""
    rolls = _rolls(spark, sf_dir)
    out = weights.reweight(_lists(spark), stats.env_yield(rolls, since()))
    of = lambda path, kind: F.get_json_object("config", path).cast(kind)
    rows = out.select("list_name", "config", F.explode(F.from_json(F.get_json_object("config", "$.pool.env_weights"), "map<string,double>")).alias("env_name", "weight"))
    return rows.select(
        "list_name", "env_name", "weight", of("$.target_active_cells", "int").alias("cells"), of("$.pool.teachers[1]", "string").alias("teacher"),
        F.coalesce(of("$.pool.cell_ttl_s", "string"), F.lit("-")).alias("ttl"), F.json_array_length(F.get_json_object("config", "$.pool.envs")).alias("n_envs"),
    )


@query(
    "pool_report",
    sql(
        """SELECT list_name, sum(n)::BIGINT AS inserted, sum(n_active + n)::BIGINT AS active_after, coalesce(string_agg(env_name, ',' ORDER BY env_name) FILTER (n < need), '') AS saturated
           FROM (SELECT list_name, env_name, need, n_active, coalesce(n, 0) AS n FROM needs LEFT JOIN (SELECT list_name, env_name, count(*) AS n FROM drawn GROUP BY ALL) d USING (list_name, env_name)) GROUP BY list_name""",
        ROLLOUTS, PROGRESS, TARGETS, NEEDS,
    ),
)
def pool_report(spark, sf_dir):
    targets, progress, added = _topped_up(spark, sf_dir)
    return weights.top_up_report(targets, progress, added, as_of()).withColumn("saturated", F.array_join("saturated", ","))


# -- cells ----------------------------------------------------------------------------------------------------------------


@query("coverage_matrix", sql("SELECT teacher_name, task_id, count(*) AS n FROM rollouts WHERE status = 'ok' GROUP BY ALL", ROLLOUTS))
def coverage_matrix(spark, sf_dir):
    return stats.coverage(_rolls(spark, sf_dir))


@query("coverage_by_env", sql("SELECT env_name, teacher_name, task_id, count(*) AS n FROM rollouts WHERE status = 'ok' GROUP BY ALL", ROLLOUTS))
def coverage_by_env(spark, sf_dir):
    return stats.coverage_by_env(_rolls(spark, sf_dir))


@query("coverage_of_env", sql("SELECT teacher_name, task_id, count(*) AS n FROM rollouts WHERE status = 'ok' AND env_name = 'swe-rebench' GROUP BY ALL", ROLLOUTS))
def coverage_of_env(spark, sf_dir):
    return stats.coverage(_rolls(spark, sf_dir), "swe-rebench")


@query(
    "coverage_pivot",
    sql(
        "SELECT task_id, " + ", ".join(f"nullif(count(*) FILTER (teacher_name = '{t}'), 0) AS {t}" for t in ("t0", "t1", "t2")) + " FROM rollouts WHERE status = 'ok' GROUP BY task_id",
        ROLLOUTS,
    ),
)
def coverage_pivot(spark, sf_dir):
    return stats.coverage_matrix(_rolls(spark, sf_dir), ["t0", "t1", "t2"])


ACTIVE = f"published_at IS NULL AND {OPEN} AND last_updated >= {AS_OF} - INTERVAL {WEEK_S} SECOND"


@query("active_cells", sql(f"SELECT {CELL}, attempts, collected FROM progress WHERE {ACTIVE}", ROLLOUTS, PROGRESS))
def active_cells(spark, sf_dir):
    return cells.active(_progress(spark, sf_dir), as_of(), WEEK_S).select(*CELL.split(", "), "attempts", "collected")


@query("active_by_env", sql(f"SELECT env_name, count(*) AS n_active FROM progress WHERE list_name = 'list-1' AND {ACTIVE} GROUP BY env_name", ROLLOUTS, PROGRESS))
def active_by_env(spark, sf_dir):
    return cells.active_by_env(_progress(spark, sf_dir), as_of(), WEEK_S, "list-1")


@query("open_progress", sql(f"SELECT {CELL}, attempts, collected FROM progress WHERE collected < target_samples", ROLLOUTS, PROGRESS))
def open_progress(spark, sf_dir):
    return cells.open_progress(_progress(spark, sf_dir)).select(*CELL.split(", "), "attempts", "collected")


@query("pending_cells", sql(f"SELECT {CELL}, attempts, collected, ({OPEN}) AS zombie FROM progress WHERE {PENDING}", ROLLOUTS, PROGRESS))
def pending_cells(spark, sf_dir):
    return cells.pending(_progress(spark, sf_dir), as_of()).select(*CELL.split(", "), "attempts", "collected", "zombie")


@query("zombie_cells", sql(f"SELECT {CELL} FROM progress WHERE {ZOMBIE}", ROLLOUTS, PROGRESS))
def zombie_cells(spark, sf_dir):
    return _progress(spark, sf_dir).where(cells.is_zombie(as_of())).select(*CELL.split(", "))


CLAIMABLE = f"published_at IS NULL AND {OPEN} AND attempts - collected < 4"
CLAIM_ORDER = "collected DESC, attempts, task_id, env_name, teacher_name"


@query(
    "claim_cells",
    sql(f"SELECT {CELL}, attempts + 1 AS attempts, attempts AS slot FROM progress WHERE {CLAIMABLE} AND list_name = 'list-1' AND env_name LIKE 'verifiers:%' ORDER BY {CLAIM_ORDER} LIMIT 8", ROLLOUTS, PROGRESS),
)
def claim_cells(spark, sf_dir):
    return cells.claim(_progress(spark, sf_dir), 8, list_name="list-1", like="verifiers:%").select(*CELL.split(", "), "attempts", "slot")


@query(
    "claim_cells_each",
    sql(f"SELECT {CELL}, attempts + 1 AS attempts, attempts AS slot FROM progress WHERE {CLAIMABLE} QUALIFY row_number() OVER (PARTITION BY list_name ORDER BY {CLAIM_ORDER}) <= 8", ROLLOUTS, PROGRESS),
)
def claim_cells_each(spark, sf_dir):
    return cells.claim_each(_progress(spark, sf_dir), 8).select(*CELL.split(", "), "attempts", "slot")


@query(
    "freeze_degenerate",
    sql(
        """SELECT env_name, task_id, teacher_name, n AS n_recent FROM (
             SELECT env_name, task_id, teacher_name, count(*) AS n, coalesce(stddev_samp(reward), 0) AS sd
             FROM (SELECT * FROM rollouts WHERE status = 'ok' QUALIFY row_number() OVER (PARTITION BY env_name, task_id, teacher_name ORDER BY created_at DESC, sample_idx DESC) <= 4)
             GROUP BY ALL) WHERE n >= 4 AND sd = 0""",
        ROLLOUTS,
    ),
)
def freeze_degenerate(spark, sf_dir):
    return cells.degenerate(_rolls(spark, sf_dir))


REWARDS = """
rewards AS (
  SELECT env_name, task_id, teacher_name, count(*) AS n_rollouts, count(reward) AS n_rewards, coalesce(avg(reward), 0) AS m,
    CASE WHEN count(reward) >= 2 THEN stddev_pop(reward) ELSE 0 END AS s FROM rollouts WHERE status = 'ok' GROUP BY ALL)"""


@query("cell_reward_stats", sql("SELECT env_name, task_id, teacher_name, n_rollouts, n_rewards, round(m, 6) AS reward_mean, round(s, 6) AS reward_std FROM rewards", ROLLOUTS, REWARDS))
def cell_reward_stats(spark, sf_dir):
    return stats.cell_rewards(_rolls(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("reward_mean", "reward_std")})


@query("task_semi_join", sql("SELECT e.user_id AS task_id, count(*) AS n FROM events e WHERE EXISTS (SELECT 1 FROM tasks t WHERE t.task_id = e.user_id) GROUP BY ALL", TASKS))
def task_semi_join(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("task_id"))
    return events.join(derive.tasks(spark, sf_dir), "task_id", "left_semi").groupBy("task_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sampling_list_init",
    sql(
        "SELECT 'new' AS list_name, env_name, unnest(generate_series(lo, hi - 1))::INTEGER AS task_id, teacher_name "
        "FROM (SELECT env_name, min(task_id) AS lo, max(task_id) + 1 AS hi FROM rollouts GROUP BY env_name), (SELECT DISTINCT teacher_name FROM rollouts)",
        ROLLOUTS,
    ),
)
def sampling_list_init(spark, sf_dir):
    rolls = _rolls(spark, sf_dir)
    span = F.struct(F.min("task_id").cast("int").alias("lo"), (F.max("task_id") + 1).cast("int").alias("hi"))
    environments = rolls.groupBy("env_name").agg(span.alias("task_id_range"))
    return cells.sampling_list(environments, rolls.select("teacher_name").distinct(), "new", 8, as_of()).select(*CELL.split(", "))


@query(
    "request_inputs",
    sql(
        f"""SELECT list_name, env_name, task_id, teacher_name, slot, 'p' || task_id AS problem, 'f' || right(teacher_name, 1) AS family FROM (
              SELECT {CELL}, attempts AS slot FROM progress WHERE {CLAIMABLE} QUALIFY row_number() OVER (PARTITION BY list_name ORDER BY {CLAIM_ORDER}) <= 8)""",
        ROLLOUTS, PROGRESS,
    ),
)
def request_inputs(spark, sf_dir):
    rolls = _rolls(spark, sf_dir)
    tasks = rolls.select("env_name", "task_id").distinct().withColumn("problem", F.concat(F.lit("p"), F.col("task_id").cast("string")))
    teachers = rolls.select("teacher_name").distinct().withColumn("family", F.concat(F.lit("f"), F.right("teacher_name", F.lit(1))))
    found = requests.with_task_and_teacher(cells.claim_each(derive.progress(rolls), 8), tasks, teachers)
    return found.select(*CELL.split(", "), "slot", "task.problem", "teacher.family")


@query(
    "backfill_collected",
    sql(f"SELECT {', '.join('p.' + c.strip() for c in CELL.split(','))}, coalesce(r.n, p.collected + 100) AS collected FROM progress p LEFT JOIN (SELECT env_name, task_id, teacher_name, count(*) AS n FROM rollouts WHERE status = 'ok' GROUP BY ALL) r USING (env_name, task_id, teacher_name)", ROLLOUTS, PROGRESS),
)
def backfill_collected(spark, sf_dir):
    rolls = _rolls(spark, sf_dir)
    stale = derive.progress(rolls).withColumn("collected", F.col("collected") + 100)
    return cells.backfill(stale, rolls).select(*CELL.split(", "), "collected")


@query(
    "increment_collected",
    sql(
        f"""SELECT {CELL}, collected + coalesce(d, 0)::BIGINT AS collected, CASE WHEN d IS NULL THEN last_updated ELSE {AS_OF} END AS last_updated
            FROM progress LEFT JOIN (SELECT env_name, task_id, teacher_name, count(*) AS d FROM rollouts WHERE status = 'ok' AND created_at > {SINCE} GROUP BY ALL) USING (env_name, task_id, teacher_name)""",
        ROLLOUTS, PROGRESS,
    ),
)
def increment_collected(spark, sf_dir):
    rolls = _rolls(spark, sf_dir)
    deltas = rolls.where("status = 'ok'").where(F.col("created_at") > since())
    deltas = deltas.select(F.concat(F.lit("list-"), (F.col("task_id") % 2).cast("string")).alias("list_name"), "env_name", "task_id", "teacher_name", F.lit(1).alias("delta"))
    return cells.increment(derive.progress(rolls), deltas, as_of()).select(*CELL.split(", "), "collected", "last_updated")


# -- publish and promote ----------------------------------------------------------------------------------------------------

CLASSIFIED = f"""
known AS (SELECT {CELL} FROM progress WHERE task_id % 5 = 0),
pending AS (SELECT * FROM progress WHERE {PENDING}),
classified AS (
  SELECT p.*, coalesce(r.n, 0) AS n_rollouts, round_even(coalesce(r.m, 0), 6) AS reward_mean, round_even(coalesce(r.s, 0), 6) AS reward_std,
    CASE WHEN k.list_name IS NOT NULL THEN 'recovered' WHEN r.n IS NULL THEN 'empty' WHEN coalesce(r.s, 0) < 0.05 THEN 'degenerate' ELSE 'commit' END AS action
  FROM pending p LEFT JOIN known k USING ({CELL})
  LEFT JOIN (SELECT list_name, r.env_name, r.task_id, r.teacher_name, count(*) AS n, avg(reward) AS m, CASE WHEN count(reward) >= 2 THEN stddev_pop(reward) ELSE 0 END AS s
             FROM rollouts r JOIN pending p ON p.env_name = r.env_name AND p.task_id = r.task_id AND p.teacher_name = r.teacher_name
             WHERE r.status = 'ok' AND sample_idx < attempts GROUP BY ALL) r USING ({CELL}))"""


def _classified(spark, sf_dir):
    rolls = _rolls(spark, sf_dir)
    progress = derive.progress(rolls)
    return publish.classify(cells.pending(progress, as_of()), rolls, progress.where("task_id % 5 = 0"))


@query("publish_classify", sql(f"SELECT {CELL}, n_rollouts, reward_mean, reward_std, action FROM classified", ROLLOUTS, PROGRESS, CLASSIFIED))
def publish_classify(spark, sf_dir):
    return _classified(spark, sf_dir).select(*CELL.split(", "), "n_rollouts", "reward_mean", "reward_std", "action")


@query(
    "publish_task_idx",
    sql(
        f"""SELECT {CELL}, action, CASE WHEN action = 'commit' THEN 1000 + before END AS task_idx FROM (
              SELECT *, coalesce(count(*) FILTER (action = 'commit') OVER (ORDER BY last_updated, {CELL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM classified)
            WHERE before < 200""",
        ROLLOUTS, PROGRESS, CLASSIFIED,
    ),
)
def publish_task_idx(spark, sf_dir):
    return publish.plan_cycle(_classified(spark, sf_dir), 1000, 200).select(*CELL.split(", "), "action", "task_idx")


def _entries(spark, sf_dir):
    return publish.manifest_entries(publish.plan_cycle(_classified(spark, sf_dir), 1000, 200), as_of(), "s3://bucket", "rollouts")


@query(
    "manifest_entries",
    sql(
        f"""SELECT env_name, list_name, task_id::INTEGER AS task_id, teacher_name, (1000 + before)::BIGINT AS task_idx, n_rollouts, reward_mean, reward_std, attempts::INTEGER AS attempts,
              'rollouts/tasks/' || lpad((1000 + before)::VARCHAR, 8, '0') || '.parquet' AS object_key, 's3://bucket/rollouts/tasks/' || lpad((1000 + before)::VARCHAR, 8, '0') || '.parquet' AS object_uri,
              '2024-01-31T00:00:00.000000+00:00' AS committed_at, '2024-01-31T00:00:00.000000+00:00' AS mature_at
            FROM (SELECT *, coalesce(count(*) FILTER (action = 'commit') OVER (ORDER BY last_updated, {CELL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM classified)
            WHERE before < 200 AND action = 'commit'""",
        ROLLOUTS, PROGRESS, CLASSIFIED,
    ),
)
def manifest_entries(spark, sf_dir):
    return _entries(spark, sf_dir)


@query(
    "manifest_lines",
    sql(
        f"""SELECT task_idx, '{{"attempts":' || attempts || ',"committed_at":"2024-01-31T00:00:00.000000+00:00","env_name":"' || env_name || '","list_name":"' || list_name || '","mature_at":"2024-01-31T00:00:00.000000+00:00"'
              || ',"n_rollouts":' || n_rollouts || ',"object_key":"' || object_key || '","object_uri":"s3://bucket/' || object_key || '","reward_mean":' || reward_mean || ',"reward_std":' || reward_std
              || ',"task_id":' || task_id || ',"task_idx":' || task_idx || ',"teacher_name":"' || teacher_name || '"}}' AS value
            FROM (SELECT *, (1000 + before)::BIGINT AS task_idx, 'rollouts/tasks/' || lpad((1000 + before)::VARCHAR, 8, '0') || '.parquet' AS object_key
                  FROM (SELECT *, coalesce(count(*) FILTER (action = 'commit') OVER (ORDER BY last_updated, {CELL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM classified)
                  WHERE before < 200 AND action = 'commit')""",
        ROLLOUTS, PROGRESS, CLASSIFIED,
    ),
)
def manifest_lines(spark, sf_dir):
    return publish.manifest_lines(_entries(spark, sf_dir))


@query(
    "manifest_antijoin",
    sql(f"SELECT {CELL}, 'new' AS side FROM pending ANTI JOIN known USING ({CELL}) UNION ALL SELECT {CELL}, 'recovered' FROM pending SEMI JOIN known USING ({CELL})", ROLLOUTS, PROGRESS, CLASSIFIED),
)
def manifest_antijoin(spark, sf_dir):
    progress = _progress(spark, sf_dir)
    pending, known, key = cells.pending(progress, as_of()), progress.where("task_id % 5 = 0"), CELL.split(", ")
    new, seen = (pending.join(known.select(*key), key, how).select(*key, F.lit(side).alias("side")) for how, side in (("left_anti", "new"), ("left_semi", "recovered")))
    return new.unionByName(seen)


PRIVATE = f"private AS (SELECT *, row_number() OVER (ORDER BY last_updated, {CELL}) AS line_no FROM progress WHERE published_at IS NOT NULL)"


def _private(spark, sf_dir):
    rows = _progress(spark, sf_dir).where("published_at is not null")  # a manifest is one ordered file
    rows = dense(rows, "line_no", F.col("last_updated"), *map(F.col, CELL.split(", "))).withColumn("line_no", F.col("line_no") + 1)
    stamp = publish.iso(F.col("published_at"))
    return rows.withColumns({"committed_at": stamp, "mature_at": F.when(F.col("task_id") % 3 == 0, F.lit("bad")).otherwise(publish.iso(F.col("published_at") + F.expr("interval 2 days")))})


@query(
    "promote_candidates",
    sql(
        f"""SELECT {CELL}, line_no FROM private WHERE promoted_at IS NULL
              AND CASE WHEN task_id % 3 = 0 THEN published_at ELSE published_at + INTERVAL 2 DAY END <= {AS_OF} ORDER BY line_no LIMIT 60""",
        ROLLOUTS, PROGRESS, PRIVATE,
    ),
)
def promote_candidates(spark, sf_dir):
    private = _private(spark, sf_dir)
    found = publish.promotable(private, private.where("promoted_at is not null"), as_of())
    return publish.promote(found, publish.promotion_budget(40)).select(*CELL.split(", "), "line_no")


@query("promoted_last_24h", sql(f"SELECT count(*) AS n_promoted FROM progress WHERE promoted_at > {AS_OF} - INTERVAL 24 HOUR", ROLLOUTS, PROGRESS))
def promoted_last_24h(spark, sf_dir):
    return publish.promoted_since(_progress(spark, sf_dir), as_of())


@query(
    "staged_released",
    sql("SELECT completed, staged, least(completed + 100, staged) AS released FROM (SELECT count(promoted_at) AS completed, count(published_at) AS staged FROM progress)", ROLLOUTS, PROGRESS),
)
def staged_released(spark, sf_dir):
    n = _progress(spark, sf_dir).agg(F.count("promoted_at").alias("completed"), F.count("published_at").alias("staged"))
    return n.withColumn("released", F.least(F.col("completed") + publish.MAX_PER_DAY * publish.STAGE_DAYS, F.col("staged")))


@query("unmarked_promotions", sql(f"SELECT {CELL} FROM progress WHERE promoted_at IS NULL AND published_at IS NOT NULL AND task_id % 3 = 0", ROLLOUTS, PROGRESS))
def unmarked_promotions(spark, sf_dir):
    progress = _progress(spark, sf_dir)
    return publish.unmarked_promotions(progress, progress.where("published_at is not null and task_id % 3 = 0")).select(*CELL.split(", "))


@query("object_key_format", "SELECT DISTINCT user_id AS task_idx, 'pre/tasks/' || lpad(user_id::VARCHAR, 8, '0') || '.parquet' AS object_key FROM events")
def object_key_format(spark, sf_dir):
    ids = table(spark, sf_dir, "events").select(F.col("user_id").alias("task_idx")).distinct()
    return ids.withColumn("object_key", publish.object_key(F.col("task_idx"), "pre/"))


# -- advantages, groups, pairs ---------------------------------------------------------------------------------------------


def _advantage_sql(group: str) -> str:
    return sql(
        f"""SELECT rollout_id, n AS group_n, round(m, 6) AS group_mean, round(s, 6) AS group_std, round(CASE WHEN n >= 2 AND s > 0 THEN (reward - m) / s ELSE 0 END, 6) AS advantage
            FROM (SELECT *, count(*) OVER w AS n, avg(reward) OVER w AS m, stddev_pop(reward) OVER w AS s FROM rollouts WHERE reward IS NOT NULL WINDOW w AS (PARTITION BY {group}))""",
        ROLLOUTS,
    )


def _advantages(spark, sf_dir, **by):
    out = stats.advantages(_rolls(spark, sf_dir), **by).select("rollout_id", "group_n", "group_mean", "group_std", "advantage")
    return out.withColumns({c: F.round(c, 6) for c in ("group_mean", "group_std", "advantage")})


@query("advantage_task", _advantage_sql("task_id"))
def advantage_task(spark, sf_dir):
    return _advantages(spark, sf_dir)


@query("advantage_task_teacher", _advantage_sql("task_id, teacher_name"))
def advantage_task_teacher(spark, sf_dir):
    return _advantages(spark, sf_dir, by_teacher=True)


@query("advantage_env_task", _advantage_sql("env_name, task_id"))
def advantage_env_task(spark, sf_dir):
    return _advantages(spark, sf_dir, by_env=True)


@query("advantage_group_stats", sql("SELECT task_id, teacher_name, count(*) AS n, round(avg(reward), 6) AS mean, round(stddev_pop(reward), 6) AS std, min(reward) AS min, max(reward) AS max FROM rollouts WHERE reward IS NOT NULL GROUP BY ALL", ROLLOUTS))
def advantage_group_stats(spark, sf_dir):
    return stats.group_stats(_rolls(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(
    "mining_groups",
    sql(f"SELECT env_name, task_id, teacher_name, count(*) AS n, string_agg(rollout_id::VARCHAR, ',' ORDER BY sample_idx) AS members FROM rollouts WHERE status = 'ok' AND env_name IN ('swe-rebench', 'verifiers:view') AND created_at >= {SINCE} GROUP BY ALL", ROLLOUTS),
)
def mining_groups(spark, sf_dir):
    groups = stats.mining_groups(_rolls(spark, sf_dir), ["swe-rebench", "verifiers:view"], [], since())
    return groups.select("env_name", "task_id", "teacher_name", F.size("rollouts").cast("long").alias("n"), F.array_join(F.transform("rollouts", lambda r: r["rollout_id"].cast("string")), ",").alias("members"))


@query(
    "group_labels",
    sql(
        """SELECT env_name, task_id, teacher_name, count(*) AS n, CASE WHEN count(*) = 1 THEN 'singleton' WHEN min(reward) >= 1 THEN 'all_win' WHEN max(reward) <= 0 THEN 'all_lose'
             WHEN min(reward) = max(reward) THEN 'degenerate' ELSE 'paired' END AS group_label FROM rollouts WHERE status = 'ok' AND reward IS NOT NULL GROUP BY ALL""",
        ROLLOUTS,
    ),
)
def group_labels(spark, sf_dir):
    return stats.group_labels(_rolls(spark, sf_dir))


@query("group_label_update", sql("SELECT group_label, count(*) AS n FROM (SELECT r.rollout_id, CASE WHEN n = 1 THEN 'singleton' WHEN lo >= 1 THEN 'all_win' WHEN hi <= 0 THEN 'all_lose' WHEN lo = hi THEN 'degenerate' WHEN n > 1 THEN 'paired' END AS group_label FROM rollouts r LEFT JOIN (SELECT env_name, task_id, teacher_name, count(*) AS n, min(reward) AS lo, max(reward) AS hi FROM rollouts WHERE status = 'ok' AND reward IS NOT NULL GROUP BY ALL) USING (env_name, task_id, teacher_name)) GROUP BY ALL", ROLLOUTS))
def group_label_update(spark, sf_dir):
    rolls = _rolls(spark, sf_dir)
    return stats.with_group_labels(rolls, stats.group_labels(rolls)).groupBy("group_label").agg(F.count(F.lit(1)).alias("n"))


PAIRS = """
pairs AS (
  SELECT md5(concat_ws('|', env_name, task_id::VARCHAR, teacher_name)) AS pair_id, env_name, task_id, teacher_name,
    first(rollout_id ORDER BY reward DESC, rollout_id) AS win_rollout_id, first(rollout_id ORDER BY reward, rollout_id) AS lose_rollout_id, max(reward) - min(reward) AS reward_gap
  FROM rollouts WHERE status = 'ok' AND reward IS NOT NULL GROUP BY env_name, task_id, teacher_name HAVING max(reward) > min(reward))"""


@query("pairs", sql("SELECT * FROM pairs", ROLLOUTS, PAIRS))
def select_pairs(spark, sf_dir):
    return pairs.select_pairs(_rolls(spark, sf_dir))


@query(
    "pairs_best_against_each",
    sql(
        """SELECT md5(concat_ws('|', r.env_name, r.task_id::VARCHAR, r.teacher_name, r.rollout_id::VARCHAR)) AS pair_id, r.env_name, r.task_id, r.teacher_name,
             b.win_rollout_id, r.rollout_id AS lose_rollout_id, b.most - r.reward AS reward_gap
           FROM rollouts r JOIN (SELECT env_name, task_id, teacher_name, max(reward) AS most, first(rollout_id ORDER BY reward DESC, rollout_id) AS win_rollout_id
                                 FROM rollouts WHERE status = 'ok' AND reward IS NOT NULL GROUP BY ALL) b USING (env_name, task_id, teacher_name)
           WHERE r.status = 'ok' AND r.reward IS NOT NULL AND b.most - r.reward > 0.25""",
        ROLLOUTS,
    ),
)
def pairs_best_against_each(spark, sf_dir):
    return pairs.select_pairs(_rolls(spark, sf_dir), 0.25, "best_against_each")


MEASURED = "measured AS (SELECT o_custkey AS student, o_totalprice AS win_ce, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice WHEN o_orderkey % 7 <> 0 THEN o_totalprice + o_orderkey % 11 - 5 END AS lose_ce FROM orders)"


def _measured(spark, sf_dir):
    k = F.col("o_orderkey")
    lose = F.when(k % 5 == 0, F.col("o_totalprice")).when(k % 7 != 0, F.col("o_totalprice") + k % 11 - 5)
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("student"), F.col("o_totalprice").alias("win_ce"), lose.alias("lose_ce"), F.lit(0.5).alias("reward_gap"))


@query(
    "student_preferences",
    sql("SELECT student, round(avg(CASE WHEN win_ce < lose_ce THEN 1.0 WHEN win_ce = lose_ce THEN 0.5 WHEN lose_ce IS NOT NULL THEN 0.0 END), 6) AS mean_score, count(lose_ce) AS n_scored FROM measured GROUP BY student", MEASURED),
)
def student_preferences(spark, sf_dir):
    return scoring.mean_scores(scoring.score_pairs(_measured(spark, sf_dir), "preference"), "student").withColumn("mean_score", F.round("mean_score", 6))


@query("student_margins", sql("SELECT student, round(avg(lose_ce - win_ce), 6) AS mean_score, count(lose_ce) AS n_scored FROM measured GROUP BY student", MEASURED))
def student_margins(spark, sf_dir):
    return scoring.mean_scores(scoring.score_pairs(_measured(spark, sf_dir)), "student").withColumn("mean_score", F.round("mean_score", 6))


@query(
    "student_rollout_scores",
    sql(
        """SELECT task_id, round(avg(CASE WHEN n >= 2 AND s > 0 THEN (reward - m) / s ELSE 0 END * exp(-(rollout_id % 10) / 10.0)), 6) AS mean_score, count(*) AS n_scored
           FROM (SELECT *, count(*) OVER w AS n, avg(reward) OVER w AS m, stddev_pop(reward) OVER w AS s FROM rollouts WHERE reward IS NOT NULL WINDOW w AS (PARTITION BY task_id)) GROUP BY task_id""",
        ROLLOUTS,
    ),
)
def student_rollout_scores(spark, sf_dir):
    rows = stats.advantages(_rolls(spark, sf_dir)).withColumns({"ce": F.col("rollout_id") % 10 / 10.0, "n_tokens": F.lit(1)})
    return scoring.mean_scores(scoring.score_rollouts(rows), "task_id").withColumn("mean_score", F.round("mean_score", 6))


@query("pairs_page", sql("SELECT pair_id, reward_gap FROM pairs WHERE pair_id > '4' AND reward_gap >= 0.5 ORDER BY pair_id LIMIT 50", ROLLOUTS, PAIRS))
def pairs_page(spark, sf_dir):
    return pairs.page(select_pairs(spark, sf_dir), "4", 50, min_gap=0.5).select("pair_id", "reward_gap")


@query("pair_count", sql("SELECT env_name, count(*) AS n FROM pairs GROUP BY env_name", ROLLOUTS, PAIRS))
def pair_count(spark, sf_dir):
    return select_pairs(spark, sf_dir).groupBy("env_name").agg(F.count(F.lit(1)).alias("n"))


LATEST = "latest AS (SELECT * FROM scores WHERE status = 'done' QUALIFY row_number() OVER (PARTITION BY student, revision, pair_set ORDER BY finished_at DESC, run_id DESC) = 1)"


@query("leaderboard", sql("SELECT student, revision, mean_score, run_id FROM latest WHERE pair_set = '1-URGENT' ORDER BY mean_score DESC, student LIMIT 50", SCORES, LATEST))
def leaderboard(spark, sf_dir):
    return pairs.leaderboard(derive.scores(spark, sf_dir), "1-URGENT")


@query("latest_score", sql("SELECT student, revision, pair_set, run_id, mean_score FROM latest", SCORES, LATEST))
def latest_score(spark, sf_dir):
    return pairs.latest_scores(derive.scores(spark, sf_dir)).select("student", "revision", "pair_set", "run_id", "mean_score")


@query("mark_latest", sql("SELECT run_id, status = 'done' AND row_number() OVER (PARTITION BY student, revision, pair_set ORDER BY status = 'done' DESC, finished_at DESC, run_id DESC) = 1 AS is_latest FROM scores", SCORES))
def mark_latest(spark, sf_dir):
    return merge.mark_latest(derive.scores(spark, sf_dir)).select("run_id", "is_latest")


@query("claim_next_run", sql("SELECT run_id, student FROM scores WHERE status = 'queued' ORDER BY started_at NULLS FIRST, run_id LIMIT 1", SCORES))
def claim_next_run(spark, sf_dir):
    return pairs.next_run(derive.scores(spark, sf_dir)).select("run_id", "student")


@query(
    "claim_next_run_running",
    sql(
        f"""SELECT run_id, CASE WHEN run_id = next THEN 'running' ELSE status END AS status, CASE WHEN run_id = next THEN {AS_OF} ELSE started_at END AS started_at
            FROM scores, (SELECT run_id AS next FROM scores WHERE status = 'queued' ORDER BY started_at NULLS FIRST, run_id LIMIT 1)""",
        SCORES,
    ),
)
def claim_next_run_running(spark, sf_dir):
    return pairs.claim_next(derive.scores(spark, sf_dir), as_of()).select("run_id", "status", "started_at")


@query(
    "mark_failed",
    sql(
        f"""SELECT run_id, CASE WHEN run_id % 10 = 0 THEN 'failed' ELSE status END AS status, CASE WHEN run_id % 10 = 0 THEN {AS_OF} ELSE finished_at END AS finished_at,
              CASE WHEN run_id % 10 <> 0 THEN config WHEN run_id % 20 = 0 THEN '{{"error":"' || err || '"}}' ELSE '{{"a":1,"b":{{"c":[true,null,"1"]}},"error":"' || err || '"}}' END AS config
            FROM (SELECT *, CASE WHEN run_id % 20 <> 0 THEN '{{"a":1,"b":{{"c":[true,null,"1"]}},"error":"x"}}' END AS config, left(repeat('e', 1999 + (run_id % 3)::INTEGER), 2000) AS err FROM scores)""",
        SCORES,
    ),
)
def mark_failed(spark, sf_dir):
    """Of the failures named, those of a wrong revision end no run."""
    scores = derive.scores(spark, sf_dir).withColumn("config", F.when(F.col("run_id") % 20 != 0, F.lit('{"a":1,"b":{"c":[true,null,"1"]},"error":"x"}')))
    revision = F.when(F.col("run_id") % 10 == 0, F.col("revision")).otherwise("another")
    failures = scores.where("run_id % 5 = 0").select("run_id", "student", revision.alias("revision"), F.expr("repeat('e', cast(1999 + run_id % 3 as int))").alias("error"))
    return merge.mark_failed(scores, failures, as_of()).select("run_id", "status", "finished_at", "config")


@query("find_by_hash", "SELECT o_orderkey AS run_id, md5(o_custkey::VARCHAR) AS model_hash FROM orders WHERE md5(o_custkey::VARCHAR) = md5('7')")
def find_by_hash(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.md5(F.col("o_custkey").cast("string")).alias("model_hash")).where(F.col("model_hash") == F.md5(F.lit("7")))


@query("latest_anti_copy", "SELECT user_id AS student, ts AS round_ts, event_type AS verdict FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_anti_copy(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("student"), F.col("ts").alias("round_ts"), F.col("event_type").alias("verdict"), "event_id")
    return pairs.latest_by(rows, ["student"], "round_ts", "event_id").drop("event_id")


@query("stale_heartbeats", f"SELECT user_id AS worker_id, max(ts) AS last_seen FROM events GROUP BY user_id HAVING max(ts) < {AS_OF} - INTERVAL 5 DAY")
def stale_heartbeats(spark, sf_dir):
    seen = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("worker_id")).agg(F.max("ts").alias("last_seen"))
    return seen.where(F.col("last_seen") < cells.before(as_of(), 5 * 86_400))


# -- writes as plans -------------------------------------------------------------------------------------------------------


@query(
    "rollout_upsert",
    sql(
        f"""SELECT env_name, task_id, teacher_name, sample_idx, CASE WHEN created_at > {SINCE} THEN status ELSE 'old' END AS status, CASE WHEN created_at > {SINCE} THEN reward END AS reward,
              CASE WHEN task_id % 2 = 0 THEN 'kept' END AS group_label FROM rollouts WHERE created_at > {SINCE} OR task_id % 2 = 0""",
        ROLLOUTS,
    ),
)
def rollout_upsert(spark, sf_dir):
    rolls, key = _rolls(spark, sf_dir), ["env_name", "task_id", "teacher_name", "sample_idx"]
    current = rolls.where("task_id % 2 = 0").select(*key, F.lit("old").alias("status"), F.lit(None).cast("double").alias("reward"), F.lit("kept").alias("group_label"))
    incoming = rolls.where(F.col("created_at") > since()).select(*key, "status", "reward", F.lit(None).cast("string").alias("group_label"))
    return merge.upsert(current, incoming, key, merge.KEPT["rollouts"])


def _submissions(spark, sf_dir, by):
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("student"), F.concat(F.lit("r"), F.col("c_nationkey")).alias("revision"), F.md5(F.col("c_name")).alias("model_hash"), (F.col("c_acctbal") > 0).alias("is_valid"),
        F.concat(F.lit(by), F.col("c_mktsegment")).alias("submitted_by"), F.col("c_acctbal").alias("submitted_at"),
    )


@query(
    "submission_upsert",
    """SELECT c_custkey AS student, 'r' || c_nationkey AS revision, md5(CASE WHEN c_custkey % 2 = 0 THEN c_name || 'x' ELSE c_name END) AS model_hash,
         CASE WHEN c_custkey % 3 = 0 THEN 'old ' ELSE 'new ' END || c_mktsegment AS submitted_by, c_acctbal > 0 AS is_valid
       FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0""",
)
def submission_upsert(spark, sf_dir):
    """A submission that comes again, in two forms of which the later counts, keeps who submitted it."""
    old = _submissions(spark, sf_dir, "old ").where("student % 3 = 0")
    name = F.md5(F.concat(F.col("c_name"), F.lit("x")))
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("student"), name.alias("other"))
    again = _submissions(spark, sf_dir, "new ").where("student % 2 = 0")
    later = again.join(names, "student").withColumns({"model_hash": F.col("other"), "submitted_at": F.col("submitted_at") + 1}).drop("other")
    return merge.upsert_into("student_submissions", old, again.unionByName(later), F.col("submitted_at")).drop("submitted_at")


@query(
    "deployment_upsert",
    """SELECT c_custkey AS deployment_id, CASE WHEN c_custkey % 3 = 0 THEN 'h' || c_nationkey ELSE 'moved' END AS host, CASE WHEN c_custkey % 2 = 0 THEN 'stopped' ELSE 'running' END AS status,
         c_custkey % 3 AS student FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0""",
)
def deployment_upsert(spark, sf_dir):
    """A deployment keeps its host and student, and takes the new status."""
    c = table(spark, sf_dir, "customer")
    rows = lambda host, status: c.select(F.col("c_custkey").alias("deployment_id"), host.alias("host"), F.lit(status).alias("status"), (F.col("c_custkey") % 3).alias("student"))
    old, new = rows(F.concat(F.lit("h"), F.col("c_nationkey")), "running").where("deployment_id % 3 = 0"), rows(F.lit("moved"), "stopped").where("deployment_id % 2 = 0")
    return merge.upsert_into("student_deployments", old, new)


@query("valid_submissions", "SELECT c_custkey AS student, md5(c_name) AS model_hash FROM customer WHERE c_acctbal > 0")
def valid_submissions(spark, sf_dir):
    return lookups.valid_submissions(_submissions(spark, sf_dir, "")).select("student", "model_hash")


@query("submissions_by_hash", "SELECT c_custkey AS student FROM customer WHERE md5(c_name) = (SELECT md5(min(c_name)) FROM customer)")
def submissions_by_hash(spark, sf_dir):
    first = table(spark, sf_dir, "customer").agg(F.min("c_name")).first()[0]
    return lookups.by_model_hash(_submissions(spark, sf_dir, ""), F.md5(F.lit(first))).select("student")


@query("latest_submissions", "SELECT c_custkey AS student, c_acctbal AS submitted_at FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal DESC, c_custkey, 'r' || c_nationkey LIMIT 25")
def latest_submissions(spark, sf_dir):
    return lookups.listed("student_submissions", lookups.valid_submissions(_submissions(spark, sf_dir, "")), 25).select("student", "submitted_at")


_UPSERTED = "env_name string, task_id long, teacher_name string, sample_idx int, status string, reward double, group_label string"


@query(
    "rollout_upsert_buckets",
    sql(
        f"""SELECT env_name, task_id, teacher_name, sample_idx, CASE WHEN created_at > {SINCE} THEN status ELSE 'old' END AS status, CASE WHEN created_at > {SINCE} THEN reward END AS reward,
              CASE WHEN task_id % 2 = 0 THEN 'kept' END AS group_label FROM rollouts WHERE created_at > {SINCE} OR task_id % 2 = 0""",
        ROLLOUTS,
    ),
)
def rollout_upsert_buckets(spark, sf_dir):
    """The same in a stored table, where the upsert rewrites the touched buckets; a repeated batch changes nothing."""
    rolls, key = _rolls(spark, sf_dir), ["env_name", "task_id", "teacher_name", "sample_idx"]
    held = buckets.Buckets(spark, derive.new_folder(spark, "upsert"), _UPSERTED, key, 16)
    held.upsert(rolls.where("task_id % 2 = 0").select(*key, F.lit("old").alias("status"), F.lit(None).cast("double").alias("reward"), F.lit("kept").alias("group_label")))
    incoming = rolls.where(F.col("created_at") > since()).select(*key, "status", "reward", F.lit(None).cast("string").alias("group_label"))
    for _ in range(2):
        held.upsert(incoming, merge.KEPT["rollouts"], once=("load", 0))
    return held.read()


@query(
    "claims_in_buckets",
    sql(
        f"""SELECT {CELL}, attempts + coalesce(claimed, 0) AS attempts, collected FROM progress LEFT JOIN (
              SELECT {CELL}, 1 AS claimed FROM progress WHERE {CLAIMABLE} ORDER BY {CLAIM_ORDER} LIMIT 8) USING ({CELL})""",
        ROLLOUTS,
        PROGRESS,
    ),
)
def claims_in_buckets(spark, sf_dir):
    """Progress after a tick of the claim loop, which comes twice."""
    rows, keys = _progress(spark, sf_dir), CELL.split(", ")
    held = buckets.Buckets(spark, derive.new_folder(spark, "claims"), rows.schema.simpleString()[7:-1], keys, 16)
    held.upsert(rows)
    for _ in range(2):
        streams.bucket_claim_tick(held, lambda claimed: None, 8)(rows, 0)
    return held.read().select(*keys, "attempts", "collected")


@query("rollout_last_write", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def rollout_last_write(spark, sf_dir):
    return merge.last_of(table(spark, sf_dir, "events"), ["user_id", "event_type"], F.col("ts"), F.col("event_id")).select("user_id", "event_type", "event_id", "value")


@query("task_insert_ignore", sql("SELECT env_name, task_id, length(problem) AS n FROM tasks WHERE task_id % 3 <> 0", TASKS))
def task_insert_ignore(spark, sf_dir):
    tasks = derive.tasks(spark, sf_dir)
    return merge.insert_ignore(tasks.where("task_id % 3 = 0"), tasks, ["env_name", "task_id"]).select("env_name", "task_id", F.length("problem").cast("long").alias("n"))


@query("status_update", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'CLOSED' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def status_update(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return merge.update(customer, customer.where("c_custkey % 4 = 0").select("c_custkey", F.lit("CLOSED").alias("c_mktsegment")), ["c_custkey"])


# -- texts ----------------------------------------------------------------------------------------------------------------

LOG = "'=== ' || l_quantity::INTEGER || ' passed, ' || l_linenumber || ' failed in 0.1s ==='"


@query(
    "pytest_parse",
    f"""WITH l AS (SELECT l_orderkey, l_linenumber, {LOG} AS line FROM lineitem),
        p AS (SELECT l_orderkey, l_linenumber, regexp_extract(line, '(\\d+)\\s+passed', 1)::INTEGER AS passed, regexp_extract(line, '(\\d+)\\s+failed', 1)::INTEGER AS failed FROM l)
        SELECT l_orderkey, l_linenumber, passed, passed + failed AS total, round(passed / (passed + failed), 9) AS score FROM p""",
)
def pytest_parse(spark, sf_dir):
    noise = "\n".join(f"line {i}" for i in range(20))
    line = F.concat(F.lit("=== "), F.col("l_quantity").cast("int").cast("string"), F.lit(" passed, "), F.col("l_linenumber").cast("string"), F.lit(" failed in 0.1s ==="))
    log = F.concat(F.lit("=== 9 passed, 9 failed\n" + noise + "\n"), line, F.lit("\nbye"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.pytest_result(log).alias("r"))
    return rows.select("l_orderkey", "l_linenumber", "r.passed", "r.total", F.round("r.score", 9).alias("score"))


@query(
    "pytest_tail",
    """SELECT l_orderkey, l_linenumber, CASE WHEN (l_orderkey + l_linenumber) % 60 < 50 THEN l_quantity::INTEGER ELSE 0 END AS passed FROM lineitem""",
)
def pytest_tail(spark, sf_dir):
    """Logs whose one count stands in the first to sixtieth last line, and that end in a line end of one kind or another: the last 50 lines count."""
    after = (F.col("l_orderkey") + F.col("l_linenumber")) % 60
    end = F.element_at(F.array(*map(F.lit, ("\n", "\r\n", "\r", "\u2028", ""))), (F.col("l_orderkey") % 5 + 1).cast("int"))
    feed = F.when(end == "", F.lit("\n")).otherwise(end)
    tail = F.array_join(F.transform(F.sequence(F.lit(0), after.cast("int")), lambda i: F.when(i == 0, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("  passed"))).otherwise(F.lit("line"))), "\u0000")
    log = F.concat(F.lit("x"), feed, F.concat_ws("", F.array(F.replace(tail, F.lit("\u0000"), feed))), end)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.pytest_result(log)["passed"].alias("passed"))


@query(
    "runs_graded",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN round((event_id % 9) / (event_id % 9 + 3)::DOUBLE, 9) ELSE value END AS reward,
         CASE WHEN event_id % 4 = 0 THEN '' ELSE 'diff ' || event_id || chr(10) END AS patch FROM events""",
)
def runs_graded(spark, sf_dir):
    i = F.col("event_id").cast("string")
    log = F.concat(F.lit("==== "), (F.col("event_id") % 9).cast("string"), F.lit(" passed, 3 failed in 1s ====\n"))
    diff = F.when(F.col("event_id") % 4 == 0, F.lit(" \n")).otherwise(F.concat(F.lit("\n diff "), i, F.lit("\n\n")))
    env = F.when(F.col("event_type") == "error", "swe-rebench:python").otherwise(F.concat(F.lit("verifiers:"), "event_type"))
    runs = table(spark, sf_dir, "events").select("event_id", env.alias("env_name"), log.alias("log"), diff.alias("diff"), F.col("value").alias("reward"))
    return environments.graded(runs).select("event_id", F.when(F.col("env_name").startswith("swe"), F.round("reward", 9)).otherwise(F.col("reward")).alias("reward"), "patch")


@query(
    "prompts",
    """SELECT p_partkey, concat_ws(chr(10), CASE WHEN p_size % 2 = 0 THEN 'Repository: ' || p_brand END, CASE WHEN p_size % 3 = 0 THEN 'Language: ' || p_type END, p_name, CASE WHEN p_size % 5 = 0 THEN 'hint' END) AS prompt,
         p_name || chr(10) AS patch, CASE WHEN p_size % 4 > 0 THEN least(p_size, p_size % 4 * 10) ELSE p_size END AS max_tokens, CASE WHEN p_size % 2 = 0 THEN 0.5 END::DOUBLE AS temperature FROM part""",
)
def prompts(spark, sf_dir):
    size = F.col("p_size")
    prompt = text.user_prompt(F.col("p_name"), F.when(size % 2 == 0, F.col("p_brand")), F.when(size % 3 == 0, F.col("p_type")).otherwise(""), F.when(size % 5 == 0, F.lit("hint")))
    args = text.sampling_args(size, size % 4 * 10, F.when(size % 2 == 0, F.lit(0.5)).otherwise(F.lit(-1.0)), F.lit(-1.0))
    rows = table(spark, sf_dir, "part").select("p_partkey", prompt.alias("prompt"), text.patch_text(F.concat(F.lit("\n\t "), "p_name", F.lit("\n\n\n"))).alias("patch"), args.alias("a"))
    return rows.select("p_partkey", "prompt", "patch", "a.max_tokens", "a.temperature")


@query(
    "chat_response",
    """SELECT conv_id, turn, text, CASE WHEN turn % 2 = 0 THEN 'stop' END AS finish_reason, turn AS tokens_in, CASE WHEN turn % 3 = 0 THEN conv_id END AS tokens_out,
         CASE turn % 3 WHEN 0 THEN '{"a":1}' ELSE '{}' END AS usage FROM conversations""",
)
def chat_response(spark, sf_dir):
    turn = F.col("turn")
    body = F.to_json(
        F.struct(
            F.array(F.struct(F.struct(F.col("text").alias("content")).alias("message"), F.when(turn % 2 == 0, "stop").alias("finish_reason"))).alias("choices"),
            F.struct(turn.alias("prompt_tokens"), F.when(turn % 3 == 0, F.col("conv_id")).alias("completion_tokens")).alias("usage"),
        )
    )
    usage = F.when(turn % 3 == 0, F.lit('{"a":1}')).when(turn % 3 == 1, F.lit("[1]")).otherwise(F.lit("no json"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", chat.response(body).alias("r"), chat.usage_object(usage).alias("usage"))
    return rows.select("conv_id", "turn", "r.*", "usage")


@query(
    "request_texts",
    """SELECT conv_id, '[' || string_agg('{"role":"' || role || '","content":' || to_json(coalesce(text, ''))::VARCHAR || CASE WHEN role = 'tool' THEN ',"tool_call_id":"c"' ELSE '' END || '}', ',' ORDER BY turn, role, text) || ']' AS messages
       FROM conversations GROUP BY conv_id""",
)
def request_texts(spark, sf_dir):
    none = F.lit(None).cast("array<struct<id:string,name:string,arguments:string,malformed:boolean>>")
    full = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), none.alias("tool_calls"), F.lit("c").alias("tool_call_id")))
    return derive.trajectories(spark, sf_dir).select("conv_id", chat.request_messages(full).alias("messages"))


@query("task_file", "SELECT doc_id::INTEGER AS task_id, 'docs' AS env_name, md5(text) AS problem FROM documents WHERE doc_id >= 5")
def task_file(spark, sf_dir):
    """The documents as a JSON-lines task file, read back; blank lines and lines that aren't JSON are in it."""
    at = f"{derive.new_folder(spark, 'tasks')}/lines"
    line = F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("problem_statement")))
    noise = F.when(F.col("doc_id") % 3 == 0, F.array(line, F.lit(" "))).when(F.col("doc_id") % 3 == 1, F.array(F.lit("{broken"), line)).otherwise(F.array(line))
    table(spark, sf_dir, "documents").select(F.explode(noise).alias("value")).write.text(at)
    return files.tasks(spark, at, "docs", lo=5).select("task_id", "env_name", F.md5("problem").alias("problem"))


@query("task_lookup", "SELECT doc_id::INTEGER AS task_id, 'docs' AS env_name, md5(text) AS problem FROM documents WHERE doc_id % 7 <> 3")
def task_lookup(spark, sf_dir):
    """Tasks found by their ids through an index of the task file, in which every fifth task has an older line before."""
    at = derive.new_folder(spark, "tasks")
    docs = table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    line = F.to_json(F.struct(F.col("doc_id").alias("id"), F.when(F.col("text") != "", F.col("text")).alias("problem_statement")))
    older = F.to_json(F.struct(F.col("doc_id").alias("task_id"), F.lit("older").alias("problem")))
    noise = F.when(F.col("doc_id") % 5 == 0, F.array(older, F.lit(" "), line)).otherwise(F.array(F.lit("{broken"), line))
    docs.select(F.explode(noise).alias("value")).write.text(f"{at}/lines")
    index = files.TaskIndex(spark, f"{at}/index", "docs")
    index.build(f"{at}/lines")
    return index.tasks(docs.where("doc_id % 7 <> 3").select(F.col("doc_id").alias("task_id"))).select("task_id", "env_name", F.md5("problem").alias("problem"))


@query(
    "dataset_tasks",
    """WITH c AS (
         SELECT conv_id, string_agg(CASE WHEN role <> 'assistant' THEN text END, chr(10) || chr(10) ORDER BY turn, role, text) AS said,
           '[' || string_agg('{"role":"assistant","content":' || to_json(text) || '}', ',' ORDER BY turn, role, text) || ']' AS raw FROM conversations GROUP BY conv_id),
       n AS (SELECT *, row_number() OVER (ORDER BY md5(conv_id::VARCHAR)) - 1 AS task_id FROM c)
       SELECT 'verifiers:chat' AS env_name, task_id, CASE WHEN conv_id % 9 = 0 THEN raw ELSE said END AS problem, conv_id AS answer, CASE WHEN conv_id % 2 = 0 THEN 1 END AS k,
         CASE WHEN conv_id % 3 = 0 THEN task_id ELSE conv_id END AS example_id, 'chat' AS env FROM n""",
)
def dataset_tasks(spark, sf_dir):
    """An evaluation split as tasks; prompts that nobody but the assistant speaks in are their own text."""
    c = table(spark, sf_dir, "conversations")
    role = F.when(F.col("conv_id") % 9 == 0, "assistant").otherwise(F.col("role"))
    said = F.array_sort(F.collect_list(F.struct("turn", "role", "text", role.alias("as"))))
    prompt = F.transform("s", lambda m: F.struct(m["as"].alias("role"), m["text"].alias("content")))
    id_ = F.col("conv_id")
    rows = c.groupBy("conv_id").agg(said.alias("s")).select(
        F.md5(id_.cast("string")).alias("place"), prompt.alias("prompt"), id_.cast("string").alias("answer"), F.when(id_ % 2 == 0, F.struct(F.lit(1).alias("k"))).alias("info"), F.when(id_ % 3 != 0, id_).alias("example_id")
    )
    meta = lambda c, kind: F.get_json_object("meta", f"$.{c}").cast(kind)
    return files.dataset_tasks(None, "verifiers:chat", "place", evaluation=rows).select(
        "env_name", "task_id", "problem", meta("answer", "long").alias("answer"), meta("info.k", "int").alias("k"), meta("example_id", "long").alias("example_id"), meta("verifiers_env_id", "string").alias("env")
    )


@query(
    "manifest_file",
    sql(
        f"""SELECT row_number() OVER (ORDER BY task_idx) - 1 AS line_no, env_name, task_id, teacher_name, task_idx FROM (
              SELECT env_name, task_id::INTEGER AS task_id, teacher_name, 1000 + before AS task_idx
              FROM (SELECT *, coalesce(count(*) FILTER (action = 'commit') OVER (ORDER BY last_updated, {CELL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM classified)
              WHERE before < 200 AND action = 'commit')""",
        ROLLOUTS, PROGRESS, CLASSIFIED,
    ),
)
def manifest_file(spark, sf_dir):
    """The cycle's lines as a file, read back with their places."""
    at = f"{derive.new_folder(spark, 'manifest')}/lines"
    manifest_lines(spark, sf_dir).repartitionByRange(3, "task_idx").sortWithinPartitions("task_idx").select("value").write.text(at)
    return files.manifest(spark, at).where("valid").select("line_no", "env_name", "task_id", "teacher_name", "task_idx")


@query(
    "shard_files",
    sql(
        f"""SELECT (1000 + before)::BIGINT AS task_idx, count(*) AS n, round(sum(r.reward), 6) AS reward FROM (
              SELECT *, coalesce(count(*) FILTER (action = 'commit') OVER (ORDER BY last_updated, {CELL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM classified) c
            JOIN rollouts r ON r.env_name = c.env_name AND r.task_id = c.task_id AND r.teacher_name = c.teacher_name AND r.status = 'ok' AND r.sample_idx < c.attempts
            WHERE before < 200 AND action = 'commit' GROUP BY before""",
        ROLLOUTS, PROGRESS, CLASSIFIED,
    ),
)
def shard_files(spark, sf_dir):
    """The cycle's shards written as files and read back."""
    at, rolls = derive.new_folder(spark, "shards"), _rolls(spark, sf_dir)
    found = store.write_shards(publish.shard_rows(publish.plan_cycle(_classified(spark, sf_dir), 1000, 200), rolls), at)
    found.select("task_idx").agg(F.max("task_idx")).collect()  # writes the files
    idx = F.regexp_extract(F.col("_metadata.file_path"), r"(\d+)\.parquet$", 1).cast("long")
    rows = spark.read.schema("reward double, status string").parquet(f"{at}/tasks").select("reward", idx.alias("task_idx"))
    return rows.groupBy("task_idx").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("reward"), 6).alias("reward"))


@query(
    "reward_extract",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value WHEN event_id % 3 = 1 THEN (event_id % 7) / greatest(event_id % 11, 1)::DOUBLE END AS reward FROM events""",
)
def reward_extract(spark, sf_dir):
    i = F.col("event_id")
    body = F.when(i % 3 == 0, F.to_json(F.struct(F.col("value").alias("score")))).when(i % 3 == 1, F.to_json(F.struct((i % 7).alias("tests_passed"), (i % 11).alias("tests_total")))).otherwise(F.lit("{}"))
    return table(spark, sf_dir, "events").select("event_id", text.reward(body).alias("reward"))


@query(
    "status_ladder",
    """SELECT CASE WHEN k % 10 = 8 THEN 'teacher_error' WHEN k % 10 = 7 THEN 'env_error' WHEN k % 10 = 6 THEN 'parse_failed' WHEN k % 10 >= 4 THEN 'empty_completion' ELSE 'ok' END AS status, count(*) AS n
       FROM (SELECT cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY ALL""",
)
def status_ladder(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int") % 10
    status = text.status(k == 8, k == 7, k != 6, (k < 4) | (k == 9) & F.lit(False))
    return table(spark, sf_dir, "events").select(status.alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("comparable_content", "SELECT conv_id, count(*) AS n_messages, coalesce(bool_or(role = 'assistant' AND trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''), false) AS comparable FROM conversations GROUP BY conv_id")
def comparable_content(spark, sf_dir):
    calls = F.array().cast("array<struct<id:string>>")
    rows = derive.trajectories(spark, sf_dir).withColumn("messages", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), calls.alias("tool_calls"))))
    return rows.select("conv_id", F.size("messages").cast("long").alias("n_messages"), text.comparable(F.col("messages")).alias("comparable"))


@query("trajectory_roles", "SELECT conv_id, string_agg(role, ',' ORDER BY turn, role, text) AS roles, count(*) AS step_count FROM conversations GROUP BY conv_id")
def trajectory_roles(spark, sf_dir):
    rows = derive.trajectories(spark, sf_dir)
    return rows.select("conv_id", F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), F.size("messages").cast("long").alias("step_count"))


FOLD = """
t AS (SELECT *, coalesce(sum((type IN ('user.message', 'tool.result'))::INTEGER) OVER (PARTITION BY session ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS turn FROM trace),
d AS (SELECT *, coalesce(max(seq) FILTER (type = 'message.done' AND text IS NOT NULL) OVER (PARTITION BY session, turn), -1) AS last FROM t WHERE type <> 'tool.result'),
a AS (
  SELECT session, turn, string_agg(coalesce(delta, text, ''), '' ORDER BY seq) FILTER ((type = 'message.delta' AND seq > last) OR (type = 'message.done' AND seq = last)) AS text,
    count(*) FILTER (type = 'tool.request') AS n_calls, string_agg(call_id, ',' ORDER BY seq) FILTER (type = 'tool.request') AS calls FROM d GROUP BY session, turn)"""


@query(
    "events_to_steps",
    sql(
        """SELECT session, turn, 0 AS part, 'assistant' AS kind, nullif(trim(text, ' '), '') AS text, coalesce(calls, '') AS calls, NULL::VARCHAR AS tool_call_id FROM a WHERE text IS NOT NULL OR n_calls > 0
           UNION ALL SELECT session, turn, 1, 'tool_result', coalesce(result_summary, ''), '', call_id FROM t WHERE type = 'tool.result'""",
        TRACE, FOLD,
    ),
)
def events_to_steps(spark, sf_dir):
    steps = trajectory.fold(derive.trace(spark, sf_dir))
    return steps.select("session", "turn", "part", "kind", "text", F.array_join(F.transform("tool_calls", lambda c: c["id"]), ",").alias("calls"), "tool_call_id")


@query("trace_usage", sql("SELECT session, coalesce(sum(input_tokens), 0)::BIGINT AS tokens_in, count(*) FILTER (type = 'message.done') AS model_calls FROM trace GROUP BY session", TRACE))
def trace_usage(spark, sf_dir):
    return trajectory.usage(derive.trace(spark, sf_dir)).select("session", "tokens_in", "model_calls")


@query(
    "claude_thinking",
    """WITH c AS (SELECT conv_id, turn, role, CASE WHEN turn % 2 = 0 THEN '<Thinking> ' || left(text, 20) || ' </thinking> ' || substr(text, 21) || ' ' ELSE text END AS text FROM conversations),
       x AS (SELECT *, list_filter(list_transform(regexp_extract_all(text, '<thinking>(.*?)</thinking>', 1, 'is'), lambda p: trim(p, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda p: p <> '') AS parts FROM c)
       SELECT conv_id, turn, role, nullif(CASE WHEN regexp_matches(text, '<thinking>(.*?)</thinking>', 'is') THEN trim(regexp_replace(text, '<thinking>(.*?)</thinking>', '', 'gis'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) ELSE text END, '') AS content,
         nullif(array_to_string(parts, chr(10)), '') AS reasoning FROM x""",
)
def claude_thinking(spark, sf_dir):
    tagged = F.concat(F.lit("<Thinking> "), F.left("text", F.lit(20)), F.lit(" </thinking> "), F.substring("text", 21, 1 << 30), F.lit(" "))
    rows = table(spark, sf_dir, "conversations").withColumn("text", F.when(F.col("turn") % 2 == 0, tagged).otherwise(F.col("text")))
    return rows.select("conv_id", "turn", "role", trajectory.thinking(F.col("text")).alias("t")).select("conv_id", "turn", "role", "t.*")


@query("verifiers_content", "SELECT conv_id, 'ok' AS status, count(*) AS n, string_agg(role || ':' || coalesce(text, ''), '' ORDER BY turn, role, text) AS joined FROM conversations GROUP BY conv_id")
def verifiers_content(spark, sf_dir):
    parts = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), F.array(F.struct(F.lit("text").alias("type"), F.left(m["content"], F.lit(5)).alias("text")), F.struct(F.lit("text").alias("type"), F.substr(m["content"], F.lit(6)).alias("text"))).alias("content")))
    raw = derive.trajectories(spark, sf_dir).select("conv_id", F.lit("verifiers").alias("family"), F.to_json(parts).alias("steps"))
    rows = normalisers.normalised(raw)
    said = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return rows.select("conv_id", F.when(F.col("error").isNull(), "ok").otherwise("parse_failed").alias("status"), F.size("messages").cast("long").alias("n"), F.array_join(said, "").alias("joined"))


@query(
    "agent_messages",
    """SELECT conv_id, CASE WHEN conv_id % 7 = 0 THEN 'parse_failed' ELSE 'ok' END AS status, CASE WHEN conv_id % 7 <> 0 THEN count(*) END AS n,
         CASE WHEN conv_id % 7 <> 0 THEN string_agg(CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'assistant' ELSE 'tool' END || ':' || coalesce(text, '')
           || CASE WHEN role = 'assistant' THEN '[c' || turn || ' run {"k": ' || turn || '} false]' WHEN role = 'user' THEN '' ELSE '[c' || turn || ']' END, '' ORDER BY turn, role, text) END AS joined
       FROM conversations GROUP BY conv_id""",
)
def agent_messages(spark, sf_dir):
    """Steps as fold() makes them, normalised; a trajectory with a step of unknown kind is parse_failed."""
    c = table(spark, sf_dir, "conversations")
    kind = F.when(F.col("conv_id") % 7 == 0, "odd").when(F.col("role").isin("user", "assistant"), F.col("role")).otherwise("tool_result")
    id_ = F.concat(F.lit("c"), F.col("turn").cast("string"))
    calls = F.when(F.col("role") == "assistant", F.array(F.struct(id_.alias("id"), F.lit("run").alias("name"), F.struct(F.col("turn").alias("k")).alias("arguments"))))
    step = F.struct("turn", "role", F.col("text").alias("t"), F.struct(kind.alias("kind"), F.coalesce("text", F.lit("")).alias("text"), calls.alias("tool_calls"), id_.alias("tool_call_id")).alias("step"))
    steps = F.to_json(F.transform(F.array_sort(F.collect_list(step)), lambda x: x["step"]))
    rows = normalisers.normalised(c.groupBy("conv_id").agg(F.lit("events").alias("family"), steps.alias("steps")))
    call = lambda x: F.concat(F.lit("["), x["id"], F.lit(" "), x["name"], F.lit(" "), x["arguments"], F.lit(" "), x["malformed"].cast("string"), F.lit("]"))
    said = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"], F.array_join(F.transform(m["tool_calls"], call), ""), F.when(m["role"] == "tool", F.concat(F.lit("["), m["tool_call_id"], F.lit("]"))).otherwise("")))
    size = F.when(F.col("messages").isNotNull(), F.size("messages").cast("long"))
    return rows.select("conv_id", F.when(F.col("error").isNull(), "ok").otherwise("parse_failed").alias("status"), size.alias("n"), F.array_join(said, "").alias("joined"))


def _said():
    """A message as one text: role, content, reasoning, calls and call id."""
    call = lambda x: F.concat_ws(" ", x["id"], x["name"], x["arguments"], x["malformed"].cast("string"))
    part = lambda x: F.coalesce(x, F.lit("-"))
    one = lambda m: F.concat_ws("|", m["role"], part(m["content"]), part(m["reasoning"]), F.array_join(F.transform(m["tool_calls"], call), ";"), part(m["tool_call_id"]))
    size = F.when(F.col("messages").isNotNull(), F.size("messages").cast("long"))
    return F.when(F.col("error").isNull(), "ok").otherwise("parse_failed").alias("status"), size.alias("n"), F.array_join(F.transform("messages", one), "\n").alias("joined")


def _steps_of(spark, sf_dir, family, step):
    """Conversations as trajectories of a family: a step (a struct) for each message, in the order of turns."""
    c = table(spark, sf_dir, "conversations")
    rows = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", F.to_json(step).alias("step")))).alias("s"))
    joined = F.array_join(F.transform("s", lambda x: x["step"]), ",")
    return rows.select("conv_id", F.lit(family).alias("family"), F.concat(F.lit("["), joined, F.lit("]")).alias("steps"))


@query(
    "claude_messages",
    """WITH m AS (
         SELECT *, CASE role WHEN 'assistant' THEN 'assistant' WHEN 'user' THEN 'user' ELSE 'tool' END AS kind, substr(text, 1, 5) AS head, substr(text, 6) AS tail FROM conversations),
       w AS (
         SELECT *, kind || '|' || CASE
             WHEN kind = 'assistant' THEN text || '|why ' || turn || chr(10) || 'more' || chr(10) || '[unhandled block type=image]|c' || turn || ' run {"k": ' || turn
               || ', "of": [1, "a, b: \\"c\\""]} false;d' || turn || ' parse {"n": ' || turn || '} false;e odd {"_raw": "no json"} true;f none {} true|-'
             WHEN kind = 'user' AND turn % 2 = 0 THEN text || '|-||-'
             WHEN kind = 'user' THEN head || chr(10) || tail || '|-||-'
             ELSE head || chr(10) || tail || chr(10) || 'end|-||c' || turn END AS said,
           kind = 'assistant' AND conv_id % 7 = 0 AS bad FROM m)
       SELECT conv_id, CASE WHEN bool_or(bad) THEN 'parse_failed' ELSE 'ok' END AS status, CASE WHEN NOT bool_or(bad) THEN count(*) END AS n,
         CASE WHEN NOT bool_or(bad) THEN string_agg(said, chr(10) ORDER BY turn, role, text) END AS joined
       FROM w GROUP BY conv_id""",
)
def claude_messages(spark, sf_dir):
    """Content blocks: texts with thinking tags, thinking blocks, blocks of unknown type, and calls whose input is an object, JSON as text, another text or missing."""
    turn, head, tail = F.col("turn").cast("string"), F.substring("text", 1, 5), F.expr("substr(text, 6)")

    def block(kind, **members):
        return F.parse_json(F.to_json(F.struct(F.lit(kind).alias("type"), *((c if not isinstance(c, str) else F.lit(c)).alias(k) for k, c in members.items()))))

    whole = F.struct(F.col("turn").alias("k"), F.parse_json(F.lit('[1, "a, b: \\"c\\""]')).alias("of"))
    named = F.when(F.col("conv_id") % 7 != 0, "run")  # a call without a name can't be read
    spoken = F.array(
        block("text", text=F.concat(F.lit("<Thinking> why "), turn, F.lit(" </thinking>"), F.col("text"))), block("thinking", thinking="more"), block("image"),
        block("tool_use", id=F.concat(F.lit("c"), turn), name=named, input=whole), block("tool_use", id=F.concat(F.lit("d"), turn), name="parse", input=F.concat(F.lit('{"n": '), turn, F.lit("}"))),
        block("tool_use", id="e", name="odd", input="no json"), block("tool_use", id="f", name="none"),
    )
    told = F.array(block("text", text=head), block("image"), block("text", text=tail))
    inner = F.array(block("text", text=head), block("image"))
    results = F.array(block("tool_result", content=inner), block("text", text=tail), block("tool_result", content="end"))
    assistant, user = F.col("role") == "assistant", F.col("role") == "user"
    plain = user & (F.col("turn") % 2 == 0)
    step = F.struct(
        F.when(assistant, "assistant").when(user, "user").otherwise("tool_result").alias("kind"), F.when(plain, F.col("text")).alias("text"),
        F.when(assistant, spoken).when(user & ~plain, told).when(~user, results).alias("content_blocks"), F.when(~assistant & ~user, F.concat(F.lit("c"), turn)).alias("tool_call_id"),
    )
    return normalisers.normalised(_steps_of(spark, sf_dir, "claude", step)).select("conv_id", *_said())


@query(
    "verifiers_calls",
    """WITH w AS (
         SELECT *, CASE role
             WHEN 'assistant' THEN 'assistant|' || text || '|' || CASE WHEN turn % 3 = 0 THEN 'thought' ELSE 'other' END || '|c' || turn || ' run {"k": ' || turn || '} false;d text {"n": ' || turn
               || '} false;e raw {"_raw": "oops ' || turn || '"} false;f list {"_raw": [' || turn || ', null]} true;g none {} false;h number {"_raw": 7} false|-'
             WHEN 'user' THEN 'user|' || CASE WHEN turn % 2 = 0 THEN text ELSE turn::VARCHAR END || '|-||-'
             ELSE 'tool|' || text || '|-||c' || turn END AS said,
           role = 'user' AND conv_id % 11 = 0 AS bad FROM conversations)
       SELECT conv_id, CASE WHEN bool_or(bad) THEN 'parse_failed' ELSE 'ok' END AS status, CASE WHEN NOT bool_or(bad) THEN count(*) END AS n,
         CASE WHEN NOT bool_or(bad) THEN string_agg(said, chr(10) ORDER BY turn, role, text) END AS joined
       FROM w GROUP BY conv_id""",
)
def verifiers_calls(spark, sf_dir):
    """Chat messages with calls: arguments as an object, as JSON text, as another text, as JSON that is no object, missing, and as a number."""
    turn = F.col("turn").cast("string")

    def made(id_, name, arguments=None):
        function = F.struct(F.lit(name).alias("name"), *([] if arguments is None else [arguments.alias("arguments")]))
        return F.parse_json(F.to_json(F.struct(id_.alias("id"), function.alias("function"))))

    calls = F.array(
        made(F.concat(F.lit("c"), turn), "run", F.struct(F.col("turn").alias("k"))), made(F.lit("d"), "text", F.concat(F.lit('{"n": '), turn, F.lit("}"))),
        made(F.lit("e"), "raw", F.concat(F.lit("oops "), turn)), made(F.lit("f"), "list", F.concat(F.lit("["), turn, F.lit(", null]"))), made(F.lit("g"), "none"), made(F.lit("h"), "number", F.lit(7)),
    )
    assistant, user = F.col("role") == "assistant", F.col("role") == "user"
    parts = F.array(*(F.struct(F.lit("text").alias("type"), x.alias("text")) for x in (F.substring("text", 1, 5), F.expr("substr(text, 6)"))))
    content = F.when(user & (F.col("turn") % 2 == 0) | ~user & ~assistant, F.to_json(F.struct(F.col("text").alias("x")))).when(user, F.to_json(F.struct(F.col("turn").alias("x")))).otherwise(F.to_json(F.struct(parts.alias("x"))))
    role = F.when(user & (F.col("conv_id") % 11 == 0), "robot").when(assistant | user, F.col("role")).otherwise("tool")
    step = F.struct(
        role.alias("role"), F.variant_get(F.parse_json(content), "$.x", "variant").alias("content"), F.when(assistant, calls).alias("tool_calls"), F.when(assistant & (F.col("turn") % 3 == 0), "thought").otherwise(F.when(assistant, "")).alias("reasoning"),
        F.when(assistant, "other").alias("reasoning_content"), F.when(~assistant & ~user, F.concat(F.lit("c"), turn)).alias("tool_call_id"),
    )
    return normalisers.normalised(_steps_of(spark, sf_dir, "verifiers", step)).select("conv_id", *_said())


@query("trajectory_blob")
def trajectory_blob(spark, sf_dir):
    body = F.to_json("messages", {"ignoreNullFields": "false"})
    rows = derive.trajectories(spark, sf_dir).select("conv_id", body.alias("body")).withColumn("blob", codecs.compressed(F.col("body")))
    return rows.select("conv_id", codecs.digest(F.col("blob")).alias("sha256"), F.length("blob").alias("n_bytes"), (codecs.decompressed(F.col("blob")) == F.col("body")).alias("same"))


@query("expression_distance")
def expression_distance(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    answer = F.concat(F.lit("\\frac{m v^2}{2} + "), F.col("p_size").cast("string"), F.lit(" x"))
    test = F.when(F.col("p_partkey") % 3 == 0, answer).when(F.col("p_partkey") % 3 == 1, F.concat(F.col("p_size").cast("string"), F.lit(" x + \\frac{1}{2} m v^{2}"))).otherwise(F.lit("\\frac{m v^2}{3} + 5 x"))
    return scoring.answer_distances(p, answer, test, "p_partkey").select("p_partkey", "e.*")


@query("env_routing", sql("SELECT DISTINCT env_name, split_part(env_name, ':', 1) AS backend, CASE WHEN strpos(env_name, ':') > 0 THEN substr(env_name, strpos(env_name, ':') + 1) ELSE env_name END AS env_id FROM rollouts", ROLLOUTS))
def env_routing(spark, sf_dir):
    return _rolls(spark, sf_dir).select("env_name").distinct().withColumns({"backend": text.backend(F.col("env_name")), "env_id": text.env_id(F.col("env_name"))})


# -- metrics --------------------------------------------------------------------------------------------------------------


def _points(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "view", "counter").when(F.col("event_type") == "click", "gauge").otherwise("histogram")
    labels = metrics.labels_key(F.create_map(F.lit("z"), (F.col("user_id") % 2).cast("string"), F.lit("a"), F.lit("x")))
    return e.select("ts", kind.alias("kind"), F.col("event_type").alias("metric"), labels.alias("labels"), "value")


@query(
    "metrics_minutely",
    """WITH p AS (SELECT date_trunc('minute', ts) AS ts_minute, ts, event_type, '{"a":"x","z":"' || user_id % 2 || '"}' AS labels, value FROM events),
       g AS (SELECT ts_minute, event_type, labels, sum(value) AS s, arg_max(value, ts) AS l, count(value)::DOUBLE AS n, max(value) AS h FROM p GROUP BY ALL)
       SELECT ts_minute, event_type AS metric, labels, round(CASE WHEN event_type = 'click' THEN l ELSE s END, 6) AS value FROM g WHERE event_type IN ('view', 'click')
       UNION ALL SELECT ts_minute, event_type || '.' || x.k, labels, round(x.v, 6) FROM g, unnest([{'k': 'sum', 'v': s}, {'k': 'count', 'v': n}, {'k': 'max', 'v': h}]) u(x) WHERE event_type NOT IN ('view', 'click')""",
)
def metrics_minutely(spark, sf_dir):
    return metrics.minutely(_points(spark, sf_dir)).withColumn("value", F.round("value", 6))


@query(
    "metrics_minutely_sticky",
    """WITH p AS (SELECT date_trunc('minute', ts) AS ts_minute, ts, event_type, '{"a":"x","z":"' || user_id % 2 || '"}' AS labels, value FROM events),
       g AS (SELECT ts_minute, event_type, labels, sum(value) AS s, count(value)::DOUBLE AS n, max(value) AS h FROM p GROUP BY ALL),
       u AS (SELECT ts_minute, event_type AS metric, labels, max_by(value, (ts, value)) AS value FROM p WHERE event_type = 'click' GROUP BY ALL),
       e AS (SELECT max(ts_minute) AS until FROM p),
       grid AS (SELECT metric, labels, unnest(generate_series(min(ts_minute), any_value(until), INTERVAL 1 MINUTE)) AS ts_minute FROM u, e GROUP BY metric, labels)
       SELECT ts_minute, event_type AS metric, labels, round(s, 6) AS value FROM g WHERE event_type = 'view'
       UNION ALL SELECT grid.ts_minute, grid.metric, grid.labels, round(u.value, 6) FROM grid ASOF JOIN u ON u.metric = grid.metric AND u.labels = grid.labels AND u.ts_minute <= grid.ts_minute
       UNION ALL SELECT ts_minute, event_type || '.' || x.k, labels, round(x.v, 6) FROM g, unnest([{'k': 'sum', 'v': s}, {'k': 'count', 'v': n}, {'k': 'max', 'v': h}]) u(x) WHERE event_type NOT IN ('view', 'click')""",
)
def metrics_minutely_sticky(spark, sf_dir):
    """Gauges keep their value in every minute up to the last of all points."""
    points = _points(spark, sf_dir)
    until = points.agg(F.max("ts")).first()[0]
    return metrics.sticky_minutely(points, F.lit(until)).withColumn("value", F.round("value", 6))


@query("event_level_filter", "SELECT event_id, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' ELSE 'INFO' END AS level FROM events WHERE event_type IN ('error', 'purchase')")
def event_level_filter(spark, sf_dir):
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "purchase", "WARNING").otherwise("INFO")
    return metrics.at_least(table(spark, sf_dir, "events").select("event_id", level.alias("level")), "warning")


@query(
    "event_normalise",
    f"""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN {AS_OF} ELSE date_trunc('second', ts) END AS ts, left(repeat(event_type, 50), 200) AS event,
          CASE WHEN event_id % 2 = 0 THEN 'INFO' ELSE 'ERROR' END AS level FROM events""",
)
def event_normalise(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    raw = e.select(
        "event_id", F.when(F.col("event_id") % 4 == 0, "never").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"), F.repeat("event_type", F.lit(50)).alias("event"),
        F.when(F.col("event_id") % 2 == 1, "error").alias("level"), F.lit(None).cast("string").alias("service"), F.col("event_id").cast("string").alias("payload"),
    )
    out = metrics.normalised_events(raw, F.lit(derive.AS_OF).cast("timestamp"))
    return out.select(F.col("payload").cast("long").alias("event_id"), F.col("ts").cast("timestamp_ntz").alias("ts"), "event", "level")


@query(
    "event_whole",
    f"""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN {AS_OF} ELSE date_trunc('second', ts) END AS ts, 'unknown' AS service, CASE WHEN event_id % 2 = 0 THEN 'info' ELSE 'error' END AS level,
          left(repeat(event_type, 50), 200) AS event, CASE WHEN event_id % 3 = 0 THEN 'message ' || event_id END AS message, CASE WHEN event_id % 5 = 0 THEN '{{}}' ELSE props END AS context,
          user_id::VARCHAR AS trace_id, event_id::VARCHAR AS rollout_id, NULL::VARCHAR AS pair_id, CASE WHEN event_id % 7 = 0 THEN 'r' || event_id END AS run_id FROM events""",
)
def event_whole(spark, sf_dir):
    """Events with message, context and ids; every fourth time can't be read, every fifth context is missing or no object."""
    e, id_ = table(spark, sf_dir, "events"), F.col("event_id")
    raw = e.select(
        F.when(id_ % 4 == 0, "never").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("ts"), F.when(id_ % 2 == 1, "error").alias("level"), F.repeat("event_type", F.lit(50)).alias("event"),
        F.when(id_ % 3 == 0, F.concat(F.lit("message "), id_)).alias("message"), F.when(id_ % 10 == 0, "[1]").when(id_ % 5 != 0, F.col("props")).alias("context"),
        F.col("user_id").alias("trace_id"), id_.alias("rollout_id"), F.when(id_ % 7 == 0, F.concat(F.lit("r"), id_)).alias("run_id"),
    )
    out = metrics.whole_events(raw, F.lit(derive.AS_OF).cast("timestamp"))
    return out.withColumn("event_id", F.col("rollout_id").cast("long")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
