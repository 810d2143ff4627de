from __future__ import annotations

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollweave.operators import cells, weights

STAMP = "timestamp_ntz'2024-03-01 12:00:00'"


def now():
    return F.expr(STAMP)


def lists(spark, **configs):
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in configs.items()], "list_name string, config string")


def pool_of(spark, names, shares=None, cells=40, **more):
    pool = {"envs": names, "teachers": ["north", "south"], "task_id_pool": {n: [1] for n in names}} | ({"env_weights": shares} if shares else {})
    return weights.parse_pool(lists(spark, one={"pool": pool, "target_active_cells": cells} | more))


def targets_of(df):
    return {r["env_name"]: r["n_target"] for r in weights.env_targets(df).collect()}


# -- targets ----------------------------------------------------------------------------------------------------------------


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=6), st.integers(10, 400), st.integers(0, 4))
def test_targets_share_the_cells_and_hold_the_floor(spark, shares, cells, floor):
    names = [f"env{i}" for i in range(len(shares))]
    got = targets_of(pool_of(spark, names, dict(zip(names, map(float, shares), strict=True)), cells, min_active_per_env=floor))
    want = {n: max(floor, round(x / sum(shares) * cells)) for n, x in zip(names, shares, strict=True)}  # Python rounds half to even too
    assert got == want and abs(sum(got.values()) - cells) <= len(names) * (0.5 + floor)


def test_halves_go_to_the_even_number(spark):
    assert targets_of(pool_of(spark, ["p", "q"], {"p": 1.0, "q": 1.0}, 5)) == {"p": 2, "q": 2}
    assert targets_of(pool_of(spark, ["p", "q"], {"p": 1.0, "q": 3.0}, 6)) == {"p": 2, "q": 4}


def test_listing_an_environment_more_often_weighs_it(spark):
    rows = {r["env_name"]: r for r in pool_of(spark, ["q", "p", "q", "r", "q", "q"]).collect()}
    assert {n: r["weight"] for n, r in rows.items()} == {"q": 4, "p": 1, "r": 1} and [rows[n]["pos"] for n in "qpr"] == [0, 1, 2]


def test_defaults_and_places_of_settings(spark):
    assert (weights.TARGET_ACTIVE, weights.TARGET_SAMPLES, cells.CELL_TTL_S, weights.MIN_ACTIVE) == (16, 8, 21_600, 1)
    bare = {"envs": ["p"], "teachers": ["north"], "task_id_pool": {"p": [0]}}
    got = {
        r["list_name"]: (r["target_active_cells"], r["target_samples"], r["cell_ttl_s"], r["min_active_per_env"])
        for r in weights.parse_pool(lists(spark, bare={"pool": bare}, inner={"pool": bare | {"cell_ttl_s": 7, "min_active_per_env": 3}}, both={"pool": bare | {"cell_ttl_s": 7}, "cell_ttl_s": 11})).collect()
    }
    assert got == {"bare": (16, 8, 21_600, 1), "inner": (16, 8, 7, 3), "both": (16, 8, 11, 1)}


def test_weights_below_zero_and_missing_ones_are_none(spark):
    assert targets_of(pool_of(spark, ["p", "q", "r"], {"p": -4.0, "q": 2.0}, 30, min_active_per_env=2)) == {"p": 2, "q": 30, "r": 2}
    assert targets_of(pool_of(spark, ["p", "q"], {"p": 0.0}, 30, min_active_per_env=3)) == {"p": 3, "q": 3}


@pytest.mark.parametrize("config", [{}, {"pool": 3}, {"pool": {"envs": [], "teachers": ["t"], "task_id_pool": {}}}, {"pool": {"envs": ["p"], "teachers": [], "task_id_pool": {"p": [1]}}}, {"pool": {"envs": ["p"], "teachers": ["t"], "task_id_pool": {"p": []}}}])
def test_pools_that_lack_something(spark, config):
    with pytest.raises(Exception, match="pool"):
        weights.parse_pool(lists(spark, one=config)).collect()


# -- weights by yield -------------------------------------------------------------------------------------------------------


def weighed(spark, yields, pins=None, **knobs):
    found = spark.createDataFrame([(e, n, 0, y) for e, (y, n) in yields.items()], "env_name string, n_cells long, n_varied long, yield double")
    rows = weights.env_weights(spark.createDataFrame([(e,) for e in [*yields, "unseen"]], "env_name string"), found, pins, **knobs).collect()
    return {r["env_name"]: (r["weight"], r["label"]) for r in rows}


def test_weights_follow_the_rule(spark):
    """Floor plus yield to the power alpha; poor environments keep the floor, young ones sample at the median, pins raise."""
    assert (weights.CUT_YIELD, weights.ALPHA, weights.MIN_CELLS, weights.FLOOR, weights.DEFAULT_PINS) == (0.10, 2.0, 30, 0.03, {"swe-rebench": 0.10})
    rng = random.Random(4)
    yields = {f"e{i}": (round(rng.random() * 0.6, 3), rng.choice([3, 29, 30, 90])) for i in range(24)}
    old = sorted(y for y, n in yields.values() if n >= 30)
    median = (old[(len(old) - 1) // 2] + old[len(old) // 2]) / 2
    pins = {"e0": 0.9, "e1": 1.0, "e2": 0.0}
    got = weighed(spark, yields, pins)
    for env, (y, n) in (yields | {"unseen": (0.0, 0)}).items():
        raw = 0.03 + (max(median, 0.1) ** 2 if n < 30 else 0 if y < 0.1 else y**2)
        assert got[env][0] == pytest.approx(max(raw, pins.get(env, 0)), abs=1e-6)
        assert ("warmup" in got[env][1]) == (n < 30) and ("CUT" in got[env][1]) == (n >= 30 and y < 0.1) and (" pinned>=" in got[env][1]) == (pins.get(env, 0) > raw)
    assert got["e0"][1].endswith(" pinned>=0.9") and got["e1"][1].endswith(" pinned>=1")


def test_without_old_environments_all_are_alike(spark):
    assert {w for w, _ in weighed(spark, {"p": (0.5, 4), "q": (0.0, 0)}).values()} == {0.04}


def test_reweighting_keeps_all_else(spark):
    pool = {"envs": ["p", "q"], "teachers": ["north"], "task_id_pool": {"p": [1], "q": [2]}, "odd": [1]}
    yields = spark.createDataFrame([("q", 50, 40, 0.9)], "env_name string, n_cells long, n_varied long, yield double")
    config = json.loads(weights.reweight(lists(spark, one={"pool": pool, "remark": {"x": None}}), yields, {}).first()["config"])
    assert config["remark"] == {"x": None} and config["pool"]["odd"] == [1] and config["pool"]["env_weights"] == {"p": 0.84, "q": 0.84}
    more = json.loads(weights.with_env(weights.with_env(json.dumps(config), "p", [9]), "z", [3, 4]))["pool"]
    assert more["envs"] == ["p", "q", "z"] and more["task_id_pool"] == {"p": [9], "q": [2], "z": [3, 4]}


def test_a_thousand_lists_are_one_plan(spark):
    """Every list gets what it would get alone, without a job before the result is asked for."""
    many = {
        f"l{i:03}": {"pool": {"envs": [f"e{i % 7}", f"e{i % 11}", "p"], "teachers": ["t"], "task_id_pool": {f"e{k}": [1] for k in range(11)} | {"p": [2]}, "env_weights": {"gone": 1.0}, "n": 1.5}, "k": [i, {"a": None}]}
        for i in range(1000)
    }
    yields = spark.createDataFrame([(f"e{k}", 40, 20, 0.05 * k) for k in range(10)], "env_name string, n_cells long, n_varied long, yield double")
    rows = lists(spark, **many).withColumn("status", F.lit("on"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("reweight", "")
    out = weights.reweight(rows, yields, {"p": 0.5})
    assert not tracker.getJobIdsForGroup("reweight") and out.columns == rows.columns
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    alone = {r["env_name"]: r["weight"] for r in weights.env_weights(spark.createDataFrame([(f"e{k}",) for k in range(11)] + [("p",)], "env_name string"), yields, {"p": 0.5}).collect()}
    got = {r["list_name"]: (json.loads(r["config"]), r["status"]) for r in out.collect()}
    assert len(got) == 1000
    for name, config in many.items():
        want = config | {"pool": config["pool"] | {"env_weights": {e: alone[e] for e in config["pool"]["envs"]}}}
        assert got[name] == (want, "on")


# -- topping up -------------------------------------------------------------------------------------------------------------

CELLS = "list_name string, env_name string, task_id int, teacher_name string, target_samples int, collected int, attempts int, age int"


def progress_of(spark, rows):
    df = spark.createDataFrame([(*r[:4], 8, 0, 0, r[4]) for r in rows], CELLS)
    return df.withColumns({"last_updated": now() - F.make_dt_interval(secs=F.col("age")), "published_at": F.lit(None).cast("timestamp_ntz")}).drop("age")


def test_each_list_counts_its_own_cells_by_its_own_ttl(spark):
    """Two lists over one environment: cells of the other list, and cells older than a list's own TTL, aren't active in it."""
    pool = {"envs": ["p"], "teachers": ["north", "south"], "task_id_pool": {"p": list(range(100))}}
    both = lists(spark, short={"pool": pool, "target_active_cells": 10, "cell_ttl_s": 60}, long={"pool": pool, "target_active_cells": 10, "cell_ttl_s": 600})
    old = [("short", "p", i, "north", 30) for i in range(3)] + [("short", "p", i, "north", 100) for i in range(3, 7)] + [("long", "p", i, "north", 100) for i in range(5)] + [("long", "p", 5, "north", 900)]
    targets, progress = weights.env_targets(weights.parse_pool(both)), progress_of(spark, old)
    tasks = spark.createDataFrame([("p", i) for i in range(100)], "env_name string, task_id int")
    added = weights.top_up(targets, progress, tasks, now())
    rows = [(r["list_name"], r["env_name"], r["task_id"], r["teacher_name"]) for r in added.collect()]
    assert sum(r[0] == "short" for r in rows) == 7 and sum(r[0] == "long" for r in rows) == 5
    assert len(set(rows)) == len(rows) and not set(rows) & {r[:4] for r in old}
    assert rows == [(r["list_name"], r["env_name"], r["task_id"], r["teacher_name"]) for r in weights.top_up(targets, progress, tasks, now()).collect()]
    assert {r["list_name"]: (r["inserted"], r["active_after"], r["saturated"]) for r in weights.top_up_report(targets, progress, added, now()).collect()} == {"short": (7, 10, []), "long": (5, 10, [])}


def test_an_environment_without_enough_cells_is_reported(spark):
    pool = {"envs": ["p", "q", "r"], "teachers": ["north"], "task_id_pool": {"p": [1, 2, 2], "q": list(range(30)), "r": [5]}}
    targets = weights.env_targets(weights.parse_pool(lists(spark, one={"pool": pool, "target_active_cells": 30})))
    tasks = spark.createDataFrame([("p", 1), ("p", 2), *(("q", i) for i in range(30))], "env_name string, task_id int")
    progress = progress_of(spark, [("one", "p", 1, "north", 9), ("two", "q", 3, "north", 9)])
    added = weights.top_up(targets, progress, tasks, now())
    got = [(r["env_name"], r["task_id"]) for r in added.collect()]
    assert [x for x in got if x[0] == "p"] == [("p", 2)] and sum(e == "q" for e, _ in got) == 10 and not any(e == "r" for e, _ in got)
    turns = {r["env_name"]: r["turn"] for r in weights.needs(targets, progress, now()).collect()}
    assert turns == {"q": 1, "r": 2, "p": 3}  # the largest deficit first, then the list's order
    assert weights.top_up_report(targets, progress, added, now()).first()["saturated"] == ["p", "r"]


# -- claims -----------------------------------------------------------------------------------------------------------------


def test_claims_take_what_is_nearly_done(spark):
    none = "cast(null as timestamp_ntz)"
    rows = [("l", "e", 1, "t", 8, 3, 4), ("l", "e", 2, "t", 8, 3, 3), ("l", "e", 3, "t", 8, 0, 4), ("l", "e", 4, "t", 8, 8, 9)]
    progress = spark.createDataFrame(rows, "list_name string, env_name string, task_id int, teacher_name string, target_samples int, collected int, attempts int")
    progress = progress.withColumns({"last_updated": now(), "published_at": F.expr(none)})
    got = cells.claim(progress, 2)
    assert [(r["task_id"], r["attempts"], r["slot"]) for r in got.collect()] == [(2, 4, 3), (1, 5, 4)]
    assert {r["task_id"]: r["attempts"] for r in cells.with_claims(progress, got).collect()} == {1: 5, 2: 4, 3: 4, 4: 9}


def test_a_list_has_a_bound_of_teachers(spark, monkeypatch):
    monkeypatch.setattr(cells, "MOST_TEACHERS", 3)
    env = spark.sql("select 'e' as env_name, named_struct('lo', 0, 'hi', 2) as task_id_range")
    names = lambda n: spark.range(n).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("teacher_name"))
    assert cells.sampling_list(env, names(3), "l", 8, now()).count() == 6
    with pytest.raises(Exception, match="too many teachers"):
        cells.sampling_list(env, names(4), "l", 8, now()).collect()
