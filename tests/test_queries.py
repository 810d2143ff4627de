from __future__ import annotations

import pytest

from rollweave.plans import registry
from tests.oracle import same

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf, name):
    same(QUERIES[name](spark, sf), ORACLES[name], sf)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).limit(5).collect()


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["env_name", "n_cells", "n_varied", "yield"]


def test_a_sampling_list_has_each_environment_s_whole_range(spark, sf):
    rolls = registry._rolls(spark, sf).select("env_name", "task_id", "teacher_name").distinct().collect()
    teachers = {r["teacher_name"] for r in rolls}
    want = set()
    for env in {r["env_name"] for r in rolls}:
        ids = [r["task_id"] for r in rolls if r["env_name"] == env]
        want |= {(env, i, t) for i in range(min(ids), max(ids) + 1) for t in teachers}
    got = [tuple(r) for r in QUERIES["sampling_list_init"](spark, sf).select("env_name", "task_id", "teacher_name").collect()]
    assert len(got) == len(want) and set(got) == want and min(i for _, i, _ in got) < 10
