from __future__ import annotations

import pytest

from rollweave.llm import registry
from tests.oracle import same

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf, name):
    assert same(QUERIES[name](spark, sf), ORACLES[name], sf)


def test_names():
    assert [n for n in QUERIES if n.startswith("op")] and {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
