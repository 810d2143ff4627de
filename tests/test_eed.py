from __future__ import annotations

import tracemalloc
from functools import lru_cache

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollweave.functions import eed
from rollweave.functions.trees import Tree, distance, score, subtree_cost
from rollweave.operators.scoring import answer_distances
from rollweave.plans.registry import QUERIES
from tests.conftest import SMALL

trees = st.recursive(st.sampled_from("abc").map(Tree), lambda kids: st.tuples(st.sampled_from("abc"), st.lists(kids, min_size=1, max_size=3)).map(lambda x: Tree(x[0], tuple(x[1]))), max_leaves=7)


def by_forests(a: Tree, b: Tree) -> float:
    """The same costs over forests as tuples, first tree first."""

    @lru_cache(None)
    def d(f, g):
        if not f and not g:
            return 0.0
        ways = []
        if f:
            ways += [d(tuple(f[0].children) + f[1:], g) + 1, d(f[1:], g) + subtree_cost(f[0].size())]
        if g:
            ways += [d(f, tuple(g[0].children) + g[1:]) + 1, d(f, g[1:]) + subtree_cost(g[0].size())]
        if f and g:
            ways.append(d(tuple(f[0].children), tuple(g[0].children)) + d(f[1:], g[1:]) + (f[0].label != g[0].label))
        return min(ways)

    return d((a,), (b,))


@settings(max_examples=60, deadline=None)
@given(trees, trees)
def test_distance(a, b):
    assert abs(distance(a, b) - by_forests(a, b)) < 1e-9
    assert distance(a, a) == 0 and abs(distance(a, b) - distance(b, a)) < 1e-9


def test_costs():
    assert [subtree_cost(n) for n in (1, 2, 5, 6, 15)] == [1, 2, 5, 5.6, 11]
    assert score(0, 3) == 100 and score(1, 5) == 40 and score(9, 5) == 0


def test_expressions():
    assert eed.compare(r"\frac{1}{2} m v^2", r"$\boxed{\frac{m v^{2}}{2}}$")[0] == 100
    assert eed.compare("2x+1", "2x+2") == (40.0, 0.2, 5.0, 1.0)
    assert eed.compare("a+b", "a+)") == (0.0, -1.0, -1.0, -1.0) == eed.compare(None, None)


def test_shortcuts(spark):
    rows = [("a", ""), ("a", None), ("\\int x", "x"), ("a", "\\sum x"), ("a+b", "a+b"), ("a", "aaaa"), ("x+y", "y+x")]
    got = [tuple(r["e"]) for r in spark.createDataFrame(rows, "a string, t string").coalesce(1).select(eed.eed(F.col("a"), F.col("t")).alias("e")).collect()]
    unfit = (0.0, -1.0, -1.0, -1.0)
    assert got == [unfit, unfit, unfit, (0.0, -1.0, -1.0, 1.0), (100.0, 0.0, -1.0, 0.0), unfit, (100.0, 0.0, 0.0, 0.0)]


def test_copies_are_compared_once(monkeypatch):
    seen = []
    monkeypatch.setattr(eed, "compare", lambda a, t: seen.append((a, t)) or (float(len(seen)), 0.0, 0.0, 0.0))
    batch = lambda: (pd.Series(["a", "b", "a", None, "a"]), pd.Series(["x", "x", None, "x", "x"]))
    got = [list(part["score"]) for part in eed._compared(iter([batch(), batch()]))]
    assert got == [[1.0, 2.0, 0.0, 3.0, 1.0]] * 2 and seen == [("a", "x"), ("b", "x"), (None, "x")]
    monkeypatch.setattr(eed, "KEPT_CHARS", 150)  # two pairs
    again = [list(part["score"]) for part in eed._compared(iter([batch(), batch()]))]
    assert again == [[4.0, 5.0, 0.0, 6.0, 7.0], [7.0, 8.0, 0.0, 9.0, 10.0]]


def test_rows_of_one_part_are_dealt_out(spark):
    rows = spark.range(400).coalesce(1).select("id", F.concat(F.lit("x+"), F.col("id") % 9).alias("t"))
    found = answer_distances(rows, F.lit("4+x"), F.col("t"), "id")
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 200
    assert {r["id"]: tuple(r["e"]) for r in found.collect()} == {i: eed.compare("4+x", f"x+{i % 9}") for i in range(400)}
    p = QUERIES["expression_distance"](spark, SMALL)
    assert p.select(F.spark_partition_id()).distinct().count() == 4


def test_memory_of_a_distance():
    def chain(n: int) -> Tree:
        return Tree("ab"[n % 2], (Tree("c"), chain(n - 1))) if n else Tree("a")

    tracemalloc.start()
    try:
        assert distance(chain(30), chain(30)) == 0 and tracemalloc.get_traced_memory()[1] < 2 << 20
    finally:
        tracemalloc.stop()
