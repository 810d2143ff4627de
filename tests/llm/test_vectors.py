from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from rollweave.llm import vectorcodes
from rollweave.llm.common import Scratch
from rollweave.llm.registry import oracle_sql, queries
from tests.oracle import same

SCHEMA = "vec_id long, embedding array<double>, label int, code string"


def plain(rows, parts, entries, rounds):
    """Every part against every entry, in Python's integers."""
    kept = [(i, [math.floor(256 * x) if abs(256 * x) < 2**53 else int(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    size = width // parts
    kept = [(i, v, v + [0] * (width - len(v)), label) for i, v, label in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(w, p) for _, _, w, _ in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), e) for e, y in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, _, w, _ in kept:
                held.setdefault(nearest(cut(w, p), books[p])[1], []).append(cut(w, p))
            for e, own in held.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = []
    for i, _, w, label in kept:
        found = [nearest(cut(w, p), books[p]) for p in range(parts)]
        out.append((i, label, [e for _, e in found], sum(d for d, _ in found)))
    most = (1 << 63) - 1
    totals = {}
    for _, label, _, error in out:
        totals[label] = totals.get(label, 0) + min(error, most)
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(((i, c, min(e, most), min(totals[label], most)) for i, label, c, e in out), key=repr), hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, parts=4, entries=8, rounds=2):
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    found, books = vectorcodes.compressed(table, Scratch(spark, "t"), parts, entries, rounds)
    got = sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found.collect()), key=repr)
    assert (got, vectorcodes.digest(books)) == plain(rows, parts, entries, rounds)
    return got


def test_odd_rows(spark):
    r = np.random.default_rng(1)
    rows = [(int(i), r.normal(size=8).round(1).tolist(), int(i) % 3 or None) for i in r.permutation(60)]
    rows += [rows[0], rows[0], (3, [0.5] * 8, 1), (None, [0.25] * 8, None), (70, None, 1), (71, [1.0, None] * 4, 1), (72, [math.nan] * 8, 1), (73, [math.inf] * 8, 1), (74, [-0.001] * 8, 9)]
    assert len(check(spark, rows)) == 65


def test_ties_and_equal_entries(spark):
    check(spark, [(i, [float(i % 2), 0.0, float(i % 3 - 1), 1.0], 0) for i in range(50)], parts=2, entries=12)
    check(spark, [(i, [1.0] * 4, None) for i in range(20)], parts=2)


def test_few_short_and_no_vectors(spark):
    check(spark, [(1, [1.0, 2.0], 1), (2, [-1.5], None), (3, [], None), (None, [7.0, 1.0, 2.0], 1)])
    check(spark, [(1, [], 1), (2, [], 1)])
    check(spark, [])


def test_large_components(spark):
    check(spark, [(i, [(-1) ** i * 1e6 * i, 3.0, 1e5 + i, -(2.0**i)], i % 2) for i in range(40)], parts=2)
    check(spark, [(i, [1e30 * i, 1.0, -1e300, 2.0**i], i % 2) for i in range(30)], parts=2)


def test_many_labels_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vectorcodes, "BROADCAST_LABELS", 1)
    check(spark, [(i, [i / 7, i / 3], None if i % 3 else i) for i in range(90)], parts=2)


@pytest.mark.parametrize("kind", [np.int64, object])
def test_trees_equal_all_comparisons(kind):
    r = np.random.default_rng(2)
    for spread, dims in ((3, 1), (3, 2), (50, 4), (10_000, 4), (1 << 23, 8)):
        entries, points = r.integers(-spread, spread, (64, dims)), r.integers(-spread, spread, (300, dims))
        index, best = vectorcodes.VantageTree(entries.astype(kind)).nearest(points.astype(kind))
        squares = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()


def test_bounds_leave_entries_out():
    r = np.random.default_rng(3)
    centres = r.integers(-10_000, 10_000, (64, 4))
    tree = vectorcodes.VantageTree(centres)
    points = centres[r.integers(0, 64, 1000)] + r.integers(-300, 300, (1000, 4))
    tree.nearest(points)
    assert tree.compared < 0.5 * 64 * 1000


def test_roots():
    squares = np.array([0, 1, 2, 3, 4, 8, 9, 10, (1 << 26) ** 2 - 1, (1 << 26) ** 2, (1 << 26) ** 2 + 1, (1 << 29) ** 2 + 1])
    want = [math.isqrt(int(x)) for x in squares]
    assert vectorcodes.root_down(squares).tolist() == want == vectorcodes.root_down(squares.astype(object)).tolist()
    assert vectorcodes.root_up(squares).tolist() == [w + (w * w < int(x)) for w, x in zip(want, squares, strict=True)]


def test_against_sql(spark, sf):
    assert same(queries()["op13_vector_codes"](spark, sf), oracle_sql()["op13_vector_codes"], sf)
