from __future__ import annotations

import hashlib
import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollweave.llm import exactdedup, neardedup, setsketch
from rollweave.llm.common import Scratch
from rollweave.llm.components import connected_components

DOC = "doc_id long, text string, source string, digest string, row int, copy string"


def docs(spark, rows):
    """(doc_id, text) with columns whose names an operator might use itself."""
    return spark.createDataFrame([(i, t, "s", "d", 1, "c") for i, t in rows], DOC)


# -- perfect hash -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 100, 5000])
def test_perfect_hash(n):
    words = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), "<u8").reshape(-1, 4)
    held = exactdedup.PerfectHash.from_bytes(exactdedup.PerfectHash.build(words).to_bytes())
    assert sorted(held.find(words).tolist()) == list(range(n))
    other = np.frombuffer(os.urandom(3200), "<u8").reshape(-1, 4)
    assert ((held.find(other) >= -1) & (held.find(other) < n)).all()


def test_repeated_digests_are_refused():
    with pytest.raises(ValueError):
        exactdedup.PerfectHash.build(np.ones((2, 4), np.uint64))


# -- exact ------------------------------------------------------------------------------------------------------------------


def plain_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for members in groups.values():
        ids = [i for i in members if i is not None]
        keep, first = min(ids, default=None), True
        for i in sorted(members, key=lambda x: (x is None, x)):
            out.append((i, keep, len(members), i == keep and first))
            first = first and i != keep
    return sorted(out, key=repr)


def test_exact_groups(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a b", "a  b", "a\n\tb", " a b", "", None, "\x0b", "c", "c ", "z" * 200_000])) for i in rng.sample(range(1000), 200)]
    rows += [rows[0], rows[0], (None, "a b"), (None, "only"), (None, "only")] + [(2000 + i, "hot") for i in range(300)]
    df = docs(spark, rows).select("doc_id", exactdedup.digest(F.col("text")).alias("digest"))
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exactdedup.decide(df, Scratch(spark, "t")).collect()]
    assert sorted(got, key=repr) == plain_exact(rows)
    kept = exactdedup.deduplicated(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns and kept.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows})


def _bypassed(digests, found, slots):
    return np.zeros(len(digests), np.int64), np.zeros(len(digests), bool)


def _unchecked(digests, found, slots):
    at = found.find(exactdedup._words(digests)) if len(slots) and digests else np.zeros(len(digests), np.int64)
    return np.maximum(at, 0), (at >= 0) & (len(slots) > 0)


def _falsified(group):
    packed = PACK(group)
    slots = np.frombuffer(packed["slots"].iloc[0], exactdedup._SLOT).copy()
    slots["winner"] += 1
    return packed.assign(slots=[slots.tobytes()])


PACK = exactdedup._pack


@pytest.mark.parametrize(("name", "other"), [("members", _bypassed), ("members", _unchecked), ("_pack", _falsified)])
def test_the_index_decides(spark, monkeypatch, name, other):
    """Without the look-up, its byte check or the slots' winners the groups are others, in the pipeline's stage too."""
    rows = [(i, f"text {i % 40}") for i in range(100)] + [(200 + i, f"new {i // 2}") for i in range(60)] + [(300 + i, f"text {i % 50}") for i in range(80)]
    df = docs(spark, rows).select("doc_id", exactdedup.digest(F.col("text")).alias("digest"))

    def found():
        return sorted((tuple(r) for r in exactdedup.decide(df, Scratch(spark, "t")).select("doc_id", "keep_id", "group_size", "kept").collect()), key=repr)

    assert found() == plain_exact(rows)
    left = sorted(r["doc_id"] for r in exactdedup.deduplicated(docs(spark, rows)).collect())
    monkeypatch.setattr(exactdedup, name, other)
    assert found() != plain_exact(rows)
    assert left != sorted(r["doc_id"] for r in exactdedup.deduplicated(docs(spark, rows)).collect())


def test_exact_of_nothing(spark):
    assert exactdedup.deduplicated(docs(spark, [])).collect() == []
    assert exactdedup.deduplicated(docs(spark, [(None, None)])).count() == 1


# -- components -------------------------------------------------------------------------------------------------------------


def plain_components(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    star = [(5000, 5001 + i) for i in range(200)]
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + chain + star + star[:5] + [(7, 7), (None, 3), (999, None)]
    rng.shuffle(links)
    found = connected_components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t"))
    assert {r["node"]: r["component"] for r in found.collect()} == plain_components(links)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).collect() == []


# -- sketches ---------------------------------------------------------------------------------------------------------------


def pair(rng, n, j):
    shared = round(2 * n * j / (1 + j))
    pool = rng.integers(0, 2**63, 2 * n - shared, dtype=np.uint64)
    return pool[:n], pool[n - shared :]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    a, b, u = (setsketch.sketch(s, np.array([len(s)])) for s in (x[:600], x[500:], x))
    assert (setsketch.merge(a, b) == u).all()
    for j in (0.5, 0.8, 0.95):
        pairs = [pair(rng, 300, j) for _ in range(60)]
        left, right = (setsketch.sketch(np.concatenate([p[k] for p in pairs]), np.full(60, 300)) for k in (0, 1))
        size = np.full(60, 300)
        assert abs(setsketch.likeliest(left, right, size, size).mean() - j) < 0.02
        if j >= 0.8:
            assert (setsketch.band_keys(left) == setsketch.band_keys(right)).any(axis=1).all()


def test_batches_don_t_matter():
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 2, 5, 50, 3000)]
    together = setsketch.sketch(np.concatenate(sets), np.array([len(s) for s in sets]))
    assert all((setsketch.sketch(s, np.array([len(s)]))[0] == row).all() for s, row in zip(sets, together, strict=True))


# -- near -------------------------------------------------------------------------------------------------------------------


def plain_near(rows, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    found = plain_components(links)
    return {i: (len(s), found.get(i, i)) for i, s in sets.items()}


def variants(rng, n_bases=12, copies=12):
    """Bases with copies of growing distance, so that similarities lie on both sides of the limit, and chains of edits."""
    rows, i = [], 0
    for _ in range(n_bases):
        base = [f"W{rng.randrange(400)}" for _ in range(rng.choice([3, 40, 120]))]
        text = list(base)
        for c in range(copies):
            rows.append((i, " ".join(text)))
            i += 1
            text = list(base) if c % 2 else text
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_groups(spark, percent):
    rng = random.Random(percent)
    rows = variants(rng)
    rows += [(900 + k, t) for k, t in enumerate(["", None, " \n", "one", "ONE", "one two", "a b c d e", "A B\tC D E", "Ä b c d e", "ä b c d e"])]
    rows += [(2000 + k, rows[5][1].upper()) for k in range(40)]
    want = plain_near(rows, percent)
    found = neardedup.components_of(docs(spark, rows), Scratch(spark, "t"), percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    kept = neardedup.deduplicated(docs(spark, rows), percent)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c} and kept.columns == docs(spark, []).columns


def test_a_hub_of_copies_that_differ_from_each_other(spark):
    """The base comes last, so buckets' least documents are copies that link with the base but hardly with each other."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(0, 150, 6), 2):
            text[at] = f"y{i}{at}"
        rows.append((i, " ".join(text)))
    rows.append((60, " ".join(base)))
    want = plain_near(rows, 85)
    found = neardedup.components_of(docs(spark, rows), Scratch(spark, "t"), 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_near_of_odd_rows(spark):
    assert neardedup.deduplicated(docs(spark, [])).collect() == []
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f")]
    found = neardedup.components_of(docs(spark, rows), Scratch(spark, "t")).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in found), key=repr) == sorted([(None, None), (None, None), (1, 1), (1, 1), (2, 1)], key=repr)
    assert sorted((r["doc_id"] for r in neardedup.deduplicated(docs(spark, rows)).collect()), key=repr) == [1, 1, None, None]


def test_one_id_with_different_texts(spark):
    """Each text keeps its own links: plain_near over rows numbered by (doc_id, words)."""
    rng = random.Random(3)
    one, two, three = (" ".join(f"{c}{rng.randrange(500)}" for _ in range(60)) for c in "abc")
    near_two = two + " end"
    rows = [(1, two), (2, one), (2, near_two), (3, one.upper()), (4, three), (4, ""), (5, three), (5, three), (6, one + " z"), (6, "unique text"), (2, one), (None, one), (7, "x y"), (7, None)]
    found = neardedup.components_of(docs(spark, rows), Scratch(spark, "t"), 80)
    got = sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "first").collect()), key=repr)
    want = [
        (1, 56, 1, True), (2, 56, 2, True), (2, 57, 1, False), (3, 56, 2, False), (4, 56, 4, True), (4, 0, 4, True), (5, 56, 4, False), (5, 56, 4, False), (6, 57, 2, False),
        (6, 1, 6, True), (2, 56, 2, True), (None, 56, None, True), (7, 1, 7, True), (7, 0, 7, True),
    ]
    assert got == sorted(want, key=repr)
    assert {(r["doc_id"], r["component_id"], r["first"]) for r in found.collect() if r["doc_id"] == 2} == {(2, 2, True), (2, 1, False)}
    kept = neardedup.deduplicated(docs(spark, rows), 80)
    assert kept.columns == docs(spark, []).columns
    stay = [r for r, w in zip(rows, want, strict=True) if w[3]]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(stay, key=repr)


def test_kept_is_the_component_s_least_id(spark, tmp_path):
    """The query's column, also where one id holds two linked texts; the stage keeps one row of them all the same."""
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (1, text + " end"), (2, text + " more"), (3, "else"), (None, "no id")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in neardedup.op6_near_dedup(spark, str(tmp_path)).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert got == sorted([(1, 56, 1, True), (1, 57, 1, True), (2, 57, 1, False), (3, 1, 3, True), (None, 1, None, True)], key=repr)
    assert neardedup.deduplicated(docs(spark, rows), 80).count() == 3


def test_blocks_compare_in_the_first_shared_band():
    known = neardedup.WordHashes()
    text = " ".join(f"w{k}" for k in range(80))
    s = neardedup.shingles(neardedup.words_of(text), known)
    row = {"text": text, "n": len(s), "registers": setsketch.sketch(s, np.array([len(s)])).tobytes(), "member": True, "outsider": True}
    rows = [row | {"doc_id": k, "component": k} for k in (1, 2)]
    assert neardedup.compare_block(0, rows, 85, known) == [(1, 2), (2, 1)]
    assert neardedup.compare_block(3, rows, 85, known) == []


def test_a_bucket_of_fifty_thousand_near_copies(spark, monkeypatch):
    """Every copy changes one word of the first, so that it links with that and hardly with another; large buckets are met in parts."""
    monkeypatch.setattr(neardedup, "HOT", 1000)
    n = 50_000
    own = F.concat(F.lit("x"), F.col("id").cast("string"))
    word = lambda k: F.when((F.col("id") > 0) & (k == F.pmod(F.xxhash64("id"), F.lit(100))), own).otherwise(F.concat(F.lit("w"), k.cast("string")))
    words = F.transform(F.sequence(F.lit(0), F.lit(99)), word)
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"))
    found = neardedup.components_of(rows, Scratch(spark, "t"), 85)
    assert found.groupBy("component_id").count().collect() == [(0, n)]


def test_long_texts_and_small_blocks(spark, monkeypatch):
    """Blocks are cut by shingles too; links between the copies of a bucket's outsiders are found in every cut."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(3000)}" for _ in range(20_000)]
    rows = []
    for i in range(24):
        text = list(base) if i % 2 else [f"{x}{i % 6 // 2}" if k % 30 == 0 else x for k, x in enumerate(base)]
        for at in rng.sample(range(len(text)), 60 + 20 * (i % 7)):
            text[at] = f"y{i}.{at}"
        rows.append((i, " ".join(text)))
    want = plain_near(rows, 85)
    for shingles, block in ((1 << 20, 256), (30_000, 256), (1 << 20, 2)):
        monkeypatch.setattr(neardedup, "BLOCK_SHINGLES", shingles)
        monkeypatch.setattr(neardedup, "BLOCK", block)
        found = neardedup.components_of(docs(spark, rows), Scratch(spark, "t"), 85).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_texts_come_after_the_estimate(spark, monkeypatch):
    """Pairs meet as registers; only the documents of pairs that the estimate keeps have their texts read."""
    met = []
    held = neardedup._meet
    monkeypatch.setattr(neardedup, "_meet", lambda pairs, facts: met.append((pairs.count(), facts.columns, facts.count())) or held(pairs, facts))
    rng = random.Random(12)
    shared = [f"p{k}" for k in range(20)]  # passages shared by all make buckets, not pairs
    rows = [(i, " ".join(shared + [f"z{rng.randrange(10**6)}" for _ in range(60)])) for i in range(300)] + [(900, "a b c d e f g"), (901, "a b c d e f g h i j k l")]
    rows += [(902, " ".join(f"q{k}" for k in range(200))), (903, " ".join(f"q{k}" for k in range(201)))]
    neardedup.components_of(docs(spark, rows), Scratch(spark, "t"), 85).collect()
    (pairs, first, _), (likely, second, texts) = met
    assert first == ["doc_id", "registers", "n"] and second == ["doc_id", "text"]
    assert likely <= pairs and texts <= 2 * likely and texts < len(rows) / 2
