from __future__ import annotations

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from rollweave.operators import lookups, merge
from rollweave.sources.appends import Appends
from rollweave.sources.buckets import Buckets
from rollweave.streaming import metrics as streams

SCHEMA = "k string, j int, v double, kept string"


@pytest.fixture
def table(spark, tmp_path):
    return Buckets(spark, f"file://{tmp_path}/t", SCHEMA, ["k", "j"], 16)


def files(table) -> dict[str, str]:
    """Bucket of each data file."""
    root = table.path.removeprefix("file://")
    return {f: os.path.basename(os.path.dirname(f)) for f in glob.glob(f"{root}/bucket=*/*.parquet")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upserts_equal_those_of_the_whole_table(spark, table):
    r, plain = random.Random(1), spark.createDataFrame([], SCHEMA)
    assert rows(table.read()) == []
    for n in (200, 3, 1, 0, 40):
        batch = {(r.choice(["a", "b", None]), r.randrange(60)): (r.random(), str(r.random())) for _ in range(n)}
        batch = spark.createDataFrame([(*k, *v) for k, v in batch.items() if k[0]], SCHEMA)
        table.upsert(batch, ["kept"])
        plain = spark.createDataFrame(merge.upsert(plain, batch, ["k", "j"], ["kept"]).collect(), SCHEMA)
        assert rows(table.read()) == rows(plain)
    table.upsert(batch.select("k", "j").limit(5))  # columns that a batch lacks stay
    assert rows(table.read()) == rows(plain)


def test_untouched_files_keep_their_names(spark, table):
    table.upsert(spark.range(400).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("j"), F.lit(0.5).alias("v"), F.lit("x").alias("kept")))
    before = files(table)
    batch = spark.createDataFrame([("7", 0, 9.0, "y"), ("new", 1, 1.0, "z")], SCHEMA)
    touched = table.touched(batch)
    assert 1 <= len(touched) <= 2 < len(set(before.values()))
    scanned = {f"bucket={b}" for b in touched}
    assert {os.path.basename(os.path.dirname(r[0])) for r in table.read(touched).select(F.input_file_name()).collect()} <= scanned
    plan = table.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan, plan
    table.upsert(batch)
    after = files(table)
    same = {f for f, b in before.items() if b not in scanned}
    assert same and same <= set(after) and not (set(before) - same) & set(after)
    assert table.read().count() == 401 and table.read().where("k = '7'").first()["v"] == 9.0


def test_inserts_and_updates(spark, table):
    table.upsert(spark.createDataFrame([("a", 1, 1.0, "x"), ("b", 2, 2.0, "y")], SCHEMA))
    table.insert_ignore(spark.createDataFrame([("a", 1, 9.0, "no"), ("c", 3, 3.0, "z"), ("c", 3, 4.0, "w")], SCHEMA), F.col("v"))
    table.update(spark.createDataFrame([("b", 2, 5.0), ("gone", 1, 1.0)], "k string, j int, v double"))
    assert rows(table.read()) == [("a", 1, 1.0, "x"), ("b", 2, 5.0, "y"), ("c", 3, 3.0, "z")]


def test_a_change_is_whole_whenever_its_writer_dies(spark, table, monkeypatch):
    first = spark.createDataFrame([(str(i), 0, 1.0, "x") for i in range(50)], SCHEMA)
    table.upsert(first)
    add = lambda current, batch: current.join(batch.select("k", "j", F.lit(1.0).alias("more")), ["k", "j"], "left").withColumn("v", F.col("v") + F.coalesce("more", F.lit(0.0))).drop("more")  # noqa: E731  not idempotent

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # in the swap, with some buckets gone
        m.setattr(Buckets, "_swap", lambda self, staged: (table.blobs.delete(next(iter({f"bucket={b}" for b in table.touched(first)}))), dies()))
        with pytest.raises(RuntimeError):
            table.change(first, add, ("q", 0))
    with monkeypatch.context() as m:  # after it, before the mark
        m.setattr(Buckets, "_apply", dies)
        with pytest.raises(RuntimeError):
            table.recover()
    assert not table.change(first, add, ("q", 0))  # made whole, and not made twice
    assert {r["v"] for r in table.read().collect()} == {2.0} and table.read().count() == 50
    os.makedirs(f"{table.path.removeprefix('file://')}/_staged/1.x.q/bucket=0")  # a write that wasn't done
    assert table.change(first, add, ("q", 1)) and {r["v"] for r in table.read().collect()} == {3.0}
    assert table.blobs.names("_staged") == []


def test_streams_upsert_touched_buckets(spark, table, tmp_path):
    source = f"{tmp_path}/in"
    for part, values in enumerate(([("a", 1, 1.0, "x"), ("a", 1, 2.0, "x"), ("b", 1, 1.0, "y")], [("a", 1, 3.0, "z")])):
        spark.createDataFrame(values, SCHEMA).coalesce(1).write.parquet(f"{source}/p{part}")
        spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(source).writeStream.foreachBatch(
            streams.bucket_sink(table, ["v"], ("kept",))
        ).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(120)
    assert rows(table.read()) == [("a", 1, 3.0, "x"), ("b", 1, 1.0, "y")]
    again = spark.createDataFrame([("a", 1, 0.0, "w")], SCHEMA)
    streams.bucket_sink(table, ["v"])(again, 1)  # the number of a batch that is in
    assert rows(table.read())[0] == ("a", 1, 3.0, "x")


def test_an_audit_row_comes_with_its_change(spark, tmp_path, monkeypatch):
    log = Appends(spark, f"file://{tmp_path}/log", Buckets.AUDIT)
    table = Buckets(spark, f"file://{tmp_path}/t", SCHEMA, ["k", "j"], 4, log)
    rows = spark.createDataFrame([("a", 1, 1.0, "x")], SCHEMA)
    row = {"ts": "2024-01-01", "actor": "me", "action": "load", "target": "a", "payload": "{}"}

    def dies(*_):
        raise RuntimeError("lost")

    for step, there in (("_stage", False), ("_swap", True), ("_note", True)):  # where the writer dies, and whether the change counts
        with monkeypatch.context() as m:
            m.setattr(Buckets, step, dies)
            with pytest.raises(RuntimeError):
                table.upsert(rows, audit=row | {"action": step})
        table.recover()
        assert ({r["action"] for r in log.read().collect()} >= {step}) is there
    table.update(rows, audit=row)
    assert sorted(r["action"] for r in log.read().collect()) == ["_note", "_swap", "load"] and table.blobs.names("_audits") == []
    with pytest.raises(ValueError, match="needs a log"):
        Buckets(spark, f"file://{tmp_path}/u", SCHEMA, ["k", "j"]).upsert(rows, audit=row)


def test_lookups(spark):
    teachers = spark.createDataFrame([("t", True), ("u", False), ("v", None)], "teacher_name string, active boolean")
    assert [r[0] for r in lookups.active_teachers(teachers).collect()] == ["t"]
    scores = spark.createDataFrame([("r1", "s", "v", "done", 1), ("r2", "s", "v", "queued", None), ("r3", "s", "v", "done", 2)], "run_id string, student string, revision string, status string, started_at int")
    assert [r[0] for r in lookups.listed("student_scores", lookups.with_status(scores, "done", "failed")).collect()] == ["r3", "r1"]
    assert [r[0] for r in lookups.listed("student_scores", lookups.with_status(scores), 3).collect()] == ["r3", "r1", "r2"]
    assert lookups.by_key("student_scores", scores, "r2", "s", "v").count() == 1 and lookups.by_key("student_scores", scores, "r2", "s", "no").count() == 0
    with pytest.raises(ValueError, match="has the key"):
        lookups.by_key("rollouts", scores, "x")
