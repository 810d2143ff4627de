"""Shards that appear with their manifest line, and a source that drops the oldest events."""

from __future__ import annotations

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rollweave.schemas import SHARD, struct
from rollweave.sources import shards
from rollweave.streaming import bounded


def rows_of(spark, first, n):
    """n shards of three rollouts."""
    rows = spark.range(3 * n).select((F.col("id") % n + first).alias("task_idx"), F.floor(F.col("id") / n).alias("sample_idx"))
    return rows.select("task_idx", *((F.col(f.name) if f.name == "sample_idx" else F.lit(None)).cast(f.dataType).alias(f.name) for f in struct(SHARD)))


def lines_of(spark, first, n):
    return spark.range(first, first + n).select(F.col("id").alias("task_idx"), F.to_json(F.struct(F.col("id").alias("task_idx"))).alias("value"))


def state(root):
    manifest = f"{root}/manifest.jsonl"
    found = [json.loads(x)["task_idx"] for x in open(manifest).read().splitlines()] if os.path.exists(manifest) else []
    jobs = os.listdir(f"{root}/_jobs") if os.path.isdir(f"{root}/_jobs") else []
    files = sorted(os.listdir(f"{root}/tasks")) if os.path.isdir(f"{root}/tasks") else []
    return found, files, jobs


def test_shards_come_with_their_lines(spark, tmp_path):
    root = f"file://{tmp_path}"
    shards.publish_shards(rows_of(spark, 0, 20), lines_of(spark, 0, 20), root, "v1")
    shards.publish_shards(rows_of(spark, 20, 2), lines_of(spark, 20, 2), root, "v1/")
    assert state(f"{tmp_path}/v1") == (list(range(22)), [f"{i:08d}.parquet" for i in range(22)], [])
    assert pq.read_table(f"{tmp_path}/v1/tasks/00000021.parquet").column("sample_idx").to_pylist() == [0, 1, 2]
    shards.publish_shards(rows_of(spark, 0, 2).limit(0), lines_of(spark, 22, 2), root, "v1")
    assert state(f"{tmp_path}/v1")[0] == list(range(22))


def test_a_job_that_fails_leaves_nothing(spark, tmp_path):
    root = f"file://{tmp_path}"
    shards.publish_shards(rows_of(spark, 0, 2), lines_of(spark, 0, 2), root)
    before = state(tmp_path)
    bad = lines_of(spark, 2, 8).withColumn("value", F.when(F.col("task_idx") == 7, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        shards.publish_shards(rows_of(spark, 2, 8), bad, root)
    assert state(tmp_path) == before
    with pytest.raises(Exception, match="someone else"):  # two cycles from one manifest
        shards.publish_shards(rows_of(spark, 0, 2), lines_of(spark, 0, 2), root)
    assert state(tmp_path)[0] == before[0]


def test_a_task_that_fails_once(tmp_path):
    """Its first attempt has written a shard; the second one's files count, the first one's go."""
    writer = shards.ShardWriter({"root": f"file://{tmp_path}", "job": "j"})
    fields = [("task_idx", pa.int64()), *((f.name, pa.int64() if f.name == "sample_idx" else pa.null()) for f in struct(SHARD)), ("line", pa.string())]

    def batch(i):
        values = {"task_idx": i, "sample_idx": 0, "line": json.dumps({"task_idx": i})}
        return pa.RecordBatch.from_arrays([pa.array([values.get(n)], t) for n, t in fields], [n for n, _ in fields])

    def dies():
        yield batch(0)
        yield batch(1)
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(dies())
    assert len(os.listdir(f"{tmp_path}/_jobs/j")) == 1 and state(tmp_path)[:2] == ([], [])
    message = writer.write(iter([batch(0), batch(1)]))
    writer.commit([message, None])
    assert state(tmp_path) == ([0, 1], ["00000000.parquet", "00000001.parquet"], [])


def drain(spark, source, checkpoint):
    rows = spark.readStream.format("bounded_events").option("path", f"file://{source}").load()
    out = rows.writeStream.foreachBatch(lambda df, i: df.write.mode("overwrite").text(f"{checkpoint}-out/{i}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    out.awaitTermination(120)
    assert out.exception() is None
    return [json.loads(r["value"]) for r in spark.read.option("recursiveFileLookup", "true").text(f"{checkpoint}-out").collect()]


def test_the_oldest_events_are_dropped_and_counted(spark, tmp_path):
    spark.dataSource.register(bounded.BoundedEvents)
    source = tmp_path / "in"
    source.mkdir()
    for f in range(5):
        (source / f"{f}.json").write_text("".join(json.dumps({"n": f * 1000 + i}) + "\n\n" for i in range(1000)))
    found = drain(spark, source, f"{tmp_path}/c")
    assert sorted(x["n"] for x in found if "n" in x) == list(range(5000 - 2048, 5000))
    assert [x["message"] for x in found if x.get("event") == bounded.DROPPED] == [str(5000 - 2048)]
    (source / "5.json").write_text("".join(json.dumps({"n": 5000 + i}) + "\n" for i in range(100)))
    found = drain(spark, source, f"{tmp_path}/c")
    assert sorted(x["n"] for x in found if "n" in x) == list(range(5000 - 2048, 5100)) and len(found) == 2048 + 100 + 1
