from __future__ import annotations

import json
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rollweave.functions import codecs
from rollweave.operators import cells, merge, metrics, publish, stats
from rollweave.sources import files
from rollweave.sources.store import Publisher, Tables, audit
from rollweave.streaming import metrics as streams

def now():
    return F.expr("timestamp_ntz'2024-02-01 00:00:00'")



PROGRESS = "list_name string, env_name string, task_id int, teacher_name string, target_samples int, collected int, attempts int, last_updated string, published_at string, promoted_at string"
ROLLS = "rollout_id string, env_name string, task_id int, teacher_name string, sample_idx int, reward double, status string, created_at string"


def progress(spark, rows):
    df = spark.createDataFrame([("l", "e", t, "x", 3, c, a, "2024-01-01 00:00:00", p, None) for t, c, a, p in rows], PROGRESS)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("last_updated", "published_at", "promoted_at")})


def rolls(spark, rows):
    df = spark.createDataFrame([(f"r{t}-{i}", "e", t, "x", i, r, "ok", "2024-01-01 00:00:00") for t, i, r in rows], ROLLS)
    return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@pytest.fixture
def cells_and_rollouts(spark):
    p = progress(spark, [(t, 3, 3, None) for t in (1, 2, 3, 4)] + [(5, 1, 1, "2024-01-02 00:00:00")])
    r = rolls(spark, [(t, i, [0.0, 0.5, 1.0][i] if t != 2 else 0.5) for t in (1, 2, 4) for i in range(3)] + [(1, 7, 9.0)])
    return p, r


def test_publish_recovers_and_promotes(spark, cells_and_rollouts, tmp_path):
    p, r = cells_and_rollouts
    private, public = Publisher(spark, f"file://{tmp_path}/private", "v1"), Publisher(spark, f"file://{tmp_path}/public", "v1")
    pending = cells.pending(p, now())
    handled = private.publish(pending, r, now())
    assert {(x["task_id"], x["action"], x["task_idx"]) for x in handled.collect()} == {(1, "commit", 0), (2, "degenerate", None), (3, "empty", None), (4, "commit", 1)}
    shard = pq.read_table(tmp_path / "private/v1/tasks/00000000.parquet")
    assert shard.column("sample_idx").to_pylist() == [0, 1, 2] and shard.num_columns == 17
    lines = [json.loads(x) for x in (tmp_path / "private/v1/manifest.jsonl").read_text().splitlines()]
    assert [(x["task_idx"], x["task_id"], x["n_rollouts"], x["reward_std"]) for x in lines] == [(0, 1, 3, 0.408248), (1, 4, 3, 0.408248)]
    assert list(lines[0]) == sorted(lines[0])

    again = private.publish(pending, r, now())  # the marks were lost: nothing is published twice
    assert {(x["task_id"], x["action"]) for x in again.collect()} == {(1, "recovered"), (2, "degenerate"), (3, "empty"), (4, "recovered")}
    assert len((tmp_path / "private/v1/manifest.jsonl").read_text().splitlines()) == 2
    p = publish.marked(p, again, now()).persist()
    assert cells.pending(p, now()).count() == 0

    first = private.promote(public, p, now(), "2024-02-01T00:00:00+00:00", max_per_cycle=1)
    assert [x["task_id"] for x in first.collect()] == [1]
    meta = json.loads((tmp_path / "public/v1/metadata.json").read_text())["tasks"]
    assert meta == {"staged_released": 2, "completed_up_to": 1}
    both = private.promote(public, p, now(), "2024-02-01T00:00:00+00:00")  # the first mark was lost too
    assert sorted(x["task_id"] for x in both.collect()) == [1, 4]
    assert pq.read_table(tmp_path / "public/v1/tasks/00000001.parquet").num_rows == 3
    assert [json.loads(x)["promoted_at"] for x in (tmp_path / "public/v1/manifest.jsonl").read_text().splitlines()] == ["2024-02-01T00:00:00+00:00"] * 2


def test_cap_stops_right_after_the_last_commit(spark):
    from rollweave.schemas import LISTED_CELL

    kinds = ["empty", "commit", "degenerate", "commit", "recovered", "commit"]
    rows = [("l", "e", i, "x", 3, 3, 3, f"2024-01-01 00:00:{i:02d}", None, None) for i in range(len(kinds))]
    df = spark.createDataFrame(rows, PROGRESS).withColumn("action", F.element_at(F.array(*map(F.lit, kinds)), F.col("task_id") + 1))
    got = {r["task_id"]: r["task_idx"] for r in publish.plan_cycle(df, 7, 2).collect()}
    assert got == {0: None, 1: 7, 2: None, 3: 8}
    assert publish.plan_cycle(df.limit(0), 7, 2).select(*LISTED_CELL).collect() == []
    assert len(publish.plan_cycle(df, 7, 3).collect()) == 6


def test_promotion_numbers():
    assert publish.promotion_budget(40) == 60 and publish.promotion_budget(400) == 0 and publish.promotion_budget(9, max_per_day=0) == 200
    assert publish.staged_released(10, 500) == 110 and publish.staged_released(10, 50) == 50 and publish.staged_released(0, 999, 0, 0) == 100


def test_promotable_reads_bad_dates(spark):
    shape = "list_name string, env_name string, task_id int, teacher_name string, committed_at string, mature_at string"
    rows = [("l", "e", 1, "x", "2024-01-01T00:00:00+00:00", "bad"), ("l", "e", 2, "x", "2024-01-01T00:00:00+00:00", "2024-03-01T00:00:00Z"), ("l", "e", 3, "x", "2024-01-01T00:00:00+00:00", None)]
    private = spark.createDataFrame(rows, shape)
    assert sorted(r["task_id"] for r in publish.promotable(private, private.where("task_id = 3"), now()).collect()) == [1]


def test_tables_swap_versions(spark, tmp_path):
    t = Tables(spark, f"file://{tmp_path}/db")
    assert t.read("teachers").count() == 0
    new = spark.createDataFrame([("a", "p", "f", "{}", True)], "teacher_name string, provider string, family string, config string, active boolean")
    t.write("teachers", new)
    t.append("teachers", new.withColumn("teacher_name", F.lit("b")))
    t.write("teachers", merge.upsert(t.read("teachers"), new.withColumn("provider", F.lit("q")), ["teacher_name"]))
    assert {(r["teacher_name"], r["provider"]) for r in t.read("teachers").collect()} == {("a", "q"), ("b", "p")}
    assert audit(spark, "me", "did", "that", {"b": 1}, now(), 1).first()["payload"] == '{"b": 1}'


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, kept string")
    new = spark.createDataFrame([(2, None, "n"), (3, "c", "n")], "k int, v string, kept string")
    got = {r["k"]: (r["v"], r["kept"]) for r in merge.upsert(old, new, ["k"], ["kept"]).collect()}
    assert got == {1: ("a", "x"), 2: (None, "y"), 3: ("c", "n")}
    assert [r["k"] for r in merge.insert_ignore(old, new.union(new), ["k"]).collect()] == [3]
    assert merge.last_of(old.unionByName(new), ["k"], F.col("v")).count() == 3


def test_freeze_and_null_rewards(spark):
    p = progress(spark, [(1, 0, 0, None), (2, 0, 0, None), (3, 0, 0, "2024-01-02 00:00:00"), (4, 0, 0, None)])
    r = rolls(spark, [(t, i, v) for t, v in ((1, None), (2, 0.5), (3, 0.5)) for i in range(4)] + [(4, i, 0.1 * i) for i in range(4)])
    got = {x["task_id"]: x["frozen"] for x in cells.freeze(p, r, now()).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False}


def test_advantages_of_small_groups(spark):
    r = rolls(spark, [(1, 0, 1.0), (2, 0, 1.0), (2, 1, 1.0), (3, 0, 0.0), (3, 1, 1.0), (3, 2, None)])
    assert sorted((x["task_id"], x["advantage"]) for x in stats.advantages(r).collect()) == [(1, 0), (2, 0), (2, 0), (3, -1), (3, 1)]


def test_task_files(spark, tmp_path):
    path = tmp_path / "tasks.jsonl"
    path.write_text('{"task_id": 3, "problem": "", "problem_statement": "p", "dockerhub_tag": "d", "test_patch": "t"}\n\nnot json\n{"id": "5", "problem": "q"}\n{"task_id": 3, "problem": "last"}\n')
    rows = files.tasks(spark, str(path), "env").orderBy("pos").collect()
    assert [(r["task_id"], r["problem"]) for r in rows] == [(3, "p"), (5, "q"), (3, "last")]
    assert json.loads(rows[0]["meta"]) == {"docker_image": "d"} and json.loads(rows[0]["hidden_tests"]) == {"test_patch": "t"}
    assert files.task_count(spark, str(path)) == 4
    assert files.task(spark, str(path), "env", 3).first()["problem"] == "last"
    assert files.tasks(spark, str(path), "env", 4, 6).count() == 1
    (tmp_path / "bad.jsonl").write_text('{"problem": "x"}\n')
    with pytest.raises(Exception, match="no whole number"):
        files.tasks(spark, str(tmp_path / "bad.jsonl"), "env").collect()
    assert files.task_source("jsonl") is files.tasks
    with pytest.raises(ValueError):
        files.task_source("none")
    chat = spark.createDataFrame([(1, [("system", " s "), ("assistant", "no"), ("user", "u"), ("user", " ")])], "i int, prompt array<struct<role:string,content:string>>")
    assert files.dataset_tasks(chat, "e", "i").first()["problem"] == "s\n\nu"


def test_manifest_and_trace_files(spark, tmp_path):
    path = tmp_path / "manifest.jsonl"
    path.write_text('{"list_name": "l", "env_name": "e", "task_id": 1, "teacher_name": "t", "task_idx": 0}\nbroken\n{"env_name": "e"}\n')
    rows = files.manifest(spark, str(path)).orderBy("line_no").collect()
    assert [(r["line_no"], r["valid"]) for r in rows] == [(0, True), (1, False), (2, False)]
    trace = tmp_path / "trace.jsonl"
    trace.write_text('{"type": "message.delta", "data": {"delta": "x"}}\n\n{"type": "usage", "data": {"input_tokens": 4}}\n')
    events = files.trace(spark, str(trace), "s")
    assert [(r["type"], r["delta"], r["input_tokens"]) for r in events.orderBy("seq").collect()] == [("message.delta", "x", None), ("usage", None, 4)]
    assert files.teachers(spark, "- {teacher_name: a, provider: p, family: f, model: m}\n- {teacher_name: b, active: false}").count() == 2


def test_blobs_round_trip(spark):
    rows = spark.createDataFrame([("x" * 1000,), ("",), (None,)], "t string").select("t", codecs.compressed(F.col("t")).alias("b"))
    for r in rows.select("t", codecs.decompressed(F.col("b")).alias("u"), codecs.digest(F.col("b")).alias("d"), F.length("b").alias("n")).collect():
        assert r["t"] == r["u"] and (r["t"] is None) == (r["d"] is None) and (r["n"] or 0) < 50


def test_metric_kinds(spark):
    rows = [("2024-01-01 00:00:01", "counter", "c", 1.0), ("2024-01-01 00:00:59", "counter", "c", 2.0), ("2024-01-01 00:00:05", "gauge", "g", 5.0), ("2024-01-01 00:00:09", "gauge", "g", 4.0), ("2024-01-01 00:01:00", "histogram", "h", 7.0)]
    points = spark.createDataFrame(rows, "ts string, kind string, metric string, value double").withColumns({"ts": F.to_timestamp("ts"), "labels": F.lit("{}")})
    assert {(r["metric"], r["value"]) for r in metrics.minutely(points).collect()} == {("c", 3.0), ("g", 4.0), ("h.sum", 7.0), ("h.count", 1.0), ("h.max", 7.0)}


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    shape = "ts timestamp, kind string, metric string, labels string, value double, cell string"
    lines = [{"ts": f"2024-01-01T00:{m:02d}:00Z", "kind": k, "metric": "m", "labels": "{}", "value": 1.0, "cell": f"c{m % 2}"} for m, k in ((0, "attempt"), (0, "collect"), (1, "attempt"), (9, "publish"))]
    (tmp_path / "in/a.json").write_text("\n".join(map(json.dumps, lines)))
    source = lambda: spark.readStream.schema(shape).json(str(tmp_path / "in"))
    q = streams.minute_metrics(source()).writeStream.format("memory").queryName("minutes").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["n"] for r in spark.table("minutes").collect()) == [1, 1, 1]
    stored = {}
    sink = streams.upsert_sink(lambda: stored.get("t", spark.createDataFrame([], "metric string, kind string, value double")), lambda df: stored.update(t=spark.createDataFrame(df.collect(), df.schema)), ["metric", "kind"], ["value"])
    q = source().select("metric", "kind", "value").writeStream.foreachBatch(sink).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination()
    assert stored["t"].count() == 3
    q = streams.append_sink(source().select("ts", "kind"), str(tmp_path / "out"), str(tmp_path / "c2"), once=True)
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    failed = []
    streams.cycles([("a", lambda: 1 / 0), ("b", lambda: failed.append("ran"))], lambda name, e: failed.append(name))
    assert failed == ["a", "ran"]


def test_cell_state_stream(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    (tmp_path / "in").mkdir()
    events = [{"cell": "a", "kind": "attempt"}, {"cell": "a", "kind": "collect"}, {"cell": "b", "kind": "attempt"}, {"cell": "a", "kind": "publish"}]
    (tmp_path / "in/a.json").write_text("\n".join(map(json.dumps, events)))
    source = spark.readStream.schema("cell string, kind string").json(str(tmp_path / "in"))
    # timers keep the query asking for batches, so it is stopped rather than awaited
    q = streams.cell_states(source).writeStream.format("memory").queryName("cells").outputMode("update").trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            time.sleep(1)
            if (rows := spark.table("cells").collect()) or q.exception():
                break
    finally:
        q.stop()
    assert {r["cell"]: (r["attempts"], r["collected"], r["published"]) for r in rows} == {"a": (1, 1, True), "b": (1, 0, False)}
