"""Task files by index, and data sets as tasks."""

from __future__ import annotations

import builtins
import json
import random

import pytest
from pyspark.sql import functions as F

from rollweave.sources import files
from rollweave.sources.scratch import dense


def test_index_against_a_scan(spark, tmp_path):
    r = random.Random(1)
    for name in ("b.jsonl", "a.jsonl", "c d.jsonl"):
        lines = []
        for _ in range(300):
            i = r.randrange(200)
            lines.append(r.choice([json.dumps({"task_id": i, "problem": f"é{r.random()}" * r.randrange(1, 30)}), json.dumps({"id": str(i), "problem_statement": f"{name} x"}, ensure_ascii=False), "", "  ", "{broken"]))
        (tmp_path / name).write_bytes(r.choice([b"\n", b"\r\n"]).join(x.encode() for x in lines))  # the last line has no end
    path = str(tmp_path / "*.jsonl")
    want = {}
    for row in files.tasks(spark, path, "e").orderBy("file", "pos").collect():
        want[row["task_id"]] = (row["env_name"], row["problem"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")  # lines across the borders of splits
    try:
        index = files.TaskIndex(spark, str(tmp_path / "index"), "e")
        index.build(path)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {r["task_id"]: (r["env_name"], r["problem"]) for r in index.tasks(spark.range(-5, 300).select(F.col("id").alias("task_id"))).collect()}
    assert got == want and index.count() == len(want)
    some = next(iter(want))
    assert [tuple(r) for r in index.task(some).select("env_name", "problem").collect()] == [want[some]] and index.task(999).count() == 0


def test_a_lookup_reads_its_line_alone(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text("".join(json.dumps({"id": i, "problem": "x" * 1000}) + "\n" for i in range(2000)))
    index = files.TaskIndex(spark, str(tmp_path / "index"), "e")
    index.build(str(tmp_path / "t.jsonl"))
    entry = index.entries().where("task_id = 1500").first()
    with builtins.open(tmp_path / "t.jsonl", "rb") as f:
        f.seek(entry["start"])
        assert json.loads(f.read(entry["length"]))["id"] == 1500 and entry["length"] < 1100
    plan = index.task(1500)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(task_id), EqualTo(task_id,1500)]" in plan and "text" not in plan.split("FileScan")[1].split("Location")[0]
    # all but that line's bytes may be lost
    data = (tmp_path / "t.jsonl").read_bytes()
    a, n = entry["start"], entry["length"]
    (tmp_path / "t.jsonl").write_bytes(b"\0" * a + data[a : a + n] + b"\0" * (len(data) - a - n))
    assert index.task(1500).first()["problem"] == "x" * 1000
    with pytest.raises(Exception, match="not the file that was indexed"):
        index.task(1501).collect()


def test_lookups_hand_on_few_bytes_at_once(spark, tmp_path):
    """Whatever the lines' lengths and however many entries come at once."""
    lines = [json.dumps({"id": i, "problem": "xé"[i % 2] * (5_000_000 if i == 70 else 100_000)}, ensure_ascii=False) for i in range(150)]
    (tmp_path / "t.jsonl").write_text("\n".join(lines) + "\n")
    index = files.TaskIndex(spark, str(tmp_path / "index"), "e")
    index.build(str(tmp_path / "t.jsonl"))
    entries = index.entries().orderBy("start").toArrow().combine_chunks().to_batches()
    got = list(files._indexed_lines(iter(entries)))
    assert len(entries) == 1 and len(got) > 5 and [x for b in got for x in b.column("value").to_pylist()] == lines
    assert all(b.num_rows == 1 or b.nbytes < 4 << 20 for b in got)
    ids = spark.range(150).select(F.col("id").alias("task_id"))
    found = index.tasks(ids).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)), F.sum(F.length("problem"))).collect()
    assert len(found) == 4 and sum(r[1] for r in found) == 150 and sum(r[2] for r in found) == 149 * 100_000 + 5_000_000


def test_empty_files_have_empty_indexes(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text("\n \n")
    index = files.TaskIndex(spark, str(tmp_path / "index"), "e")
    index.build(str(tmp_path / "t.jsonl"))
    assert index.count() == 0 and index.task(1).count() == 0
    (tmp_path / "u.jsonl").write_text('{"name": 1}\n')
    with pytest.raises(Exception, match="no whole number"):
        index.build(str(tmp_path / "u.jsonl"))


def test_dense_numbers(spark):
    rows = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(500)], "k int, v int").repartition(9)
    got = sorted((tuple(r) for r in dense(rows, "n", F.col("k")).collect()), key=lambda r: r[2])
    assert [r[2] for r in got] == list(range(500))
    keys = [r[0] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    assert dense(rows.limit(0), "n", F.col("k")).count() == 0


def test_datasets(spark):
    chat = "place int, prompt array<struct<role:string,content:string>>, answer string, example_id int"
    rows = [(3, [("system", " s "), ("user", "u"), ("assistant", "a"), ("user", " ")], "42", 9), (1, [("assistant", "only me")], None, None), (2, None, "x", None), (2, [], "x", None)]
    train = spark.createDataFrame(rows, chat)
    found = files.dataset_tasks(train, "verifiers:x", "place").orderBy("task_id")
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString().split("Sort")[-1] and "Window" not in found._jdf.queryExecution().executedPlan().toString()
    got = found.collect()
    assert [r["problem"] for r in got][0] == '[{"role":"assistant","content":"only me"}]' and got[3]["problem"] == "s\n\nu"
    assert sorted(r["problem"] for r in got[1:3]) == ["", "[]"]
    assert json.loads(got[3]["meta"]) == {"verifiers_env_id": "x", "prompt": [{"role": a, "content": b} for a, b in rows[0][1]], "answer": "42", "example_id": 9, "info": {}}
    assert json.loads(got[0]["meta"])["example_id"] == 0
    plain = spark.createDataFrame([(1, "text", '{"a": 1}'), (2, None, None)], "place int, prompt string, info string")
    got = files.dataset_tasks(None, "e", "place", evaluation=plain).orderBy("task_id").collect()
    assert [r["problem"] for r in got] == ["text", ""] and json.loads(got[0]["meta"])["info"] == {"a": 1}
    with pytest.raises(ValueError, match="no data set"):
        files.dataset_tasks(None, "e", "place")
