"""Registries that users add to, lookups, limits, and writes that meet other writers."""

from __future__ import annotations

import shutil
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from rollweave.functions import eed, text
from rollweave.operators import environments, merge, pairs, requests, scoring
from rollweave.sources import files
from rollweave.sources.blobs import Blobs
from rollweave.sources.store import Conflict, Tables
from rollweave.streaming import metrics as streams
from tests.test_layout import ROOT


def test_a_missing_task_or_teacher_is_an_error(spark):
    claimed = spark.createDataFrame([("e", 1, "t", 0)], "env_name string, task_id int, teacher_name string, slot int")
    tasks = spark.createDataFrame([("e", 1, "p")], "env_name string, task_id int, problem string")
    teachers = spark.createDataFrame([("t", "f")], "teacher_name string, family string")
    row = requests.with_task_and_teacher(claimed, tasks, teachers).first()
    assert (row["env_name"], row["slot"], row["task"]["problem"], row["teacher"]["family"]) == ("e", 0, "p", "f")
    with pytest.raises(Exception, match="unknown task: e:1"):
        requests.with_task_and_teacher(claimed, tasks.where("task_id = 2"), teachers).collect()
    with pytest.raises(Exception, match="unknown teacher: t"):
        requests.with_task_and_teacher(claimed, tasks, teachers.limit(0)).collect()
    assert requests.with_task_and_teacher(claimed.limit(0), tasks, teachers.limit(0)).collect() == []


def test_strategies_by_name(spark, monkeypatch):
    rolls = spark.createDataFrame([(i, "e", 1, "t", "ok", r) for i, r in enumerate([0.2, 0.9, 0.9, None, 0.5])], "rollout_id int, env_name string, task_id int, teacher_name string, status string, reward double")
    assert [(r["win_rollout_id"], r["lose_rollout_id"]) for r in pairs.select_pairs(rolls).collect()] == [(1, 0)]
    assert sorted((r["win_rollout_id"], r["lose_rollout_id"]) for r in pairs.select_pairs(rolls, 0.1, "best_against_each").collect()) == [(1, 0), (1, 4)]
    monkeypatch.setitem(pairs.PAIR_STRATEGIES, "none", lambda rollouts, min_gap: pairs.best_and_worst(rollouts, 9))
    assert pairs.select_pairs(rolls, 0, "none").collect() == []
    with pytest.raises(ValueError, match="known: best_against_each"):
        pairs.select_pairs(rolls, 0, "other")
    ce = spark.createDataFrame([(1.0, 2.0, 0.5), (2.0, 2.0, 0.5), (3.0, 2.0, 0.5), (None, 2.0, 0.5)], "win_ce double, lose_ce double, reward_gap double")
    assert [r["score"] for r in scoring.score_pairs(ce, "preference").collect()] == [1.0, 0.5, 0.0, None]
    assert scoring.mean_scores(scoring.score_pairs(ce)).first().asDict() == {"mean_score": 0.0, "n_scored": 3}
    with pytest.raises(ValueError, match="rollout score"):
        scoring.score_rollouts(ce, "other")


def test_environments_in_front_take_names(spark, monkeypatch):
    monkeypatch.setattr(environments, "ENVIRONMENTS", list(environments.ENVIRONMENTS))
    assert environments.get_env("swe-rebench:python").name == "swe-rebench" and environments.get_env("swe-rebench").task_source() is files.tasks
    with pytest.raises(ValueError, match="no environment for 'swe-rebenchx'"):
        environments.get_env("swe-rebenchx")
    runs = spark.createDataFrame([("swe-rebench:a", "2 passed, 2 failed\n", " d\n\n", None), ("verifiers:m", None, "", 0.25)], "env_name string, log string, diff string, reward double")
    got = {r["env_name"]: (r["reward"], r["patch"]) for r in environments.graded(runs).collect()}
    assert got == {"swe-rebench:a": (0.5, "d\n"), "verifiers:m": (0.25, "")}
    environments.register_env(environments.Environment("verifiers", "verifiers", lambda run: F.create_map(F.lit("score"), F.lit(1.0))))
    assert environments.known_envs() == ["verifiers", "swe-rebench", "verifiers"]
    assert {r["env_name"]: r["reward"] for r in environments.graded(runs).collect()} == {"swe-rebench:a": 0.5, "verifiers:m": 1.0}
    with pytest.raises(Exception, match="no environment for"):
        environments.graded(runs.withColumn("env_name", F.lit("x"))).collect()


def test_work_that_takes_too_long_is_left():
    def forever():
        while True:
            time.sleep(0.01)

    began = time.monotonic()
    assert eed.limited(0.2, forever, "late") == "late" and time.monotonic() - began < 2
    assert eed.limited(5, lambda: 7, None) == 7
    with pytest.raises(ZeroDivisionError):
        eed.limited(5, lambda: 1 / 0, None)
    import threading

    out = []
    aside = threading.Thread(target=lambda: out.append(eed.limited(0.2, forever, "late")))
    aside.start()
    aside.join(5)
    assert out == ["late"]


LOGS = {
    "5 passed\n" + "x\n" * 49: 5, "5 passed\n" + "x\n" * 50: 0, "5 passed\r\n" + "x\r\n" * 49: 5, "5 passed\r" + "x\r" * 50: 0, "5 passed" + "\nx" * 49: 5, "5 passed" + "\nx" * 50: 0, "": 0, None: 0, "passed": 0, "12  passed, 3 passed": 12,
    "1 passed\n2 passed\nno passed": 2, "5\npassed": 0, "5 passed\n\n" + "x\n" * 48: 5, "99999999999 passed": 0, "5 passed " + "x\n" * 49: 5,
}


def test_the_last_fifty_lines_count(spark):
    rows = list(LOGS.items())
    df = spark.createDataFrame([(i, log) for i, (log, _) in enumerate(rows)], "i int, log string")
    got = {r["i"]: r["n"] for r in df.select("i", text.pytest_result(F.col("log"))["passed"].alias("n")).collect()}
    assert got == {i: n for i, (_, n) in enumerate(rows)}


def test_boxed_braces(spark):
    values = {r"\boxed{a}": "a", r"x \boxed{\frac{1}{2}} y": r"\frac{1}{2}", r"\boxed{a} \boxed{b_{c_{d}}}": "b_{c_{d}}", "none": None, r"\boxed{open": None, r"\boxed{}": ""}
    df = spark.createDataFrame([(x,) for x in values], "x string")
    assert {r["x"]: r["b"] for r in df.select("x", text.boxed(F.col("x")).alias("b")).collect()} == values


TEACHER = "teacher_name string, provider string, family string, config string, active boolean"


def test_two_writers_and_a_lost_log(spark, tmp_path):
    t = Tables(spark, f"file://{tmp_path}/db")
    row = lambda name: spark.createDataFrame([(name, "p", "f", "{}", True)], TEACHER)
    names = lambda version=None: sorted(r["teacher_name"] for r in t.read("teachers", version).collect())
    assert t.version("teachers") == 0 and t.write("teachers", row("a")) == 1
    base = t.version("teachers")
    assert t.write("teachers", row("b"), base=base) == 2
    with pytest.raises(Conflict):
        t.write("teachers", row("c"), base=base)  # made from what another writer has replaced
    assert names() == ["b"]
    assert t.append("teachers", row("d")) == 3 and names() == ["b", "d"] and names(2) == ["b"] and names(1) == ["a"]
    t.blobs.delete("teachers/_log")
    with pytest.raises(FileNotFoundError):
        t.read("teachers")  # never an empty table, which an upsert would write back


def test_objects_are_whole(spark, tmp_path):
    b = Blobs(spark, f"file://{tmp_path}/o")
    assert b.put_new("x/a", b"1") and not b.put_new("x/a", b"2") and b.get("x/a") == b"1"
    b.put("x/a", b"3")
    assert b.get("x/a") == b"3" and b.names("x") == ["a"] and b.names("none") == []
    b.delete("x")
    assert not b.exists("x/a")


def test_the_first_of_repeated_inserts(spark):
    old = spark.createDataFrame([(1, "x", 0)], "k int, v string, at int")
    new = spark.createDataFrame([(2, "late", 9), (2, "early", 1), (1, "no", 0), (3, None, None)], "k int, v string, at int")
    assert sorted((r["k"], r["v"]) for r in merge.insert_ignore(old, new, ["k"], F.col("at")).collect()) == [(2, "early"), (3, None)]
    assert merge.insert_ignore(old.select("k"), new.select("k"), ["k"]).count() == 2


def test_failures_name_run_student_and_revision(spark):
    scores = spark.createDataFrame([("r", "s", "1", "running", '{"n":1.5,"t":true,"o":{"z":null}}'), ("q", "s", "1", "running", "[1]")], "run_id string, student string, revision string, status string, config string")
    scores = scores.withColumn("finished_at", F.lit(None).cast("timestamp_ntz"))
    stamp = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    fail = lambda *rows: {r["run_id"]: (r["status"], r["finished_at"] is not None, r["config"]) for r in merge.mark_failed(scores, spark.createDataFrame(rows, "run_id string, student string, revision string, error string"), stamp).collect()}
    assert fail(("r", "s", "2", "e"), ("r", "z", "1", "e")) == {"r": ("running", False, '{"n":1.5,"t":true,"o":{"z":null}}'), "q": ("running", False, "[1]")}
    assert fail(("r", "s", "1", 'a "b"'), ("q", "s", "1", None)) == {"r": ("failed", True, '{"n":1.5,"t":true,"o":{"z":null},"error":"a \\"b\\""}'), "q": ("failed", True, '{"error":""}')}


def test_lines_of_several_files_are_numbered(spark, tmp_path):
    for name, n in (("a", 700), ("b", 3), ("c", 1200)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = files.numbered(files.lines(spark, str(tmp_path))).select("line_no", "value").orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["value"] for r in rows] == [f"{name}{i}" for name, n in (("a", 700), ("b", 3), ("c", 1200)) for i in range(n)] and [r["line_no"] for r in rows] == list(range(1903))


def test_rounds_hold_back_stages():
    ran, at = [], [0.0]
    stages, last = [("a", lambda: ran.append("a")), ("b", lambda: ran.append("b"))], {}
    for at[0] in (0.0, 10.0, 61.0):
        streams.cycles(stages, lambda *_: None, {"b": 60}, last, lambda: at[0])
    assert ran == ["a", "b", "a", "a", "b"]


def test_the_engine_works_where_the_training_operators_lack_something(tmp_path):
    shutil.copytree(ROOT / "rollweave", tmp_path / "rollweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "rollweave/llm").mkdir()
    (tmp_path / "rollweave/llm/__init__.py").write_text("")
    (tmp_path / "rollweave/llm/registry.py").write_text("import a_library_that_is_not_there\n")
    code = "import __spark_entry__ as e; assert 'env_yield' in e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120, capture_output=True, text=True)
    assert "a_library_that_is_not_there" in done.stderr
