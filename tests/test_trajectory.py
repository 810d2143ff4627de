from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollweave.functions import text
from rollweave.operators import trajectory

EVENT = "session long, seq long, type string, text string, delta string, call_id string, tool string, args string, result_summary string, exit_code int"
TYPES = ["user.message", "thinking.delta", "thinking.done", "message.delta", "message.done", "tool.request", "tool.result", "usage"]


def plain_fold(events):
    steps, said, thought, calls = [], [], [], []

    def flush():
        if said or thought or calls:
            steps.append(("assistant", "".join(said).strip() or None, "".join(thought).strip() or None, tuple(calls)))
        said.clear(), thought.clear(), calls.clear()

    for kind, value in events:
        if kind in ("user.message", "tool.result"):
            flush()
            steps.append(("user" if kind[0] == "u" else "tool_result", value or "", None, ()))
        elif kind.endswith(".delta"):
            (said if kind[0] == "m" else thought).append(value or "")
        elif kind.endswith(".done") and value is not None:
            (said if kind[0] == "m" else thought)[:] = [value]
        elif kind == "tool.request":
            calls.append(value or "")
    flush()
    return steps


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.sampled_from(TYPES), st.sampled_from([None, "", " a ", "b\n", "c"])), max_size=12), min_size=1, max_size=6))
def test_fold_is_the_plain_loop(spark, sessions):
    rows = []
    for s, events in enumerate(sessions):
        for i, (kind, v) in enumerate(events):
            rows.append((s, i, kind, v if kind.endswith(("done", "message")) else None, v if kind.endswith("delta") else None, v, None, None, v if kind == "tool.result" else None, None))
    steps = trajectory.fold(spark.createDataFrame(rows, EVENT)).orderBy("session", "turn", "part").collect()
    for s, events in enumerate(sessions):
        got = [(r["kind"], r["text"], r["reasoning"], tuple(c["id"] for c in r["tool_calls"])) for r in steps if r["session"] == s]
        assert got == plain_fold(events)


def test_prompt_comes_first_where_no_user_spoke(spark):
    events = spark.createDataFrame([(1, 0, "message.delta", None, "x", None, None, None, None, None), (2, 0, "user.message", "hi", None, None, None, None, None, None)], EVENT)
    steps = trajectory.with_prompt(trajectory.fold(events), spark.createDataFrame([(1, "go"), (2, "go")], "session long, prompt string"))
    got = [(r["session"], r["kind"], r["text"]) for r in steps.orderBy("session", "turn", "part").collect()]
    assert got == [(1, "user", "go"), (1, "assistant", "x"), (2, "user", "hi")]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_text_functions(spark):
    log = F.lit("\n".join(["9 passed"] + [f"l{i}" for i in range(55)] + ["3 passed, 1 failed", "2 errors 7 error", "4 passed 5 passed", "end"]))
    assert tuple(one(spark, text.pytest_result(log))) == (4, 7, 4 / 7)  # 4 passed, 1 failed, "2 errors" counts 2
    assert tuple(one(spark, text.pytest_result(F.lit("nothing")))) == (0, 0, 0.0)
    assert one(spark, text.reward(F.lit('{"score": null, "tests_passed": 1}'))) is None
    assert one(spark, text.reward(F.lit('{"tests_passed": 1, "tests_total": 4}'))) == 0.25
    assert one(spark, text.env_id(F.lit("a:b:c"))) == "b:c" and one(spark, text.env_id(F.lit("a"))) == "a" and one(spark, text.backend(F.lit("a:b"))) == "a"
    assert tuple(one(spark, text.task_range(F.lit("[3,9)")))) == (3, 9) and one(spark, text.task_range(F.lit("x"))) is None
    assert one(spark, text.csv(F.lit(" a, ,b"))) == ["a", "b"]
    assert one(spark, text.pins(F.lit("a=1,b=x,a=0.5,=3"))) == {"a": 0.5} and one(spark, text.pins(F.lit(""))) == {} and one(spark, text.pins(F.lit(None).cast("string"))) == {"swe-rebench": 0.1}
    assert tuple(one(spark, text.uri_parts(F.lit("s3://b/k/l")))) == ("s3", "b", "k/l")
    assert one(spark, text.patch_text(F.lit("\n  diff\n\n"))) == "diff\n"
    assert one(spark, text.boxed(F.lit("\\boxed{1} so \\boxed{42}"))) == "42" and one(spark, text.final_answer(F.lit("x $$ a = 1 $$"))) == "a = 1"
    assert json.loads(one(spark, text.breakdown(F.lit(0.5), F.create_map(F.lit("score"), F.lit(9.0), F.lit("m"), F.lit(1.0))))) == {"m": 1.0, "score": 0.5}
    assert one(spark, text.user_prompt(F.lit("p"), F.lit("r"), F.lit(""), F.lit(None).cast("string"))) == "Repository: r\np"
    assert tuple(one(spark, text.sampling_args(F.lit(10), F.lit(0), F.lit(-1.0), F.lit(0.5)))) == (10, None, 0.5)
    assert one(spark, text.number_or(F.lit(" x "), "int", 7)) == 7
