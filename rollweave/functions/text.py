"""Column functions of scoring and of trajectories; all native expressions."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's strip removes of ASCII.
BLANK = " \t\n\r\f\x0b"
LOG_LINES, LOG_TAIL = 50, 4096


def stripped(x: Column) -> Column:
    return F.btrim(x, F.lit(BLANK))


#: Characters besides the line feed that end a line.
LINE_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def last_lines(log: Column, n: int = LOG_LINES) -> Column:
    """The log's last n lines, ended by line feeds but for the last: a line end after the last line begins no further one."""
    near = F.substring_index(log, "\n", -n - 2)  # other line ends only make more lines of it
    other = functools.reduce(lambda x, c: x | F.contains(near, F.lit(c)), LINE_ENDS, F.lit(False))
    whole = F.when(other, F.translate(F.replace(near, F.lit("\r\n"), F.lit("\n")), LINE_ENDS, "\n" * len(LINE_ENDS))).otherwise(near)
    whole = F.when(F.endswith(whole, F.lit("\n")), F.left(whole, F.length(whole) - 1)).otherwise(whole)
    return F.substring_index(whole, "\n", -n)


def pytest_count(tail: Column, word: str) -> Column:
    """The number before ``word`` in the last of the lines that has one, the first in that line; 0 without."""
    found = F.regexp_extract(tail, rf"(?s)^(?:.*\n)?[^\n]*?(\d+)[^\S\n]+{word}", 1)
    return F.coalesce(F.when(F.contains(tail, F.lit(word)), found).try_cast("int"), F.lit(0))


def pytest_result(log: Column) -> Column:
    """struct<passed, total, score>; a log without counts scores 0."""
    tail = last_lines(log)
    passed, failed, errors = (pytest_count(tail, w) for w in ("passed", "failed", "error"))
    total = passed + failed + errors
    return F.struct(passed.alias("passed"), total.alias("total"), F.coalesce(F.try_divide(passed, total), F.lit(0.0)).alias("score"))


def log_tail(log: Column) -> Column:
    return F.right(log, F.lit(LOG_TAIL))


def reward(breakdown: Column) -> Column:
    """From a JSON text: ``score`` if the key is there, else passed over total tests, else null."""
    number = lambda k: F.get_json_object(breakdown, f"$.{k}").try_cast("double")
    has = F.array_contains(F.json_object_keys(breakdown), "score")
    return F.when(has, number("score")).otherwise(number("tests_passed") / F.greatest(F.coalesce(number("tests_total"), F.lit(0.0)), F.lit(1.0)))


def comparable(messages: Column) -> Column:
    """Some assistant message says something or calls a tool. Messages: array<struct<role,content,tool_calls>>."""
    said = lambda m: F.coalesce(stripped(m["content"]) != "", F.lit(False))
    calls = lambda m: F.coalesce(F.size(m["tool_calls"]), F.lit(0)) > 0
    return F.coalesce(F.exists(messages, lambda m: (m["role"] == "assistant") & (said(m) | calls(m))), F.lit(False))


def status(teacher_error: Column, env_error: Column, parsed: Column, comparable_: Column) -> Column:
    return (
        F.when(teacher_error, "teacher_error").when(env_error, "env_error").when(~parsed, "parse_failed").when(~comparable_, "empty_completion").otherwise("ok")
    )


def env_id(env: Column) -> Column:
    """After the first colon; the whole name without one."""
    return F.when(F.instr(env, ":") > 0, F.regexp_extract(env, "^[^:]*:(?s)(.*)$", 1)).otherwise(env)


def backend(env: Column) -> Column:
    return F.substring_index(env, ":", 1)


def task_range(x: Column) -> Column:
    """'[lo,hi)' as struct<lo,hi>; null for other texts."""
    lo, hi = (F.regexp_extract(x, r"^\[(-?\d+),(-?\d+)\)$", k).try_cast("int") for k in (1, 2))
    return F.when(lo.isNotNull() & hi.isNotNull(), F.struct(lo.alias("lo"), hi.alias("hi")))


def csv(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, ","), stripped), lambda v: v != "")


def number_or(x: Column, kind: str, default: int | float) -> Column:
    return F.coalesce(stripped(x).try_cast(kind), F.lit(default))


def pins(x: Column) -> Column:
    """'a=0.1,b=2' as a map of doubles; bad entries are left out, the last of a repeated name counts. Null means the default pin."""
    entries = F.transform(csv(x), lambda e: F.struct(stripped(F.substring_index(e, "=", 1)).alias("k"), F.try_to_number(stripped(F.regexp_extract(e, "=(.*)$", 1)), F.lit("999999999D999999999")).cast("double").alias("v")))
    good = F.filter(entries, lambda e: e["v"].isNotNull() & (e["k"] != ""))
    last = F.aggregate(good, F.create_map().cast("map<string,double>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["k"]), F.create_map(e["k"], e["v"])))
    return F.coalesce(last, F.create_map(F.lit("swe-rebench"), F.lit(0.10)))


def uri_parts(uri: Column) -> Column:
    return F.struct(
        F.regexp_extract(uri, r"^([^:]+)://", 1).alias("scheme"), F.regexp_extract(uri, r"^[^:]+://([^/]*)", 1).alias("bucket"), F.regexp_extract(uri, r"^[^:]+://[^/]*/(.*)$", 1).alias("key")
    )


def patch_text(x: Column) -> Column:
    """Without white space in front and with exactly one line feed at the end."""
    return F.concat(F.rtrim(F.regexp_replace(x, r"^\s+", ""), F.lit("\n")), F.lit("\n"))


def breakdown(score: Column, metrics: Column) -> Column:
    """Metrics (map) and the score under its own name, which metrics can't overwrite."""
    return F.to_json(F.map_concat(F.map_filter(metrics, lambda k, _: k != "score"), F.create_map(F.lit("score"), score)))


def user_prompt(problem: Column, repo: Column, language: Column, hint: Column) -> Column:
    """The optional repository and language lines, the problem, and the task's hint where there is one."""
    line = lambda name, x: F.when(F.coalesce(x, F.lit("")) != "", F.concat(F.lit(f"{name}: "), x))
    return F.concat_ws("\n", line("Repository", repo), line("Language", language), problem, F.when(F.coalesce(hint, F.lit("")) != "", hint))


def sampling_args(max_tokens: Column, teacher_cap: Column, temperature: Column, top_p: Column) -> Column:
    """struct: the smaller token limit, teachers without a positive one don't limit; negative temperature and top_p are unset."""
    cap = F.when(teacher_cap > 0, F.least(max_tokens, teacher_cap)).otherwise(max_tokens)
    return F.struct(cap.alias("max_tokens"), F.when(temperature >= 0, temperature).alias("temperature"), F.when(top_p >= 0, top_p).alias("top_p"))


#: Braces within braces that boxed() follows.
_NESTED = 6


def boxed(x: Column) -> Column:
    """What the last \\boxed{..} holds, with braces in it nested up to six deep."""
    inside = r"[^{}]*+"
    for _ in range(_NESTED):
        inside = rf"(?:[^{{}}]++|\{{{inside}\}})*+"
    return F.try_element_at(F.regexp_extract_all(x, F.lit(rf"\\boxed\{{({inside})\}}"), F.lit(1)), F.lit(-1))


def final_answer(x: Column) -> Column:
    """What stands after the last $$ pair, stripped of white space."""
    return stripped(F.try_element_at(F.filter(F.split(x, r"\$\$"), lambda p: stripped(p) != ""), F.lit(-1)))


def rubric(eed: Column, accuracy: Column, form: Column) -> Column:
    return eed * 1.0 + accuracy * 0.5 + form * 0.2
