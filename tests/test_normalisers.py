"""The normalisers against plain loops over the parsed steps."""

from __future__ import annotations

import json
import random
import re
from collections.abc import Iterable

import pytest
from pyspark.sql import functions as F

from rollweave.operators import normalisers
from rollweave.plans import registry

_THINKING = re.compile("<thinking>(.*?)</thinking>", re.S | re.I)


class Unreadable(ValueError):
    """A step that its family doesn't allow."""


def _message(role: str, content: str | None = None, reasoning: str | None = None, calls: Iterable[dict] = (), call_id: str | None = None) -> dict:
    return {"role": role, "content": content, "reasoning": reasoning, "tool_calls": list(calls), "tool_call_id": call_id}


def _call(id_: str, name: str, arguments: object, malformed: bool | None = None) -> dict:
    whole = isinstance(arguments, dict)
    return {"id": id_, "name": name, "arguments": json.dumps(arguments if whole else {"_raw": arguments}, sort_keys=True, ensure_ascii=False), "malformed": not whole if malformed is None else malformed}


def _event_step(step: dict) -> dict:
    match step.get("kind"):
        case "user":
            return _message("user", step.get("text", ""))
        case "assistant":
            calls = [_call(c.get("id", ""), c.get("name", ""), c.get("arguments")) for c in step.get("tool_calls") or []]
            return _message("assistant", step.get("text"), step.get("reasoning"), calls)
        case "tool_result":
            return _message("tool", step.get("text", ""), call_id=step.get("tool_call_id") or "")
        case kind:
            raise Unreadable(f"unknown step kind {kind!r}")


def _texts(blocks: Iterable[dict]) -> list[str]:
    return [b.get("text", "") for b in blocks if b.get("type") == "text"]


def _lines(parts: Iterable[str]) -> str | None:
    return "\n".join(p for p in parts if p) or None


def _claude_call(block: dict) -> dict:
    if not block.get("id") or not block.get("name"):
        raise Unreadable("a tool_use block without id or name")
    given = block.get("input")
    if isinstance(given, str):
        try:
            read = json.loads(given)
        except ValueError:
            read = None
        return _call(block["id"], block["name"], read if isinstance(read, dict) else given)
    return _call(block["id"], block["name"], given if isinstance(given, dict) else {}, not isinstance(given, dict))


def _claude(step: dict) -> dict:
    kind, blocks, text = step.get("kind"), step.get("content_blocks") or [], step.get("text")
    if kind == "user":
        return _message("user", ("\n".join(_texts(blocks)) if text is None else text) or "")
    if kind == "tool_result":
        if not step.get("tool_call_id"):
            raise Unreadable("a tool_result step without tool_call_id")
        if text is None:
            parts = []
            for b in blocks:
                inner = b.get("content")
                if b.get("type") == "tool_result":
                    parts += [inner] if isinstance(inner, str) else _texts(inner) if isinstance(inner, list) else []
                else:
                    parts += _texts([b])
            text = _lines(parts)
        return _message("tool", text or "", call_id=step["tool_call_id"])
    if kind != "assistant":
        raise Unreadable(f"unknown step kind {kind!r}")
    said, thought, calls = [], [], []
    for b in blocks:
        match b.get("type"):
            case "text":
                rest, n = _THINKING.subn("", whole := b.get("text", ""))
                thought += [x.strip() for x in _THINKING.findall(whole)]
                said.append(rest.strip() if n else whole)
            case "thinking":
                thought.append(b.get("thinking") or b.get("text", ""))
            case "tool_use":
                calls.append(_claude_call(b))
            case other:
                thought.append(f"[unhandled block type={other}]")
    return _message("assistant", _lines(said), _lines(thought), calls)


def _content(x: object) -> str | None:
    if x is None or isinstance(x, str):
        return x
    return "".join(p.get("text", "") for p in x if isinstance(p, dict)) if isinstance(x, list) else str(x)


def _chat_call(call: dict) -> dict:
    function = call.get("function") or {}
    given = function.get("arguments")
    if not isinstance(given, dict):
        try:
            given = json.loads(given) if given else {}
        except (TypeError, ValueError):
            given = {"_raw": given}  # kept as an object, so not malformed
    return _call(call.get("id", ""), function.get("name", ""), given)


def _verifiers(step: dict) -> dict:
    match step.get("role"):
        case "tool":
            return _message("tool", _content(step.get("content")) or "", call_id=step.get("tool_call_id") or "")
        case "system" | "user" | "assistant" as role:
            calls = [_chat_call(c) for c in step.get("tool_calls") or []]
            return _message(role, _content(step.get("content")), step.get("reasoning") or step.get("reasoning_content"), calls)
        case role:
            raise Unreadable(f"unknown role {role!r}")



PLAIN = {"events": _event_step, "claude": _claude, "verifiers": _verifiers}


def plain(family, steps):
    """Messages, or None where a step can't be read."""
    try:
        read = json.loads(steps or "[]")
        if family not in PLAIN or not isinstance(read, list):
            return None
        found = [PLAIN[family](step) for step in read]
    except Exception:  # noqa: BLE001
        return None
    texts = [x for m in found for x in (m["content"], m["reasoning"], m["tool_call_id"], *(c[k] for c in m["tool_calls"] for k in ("id", "name")))]
    return found if all(x is None or isinstance(x, str) for x in texts) else None


def results(spark, rows):
    df = spark.createDataFrame([(i, f, s) for i, (f, s) in enumerate(rows)], "id long, family string, steps string")
    found = sorted(normalisers.normalised(df).collect(), key=lambda r: r["id"])
    return [(None if r["messages"] is None else [m.asDict(True) for m in r["messages"]], r["error"]) for r in found]


def normal(spark, family, steps):
    return results(spark, [(family, json.dumps(steps))])[0]


TEXTS = ["", "a", " b ", "<thinking> x </thinking>", "p <THINKING>1</thinking> q <thinking>\n2</thinking>", "é \"q\", [1: 2]", "<thinking></thinking>"]
ARGUMENTS = [{}, {"b": 1, "a": [1, {"c": "x, y: z"}]}, "", '{"n": 2}', "[1, 2]", "oops", "5", None, 7, [1], [], True, "null"]


def some(r, **members):
    """An object with some of the members."""
    return {k: r.choice(v) for k, v in members.items() if r.random() < 0.8}


def random_step(r, family):
    if family == "events":
        calls = [some(r, id=["1", ""], name=["f"], arguments=ARGUMENTS) for _ in range(r.randrange(3))]
        return {"kind": r.choice(["user", "assistant", "tool_result"] * 9 + ["odd"]), **some(r, text=TEXTS, reasoning=[None, "r"], tool_calls=[calls, None], tool_call_id=["9", ""])}
    if family == "claude":
        def block():
            kind = r.choice(["text", "text", "thinking", "tool_use", "tool_result", "image"])
            own = some(r, text=TEXTS, thinking=["", "t"], input=ARGUMENTS, content=["in", [{"type": "text", "text": "n"}, {"type": "x"}], None])
            return {"type": kind, **own, **({"id": "1", "name": "f"} if r.random() < 0.97 else {})}
        return {"kind": r.choice(["user", "assistant", "tool_result"]), **some(r, text=[None, *TEXTS], content_blocks=[[block() for _ in range(r.randrange(4))], None]), "tool_call_id": r.choice(["7"] * 9 + [""])}
    calls = [{**some(r, id=["1"]), "function": some(r, name=["g"], arguments=ARGUMENTS)} for _ in range(r.randrange(3))]
    content = [None, *TEXTS, [{"text": "a"}, {"type": "x"}, 3, {"text": "b"}], 5]
    return {"role": r.choice(["system", "user", "assistant", "tool"] * 9 + ["robot"]), **some(r, content=content, reasoning=[None, "", "r"], reasoning_content=[None, "c"], tool_calls=[calls, None], tool_call_id=["4", None])}


@pytest.mark.parametrize("family", sorted(PLAIN))
def test_against_plain_loops(spark, family):
    r = random.Random(family)
    rows = [(family, json.dumps([random_step(r, family) for _ in range(r.randrange(4))])) for _ in range(400)]
    rows += [(family, s) for s in (None, "", "[]", "{}", "oops", "[1]", "[null]", '["x"]', "[[]]")]
    want = [plain(*x) for x in rows]
    for row, got, own in zip(rows, results(spark, rows), want, strict=True):
        assert got[0] == own, row
        assert (got[1] is None) == (own is not None)
    assert 10 < sum(w is None for w in want) < 200


def test_wrong_types_are_problems(spark):
    bad = [
        ("events", [{"kind": "user", "text": 5}]), ("events", [{"kind": "assistant", "tool_calls": {}}]), ("events", [{"kind": "assistant", "tool_calls": [3]}]), ("claude", [{"kind": "assistant", "content_blocks": "x"}]),
        ("claude", [{"kind": "assistant", "content_blocks": [{"type": "text", "text": 1}]}]), ("verifiers", [{"role": "user", "content": [{"text": 1}]}]), ("verifiers", [{"role": "assistant", "tool_calls": [{"function": "f"}]}]), (None, []), ("other", []),
    ]
    found = results(spark, [(f, json.dumps(s)) for f, s in bad])
    assert all(m is None for m, _ in found)
    assert [e for _, e in found] == [
        "step 0: text is not a text", "step 0: tool_calls is not a list", "step 0: tool_calls holds something else than objects", "step 0: content_blocks is not a list",
        "step 0: text is not a text", "step 0: text is not a text", "step 0: function is not an object", "unknown family null", "unknown family other",
    ]
    assert results(spark, [("events", '[{"kind": "user"}, {"kind": "robot"}]')])[0][1] == 'step 1: unknown kind "robot"'


def test_no_python_in_the_plans(spark, sf):
    for name in ("agent_messages", "verifiers_content", "claude_messages", "verifiers_calls"):
        plan = registry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "InArrow" not in plan and "ArrowEval" not in plan and "BatchEval" not in plan


def test_claude_blocks(spark):
    (m,), error = normal(spark, "claude", [{"kind": "assistant", "content_blocks": [
        {"type": "text", "text": " <THINKING> why\n</thinking> because "}, {"type": "thinking", "thinking": "more"}, {"type": "image"}, {"type": "text", "text": " kept "},
        {"type": "tool_use", "id": "1", "name": "f", "input": '{"a": 1}'}, {"type": "tool_use", "id": "2", "name": "g", "input": "no json"}, {"type": "tool_use", "id": "3", "name": "h"}]}])
    assert error is None and m["content"] == "because\n kept " and m["reasoning"] == "why\nmore\n[unhandled block type=image]"
    assert [(c["id"], c["arguments"], c["malformed"]) for c in m["tool_calls"]] == [("1", '{"a": 1}', False), ("2", '{"_raw": "no json"}', True), ("3", "{}", True)]
    for bad in ([{"kind": "tool_result"}], [{"kind": "x"}], [{"kind": "assistant", "content_blocks": [{"type": "tool_use", "name": "f"}]}]):
        assert normal(spark, "claude", bad)[0] is None
    (m,), _ = normal(spark, "claude", [{"kind": "tool_result", "tool_call_id": "1", "content_blocks": [{"type": "tool_result", "content": [{"type": "text", "text": "a"}]}, {"type": "text", "text": "b"}]}])
    assert (m["role"], m["content"], m["tool_call_id"]) == ("tool", "a\nb", "1")


def test_chat_messages(spark):
    (m,), _ = normal(spark, "verifiers", [{"role": "assistant", "content": [{"text": "a"}, {"text": "b"}, 3], "reasoning_content": "r", "tool_calls": [
        {"id": "1", "function": {"name": "f", "arguments": "oops"}}, {"id": "2", "function": {"name": "g", "arguments": "[1]"}}, {"id": "3", "function": {"name": "h"}}]}])
    assert (m["content"], m["reasoning"]) == ("ab", "r")
    assert [(c["arguments"], c["malformed"]) for c in m["tool_calls"]] == [('{"_raw": "oops"}', False), ('{"_raw": [1]}', True), ("{}", False)]
    assert normal(spark, "verifiers", [{"role": "robot"}])[0] is None and normal(spark, "unknown", [])[0] is None and normal(spark, "events", [{"kind": "user"}])[0][0]["content"] == ""


def test_families_can_be_added(spark):
    normalisers.FAMILIES["echo"] = lambda step: normalisers.read(normalisers.message(F.lit("user"), normalisers.text(step, "x")))
    try:
        rows = spark.createDataFrame([(1, "echo", '[{"x": "hey"}]'), (2, "echo", "broken"), (3, None, None)], "id long, family string, steps string")
        got = {r["id"]: (r["messages"], r["error"]) for r in normalisers.normalised(rows).collect()}
        assert got[1][0][0]["content"] == "hey" and got[2][0] is None and got[3][0] is None
    finally:
        del normalisers.FAMILIES["echo"]
