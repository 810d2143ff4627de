"""Steps of each family, as JSON, normalised into one message form by column functions over VARIANT.

A reader takes a step and gives struct<message, problem>; a problem says why the step can't be read, and a trajectory
with one has no messages but the first problem as its error. Steps must be objects, texts strings, and lists arrays;
missing ones and JSON nulls count as absent. Arguments are JSON text with a space after ``:`` and ``,`` and members in
the order of their names. JSON with an object that has one name twice can't be read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.functions.text import stripped
from rollweave.operators.trajectory import thinking
from rollweave.schemas import MESSAGE, TOOL_CALL

CALLS = f"array<{TOOL_CALL}>"
#: What stands between separators of JSON text: strings as a whole, and anything else but quotes and separators.
_BEFORE = r'\G((?:"(?:[^"\\]|\\.)*+"|[^":,])++)([:,])'


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use).getItem(0)


def member(step: Column, name: str) -> Column:
    """A member of an object as a variant; null where it is missing or a JSON null."""
    return let(F.try_variant_get(step, f"$.{name}", "variant"), lambda v: F.when(~F.is_variant_null(v), v))


def is_a(value: Column, kind: str) -> Column:
    """Whether a variant is a STRING, an OBJECT, an ARRAY; false for null."""
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(kind)), F.lit(False))


def string(value: Column) -> Column:
    """The text of a variant that is one; else null."""
    return F.when(is_a(value, "STRING"), F.try_variant_get(value, "$", "string"))


def text(step: Column, name: str) -> Column:
    return string(member(step, name))


def items(value: Column) -> Column:
    """The elements of a variant that is an array; else none."""
    return F.coalesce(F.when(is_a(value, "ARRAY"), F.try_variant_get(value, "$", "array<variant>")), F.array().cast("array<variant>"))


def json_text(value: Column) -> Column:
    """A variant as JSON with a space after : and ,; null as null."""
    return F.coalesce(F.regexp_replace(F.to_json(value), _BEFORE, "$1$2 "), F.lit("null"))


def raw(value: Column) -> Column:
    return F.concat(F.lit('{"_raw": '), json_text(value), F.lit("}"))


def call(id_: Column, name: Column, arguments: Column, malformed: Column) -> Column:
    return F.struct(id_.alias("id"), name.alias("name"), arguments.alias("arguments"), malformed.alias("malformed"))


def message(role: Column, content: Column | None = None, reasoning: Column | None = None, calls: Column | None = None, call_id: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    calls = F.array().cast(CALLS) if calls is None else calls
    parts = {"role": role, "content": content, "reasoning": reasoning, "tool_calls": calls, "tool_call_id": call_id}
    return F.struct(*((none if c is None else c).alias(n) for n, c in parts.items())).cast(MESSAGE)


def wrong(holder: Column, kind: str, *names: str) -> list[Column]:
    """A problem for each named member that is there and isn't of a kind."""
    sort = {"STRING": "a text", "ARRAY": "a list", "OBJECT": "an object"}[kind]

    def one(name: str) -> Column:
        return let(member(holder, name), lambda v: F.when(v.isNotNull() & ~is_a(v, kind), F.lit(f"{name} is not {sort}")))

    return [one(n) for n in names]


def not_objects(values: Column, name: str) -> Column:
    return F.when(F.exists(values, lambda v: ~is_a(v, "OBJECT")), F.lit(f"{name} holds something else than objects"))


def problem_in(values: Column, problems: Callable[[Column], list[Column]]) -> Column:
    """The first problem of any element."""
    return F.get(F.filter(F.transform(values, lambda v: F.coalesce(*problems(v), F.lit(None).cast("string"))), lambda p: p.isNotNull()), F.lit(0))


def read(found: Column, *problems: Column) -> Column:
    return F.struct(found.alias("message"), F.coalesce(*problems, F.lit(None).cast("string")).alias("problem"))


def by_kind(step: Column, name: str, kinds: dict[str, Column]) -> Column:
    """The reading of a step's kind; of any other kind a problem."""

    def choose(kind: Column) -> Column:
        unknown = F.concat(F.lit(f"unknown {name} "), F.coalesce(json_text(kind), F.lit("null")))
        out = read(F.lit(None).cast(MESSAGE), unknown)
        for k, reading in kinds.items():
            out = F.when(F.coalesce(string(kind) == k, F.lit(False)), reading).otherwise(out)
        return out

    return let(member(step, name), choose)


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def lines(texts: Column) -> Column:
    """Texts that aren't empty, a line each; null if there are none."""
    return F.nullif(F.array_join(F.filter(texts, lambda t: F.coalesce(t != "", F.lit(False))), "\n"), F.lit(""))


# -- steps that trajectory.fold() makes ---------------------------------------------------------------------------------------


def event_step(step: Column) -> Column:
    def calls(found: Column) -> Column:
        def one(c: Column) -> Column:
            return let(member(c, "arguments"), lambda a: call(or_empty(text(c, "id")), or_empty(text(c, "name")), F.when(is_a(a, "OBJECT"), json_text(a)).otherwise(raw(a)), ~is_a(a, "OBJECT")))

        said = message(F.lit("assistant"), text(step, "text"), text(step, "reasoning"), F.transform(found, one))
        return read(said, *wrong(step, "STRING", "text", "reasoning"), *wrong(step, "ARRAY", "tool_calls"), not_objects(found, "tool_calls"), problem_in(found, lambda c: wrong(c, "STRING", "id", "name")))

    user = read(message(F.lit("user"), or_empty(text(step, "text"))), *wrong(step, "STRING", "text"))
    result = read(message(F.lit("tool"), or_empty(text(step, "text")), call_id=or_empty(text(step, "tool_call_id"))), *wrong(step, "STRING", "text", "tool_call_id"))
    return by_kind(step, "kind", {"user": user, "assistant": let(items(member(step, "tool_calls")), calls), "tool_result": result})


# -- content blocks -----------------------------------------------------------------------------------------------------------


def _is_type(block: Column, kind: str) -> Column:
    return F.coalesce(text(block, "type") == kind, F.lit(False))


def _texts(blocks: Column) -> Column:
    return F.transform(F.filter(blocks, lambda b: _is_type(b, "text")), lambda b: or_empty(text(b, "text")))


def _text_problems(block: Column) -> list[Column]:
    return [F.when(_is_type(block, "text"), p) for p in wrong(block, "STRING", "text")]


def _block_call(block: Column) -> Column:
    """An input that is an object, or a text that holds one, is whole; another text is kept raw, and anything else is empty."""

    def from_text(given: Column) -> Column:
        inner = F.try_parse_json(string(given))
        return let(inner, lambda v: F.struct(F.when(is_a(v, "OBJECT"), json_text(v)).otherwise(raw(given)).alias("arguments"), (~is_a(v, "OBJECT")).alias("malformed")))

    def made(given: Column) -> Column:
        whole = F.struct(json_text(given).alias("arguments"), F.lit(False).alias("malformed"))
        nothing = F.struct(F.lit("{}").alias("arguments"), F.lit(True).alias("malformed"))
        chosen = F.when(is_a(given, "OBJECT"), whole).when(is_a(given, "STRING"), from_text(given)).otherwise(nothing)
        return let(chosen, lambda c: call(text(block, "id"), text(block, "name"), c["arguments"], c["malformed"]))

    return let(member(block, "input"), made)


def _thoughts(block: Column) -> Column:
    """What a block adds to the reasoning: tagged parts of a text, a thinking block, and the type of a block that is neither text nor call."""
    tagged = F.array(thinking(or_empty(text(block, "text")))["reasoning"])
    thought = F.array(F.coalesce(F.nullif(text(block, "thinking"), F.lit("")), text(block, "text")))
    kind = let(member(block, "type"), lambda v: F.coalesce(string(v), F.when(v.isNotNull(), json_text(v)), F.lit("None")))
    other = F.array(F.concat(F.lit("[unhandled block type="), kind, F.lit("]")))
    none = F.array().cast("array<string>")
    return F.when(_is_type(block, "text"), tagged).when(_is_type(block, "thinking"), thought).when(_is_type(block, "tool_use"), none).otherwise(other)


def _inner(block: Column) -> Column:
    """The texts of a tool's result: a text block's, or the text or text blocks within a result block."""

    def nested(content: Column) -> Column:
        return F.when(is_a(content, "STRING"), F.array(string(content))).otherwise(_texts(items(content)))

    return F.when(_is_type(block, "tool_result"), let(member(block, "content"), nested)).otherwise(_texts(F.array(block)))


def block_step(step: Column) -> Column:
    def kinds(blocks: Column) -> Column:
        given = [*wrong(step, "STRING", "text"), *wrong(step, "ARRAY", "content_blocks"), not_objects(blocks, "content_blocks")]
        user = read(message(F.lit("user"), F.coalesce(text(step, "text"), F.array_join(_texts(blocks), "\n"))), *given, problem_in(blocks, _text_problems))

        no_id = F.when(or_empty(text(step, "tool_call_id")) == "", F.lit("a tool_result step without tool_call_id"))
        told = F.coalesce(text(step, "text"), lines(F.flatten(F.transform(blocks, _inner))), F.lit(""))
        result = read(message(F.lit("tool"), told, call_id=text(step, "tool_call_id")), no_id, *given, problem_in(blocks, _text_problems))

        said = lines(F.transform(F.filter(blocks, lambda b: _is_type(b, "text")), lambda b: thinking(or_empty(text(b, "text")))["content"]))
        calls = F.transform(F.filter(blocks, lambda b: _is_type(b, "tool_use")), _block_call)
        nameless = F.when(
            F.exists(blocks, lambda b: _is_type(b, "tool_use") & ((or_empty(text(b, "id")) == "") | (or_empty(text(b, "name")) == ""))), F.lit("a tool_use block without id or name")
        )
        spoken = message(F.lit("assistant"), said, lines(F.flatten(F.transform(blocks, _thoughts))), calls)
        assistant = read(spoken, *given[1:], nameless, problem_in(blocks, _text_problems))
        return by_kind(step, "kind", {"user": user, "tool_result": result, "assistant": assistant})

    return let(items(member(step, "content_blocks")), kinds)


# -- chat messages --------------------------------------------------------------------------------------------------------------


def _content(step: Column) -> Column:
    """A text; of a list the texts of its objects; of anything else its JSON."""
    parts = lambda v: F.array_join(F.transform(F.filter(items(v), lambda p: is_a(p, "OBJECT")), lambda p: or_empty(text(p, "text"))), "")
    return let(member(step, "content"), lambda v: F.when(is_a(v, "STRING"), string(v)).when(is_a(v, "ARRAY"), parts(v)).when(v.isNotNull(), json_text(v)))


def _content_problem(step: Column) -> Column:
    return problem_in(F.filter(items(member(step, "content")), lambda p: is_a(p, "OBJECT")), lambda p: wrong(p, "STRING", "text"))


def _chat_call(given: Column) -> Column:
    """Arguments are an object, or JSON text: a text that is no JSON is kept as an object of its own, JSON that is no object is malformed."""

    def made(function: Column) -> Column:
        name, id_ = or_empty(text(function, "name")), or_empty(text(given, "id"))

        def of_text(a: Column) -> Column:
            return let(
                F.try_parse_json(string(a)),
                lambda v: F.when(v.isNull(), call(id_, name, raw(a), F.lit(False))).when(is_a(v, "OBJECT"), call(id_, name, json_text(v), F.lit(False))).otherwise(call(id_, name, raw(v), F.lit(True))),
            )

        def of(a: Column) -> Column:
            whole = call(id_, name, json_text(a), F.lit(False))
            # nothing, an empty text or list, zero and false
            empty = a.isNull() | json_text(a).isin('""', "[]", "0", "0.0", "false")
            return F.when(empty, call(id_, name, F.lit("{}"), F.lit(False))).when(is_a(a, "OBJECT"), whole).when(is_a(a, "STRING"), of_text(a)).otherwise(call(id_, name, raw(a), F.lit(False)))

        return let(member(function, "arguments"), of)

    return let(member(given, "function"), made)


def chat_step(step: Column) -> Column:
    def kinds(calls: Column) -> Column:
        reasoning = F.coalesce(F.nullif(text(step, "reasoning"), F.lit("")), text(step, "reasoning_content"))
        found = message(string(member(step, "role")), _content(step), reasoning, F.transform(calls, _chat_call))

        def problems(c: Column) -> list[Column]:
            return [*wrong(c, "STRING", "id"), *wrong(c, "OBJECT", "function"), let(member(c, "function"), lambda f: F.coalesce(*wrong(f, "STRING", "name")))]

        given = [*wrong(step, "STRING", "reasoning", "reasoning_content"), *wrong(step, "ARRAY", "tool_calls"), not_objects(calls, "tool_calls"), problem_in(calls, problems)]
        spoken = read(found, *given, _content_problem(step))
        told = message(F.lit("tool"), or_empty(_content(step)), call_id=or_empty(text(step, "tool_call_id")))
        return by_kind(step, "role", {"system": spoken, "user": spoken, "assistant": spoken, "tool": read(told, *wrong(step, "STRING", "tool_call_id"), _content_problem(step))})

    return let(items(member(step, "tool_calls")), kinds)


#: Step readers by family; add to it, or replace, to extend. "events": the steps that fold() makes; another name for a family is another key.
FAMILIES: dict[str, Callable[[Column], Column]] = {"events": event_step, "claude": block_step, "verifiers": chat_step}


def messages_of(family: Column, steps: Column) -> Column:
    """struct<messages, error> of steps as JSON text, by the family's reader; one of the two is null. No text, or an empty one, is no steps."""
    shape = f"array<struct<message:{MESSAGE},problem:string>>"

    def with_reader(reader: Callable[[Column], Column], parsed: Column) -> Column:
        def one(step: Column) -> Column:
            return F.when(is_a(step, "OBJECT"), reader(step)).otherwise(read(F.lit(None).cast(MESSAGE), F.lit("a step is no object")))

        return F.transform(items(parsed), one).cast(shape)

    def made(parsed: Column) -> Column:
        found = F.lit(None).cast(shape)
        for name, reader in FAMILIES.items():
            found = F.when(family == name, with_reader(reader, parsed)).otherwise(found)

        def split(readings: Column) -> Column:
            place = F.array_position(F.transform(readings, lambda r: r["problem"].isNotNull()), True)
            first = F.concat(F.lit("step "), (place - 1).cast("string"), F.lit(": "), F.get(readings, (place - 1).cast("int"))["problem"])
            unknown = F.concat(F.lit("unknown family "), F.coalesce(family, F.lit("null")))
            error = F.when(~F.coalesce(family.isin(*FAMILIES), F.lit(False)), unknown).when(~is_a(parsed, "ARRAY"), F.lit("the steps are no JSON list")).when(place > 0, first)
            return F.struct(F.when(error.isNull(), F.transform(readings, lambda r: r["message"])).alias("messages"), error.alias("error"))

        return let(found, split)

    return let(F.try_parse_json(F.coalesce(F.nullif(steps, F.lit("")), F.lit("[]"))), made)


@lru_cache(maxsize=2)
def _found(families: tuple, context: SparkContext) -> Column:
    """The expression over columns family and steps: some thousands of nodes, built once for a context and its families."""
    return messages_of(F.col("family"), F.col("steps"))


def normalised(trajectories: DataFrame) -> DataFrame:
    """trajectories (id columns, family, steps as JSON) -> id columns, messages, error. A projection: no shuffle, no Python."""
    ids = [c for c in trajectories.columns if c not in ("family", "steps")]
    found = _found(tuple(FAMILIES.items()), trajectories.sparkSession.sparkContext)
    return trajectories.select(*ids, found.alias("_found")).select(*ids, F.col("_found.messages").alias("messages"), F.col("_found.error").alias("error"))
