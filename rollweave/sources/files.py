"""Readers of task files, agent traces, manifests and teacher lists."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.functions.text import env_id, stripped
from rollweave.schemas import MANIFEST, PUBLIC_MANIFEST, TRACE_EVENT, struct
from rollweave.sources.scratch import dense, new_folder, shuffle_parts

TASK_LINE = (
    "task_id string, id string, repo string, base_commit string, problem string, problem_statement string, difficulty string, test_patch string, "
    "augmented_test_patch string, fail_to_pass string, pass_to_pass string, test_command string, setup_files string, setup_commands string, docker_image string, "
    "dockerhub_tag string, repo_language string, instance_id string, version string, workspace_path string"
)
TEST_KEYS = ("test_patch", "augmented_test_patch", "fail_to_pass", "pass_to_pass", "test_command", "setup_files", "setup_commands")
META_KEYS = ("docker_image", "repo_language", "instance_id", "version", "workspace_path", "repo", "base_commit")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value and pos, its place: lines of one file keep their order; files go by name."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"))


def numbered(rows: DataFrame) -> DataFrame:
    """line_no from 0 over all lines, files by name. Only the parts of files that tasks read, a row each, are ordered in one place."""
    part = F.shiftright("pos", 33)
    parts = rows.groupBy("file", part.alias("part")).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("file", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = rows.withColumn("part", part).join(parts.drop("n"), ["file", "part"])
    return placed.withColumn("line_no", F.col("before") + F.col("pos") - F.col("first")).drop("part", "first", "before")


def _picked(columns: tuple[str, ...]) -> Column:
    entries = F.array(*(F.struct(F.lit(c).alias("k"), F.col(c).alias("v")) for c in columns))
    return F.to_json(F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull())))


def line_id(line: Column, parsed: Column) -> Column:
    """A task line's whole number; an error where a line that is JSON has none."""
    # the error is for readable lines only, in whatever order Spark tests the conditions
    missing = F.when(F.try_parse_json(line).isNotNull(), F.raise_error(F.lit("a task line has no whole number as task_id or id")).cast("int"))
    return F.coalesce(parsed["task_id"].try_cast("int"), parsed["id"].try_cast("int"), missing)


def parsed(rows: DataFrame, env_name: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Task lines (file, pos, value) as tasks."""
    rows = rows.where(stripped(F.col("value")) != "").select("file", "pos", F.from_json("value", TASK_LINE).alias("t"), F.try_parse_json("value").alias("ok"), "value")
    rows = rows.where("ok is not null").select("file", "pos", line_id(F.col("value"), F.col("t")).alias("number"), "t.*").withColumn("docker_image", F.coalesce("docker_image", "dockerhub_tag"))
    rows = rows.withColumn("task_id", F.col("number"))
    if lo is not None:
        rows = rows.where(F.col("task_id") >= lo)
    if hi is not None:
        rows = rows.where(F.col("task_id") < hi)
    problem = F.coalesce(F.nullif("problem", F.lit("")), F.nullif("problem_statement", F.lit("")), F.lit(""))
    return rows.select(
        F.lit(env_name).alias("env_name"), "task_id", problem.alias("problem"), _picked(TEST_KEYS).alias("hidden_tests"), "difficulty", _picked(META_KEYS).alias("meta"), "file", "pos"
    )


def tasks(spark: SparkSession, path: str, env_name: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """JSON-lines tasks with lo <= task_id < hi. Blank lines and lines that aren't JSON are left out; a line without a whole number as id is an error."""
    return parsed(lines(spark, path), env_name, lo, hi)


def task_count(spark: SparkSession, path: str) -> int:
    """Lines that aren't blank, readable or not."""
    return spark.read.text(path).where(stripped(F.col("value")) != "").count()


def task(spark: SparkSession, path: str, env_name: str, task_id: int) -> DataFrame:
    """The task; of lines with one id the last."""
    return tasks(spark, path, env_name).where(F.col("task_id") == task_id).orderBy(F.desc("file"), F.desc("pos")).limit(1)


def problem_text(rows: DataFrame, prompt: str) -> Column:
    """A prompt as text: chat messages join their system and user texts, and without any are their own JSON; null is empty."""
    if rows.schema[prompt].dataType.typeName() != "array":
        return F.coalesce(F.col(prompt).cast("string"), F.lit(""))
    texts = F.transform(F.filter(prompt, lambda m: m["role"].isin("system", "user")), lambda m: stripped(m["content"]))
    said = F.array_join(F.filter(texts, lambda x: x.isNotNull() & (x != "")), "\n\n")
    return F.coalesce(F.nullif(said, F.lit("")), F.to_json(prompt), F.lit(""))


def dataset_tasks(rows: DataFrame | None, env_name: str, order: str, prompt: str = "prompt", evaluation: DataFrame | None = None) -> DataFrame:
    """A prompt data set as tasks: env_name, task_id, problem and meta.

    task_id is the place by ``order``, equal places in an order of their own; ranges are numbered in parallel. Without
    a training split (None) the evaluation split gives the tasks. meta is JSON with the environment's id, prompt, answer,
    info ({} where missing) and example_id (the task_id where missing); absent columns count as missing.
    """
    if rows is None and evaluation is None:
        raise ValueError(f"{env_name} has no data set")
    rows = evaluation if rows is None else rows
    ids, have = dense(rows, "task_id", F.col(order)), set(rows.columns)
    col = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    info = F.coalesce(F.to_json("info") if "info" in have and rows.schema["info"].dataType.typeName() != "string" else col("info"), F.lit("{}"))
    given = F.to_json(F.struct(env_id(F.lit(env_name)).alias("verifiers_env_id"), F.col(prompt).alias("prompt"), col("answer").alias("answer"), F.coalesce(col("example_id"), F.col("task_id")).alias("example_id")))
    meta = F.concat(F.substring(given, F.lit(1), F.length(given) - 1), F.lit(',"info":'), info, F.lit("}"))
    return ids.select(F.lit(env_name).alias("env_name"), "task_id", problem_text(rows, prompt).alias("problem"), meta.alias("meta"))


def _number(line: str) -> int | None:
    """A task line's number, as line_id reads it; None for any other line."""
    try:
        held = json.loads(line)
        given = [str(held[k]) for k in ("task_id", "id") if k in held]
    except (TypeError, ValueError):
        return None
    return next((int(x) for x in given if x.strip().lstrip("+-").isdigit()), None)


#: Bytes of lines that a lookup hands on at once: a batch of the index has thousands of entries, whatever their lines' lengths.
LINES_BYTES = 4 << 20


def _indexed_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that entries of an index (task_id, file, start, length) point at, in batches of LINES_BYTES or one longer line."""
    from pyarrow import fs

    def made(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], ["file", "pos", "value"])

    name, stream = None, None
    for batch in batches:
        found, size = [], 0
        for file, start, length, id_ in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "length", "task_id")), strict=True):
            if found and size + length > LINES_BYTES:
                yield made(found)
                found, size = [], 0
            if file != name:
                store, at = fs.FileSystem.from_uri(file.replace("s3a://", "s3://", 1))  # Hadoop's name and Arrow's
                name, stream = file, store.open_input_file(at)
            stream.seek(start)
            line = stream.read(length).decode(errors="replace").rstrip()
            if _number(line) != id_:
                raise ValueError(f"{file} is not the file that was indexed")
            found.append((file, start, line))
            size += length
        if found:
            yield made(found)


class TaskIndex:
    """Where each task's line lies in JSON-lines files: a lookup reads those lines' bytes and no others.

    The index is a table (task_id, file, start, length) sorted by task_id, so that finding a task reads a part of it;
    of lines with one id the last is in it, files by name. Files that were changed since are an error where it shows.
    """

    SCHEMA = "task_id int, file string, start long, length long"

    def __init__(self, spark: SparkSession, index: str, env_name: str):
        self.spark, self.index, self.env_name = spark, index, env_name

    def build(self, path: str) -> None:
        """One pass over the uncompressed files; offsets come from the lines' lengths and from those of the parts before them."""
        at = new_folder(self.spark, "offsets")
        read = self.spark.read.option("lineSep", "\n").text(path)
        line = stripped(F.col("value"))
        known = F.from_json(line, TASK_LINE)
        id_ = F.when((line != "") & F.try_parse_json(line).isNotNull(), line_id(line, known))
        pos = F.monotonically_increasing_id()
        rows = read.select(F.col("_metadata.file_path").alias("file"), pos.alias("pos"), F.shiftright(pos, 33).alias("part"), F.octet_length("value").cast("long").alias("length"), id_.alias("task_id"))
        rows.write.mode("overwrite").option("compression", "zstd").parquet(at)  # narrow: what follows doesn't read the files again
        held = self.spark.read.schema(rows.schema).parquet(at)
        sums = held.groupBy("file", "part").agg(F.sum(F.col("length") + 1).alias("bytes")).orderBy("file", "part").collect()  # a row for each part that a task read
        begins, before = [], {}
        for r in sums:
            begins.append((r["file"], r["part"], before.get(r["file"], 0)))
            before[r["file"]] = before.get(r["file"], 0) + r["bytes"]
        parts = self.spark.createDataFrame(begins, "file string, part long, begin long")
        within = F.sum(F.col("length") + 1).over(Window.partitionBy("file", "part").orderBy("pos")) - F.col("length") - 1
        placed = held.withColumn("within", within).where("task_id is not null").join(F.broadcast(parts), ["file", "part"])
        last = placed.groupBy("task_id").agg(F.max(F.struct("file", (F.col("begin") + F.col("within")).alias("start"), "length")).alias("at"))
        ordered = last.select("task_id", "at.*").repartitionByRange("task_id").sortWithinPartitions("task_id")
        ordered.write.mode("overwrite").option("compression", "zstd").parquet(self.index)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.index)

    def count(self) -> int:
        return self.entries().count()

    def task(self, task_id: int) -> DataFrame:
        """The task as a row; none if there is no such line."""
        return self._tasks(self.entries().where(F.col("task_id") == task_id))

    def tasks(self, ids: DataFrame) -> DataFrame:
        """The tasks of many ids (task_id), each once: lines are read in parallel, in the order of files and places. Entries are
        few bytes for the lines that they stand for, so the number of ranges is given."""
        wanted = ids.select(F.col("task_id").cast("int")).distinct()
        ranges = self.entries().join(wanted, "task_id").repartitionByRange(shuffle_parts(self.spark), "file", "start")
        return self._tasks(ranges.sortWithinPartitions("file", "start"))

    def _tasks(self, entries: DataFrame) -> DataFrame:
        return parsed(entries.mapInArrow(_indexed_lines, "file string, pos long, value string"), self.env_name)


def trace(spark: SparkSession, path: str, session: str) -> DataFrame:
    """Agent events as fold() takes them; blank lines and lines that aren't JSON are left out."""
    rows = numbered(lines(spark, path)).where(F.try_parse_json("value").isNotNull())
    return rows.select(F.lit(session).alias("session"), F.col("line_no").alias("seq"), F.from_json("value", TRACE_EVENT).alias("e")).select("session", "seq", "e.type", "e.data.*")


def manifest(spark: SparkSession, path: str, public: bool = False) -> DataFrame:
    """line_no, the line's fields (null for lines that can't be read) and ``valid``. The next task_idx is the number of lines."""
    shape = PUBLIC_MANIFEST if public else MANIFEST
    rows = numbered(lines(spark, path)).select("line_no", F.from_json("value", shape).alias("m"), "value")
    fine = F.try_parse_json("value").isNotNull() & F.col("m.list_name").isNotNull() & F.col("m.env_name").isNotNull() & F.col("m.task_id").isNotNull() & F.col("m.teacher_name").isNotNull()
    return rows.select("line_no", fine.alias("valid"), "m.*")


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], struct("line_no long, valid boolean, " + MANIFEST))


def teachers(spark: SparkSession, text: str) -> DataFrame:
    """A YAML list of teachers, or JSON, which is YAML too; every entry keeps what isn't a column in config."""
    try:
        import yaml

        found = yaml.safe_load(text)
    except ImportError:
        found = json.loads(text)
    rows = [
        (x["teacher_name"], x.get("provider"), x.get("family"), json.dumps({k: v for k, v in x.items() if k not in ("teacher_name", "provider", "family", "active")}, sort_keys=True), bool(x.get("active", True)))
        for x in found or []
    ]
    return spark.createDataFrame(rows, "teacher_name string, provider string, family string, config string, active boolean")


#: Task sources by kind; add to it to extend.
TASK_SOURCES: dict[str, Callable[..., DataFrame]] = {"jsonl": tasks, "swe_rebench": tasks, "verifiers": dataset_tasks}


def task_source(kind: str) -> Callable[..., DataFrame]:
    if kind not in TASK_SOURCES:
        raise ValueError(f"unknown task source {kind!r}; known: {', '.join(sorted(TASK_SOURCES))}")
    return TASK_SOURCES[kind]
