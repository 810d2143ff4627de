"""Snapshot tables on plain files, and the publisher's shards, manifest and metadata.

A table is a folder of data folders and a log. Each log entry is a version: the list of the data folders that it is made
of. A write makes a new data folder and then the next log entry, so readers see one whole version, a write that dies
leaves nothing that counts, and of two writers that began from one version the second fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession

from rollweave.operators import publish as plans
from rollweave.schemas import LISTED_CELL, SHARD, TABLES, struct
from rollweave.sources import files
from rollweave.sources.blobs import Blobs
from rollweave.sources.shards import publish_shards


class Conflict(Exception):
    """Another writer has made the version that a write was to make."""


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.blobs, self.root = spark, Blobs(spark, root), root.rstrip("/")

    def version(self, name: str) -> int:
        """The number of the current version; 0 before the first write. A log that is gone from under its data is an error."""
        entries = [x for x in self.blobs.names(f"{name}/_log") if x.isdigit()]
        if not entries and any(x.startswith("v-") for x in self.blobs.names(name)):
            raise FileNotFoundError(f"{self.root}/{name} has data and no log")
        return int(entries[-1]) if entries else 0

    def _folders(self, name: str, version: int) -> list[str]:
        return json.loads(self.blobs.get(self._entry(name, version)))["folders"] if version else []

    @staticmethod
    def _entry(name: str, version: int) -> str:
        return f"{name}/_log/{version:020d}"

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The current version, or an earlier one; without rows before the first write."""
        if folders := self._folders(name, self.version(name) if version is None else version):
            return self.spark.read.parquet(*(f"{self.root}/{name}/{x}" for x in folders))
        return self.spark.createDataFrame([], struct(TABLES[name]))

    def _commit(self, name: str, df: DataFrame, base: int, held: list[str], partition_by: tuple[str, ...]) -> int:
        if not base:  # the log is there before any data is
            self.blobs.put_new(self._entry(name, 0), json.dumps({"folders": []}).encode())
        folder = f"v-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(f"{self.root}/{name}/{folder}")
        if not self.blobs.put_new(self._entry(name, base + 1), json.dumps({"folders": [*held, folder]}).encode()):
            raise Conflict(f"version {base + 1} of {name} was written by someone else")
        return base + 1

    def write(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = (), base: int | None = None) -> int:
        """df becomes the table's next version; returns its number.

        ``base``: the version that df was made from, now by default. If it isn't the current one any more, nothing is
        written over it and Conflict is raised: read again and repeat.
        """
        return self._commit(name, df, self.version(name) if base is None else base, [], partition_by)

    def append(self, name: str, df: DataFrame, tries: int = 10) -> int:
        """A version of all that the table holds and new rows, which are one more data folder. Repeated where other writers come between."""
        for left in reversed(range(tries)):
            base = self.version(name)
            try:
                return self._commit(name, df, base, self._folders(name, base), ())
            except Conflict:
                if not left:
                    raise
        raise ValueError("tries must be positive")


def write_shards(rows: DataFrame, root: str, prefix: str = "") -> DataFrame:
    """task_idx and shard columns -> one zstd file tasks/NNNNNNNN.parquet for each task_idx, in order of sample_idx; returns (task_idx, n, object_key).

    A cell is a few rollouts, so each fits a task. Files are written under another name and moved: repeated tasks
    overwrite a file by an equal one.
    """
    names, at = [f.name for f in struct(SHARD)], f"{prefix.rstrip('/')}/tasks" if prefix else "tasks"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))  # Hadoop's name and Arrow's
        store.create_dir(f"{folder}/{at}", recursive=True)
        held: list[pa.Table] = []

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                whole = pa.concat_tables(held)
                idx, final = whole.column("task_idx")[0].as_py(), f"{folder}/{at}/{whole.column('task_idx')[0].as_py():08d}.parquet"
                beside = f"{final}.{uuid.uuid4().hex}"
                with store.open_output_stream(beside) as stream:
                    pq.write_table(whole.select(names), stream, compression="zstd")
                store.move(beside, final)
                yield pa.RecordBatch.from_arrays([pa.array([idx], pa.int64()), pa.array([whole.num_rows], pa.int64()), pa.array([f"{at}/{idx:08d}.parquet"])], ["task_idx", "n", "object_key"])
                held.clear()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            start = 0
            ids = batch.column("task_idx").to_pylist()
            for i in range(1, len(ids) + 1):
                if i == len(ids) or ids[i] != ids[start]:
                    if held and held[0].column("task_idx")[0].as_py() != ids[start]:
                        yield from out()
                    held.append(table.slice(start, i - start))
                    start = i
        yield from out()

    return rows.repartition("task_idx").sortWithinPartitions("task_idx", "sample_idx").mapInArrow(run, "task_idx long, n long, object_key string")


class Publisher:
    """A bucket of published cells: tasks/*.parquet, manifest.jsonl, metadata.json."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix, self.blobs = spark, root.rstrip("/"), f"{prefix.rstrip('/')}/" if prefix else "", Blobs(spark, root)

    def manifest_text(self) -> str:
        return (self.blobs.get(f"{self.prefix}manifest.jsonl") or b"").decode()

    def manifest(self, public: bool = False) -> DataFrame:
        if not self.manifest_text():
            return files.empty_manifest(self.spark)
        return files.manifest(self.spark, self.blobs.uri(f"{self.prefix}manifest.jsonl"), public)

    def _append(self, new: list[str]) -> int:
        old = self.manifest_text().splitlines()
        if new:
            self.blobs.put(f"{self.prefix}manifest.jsonl", "\n".join([*old, *new]).encode())
        return len(old) + len(new)

    def publish(self, pending: DataFrame, rollouts: DataFrame, now: Column, cap: int = plans.MAX_NEW, mature_after_s: int = 0, stamp: str = "") -> DataFrame:
        """One cycle; returns the cells that it handled, to be marked. The manifest is written before any mark, so what a crash leaves
        unmarked is found again as recovered. A cycle has ``cap`` new manifest lines at most, which one commit adds with their shards; the
        plan, of any number of cells, is a table below _cycles, which done() deletes."""
        next_idx = len(self.manifest_text().splitlines())
        known = self.manifest().where("valid")
        at = f"{self.root}/{self.prefix}_cycles/{uuid.uuid4().hex}"
        made = plans.plan_cycle(plans.classify(pending, rollouts, known), next_idx, cap)
        made.write.option("compression", "zstd").parquet(at)
        plan = self.spark.read.schema(made.schema).parquet(at)
        entries = plans.manifest_entries(plan, now, self.root, self.prefix, mature_after_s)
        publish_shards(plans.shard_rows(plan, rollouts), plans.manifest_lines(entries), self.root, self.prefix)
        total = next_idx + entries.count()
        self.blobs.put(f"{self.prefix}metadata.json", json.dumps({"version": 1, "last_updated": stamp, "tasks": {"total": total}}, sort_keys=True).encode())
        return plan.select(*LISTED_CELL, "action", "task_idx")

    def done(self) -> None:
        """Deletes the cycles' plans; call it once the cells that publish() returned are marked."""
        self.blobs.delete(f"{self.prefix}_cycles")

    def promote(self, public: Publisher, progress: DataFrame, now: Column, now_text: str, max_per_cycle: int = plans.MAX_PER_CYCLE, max_per_day: int = plans.MAX_PER_DAY, stage_days: int = plans.STAGE_DAYS) -> DataFrame:
        """Copies mature cells to the public bucket, first published first; returns every cell that is public and unmarked."""
        there = public.manifest(True).where("valid")
        today = plans.promoted_since(progress, now).first()[0] if max_per_day > 0 else 0
        budget = plans.promotion_budget(today, max_per_cycle, max_per_day)
        chosen = plans.promote(plans.promotable(self.manifest().where("valid"), there, now), budget).orderBy("line_no").collect()
        new = []
        for row in chosen:  # the cycle's budget at most
            entry = {k: v for k, v in row.asDict().items() if k not in ("line_no", "valid")}
            self.blobs.copy(entry["object_key"], public.blobs, entry["object_key"])
            entry |= {"promoted_at": now_text, "object_uri": public.blobs.uri(entry["object_key"])}
            new.append(json.dumps(entry, sort_keys=True))
        completed = public._append(new)
        staged = sum(1 for x in self.manifest_text().splitlines() if x.strip())
        body = {"version": 1, "last_updated": now_text, "tasks": {"staged_released": plans.staged_released(completed, staged, max_per_day, stage_days), "completed_up_to": completed}}
        public.blobs.put(f"{public.prefix}metadata.json", json.dumps(body, sort_keys=True).encode())
        return plans.unmarked_promotions(progress, public.manifest(True).where("valid"))


def audit(spark: SparkSession, actor: str, action: str, target: str, payload: dict, now: Column, id_: int) -> DataFrame:
    """A row of the audit log."""
    row = spark.createDataFrame([(id_, actor, action, target, json.dumps(payload, sort_keys=True))], "id long, actor string, action string, target string, payload string")
    return row.select("id", now.alias("ts"), "actor", "action", "target", "payload")
