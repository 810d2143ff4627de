"""Published shards and their manifest lines as one write: a data source whose commit makes both visible, or neither.

Tasks write shards under names of their own attempt. The commit moves them to their places and puts the manifest with
their lines; readers go by the manifest, so that put is what publishes. A task that is repeated leaves files that no
message names, and an aborted job's files go; both lie in the write's own folder, which its commit deletes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from rollweave.schemas import SHARD, struct


def _store(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))  # Hadoop's name and Arrow's


@dataclass
class Shards(WriterCommitMessage):
    #: (task_idx, rows, file in the write's folder, manifest line)
    written: list[tuple[int, int, str, str]]


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.root, self.prefix = options["root"].rstrip("/"), options.get("prefix", "").rstrip("/")
        self.job = options.get("job") or uuid.uuid4().hex

    def _folder(self) -> tuple:
        store, at = _store(self.root)
        return store, f"{at}/{self.prefix}" if self.prefix else at

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shards:
        """Rows come sorted by task_idx; a shard is written when its last row has come."""
        import pyarrow.parquet as pq

        store, at = self._folder()
        held, out, current = [], [], None
        store.create_dir(f"{at}/_jobs/{self.job}", recursive=True)

        def close() -> None:
            if held:
                whole, name = pa.concat_tables(held), f"_jobs/{self.job}/{current:08d}.{uuid.uuid4().hex}.parquet"
                with store.open_output_stream(f"{at}/{name}") as stream:
                    pq.write_table(whole.drop_columns(["task_idx", "line"]), stream, compression="zstd")
                out.append((current, whole.num_rows, name, whole.column("line")[0].as_py()))
                held.clear()

        for batch in iterator:
            ids, table, start = batch.column(batch.schema.get_field_index("task_idx")).to_pylist(), pa.Table.from_batches([batch]), 0
            for i in range(1, len(ids) + 1):
                if i == len(ids) or ids[i] != ids[start]:
                    if current != ids[start]:
                        close()
                        current = ids[start]
                    held.append(table.slice(start, i - start))
                    start = i
        close()
        return Shards(out)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, at = self._folder()
        found = sorted(x for m in messages if m is not None for x in m.written)
        store.create_dir(f"{at}/tasks", recursive=True)
        for idx, _, name, _ in found:
            store.move(f"{at}/{name}", f"{at}/tasks/{idx:08d}.parquet")
        if found:
            self._append([line for *_, line in found], store, f"{at}/manifest.jsonl")
        self._clear(store, at)

    def _append(self, lines: list[str], store, path: str) -> None:
        from pyarrow import fs

        old = b""
        if store.get_file_info(path).type != fs.FileType.NotFound:
            with store.open_input_stream(path) as stream:
                old = stream.read()
        text = [*old.decode().splitlines(), *lines]
        first = json.loads(lines[0])["task_idx"]
        if first is not None and first != len(text) - len(lines):
            raise ValueError(f"the manifest has {len(text) - len(lines)} lines, and the first new one is of task_idx {first}: someone else has published")
        beside = f"{path}.{uuid.uuid4().hex}.tmp"
        with store.open_output_stream(beside) as stream:
            stream.write("\n".join(text).encode())
        store.move(beside, path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*self._folder())

    def _clear(self, store, at: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{at}/_jobs/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{at}/_jobs/{self.job}")


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rollout_shards"

    def schema(self) -> str:
        return f"task_idx long, {SHARD}, line string"

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter(dict(self.options) | {"job": uuid.uuid4().hex})


def publish_shards(rows: DataFrame, lines: DataFrame, root: str, prefix: str = "") -> None:
    """rows (task_idx and the shard's columns) and lines (task_idx, value) -> one file and one manifest line for each task_idx of rows.

    A cell is a few rollouts, so a shard fits a task; the driver holds a line for each shard of the write.
    """
    rows.sparkSession.dataSource.register(ShardSource)
    placed = rows.join(lines.withColumnRenamed("value", "line"), "task_idx").select("task_idx", *(f.name for f in struct(SHARD)), "line")
    ordered = placed.repartition("task_idx").sortWithinPartitions("task_idx", "sample_idx")
    ordered.write.format("rollout_shards").option("root", root).option("prefix", prefix).mode("append").save()
