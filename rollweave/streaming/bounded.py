"""A stream of events that drops the oldest when it falls behind, and says how many.

Events are lines of JSON in files that don't change once they are there, read in the order of their names. A batch has
the last ``limit`` of the events that came since the batch before; the ones before them are left out, and an event of
its own counts them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

LIMIT = 2048
DROPPED = "events.dropped"


@dataclass
class Part(InputPartition):
    """Lines of a file, or the number of dropped events."""

    file: str
    skip: int
    take: int
    dropped: int = 0


class BoundedReader(DataSourceStreamReader):
    def __init__(self, path: str, limit: int):
        self.path, self.limit = path, limit
        self.counts: dict[str, int] = {}

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path.replace("s3a://", "s3://", 1))

    def _files(self) -> list[tuple[str, int]]:
        """(file, events) in the order of names; each file is read for its count once."""
        from pyarrow import fs

        store, at = self._store()
        out = []
        for info in sorted(store.get_file_info(fs.FileSelector(at)), key=lambda x: x.base_name):
            if info.is_file and not info.base_name.startswith(("_", ".")):
                if info.path not in self.counts:
                    with store.open_input_stream(info.path) as stream:
                        self.counts[info.path] = sum(1 for line in stream.read().splitlines() if line.strip())
                out.append((info.path, self.counts[info.path]))
        return out

    def initialOffset(self) -> dict:
        return {"files": 0, "events": 0}

    def latestOffset(self) -> dict:
        files = self._files()
        return {"files": len(files), "events": sum(n for _, n in files)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        """The same for the same offsets, so that a batch which is repeated has the same events."""
        first = max(start["events"], end["events"] - self.limit)
        out, at = [], 0
        for file, n in self._files()[: end["files"]]:
            skip, upto = max(first - at, 0), min(end["events"] - at, n)
            if skip < upto:
                out.append(Part(file, skip, upto - skip))
            at += n
        if lost := first - start["events"]:
            out.append(Part("", 0, 0, lost))
        return out

    def read(self, partition: Part) -> Iterator[tuple]:
        if partition.dropped:
            yield (json.dumps({"level": "warning", "service": "event_sink", "event": DROPPED, "message": str(partition.dropped)}),)
            return
        store, _ = self._store()
        with store.open_input_stream(partition.file) as stream:
            lines = [line for line in stream.read().splitlines() if line.strip()]
        for line in lines[partition.skip : partition.skip + partition.take]:
            yield (line.decode(errors="replace"),)

    def commit(self, end: dict) -> None:
        pass


class BoundedEvents(DataSource):
    """spark.readStream.format("bounded_events").option("path", a URI).option("limit", 2048): value string."""

    @classmethod
    def name(cls) -> str:
        return "bounded_events"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> BoundedReader:
        return BoundedReader(self.options["path"], int(self.options.get("limit", LIMIT)))
