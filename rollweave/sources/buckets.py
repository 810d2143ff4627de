"""Keyed tables whose rows lie in folders by a hash of their key, so that a write replaces only the folders it touches.

A change finds the buckets of its batch, reads those alone, and writes their new rows to a folder of its own first. Then
these take the place of the touched buckets by a dynamic partition overwrite; all other files stay as they are. A writer
that dies before the first write is done leaves nothing that counts; after it, recover() repeats the swap from what was
written, so a change is made whole once. A batch given again, under the same query and number, is left out.

One writer at a time; a reader during a swap may see some buckets old and some new.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.operators import merge
from rollweave.schemas import struct
from rollweave.sources.appends import Appends
from rollweave.sources.blobs import Blobs

#: Rows of a file at most.
FILE_ROWS = 5_000_000


class Buckets:
    """``n``: buckets, some hundred MB each at the size that the table will have; it can't change afterwards.

    ``log``: where audit rows go, in the columns of AUDIT.
    """

    AUDIT = "ts string, actor string, action string, target string, payload string"

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], n: int = 256, log: Appends | None = None):
        self.spark, self.path, self.keys, self.n = spark, path.rstrip("/"), list(keys), n
        self.schema, self.blobs, self.log = struct(schema), Blobs(spark, self.path), log

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n)).cast("int")

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table's rows, or those of some buckets: the scan opens no others."""
        if not any(x.startswith("bucket=") for x in self.blobs.names("")):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(struct(f"{self.schema.simpleString()[7:-1]}, bucket int")).parquet(self.path)
        return (rows if buckets is None else rows.where(F.col("bucket").isin(list(buckets)))).drop("bucket")

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets that hold the batch's keys, n at most."""
        return sorted(r[0] for r in batch.select(self.bucket()).distinct().collect())

    def change(self, batch: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], once: tuple[str, int] | None = None, audit: dict[str, str] | None = None) -> bool:
        """The touched buckets' rows become how(rows, batch), which keeps every row's key and drops none; whether it was done.

        ``once``: a query's name and its batch's number: batches up to that number are left out when they come again.
        ``audit``: a row of the log, which is written if the change is made, and once, whenever the writer dies.
        """
        if audit and self.log is None:
            raise ValueError("an audited change needs a log")
        self.recover()
        if once and once[1] <= self._applied(once[0]):
            return False
        batch = batch.persist()
        try:
            if buckets := self.touched(batch):
                self._stage(how(self.read(buckets), batch), once, audit)
                self.recover()
            elif once:
                self._apply(*once)
        finally:
            batch.unpersist()
        return True

    def _stage(self, rows: DataFrame, once: tuple[str, int] | None, audit: dict[str, str] | None) -> None:
        (query, number), name = once or ("-", -1), uuid.uuid4().hex
        if audit:  # there before the change counts
            self.blobs.put(f"_audits/{name}", json.dumps(audit).encode())
        rows = rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema)).withColumn("bucket", self.bucket())
        staged = f"{self.path}/_staged/{number}.{name}.{query}"
        rows.hint("rebalance", "bucket").write.option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).partitionBy("bucket").parquet(staged)

    def recover(self) -> None:
        """Ends a change whose writer died: what was written whole takes its place, what wasn't goes."""
        for name in self.blobs.names("_staged"):
            folder = f"_staged/{name}"
            if self.blobs.exists(f"{folder}/_SUCCESS"):
                self._swap(f"{self.path}/{folder}")
                number, change, query = name.split(".", 2)
                if int(number) >= 0:
                    self._apply(query, int(number))
                if row := self.blobs.get(f"_audits/{change}"):
                    self._note(json.loads(row), change)
            self.blobs.delete(folder)
        self.blobs.delete("_audits")

    def _note(self, row: dict[str, str], change: str) -> None:
        """Written again it replaces itself."""
        names = [f.split()[0] for f in self.AUDIT.split(", ")]
        self.log.append(self.spark.createDataFrame([tuple(row.get(c) for c in names)], self.AUDIT), change, 0)

    def _swap(self, staged: str) -> None:
        rows = self.spark.read.schema(struct(f"{self.schema.simpleString()[7:-1]}, bucket int")).parquet(staged)
        out = rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).partitionBy("bucket").parquet(self.path)

    def _applied(self, query: str) -> int:
        return int(self.blobs.get(f"_applied/{query}") or -1)

    def _apply(self, query: str, number: int) -> None:
        self.blobs.put(f"_applied/{query}", str(number).encode())

    # -- changes ------------------------------------------------------------------------------------------------------

    def upsert(self, rows: DataFrame, keep: Sequence[str] = (), order: Sequence[str] = (), once: tuple[str, int] | None = None, audit: dict[str, str] | None = None) -> bool:
        """merge.upsert on the touched buckets; with ``order`` the last row of each key counts, else a key has one row at most."""
        last = merge.last_of(rows, self.keys, *map(F.col, order)) if order else rows
        return self.change(last, lambda current, batch: merge.upsert(current, batch, self.keys, keep), once, audit)

    def insert_ignore(self, rows: DataFrame, *order: Column, once: tuple[str, int] | None = None) -> bool:
        return self.change(rows, lambda current, batch: current.unionByName(merge.insert_ignore(current, batch, self.keys, *order), allowMissingColumns=True), once)

    def update(self, changes: DataFrame, once: tuple[str, int] | None = None, audit: dict[str, str] | None = None) -> bool:
        return self.change(changes, lambda current, batch: merge.update(current, batch, self.keys), once, audit)
