"""Tables that rows are added to, each batch once: a batch's rows lie under its query's name and number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.schemas import struct
from rollweave.sources.blobs import Blobs


class Appends:
    """A folder of ``query=../batch=..`` folders. A batch given again replaces what it wrote before, also where its rows were made anew in another order.

    Queries that write to one table need names of their own, and a query that begins with a new checkpoint a new name.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), struct(schema)

    def append(self, rows: DataFrame, query: str, number: int) -> None:
        """Writes a batch; others of any query may be written at the same time."""
        named = rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema))
        named.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/query={query}/batch={number}")

    def sink(self, query: str) -> Callable[[DataFrame, int], None]:
        """For foreachBatch."""
        return lambda batch, number: self.append(batch, query, number)

    def read(self, query: str | None = None, since: int | None = None) -> DataFrame:
        """All rows with the query and batch that they came with, or those of one query, from a batch on: no other folders are listed for their rows."""
        kind = struct(f"{self.schema.simpleString()[7:-1]}, query string, batch long")
        if not any(x.startswith("query=") for x in Blobs(self.spark, self.path).names("")):
            return self.spark.createDataFrame([], kind)
        rows = self.spark.read.schema(kind).parquet(self.path)
        rows = rows if query is None else rows.where(F.col("query") == query)
        return rows if since is None else rows.where(F.col("batch") >= since)
