"""What the training-data operators share: shared storage, text normalisation and joins that survive hot keys."""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space of every contract of this package: space, tab, LF, VT, FF, CR.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a local one only where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), f"rollweave-{os.getuid()}")
    return found.rstrip("/")


#: Bytes of an Arrow batch between Spark and Python. Spark's own limit of 64 MB, with buffers that double as they fill, on
#: both sides and for each task, is a third of a small executor; so are the 4096 rows that its Parquet reader decodes at
#: a time where texts are long.
BATCH_BYTES, SCAN_ROWS = 8 << 20, 512
_SETTINGS = (("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", BATCH_BYTES), ("spark.sql.parquet.columnarReaderBatchSize", "4096", SCAN_ROWS))


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limits for batches of rows, unless they have been set: long texts make batches of few rows."""
    for name, default, ours in _SETTINGS:
        if spark.conf.get(name) == default:
            spark.conf.set(name, str(ours))


#: Bytes of a file of a small table whose size is known; large tables have as many files as the shuffle before them made.
PART_BYTES = 4 << 20
_made: list[str] = []


def release(spark: SparkSession, since: int = 0) -> None:
    """Deletes the tables that this session's operators wrote, or those after the first ``since``; call it when no result of theirs will be read again."""
    while len(_made) > since:
        delete(spark, _made.pop())


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes what operators write within, once it is left: their results must have been written elsewhere by then."""
    since = len(_made)
    yield
    release(spark, since)


class Scratch:
    """Tables written once in the shared folder, so that later stages read them instead of computing them again.

    ``keep`` writes and reads back; ``drop`` deletes a table that no unfinished plan reads any more. Written tables
    survive lost executors, unlike caches. What isn't dropped or released goes with the driver's JVM.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}", 0
        self.at: dict[int, str] = {}
        small_batches(spark)
        _made.append(self.root)
        fs, folder = _hadoop(spark, self.root)
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str = "t", size: int | None = None) -> DataFrame:
        """``size``: bytes that the table has at most, where they are known: it gets a file for PART_BYTES of them, two for each core at least."""
        self.n += 1
        path = self.path(f"{name}{self.n}")
        if size is not None:
            df = df.coalesce(max(2 * self.spark.sparkContext.defaultParallelism, size // PART_BYTES))
        df.write.option("compression", "zstd").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.at[id(out)] = path
        return out

    def drop(self, *dfs: DataFrame) -> None:
        for df in dfs:
            if path := self.at.pop(id(df), None):
                delete(self.spark, path)


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as this Python worker, so that a worker's later tasks find what earlier ones learned."""
    held = sys.modules.setdefault("rollweave_process_cache", types.ModuleType("rollweave_process_cache"))
    return held.__dict__.setdefault(f"cache:{name}", {})


def _hadoop(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def delete(spark: SparkSession, path: str) -> None:
    fs, found = _hadoop(spark, path)
    fs.delete(found, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like those asked for that df doesn't have (in any case), so that working columns never clash."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct: an operator's working columns can't clash with names below it."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns))


def normalised(text: Column) -> Column:
    """Null becomes the empty text; every run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def salted(by: Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")
