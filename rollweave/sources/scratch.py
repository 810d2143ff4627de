"""Folders of a session's own in the storage that driver and executors share, and numbers for rows in order."""

from __future__ import annotations

import os
import tempfile
import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own in the shared folder (spark.checkpoint.dir; a local one only where that is unset), which goes with the driver's JVM."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"file://{tempfile.gettempdir()}/rollweave-{os.getuid()}"
    found = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return found


def shuffle_parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions: given as a number, they stay as many where their rows' bytes are few and the work on a row is much."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def places(rows: DataFrame, *by: str) -> DataFrame:
    """(by, first, before) for each part of rows that hold by, part and pos: the rows of earlier parts. The driver sees a count for each part that a task read."""
    parts = rows.groupBy(*by, "part").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).orderBy(*by, "part").collect()
    before = accumulate((r["n"] for r in parts), initial=0)
    found = [(*r[:-1], b) for r, b in zip(parts, before, strict=False)]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*by, "part").schema)
    return rows.sparkSession.createDataFrame(found, f"{kinds}, first long, before long")


def dense(rows: DataFrame, name: str, *order: Column) -> DataFrame:
    """Adds numbers from 0 in an order, equal rows next to each other: ranges are sorted in parallel and written, then numbered by what lies before them."""
    tie = F.xxhash64(*rows.columns)
    ordered = rows.withColumn("_tie", tie).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    at = new_folder(rows.sparkSession, "ordered")
    marked = ordered.select(F.struct(*rows.columns).alias("row"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos"))
    marked.write.mode("overwrite").option("compression", "zstd").parquet(at)
    held = rows.sparkSession.read.schema(marked.schema).parquet(at)
    placed = held.join(F.broadcast(places(held)), "part")
    return placed.select("row.*", (F.col("before") + F.col("pos") - F.col("first")).alias(name))
