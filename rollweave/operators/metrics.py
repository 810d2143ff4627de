"""Minute metrics: counters add up, gauges keep their last value, histograms become sum, count and max."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEVELS = {"DEBUG": 10, "INFO": 20, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}


def labels_key(labels: Column) -> Column:
    """A map of labels as JSON with sorted keys; {} for null."""
    entries = F.array_sort(F.map_entries(F.coalesce(labels, F.create_map().cast("map<string,string>"))))
    return F.to_json(F.map_from_entries(entries))


def minutely(points: DataFrame) -> DataFrame:
    """points (ts, kind: counter, gauge or histogram, metric, labels text, value) -> (ts_minute, metric, labels, value).

    Kinds of one metric name don't meet: a histogram's rows are named metric.sum, .count and .max.
    """
    minute = F.date_trunc("minute", "ts").alias("ts_minute")
    sums = points.groupBy(minute, "kind", "metric", "labels").agg(
        F.sum("value").alias("total"), F.max_by("value", "ts").alias("last"), F.count("value").alias("n"), F.max("value").alias("high")
    )
    named = F.when(
        F.col("kind") == "histogram",
        F.array(*(F.struct(F.concat("metric", F.lit(f".{k}")).alias("metric"), F.col(c).cast("double").alias("value")) for k, c in (("sum", "total"), ("count", "n"), ("max", "high")))),
    ).otherwise(F.array(F.struct(F.col("metric"), F.when(F.col("kind") == "gauge", F.col("last")).otherwise(F.col("total")).cast("double").alias("value"))))
    return sums.select("ts_minute", "labels", F.explode(named).alias("m")).select("ts_minute", "m.metric", "labels", "m.value")


def carried(points: DataFrame, until: Column | None = None, first: Column | None = None) -> DataFrame:
    """Gauges as they stand in every minute: points (ts, metric, labels, value) -> (ts_minute, metric, labels, value).

    A gauge keeps its last value from the minute in which it was first set up to ``until``'s, by default its own last
    minute; of points at one time the greatest value counts, points without a time or value don't. ``first``: minutes
    before it are left out, while values from before it are still carried into it. One window over each gauge's minutes
    with points; the minutes between are made by an explode, without a shuffle of their own.
    """
    set_ = points.where("ts is not null and value is not null").groupBy("metric", "labels", F.date_trunc("minute", "ts").alias("begin"))
    set_ = set_.agg(F.max_by("value", F.struct("ts", "value")).cast("double").alias("value"))
    after = F.lead("begin").over(Window.partitionBy("metric", "labels").orderBy("begin"))
    minute = F.expr("interval 1 minute")
    last = F.coalesce(after - minute, F.col("begin") if until is None else F.date_trunc("minute", until))
    start = F.col("begin") if first is None else F.greatest(F.col("begin"), F.date_trunc("minute", first))
    spans = set_.withColumn("last", last).withColumn("start", start).where("start <= last")
    return spans.select(F.explode(F.sequence("start", "last", minute)).alias("ts_minute"), "metric", "labels", "value")


def sticky_minutely(points: DataFrame, until: Column) -> DataFrame:
    """minutely(), with gauges carried into every minute up to ``until``: what a process that flushes each minute writes."""
    gauge = F.coalesce(F.col("kind") == "gauge", F.lit(False))
    return minutely(points.where(~gauge)).unionByName(carried(points.where(gauge), until))


IDS = ("trace_id", "rollout_id", "pair_id", "run_id")


def whole_events(events: DataFrame, now: Column) -> DataFrame:
    """System events with all that they carry: ts, service, level, event, message, context and the ids they speak of.

    A time that is missing or can't be read is now; Z is UTC. Service and level have defaults, which an absent column
    has too; event names have 200 characters at most; a context is a JSON object, {} if it is missing or no object.
    """
    have = set(events.columns)
    col = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    context = F.coalesce(col("context"), F.lit("{}"))
    whole = F.startswith(F.schema_of_variant(F.try_parse_json(context)), F.lit("OBJECT"))
    return events.select(
        F.coalesce(F.try_to_timestamp(col("ts")), now).alias("ts"), F.coalesce(col("service"), F.lit("unknown")).alias("service"), F.coalesce(col("level"), F.lit("info")).alias("level"),
        F.left(F.coalesce(col("event"), F.lit("")), F.lit(200)).alias("event"), col("message").alias("message"), F.when(whole, context).otherwise("{}").alias("context"), *(col(c).alias(c) for c in IDS),
    )


def normalised_events(events: DataFrame, now: Column) -> DataFrame:
    """System events with defaults: bad or missing times are now, names have 200 characters at most."""
    return events.select(
        F.coalesce(F.try_to_timestamp("ts"), now).alias("ts"), F.upper(F.coalesce("level", F.lit("INFO"))).alias("level"),
        F.coalesce("service", F.lit("unknown")).alias("service"), F.left(F.coalesce("event", F.lit("")), F.lit(200)).alias("event"),
        F.coalesce("payload", F.lit("{}")).alias("payload"),
    )


def at_least(events: DataFrame, level: str) -> DataFrame:
    ranks = F.create_map(*(F.lit(x) for pair in LEVELS.items() for x in pair))
    return events.where(ranks[F.upper("level")] >= LEVELS[level.upper()])
