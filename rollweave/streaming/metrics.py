"""Streams: minute metrics, event sinks, cell state and upserts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from rollweave.operators.cells import CELL_TTL_S
from rollweave.operators.merge import last_of, upsert
from rollweave.sources.buckets import Buckets


def minute_metrics(points: DataFrame, late: str = "2 minutes") -> DataFrame:
    """points (ts timestamp, kind, metric, labels, value) -> sums, last values, counts and maxima by minute, final once the watermark has passed."""
    return (
        points.withWatermark("ts", late)
        .groupBy(F.window("ts", "1 minute").alias("w"), "kind", "metric", "labels")
        .agg(F.sum("value").alias("total"), F.max_by("value", "ts").alias("last"), F.count("value").alias("n"), F.max("value").alias("high"))
        .select(F.col("w.start").alias("ts_minute"), "kind", "metric", "labels", "total", "last", "n", "high")
    )


def upsert_sink(read: Callable[[], DataFrame], write: Callable[[DataFrame], None], keys: list[str], order: list[str], keep: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: the last row of each key replaces the stored one. A repeated batch changes nothing."""

    def each(batch: DataFrame, _: int) -> None:
        write(upsert(read(), last_of(batch, keys, *map(F.col, order)), keys, keep))

    return each


def bucket_sink(table: Buckets, order: list[str], keep: tuple[str, ...] = (), query: str = "upsert") -> Callable[[DataFrame, int], None]:
    """upsert_sink for a table in buckets: only the buckets of a batch's keys are read and written, and a repeated batch is left out.

    Name the query by its checkpoint: a new checkpoint begins to count its batches anew.
    """
    return lambda batch, number: table.upsert(batch, keep, order, (query, number)) and None


def append_sink(events: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """System events as Parquet. Spark slows a full source down instead of dropping its oldest events."""
    out = events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(availableNow=True) if once else out.trigger(processingTime="1 second")).start()


class CellState(StatefulProcessor):
    """A cell's life: attempts and collected add up; the first published_at and promoted_at count; silence for ttl_s makes it a zombie.

    Takes events (cell, kind: attempt, collect, publish or promote, ts in ms) and emits the cell after each batch and when it times out.
    """

    SCHEMA = "cell string, attempts long, collected long, published boolean, promoted boolean, zombie boolean"

    def __init__(self, ttl_s: int = CELL_TTL_S):
        self.ttl_ms = ttl_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("cell", "attempts long, collected long, published boolean, promoted boolean")

    def _row(self, key: Any, state: tuple, zombie: bool) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *state, zombie)], columns=["cell", "attempts", "collected", "published", "promoted", "zombie"])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        attempts, collected, published, promoted = self.state.get() if self.state.exists() else (0, 0, False, False)
        for part in rows:
            kinds = part["kind"].value_counts()
            attempts, collected = attempts + int(kinds.get("attempt", 0)), collected + int(kinds.get("collect", 0))
            published, promoted = published or bool(kinds.get("publish", 0)), promoted or bool(kinds.get("promote", 0))
        self.state.update((attempts, collected, published, promoted))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not published:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
        yield self._row(key, (attempts, collected, published, promoted), False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        state = self.state.get()
        if not state[2]:
            yield self._row(key, tuple(state), True)

    def close(self) -> None:
        pass


def cell_states(events: DataFrame, ttl_s: int = CELL_TTL_S) -> DataFrame:
    return events.groupBy("cell").transformWithStateInPandas(CellState(ttl_s), CellState.SCHEMA, "Update", "ProcessingTime")


class CellLife(StatefulProcessor):
    """CellState by event time, with counts by teacher, which can begin from a table of cells.

    Takes events (cell, kind: attempt, collect, publish or promote, teacher, ts_ms) and emits the cell after each batch and
    when ttl_s have passed without an event, by the watermark; a published cell has no time limit. State: the cell's
    counts, and a map from teachers to theirs.
    """

    SCHEMA = "cell string, attempts long, collected long, published boolean, promoted boolean, last_ms long, zombie boolean, teachers map<string,long>"
    #: What a snapshot has of each cell: the columns that SCHEMA has, but for zombie.
    SNAPSHOT = "cell string, attempts long, collected long, published boolean, promoted boolean, last_ms long, teachers map<string,long>"
    COUNTED = ("attempts", "collected", "published", "promoted", "last_ms")

    def __init__(self, ttl_s: int = CELL_TTL_S):
        self.ttl_ms = ttl_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("cell", "attempts long, collected long, published boolean, promoted boolean, last_ms long")
        self.teachers = handle.getMapState("teachers", "teacher string", "n long")

    def _put(self, counted: tuple) -> None:
        self.state.update(counted)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not counted[2]:
            self.handle.registerTimer(counted[4] + self.ttl_ms)

    def _row(self, key: Any, counted: tuple, zombie: bool) -> pd.DataFrame:
        teachers = {t[0]: n[0] for t, n in self.teachers.iterator()}
        row = dict(zip(self.COUNTED, counted, strict=True)) | {"cell": key[0], "zombie": zombie, "teachers": teachers}
        return pd.DataFrame([row])[[c.split()[0] for c in self.SCHEMA.replace("map<string,long>", "map").split(", ")]]

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        row = initialState.iloc[0]
        for teacher, n in dict(row["teachers"] if row["teachers"] is not None else {}).items():
            self.teachers.updateValue((teacher,), (int(n),))
        self._put((int(row["attempts"]), int(row["collected"]), bool(row["published"]), bool(row["promoted"]), int(row["last_ms"])))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        attempts, collected, published, promoted, last = self.state.get() if self.state.exists() else (0, 0, False, False, 0)
        for part in rows:
            kinds = part["kind"].value_counts()
            attempts, collected = attempts + int(kinds.get("attempt", 0)), collected + int(kinds.get("collect", 0))
            published, promoted = published or bool(kinds.get("publish", 0)), promoted or bool(kinds.get("promote", 0))
            last = max(last, int(part["ts_ms"].max()))
            for teacher, n in part.loc[part["kind"] == "collect", "teacher"].value_counts().items():
                held = self.teachers.getValue((teacher,))[0] if self.teachers.containsKey((teacher,)) else 0
                self.teachers.updateValue((teacher,), (held + int(n),))
        counted = (attempts, collected, published, promoted, last)
        self._put(counted)
        yield self._row(key, counted, False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        counted = tuple(self.state.get())
        if not counted[2]:
            yield self._row(key, counted, True)

    def close(self) -> None:
        pass


def cell_lives(events: DataFrame, snapshot: DataFrame | None = None, ttl_s: int = CELL_TTL_S, late: str = "10 minutes") -> DataFrame:
    """events (cell, kind, teacher, ts timestamp) -> CellLife's rows. ``snapshot``: CellLife.SNAPSHOT's columns, a row for each cell, where an earlier run or a table left off."""
    rows = events.withWatermark("ts", late).select("cell", "kind", "teacher", F.unix_millis("ts").alias("ts_ms"), "ts")
    first = None if snapshot is None else snapshot.groupBy("cell")
    return rows.groupBy("cell").transformWithStateInPandas(CellLife(ttl_s), CellLife.SCHEMA, "Update", "EventTime", first)


class StickyGauge(StatefulProcessor):
    """A gauge's value in every minute that the watermark has passed, from the minute in which it was first set.

    Takes (ts_ms, value) and emits (ts_minute in ms, value). State: the value carried so far and the next minute to emit,
    and the points of minutes still open; the timer is the end of the next minute. Of points at one time the greatest
    value counts, as in operators.metrics.carried.
    """

    SCHEMA = "metric string, labels string, ts_ms long, value double"
    MINUTE = 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.carried = handle.getValueState("carried", "next long, value double")
        self.open = handle.getMapState("open", "minute long", "ts long, value double")

    def _wait(self, minute: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(minute + self.MINUTE)

    def _held(self) -> tuple[int | None, float | None]:
        return self.carried.get() if self.carried.exists() else (None, None)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        following, value = self._held()
        for part in rows:
            part = part.dropna(subset=["ts_ms", "value"]).sort_values(["ts_ms", "value"])
            for minute, own in part.groupby(part["ts_ms"] // self.MINUTE * self.MINUTE):
                if following is not None and value is not None and minute < following:
                    continue  # its minute has been written
                last = (int(own["ts_ms"].iloc[-1]), float(own["value"].iloc[-1]))
                at = (int(minute),)
                if not self.open.containsKey(at) or tuple(self.open.getValue(at)) < last:
                    self.open.updateValue(at, last)
                if value is None:
                    following = int(minute) if following is None else min(following, int(minute))
        if following is not None:
            self.carried.update((following, value))
            self._wait(following)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        following, value = self._held()
        until, out = timerValues.getCurrentWatermarkInMs(), []
        while following + self.MINUTE <= until:
            if self.open.containsKey((following,)):
                value = self.open.getValue((following,))[1]
                self.open.removeKey((following,))
            out.append((*key, following, value))
            following += self.MINUTE
        self.carried.update((following, value))
        self._wait(following)
        if out:
            yield pd.DataFrame(out, columns=["metric", "labels", "ts_ms", "value"])

    def close(self) -> None:
        pass


def sticky_gauges(points: DataFrame, late: str = "2 minutes") -> DataFrame:
    """points (ts timestamp, metric, labels, value) of gauges -> (ts_minute, metric, labels, value), a row for each minute that the watermark has passed.

    A minute's value is final once written; points that come after it are left out. The query needs the RocksDB state store.
    """
    given = points.where("metric is not null and labels is not null").withWatermark("ts", late)
    rows = given.select("metric", "labels", F.unix_millis("ts").alias("ts_ms"), F.col("value").cast("double").alias("value"), "ts")
    out = rows.groupBy("metric", "labels").transformWithStateInPandas(StickyGauge(), StickyGauge.SCHEMA, "Append", "EventTime")
    return out.select(F.timestamp_millis("ts_ms").alias("ts_minute"), "metric", "labels", "value")


def heartbeats(spark: SparkSession, worker_id: str, service: str, version: str, seconds: int = 10) -> DataFrame:
    """A row every few seconds for upsert_sink on worker_id."""
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("advanceMillisPerBatch", seconds * 1000).load()
    return ticks.select(
        F.lit(worker_id).alias("worker_id"), F.lit(service).alias("service"), F.lit("running").alias("status"), F.lit(version).alias("version"), F.col("timestamp").alias("last_seen")
    )


def cycles(
    stages: list[tuple[str, Callable[[], None]]], failed: Callable[[str, Exception], None], every: dict[str, float] | None = None,
    last: dict[str, float] | None = None, clock: Callable[[], float] = time.monotonic,
) -> None:
    """One round of a service loop: each stage runs whether or not an earlier one failed.

    ``every``: seconds that must have passed since a stage's last successful run, which ``last`` keeps between rounds.
    """
    last = {} if last is None else last
    for name, stage in stages:
        if name in last and clock() - last[name] < (every or {}).get(name, 0):
            continue
        try:
            stage()
            last[name] = clock()
        except Exception as e:  # noqa: BLE001  reported, and the next round tries again
            failed(name, e)


def claim_loop(read: Callable[[], DataFrame], write: Callable[[DataFrame], None], hand_out: Callable[[DataFrame], None], batch: int, seconds: int = 5) -> Callable[[SparkSession], StreamingQuery]:
    """A producer's claims as a stream: each tick claims from the current snapshot, writes the counted attempts and hands the cells out.

    One query is the table's only writer, which stands in for row locks.
    """
    from rollweave.operators.cells import claim, with_claims

    def tick(_: DataFrame, __: int) -> None:
        progress = read()
        claimed = claim(progress, batch).persist()
        try:
            write(with_claims(progress, claimed))
            hand_out(claimed)
        finally:
            claimed.unpersist()

    return lambda spark: spark.readStream.format("rate").load().writeStream.foreachBatch(tick).trigger(processingTime=f"{seconds} seconds").start()


def bucket_claim_tick(progress: Buckets, hand_out: Callable[[DataFrame], None], batch: int, query: str = "claims") -> Callable[[DataFrame, int], None]:
    """A tick of a claim loop over progress in buckets: it scans for claimable cells and writes the claimed cells' buckets alone.

    Attempts are counted before cells are handed out; a tick that comes again after that hands nothing out, and its cells
    fall to the time limit of cells.
    """
    from rollweave.operators.cells import claim, with_claims

    def tick(_: DataFrame, number: int) -> None:
        claimed = claim(progress.read(), batch).persist()
        try:
            claimed.count()  # what is handed out is what was counted
            if progress.change(claimed, with_claims, (query, number)):
                hand_out(claimed)
        finally:
            claimed.unpersist()

    return tick


def bucket_claim_loop(progress: Buckets, hand_out: Callable[[DataFrame], None], batch: int, checkpoint: str, seconds: int = 5) -> Callable[[SparkSession], StreamingQuery]:
    """claim_loop over a table in buckets; the checkpoint keeps the number of ticks."""
    tick = bucket_claim_tick(progress, hand_out, batch)
    return lambda spark: spark.readStream.format("rate").load().writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()
