"""Quality classification by compression: one zstandard dictionary of good text and one of bad.

A text is cut into pieces of PIECE bytes, so that its own repetition doesn't hide the dictionaries, and every piece is
compressed with both. The difference of the two compressed sizes, divided by the text's own size, says which dictionary
knows the text better; a logistic curve over that one number, fitted to held-back labels, makes the calibrated score.

Fitting takes at most SAMPLE labelled documents of each label, those with the least MD5 of doc_id: half for the
dictionaries and half for the calibration. Their texts are read whole. GROUPS tasks for each label make a dictionary of
every SLICE bytes of text that they read, on the executors; the driver makes one dictionary of those.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.llm.common import small_batches, table
from rollweave.llm.langid import remainder

SAMPLE = 3000
PIECE = 1024
DICTIONARY = 65_536
LEVEL = 3
GROUPS = 8
SLICE = 8 << 20
#: Strength of the pull to zero on the regression's weight, which keeps separable samples finite.
RIDGE = 1e-3


@dataclass
class Model:
    good: bytes
    bad: bytes
    #: Intercept and weight of the difference, and the difference's mean and deviation.
    weights: tuple[float, float] = (0.0, 0.0)
    centre: float = 0.0
    scale: float = 1.0


class Sizer:
    def __init__(self, model: Model):
        import zstandard

        self.compressors = []
        for content in (model.good, model.bad):
            held = zstandard.ZstdCompressionDict(content) if content else None
            if held is not None:
                held.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, text: str | None) -> float:
        """Compressed bytes that the good dictionary saves against the bad one, per byte of text; 0 for null and empty texts."""
        raw = (text or "").encode()
        if not raw:
            return 0.0
        good, bad = (sum(len(c.compress(raw[i : i + PIECE])) for i in range(0, len(raw), PIECE)) for c in self.compressors)
        return (bad - good) / len(raw)


def cut(raw: bytes) -> list[bytes]:
    return [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]


def dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary of all pieces; where they are too few to train one (some ten), the pieces themselves."""
    import zstandard

    if not pieces:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)


def combined(parts: list[bytes]) -> bytes:
    """One dictionary of the text of several."""
    return parts[0] if len(parts) == 1 else dictionary([x for part in parts for x in cut(part)])


def calibrate(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weighted logistic regression on one number by Newton's method: intercept and weight, centre and scale."""
    centre, scale = float(x.mean()), max(float(x.std()), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    beta, ridge = np.zeros(2), RIDGE * w.sum() * np.diag([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(2), z.T @ (w * (y - p)) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return beta, centre, scale


def _learned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (label, part, text) sorted by label and part -> a dictionary (label, part, number, content) of every SLICE bytes of a part."""
    at, pieces, size, n = None, [], 0, 0

    def out() -> pa.RecordBatch:
        found = [(*at, n, dictionary(pieces))] if pieces else []
        kinds = [("label", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), ("content", pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], k) for i, (_, k) in enumerate(kinds)], [name for name, _ in kinds])

    for batch in batches:
        for label, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if (label, part) != at:
                yield out()
                at, pieces, size, n = (label, part), [], 0, 0
            for piece in cut((text.as_py() or "").encode()):
                pieces.append(piece)
                size += len(piece)
                if size >= SLICE:
                    yield out()
                    pieces, size, n = [], 0, n + 1
    yield out()


def _sizes(rows: DataFrame, model: Model, keep: str) -> DataFrame:
    """rows (``keep`` column, text) -> the column and d."""
    small_batches(rows.sparkSession)
    fields = rows.sparkSession.sparkContext.broadcast((model.good, model.bad))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(Model(*fields.value))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sizer(x.as_py()) for x in batch.column(1)], pa.float64())], [keep, "d"])

    return rows.select(keep, "text").mapInArrow(run, f"{keep} {rows.schema[keep].dataType.simpleString()}, d double")


def sampled(labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label, part) of the labels that are learned from, and how many labels there are of each kind.

    Repeated labels count once. Labels that are null or other numbers than 0 and 1, and those of a doc_id that is
    labelled both ways, teach nothing. ``part``: 0 to GROUPS - 1 for the dictionaries, -1 for the calibration.
    """
    labels = labels.where("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"), F.max("label").alias("most"))
    labels = labels.where("label = most").select("doc_id", "label")
    count = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    h = F.md5(F.col("doc_id").cast("string"))
    least = [labels.where(f"label = {k}").orderBy(h, "doc_id").limit(sample) for k in (0, 1)]
    spot = F.conv(F.substring(h, -2, 2), 16, 10).cast("int")
    part = F.when(spot % 2 == 1, F.lit(-1)).otherwise((spot / 2).cast("int") % GROUPS)
    return least[0].unionByName(least[1]).withColumn("part", part), count


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of docs (doc_id, text) and labels (doc_id, label 0 or 1, learnable rows only).

    Labels without a document teach nothing; rows that repeat a doc_id are texts of its label. With labels of one kind
    only, or none, or an empty table of documents, the model knows no text and its score is the share of good labels
    (one good and one bad label added), 0.5 for none.
    """
    small_batches(docs.sparkSession)
    ids, count = sampled(labels, sample)
    share = (count.get(1, 0) + 1) / (sum(count.values()) + 2)
    unlearned = Model(b"", b"", (math.log(share / (1 - share)), 0.0))
    if len(count) < 2:
        return unlearned
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # 2 * sample ids at most
    taught = rows.where("part >= 0").repartition("label", "part").sortWithinPartitions("label", "part", "doc_id", "text").select("label", "part", "text")
    parts = sorted((r["label"], r["part"], r["n"], bytes(r["content"])) for r in taught.mapInArrow(_learned, "label int, part int, n int, content binary").collect())
    good, bad = ([x[3] for x in parts if x[0] == k] for k in (1, 0))
    if not good or not bad:
        return unlearned
    model = Model(combined(good), combined(bad))
    found = sorted((r["label"], r["d"]) for r in _sizes(rows.where("part = -1"), model, "label").collect())
    y = np.array([x for x, _ in found], np.float64)
    if len(set(y.tolist())) < 2:
        return unlearned
    # the sample takes labels alike; weights give each its share of all labels
    w = np.where(y == 1, count[1] / (y == 1).sum(), count[0] / (y == 0).sum()) * len(y) / sum(count.values())
    beta, model.centre, model.scale = calibrate(np.array([d for _, d in found]), y, w)
    model.weights = float(beta[0]), float(beta[1])
    return model


def score_of(model: Model) -> Column:
    """The score from d."""
    z = F.lit(model.weights[0]) + F.lit(model.weights[1] / model.scale) * (F.col("d") - model.centre)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """rows (row struct, text) -> row and score, every row by itself; null and empty texts score as texts of no difference."""
    return _sizes(rows, model, "row").select("row", score_of(model).alias("score"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = remainder(F.col("doc_id"), 3) == 1
    model = fit(docs, labels.where(~held).select("doc_id", F.col("quality").alias("label")))
    found = scored(docs.select(F.struct("doc_id", held.alias("held_out")).alias("row"), "text"), model)
    return found.select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
