"""Codes of vectors: each part of a vector as the index of the nearest entry of that position's codebook.

Nearest entries are found in a vantage-point tree over the entries of each part position. A node has a vantage point and
the others split by their distance to it; of each side it keeps the least distance, rounded down, and the greatest,
rounded up, as integers. A part's own distance to the vantage point is rounded both ways, so the triangle inequality
gives a bound below the distance to anything in a side, and a side is visited unless that bound exceeds the best distance
so far: a side that could tie is visited. Distances to vantage points and in leaves are integers, ties go to the lower
index, so the result is that of comparing all entries.

Codebooks have 64 entries for each position, so all of them together are as large as 64 vectors: they travel with the
tasks. A round sums each entry's parts within the tasks, and only those sums are shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.llm.common import Scratch, salted, table

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Entries of a leaf, compared one by one.
LEAF = 4
#: Sums of labels are broadcast up to this many labels (some 4 MB); beyond, the join shuffles.
BROADCAST_LABELS = 50_000
SALTS = 64
#: Components below this keep squared distances, and sums of a task, within 64 bits; larger ones are Python's integers.
SMALL = 1 << 24
_LONG = (1 << 63) - 1


def root_down(squares: np.ndarray) -> np.ndarray:
    """The greatest integers whose squares don't exceed the given ones."""
    if squares.dtype == object:
        return np.array([math.isqrt(x) for x in squares.tolist()], object)
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


def root_up(squares: np.ndarray) -> np.ndarray:
    root = root_down(squares)
    return root + (root * root < squares)


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, as integers, of the rows of x to y."""
    return ((x - y) ** 2).sum(axis=1)


@dataclass
class Node:
    index: int
    #: (least distance rounded down, greatest rounded up, subtree) of the near and of the far entries
    sides: list[tuple[int, int, Node | np.ndarray]]


class VantageTree:
    """Exact nearest entries, of equal distances the lowest index."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._build(np.arange(len(entries)))
        self.compared = 0

    def _build(self, at: np.ndarray) -> Node | np.ndarray:
        if len(at) <= LEAF:
            return at
        centre, rest = at[0], at[1:]
        squares = distance(self.entries[rest], self.entries[centre])
        order = np.argsort(squares, kind="stable")
        half = len(order) // 2
        sides = []
        for part in (order[:half], order[half:]):
            own = squares[part]
            sides.append((root_down(own.min(keepdims=True))[0], root_up(own.max(keepdims=True))[0], self._build(np.sort(rest[part]))))
        return Node(int(centre), sides)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry for each row of points."""
        n = len(points)
        index = np.full(n, len(self.entries), np.int64)
        best = np.full(n, -1, points.dtype)  # -1: none yet
        self._visit(self.root, points, np.arange(n), index, best)
        return index, best

    def _meet(self, entry: int, points: np.ndarray, rows: np.ndarray, index: np.ndarray, best: np.ndarray) -> np.ndarray:
        squares = distance(points[rows], self.entries[entry])
        self.compared += len(rows)
        held = best[rows]
        better = ((held < 0) | (squares < held) | ((squares == held) & (entry < index[rows]))).astype(bool)
        index[rows[better]], best[rows[better]] = entry, squares[better]
        return squares

    def _visit(self, node: Node | np.ndarray, points: np.ndarray, rows: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        if not len(rows):
            return
        if isinstance(node, np.ndarray):
            for entry in node.tolist():
                self._meet(entry, points, rows, index, best)
            return
        squares = self._meet(node.index, points, rows, index, best)
        low, high = root_down(squares), root_up(squares)
        bounds = [np.maximum(np.maximum(low - most, least - high), 0) for least, most, _ in node.sides]
        # each part goes to the side first whose bound is lower, the near one of equal bounds
        far_first = (bounds[1] < bounds[0]).astype(bool)
        for turn, chosen in ((0, ~far_first), (1, ~far_first), (1, far_first), (0, far_first)):
            can = chosen & ((best[rows] < 0) | (bounds[turn] ** 2 <= best[rows])).astype(bool)
            self._visit(node.sides[turn][2], points, rows[can], index, best)


#: For each part position, an array (entries x components) of integers.
Codebooks = list[np.ndarray]


def _integers(values: np.ndarray, small: bool) -> np.ndarray:
    return values.astype(np.int64) if small else np.array([[int(v) for v in row] for row in values.tolist()], object).reshape(values.shape)


def _matrix(column: pa.Array, width: int, small: bool) -> np.ndarray:
    """Vectors as rows of integers, filled with zeros up to width."""
    if column.null_count:
        raise ValueError("vectors must not be null")
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return _integers(out, small)


def assign(matrix: np.ndarray, trees: list[VantageTree]) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, squared distances), each vectors x parts."""
    size = matrix.shape[1] // len(trees)
    found = [tree.nearest(matrix[:, p * size : (p + 1) * size]) for p, tree in enumerate(trees)]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(column: Callable[[pa.RecordBatch], np.ndarray], books: Codebooks):
    """A task's partial sums: (part, entry, n, sums as decimal text) for each entry that got parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [VantageTree(b) for b in books]
        size = books[0].shape[1]
        count = np.zeros((len(books), len(books[0])), np.int64)
        total = np.zeros((len(books), len(books[0]), size), object)
        for batch in batches:
            matrix = column(batch)
            index, _ = assign(matrix, trees)
            for p in range(len(books)):
                part = matrix[:, p * size : (p + 1) * size]
                for entry in np.unique(index[:, p]).tolist():
                    own = part[index[:, p] == entry]
                    count[p, entry] += len(own)
                    total[p, entry] += np.array([int(x) for x in own.sum(axis=0)], object)
        for p, entry in np.argwhere(count).tolist():
            values = [[p], [entry], [int(count[p, entry])], [[str(x) for x in total[p, entry]]]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["part", "entry", "n", "sums"])

    return run


def _means(group: pd.DataFrame) -> pd.DataFrame:
    """Componentwise floor(sum / count) of one entry over all tasks."""
    n = int(group["n"].sum())
    sums = [sum(map(int, own)) for own in zip(*group["sums"], strict=True)]
    return pd.DataFrame({"part": group["part"].iloc[:1], "entry": group["entry"].iloc[:1], "mean": [[str(s // n) for s in sums]]})


def quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, label, v): v has floor(256 * x) of each component; rows whose vector is null or holds null or non-finite components go."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # doubles: SQL's floor would make longs, which large components don't fit
    scaled = F.transform("embedding", lambda x: x.cast("double") * 256)
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x))
    return rows.where(F.col("embedding").isNotNull()).where(finite).select("vec_id", "label", whole.alias("v"))


def first_books(vectors: DataFrame, width: int, small: bool, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest vec_ids; equal vec_ids in the order of their vectors, null ones last."""
    first = vectors.where("vec_id is not null").orderBy("vec_id", "v").limit(entries).collect()
    if len(first) < entries:
        first += vectors.where("vec_id is null").orderBy("v").limit(entries - len(first)).collect()
    rows = np.zeros((len(first), width))
    for row, found in zip(rows, first, strict=True):
        row[: len(found["v"])] = found["v"]
    size = width // parts
    return [_integers(rows[:, p * size : (p + 1) * size], small) for p in range(parts)]


def _column(width: int, small: bool) -> Callable[[pa.RecordBatch], np.ndarray]:
    return lambda batch: _matrix(batch.column(batch.schema.get_field_index("v")), width, small)


def train(vectors: DataFrame, width: int, small: bool, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after the given rounds; entries that got no part stay as they are."""
    books = first_books(vectors, width, small, parts, entries)
    for _ in range(rounds if width else 0):
        partial = vectors.select("v").mapInArrow(_sums(_column(width, small), books), "part int, entry int, n long, sums array<string>")
        found = partial.groupBy("part", "entry").applyInPandas(_means, "part int, entry int, mean array<string>").collect()  # entries x parts rows at most
        books = [b.copy() for b in books]
        for row in found:
            books[row["part"]][row["entry"]] = [int(x) for x in row["mean"]]
    return books


def digest(books: Codebooks) -> str:
    """SHA-256 of all entries' components, by part, entry and position, in decimals joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.reshape(-1)).encode()).hexdigest()


def coded(vectors: DataFrame, books: Codebooks, width: int, small: bool) -> DataFrame:
    """Adds code (array of indexes, one for each part) and error (summed squared distances) to (vec_id, label, v), without v."""
    column = _column(width, small)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [VantageTree(b) for b in books]
        for batch in batches:
            if width:
                index, squares = assign(column(batch), trees)
            else:
                index = squares = np.zeros((batch.num_rows, len(books)), np.int64)
            error = pa.array([min(int(x), _LONG) for x in squares.sum(axis=1)], pa.int64())
            code = pa.ListArray.from_arrays(pa.array(np.arange(0, index.size + 1, len(books)), pa.int32()), pa.array(index.reshape(-1), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code, error], ["vec_id", "label", "code", "error"])

    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    return vectors.select("vec_id", "label", "v").mapInArrow(run, f"{kinds}, code array<int>, error long")


def with_label_error(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds label_error, the error summed over the rows of equal label, null labels together; at most the largest long."""
    rows = rows.withColumn("salt", salted(F.struct("vec_id", "error"), SALTS))
    partial = rows.groupBy("label", "salt").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("own"))
    totals = scratch.keep(partial.groupBy("label").agg(F.least(F.sum("own"), F.lit(_LONG)).cast("long").alias("label_error")), "labels")
    if totals.count() <= BROADCAST_LABELS:
        stats, by = F.broadcast(totals.withColumnRenamed("label", "of")), F.col("label").eqNullSafe(F.col("of"))
    else:
        stats = totals.withColumnRenamed("label", "of").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        by = F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("turn"))
    return rows.join(stats, by).select("vec_id", "label", "code", "error", "label_error")


def compressed(rows: DataFrame, scratch: Scratch, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """rows (vec_id, embedding, label) -> (vec_id, label, code, error, label_error) and the codebooks.

    Rows whose vector is null or holds null or non-finite components go; repeated rows, and rows without vec_id or label,
    stay. Vectors whose lengths differ, or don't divide into equal parts, are filled with zeros. With fewer vectors than
    entries, all of them are entries; an empty table gives no rows and empty codebooks. Errors beyond 64 bits are the
    largest long. Other columns don't matter.
    """
    vectors = scratch.keep(quantised(rows.select("vec_id", "embedding", "label")), "vectors")
    most = F.max(F.array_max(F.transform("v", F.abs)))
    longest, largest = vectors.agg(F.max(F.size("v")), most).first()
    width = -(-(longest or 0) // parts) * parts
    small = (largest or 0) < SMALL
    books = train(vectors, width, small, parts, entries, rounds)
    found = scratch.keep(coded(vectors, books, width, small), "codes")
    scratch.drop(vectors)
    return with_label_error(found, scratch), books


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = compressed(table(spark, sf_dir, "embeddings"), Scratch(spark, "codes"))
    code = F.array_join(F.transform("code", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")
    return found.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
