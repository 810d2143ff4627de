"""SentencePiece encoding with byte spans in the original text, and decoding.

The text is normalised here, by longest-prefix replacement through the model's compiled character map (a Darts-clone
double array), and every normalised byte keeps the original byte that it comes from. The library then encodes the
normalised text with its own normaliser switched off, and each piece's normalised bytes are projected back.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.llm.common import small_batches, table

SPACE_MARK = "▁"
#: Bytes of text that are encoded at a time.
SLICE = 1 << 20


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields: integers as int, all else as bytes."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = message[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(message):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            n, at = {1: (8, at), 5: (4, at)}.get(tag & 7) or varint(at)
            value, at = message[at : at + n], at + n
        yield tag >> 3, value


@dataclass
class CharMap:
    """The compiled character map: a double array over UTF-8 bytes, whose values are places in a blob of replacements."""

    units: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    blob: bytes = b""

    @classmethod
    def parse(cls, data: bytes) -> CharMap:
        if not data:
            return cls()
        (n,) = struct.unpack_from("<I", data)
        return cls(np.frombuffer(data, "<u4", n // 4, 4), data[4 + n :])

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that the text has at ``at``."""
        if not len(self.units):
            return None
        found, unit = None, int(self.units[0])
        place = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(text)):
            place ^= text[i]
            if place >= len(self.units):
                break
            unit = int(self.units[place])
            if unit & 0x800000FF != text[i]:
                break
            place ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = i + 1 - at, int(self.units[place]) & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.blob[found[1] : self.blob.index(b"\0", found[1])]


@dataclass
class Normaliser:
    chars: CharMap
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True
    #: Pieces that are never normalised.
    kept: tuple[bytes, ...] = ()

    @classmethod
    def of_model(cls, model: bytes, kept: Iterable[str] = ()) -> Normaliser:
        spec = dict(_fields(b"".join(v for k, v in _fields(model) if k == 3)))
        return cls(
            CharMap.parse(spec.get(2, b"")), bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1)),
            tuple(sorted((x.encode() for x in kept), key=len, reverse=True)),
        )

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the original byte that it comes from."""
        if not len(self.chars.units) and not self.kept and not self.remove_extra_whitespaces and self.escape_whitespaces:
            return self._plain(text)
        return self._general(text.encode())

    def _plain(self, text: str) -> tuple[str, np.ndarray]:
        """An empty character map: only spaces change, so the alignment is an array operation."""
        if not text:
            return "", np.zeros(1, np.int64)
        source = np.frombuffer(text.encode(), np.uint8)
        origin = np.repeat(np.arange(len(source)), np.where(source == 32, 3, 1))
        lead = np.zeros(3 * self.add_dummy_prefix, np.int64)
        return SPACE_MARK * self.add_dummy_prefix + text.replace(" ", SPACE_MARK), np.concatenate([lead, origin, [len(source)]])

    def _step(self, text: bytes, at: int) -> tuple[int, bytes]:
        for x in self.kept:
            if text.startswith(x, at):
                return len(x), x
        if found := self.chars.longest(text, at):
            return found
        lead = text[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return n, text[at : at + n]

    def _general(self, text: bytes) -> tuple[str, np.ndarray]:
        mark = SPACE_MARK.encode() if self.escape_whitespaces else b" "
        at, out, origin = 0, bytearray(), []
        if self.remove_extra_whitespaces:
            while at < len(text):
                n, chunk = self._step(text, at)
                if chunk != b" ":
                    break
                at += n
        if at >= len(text):
            return "", np.array([len(text)] if not text else [at])
        before = self.remove_extra_whitespaces

        def put(piece: bytes, place: int) -> None:
            out.extend(piece)
            origin.extend([place] * len(piece))

        if self.add_dummy_prefix:
            put(mark, at)
        while at < len(text):
            n, chunk = self._step(text, at)
            if before:
                chunk = chunk.lstrip(b" ")
            if chunk:
                put(chunk.replace(b" ", mark), at)
                before = self.remove_extra_whitespaces and chunk.endswith(b" ")
            at += n
        end = len(text)
        if self.remove_extra_whitespaces:
            while out.endswith(mark):
                del out[-len(mark) :]
                end = origin[len(out)]
                del origin[len(out) :]
        return out.decode(), np.array([*origin, end], np.int64)


class Codec:
    """Encodes to ids and byte bounds, and decodes; made once for each task from the model's bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        kept = [self.whole.id_to_piece(i) for i in self._typed(model, 4)]
        self.normalise = Normaliser.of_model(model, kept)
        # a later normaliser spec overrides the fields of an earlier one: no character map, no prefix, nothing removed or escaped
        self.inner = sentencepiece.SentencePieceProcessor(model_proto=model + bytes([0x1A, 8, 0x12, 0, 0x18, 0, 0x20, 0, 0x28, 0]))
        n = self.whole.get_piece_size()
        self.unknown = self.whole.unk_id()
        self.length = np.array([1 if self.whole.is_byte(i) else len(self.whole.id_to_piece(i).encode()) for i in range(n)], np.int64)

    @staticmethod
    def _typed(model: bytes, kind: int) -> list[int]:
        pieces = (dict(_fields(v)) for k, v in _fields(model) if k == 1)
        return [i for i, x in enumerate(pieces) if x.get(3, 1) == kind]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, bounds) for each text; piece i covers the original bytes bounds[i] to bounds[i + 1]."""
        plain = [self.normalise(x) for x in texts]
        out = []
        for (text, origin), ids in zip(plain, self.inner.encode([x for x, _ in plain], num_threads=1), strict=True):
            ids = np.array(ids, np.int32)
            if (ids == self.unknown).any():  # an unknown piece's length isn't in the vocabulary
                parts = self.inner.encode(text, return_type="proto").pieces
                ends = np.cumsum([len(x.surface.encode()) for x in parts])
            else:
                ends = np.cumsum(self.length[ids])
            out.append((ids, origin[np.concatenate([[0], ends]).astype(np.int64)].astype(np.int32)))
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.whole.decode([x.tolist() for x in ids], num_threads=1)


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts): runs of SLICE bytes or one longer text."""
    first, held, size = 0, [], 0
    for i, x in enumerate(texts):
        text = x.as_py() or ""
        if held and size + len(text) > SLICE:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def _lists(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32), pa.int32()))


def encoded(rows: DataFrame, model_path: str) -> DataFrame:
    """rows (row struct, text string) -> row, ids, bounds (original byte bounds, one more than ids) and decoded.

    A row for each row, repeats included; names below ``row`` can't clash, and an empty table gives an empty one. Null
    counts as the empty text, which has no ids and the one bound 0. Texts are encoded whole, in slices of SLICE bytes or
    one longer text at a time: a task holds a text's ids and bounds, some 16 bytes a byte of text at most. The model file
    is read on the driver and broadcast (some 0.5 MB).
    """
    small_batches(rows.sparkSession)
    with open(model_path, "rb") as file:
        model = rows.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model.value)
        for batch in batches:
            for first, texts in _slices(batch.column(1)):
                found = codec.encode(texts)
                ids = [x for x, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), _lists(ids), _lists([x for _, x in found]), pa.array(codec.decode(ids), pa.string())],
                    ["row", "ids", "bounds", "decoded"],
                )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.select("row", "text").mapInArrow(run, f"row {kind}, ids array<int>, bounds array<int>, decoded string")


def digest(numbers: Column) -> Column:
    """SHA-256 of the decimal numbers joined by commas."""
    return F.sha2(F.array_join(numbers.cast("array<string>"), ",").cast("binary"), 256)


def _digests(rows: DataFrame, model_path: str) -> DataFrame:
    return encoded(rows, model_path).select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.col("ids")).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        digest(F.col("bounds")).alias("bounds_sha256"),
    )


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def tokenised(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and bounds_sha256 (of the pieces' byte bounds in the text, one more than ids) for each row of docs, repeats included."""
    return _digests(docs.select(F.struct("doc_id").alias("row"), "text"), model_path or model_file())


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents"))
