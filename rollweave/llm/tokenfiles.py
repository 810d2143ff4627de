"""Token ids in Arrow IPC files of fixed-size-list batches, and reading them back by position.

A shard is one range of doc_id. Its sequence file holds the ids of its documents one after another, cut into sequences
of equal length: a record batch is BATCH rows of (ids: fixed_size_list<uint16 or uint32>, mask: fixed_size_list<bool>),
so sequence i is row i % BATCH of batch i // BATCH, and both lists are views of the mapped file. Only the last sequence
of a shard is padded, with mask false. A second file has doc_id, offset and n_tokens of the shard's documents.

A task writes files under names of its own attempt and hands on one manifest row; files of lost or repeated attempts are
in no manifest.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.llm.common import Scratch, process_cache, table

SEQUENCE = 2048
BATCH = 64
END_ID = 2
SLICE = 8 << 20
#: Chunks that a worker remembers at most, some 200 bytes each; later ones are encoded each time.
KNOWN_CHUNKS = 400_000
#: Chunks that are encoded as one text; the library's time for a text grows faster than the text.
STRUNG = 500
#: A Latin letter and the ASCII punctuation after it, without the apostrophe, which contractions begin with.
_LETTER_MARK = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}])([!-&(-/:-@\[-`{-~])"
#: White space in Unicode, for RE2.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_IRREGULAR = f" {_WHITE}|{_WHITE} |\\x00"

MANIFEST = "shard int, ids_path string, docs_path string, tokens long, sequences long, docs long"


class Encoder:
    """Encodes whole texts with the tokenizers library.

    A byte-level vocabulary's own pattern never joins what a single space between two words divides, so texts are
    encoded as chunks that begin at such spaces, and a chunk seen before isn't encoded again; nor does it join letters
    and the punctuation after them. Texts with other runs of spaces or with an added token's content, and vocabularies
    of other kinds, are encoded whole; the ids are the same either way. ``plain_special``: the strings of special tokens
    are plain text.
    """

    def __init__(self, vocabulary: str, plain_special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = plain_special
        spec = json.loads(vocabulary)
        pre, size = spec.get("pre_tokenizer") or {}, self.tokenizer.get_vocab_size()
        self.chunked = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        added = [t["content"] for t in spec.get("added_tokens") or [] if t["content"] and not (plain_special and t["special"])]
        #: Chunks would cut an added token, and chunks encoded as one text would make one that has a space.
        self.chunked &= not any(" " in x for x in added)
        self.irregular = "|".join([_IRREGULAR, *("".join(f"\\x{{{ord(c):x}}}" for c in x) for x in added)])
        self.dtype = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)
        #: Bytes that each id stands for: a byte-level vocabulary writes each byte as one character.
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.known: dict[str, bytes] = process_cache(f"chunks {zlib.crc32(vocabulary.encode())} {plain_special}")

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.dtype) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _strung(self, chunks: list[str]) -> list[bytes]:
        """Encodes chunks that begin with a space and end without one as texts of STRUNG chunks, and cuts the ids where chunks end."""
        if not chunks:
            return []
        ids = np.concatenate(self.whole(["".join(chunks[i : i + STRUNG]) for i in range(0, len(chunks), STRUNG)]))
        upto = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum([len(x.encode()) for x in chunks])) + 1
        raw, cuts = ids.tobytes(), [0, *(upto * self.dtype.itemsize).tolist()]
        return [raw[i:j] for i, j in zip(cuts, cuts[1:])]  # noqa: B905  one more cut than chunks

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        strung = [c for c in chunks if c[:1] == " " and len(c) > 1 and not c[-1].isspace()]
        out = dict(zip(strung, self._strung(strung), strict=True))
        rest = [c for c in chunks if c not in out]
        out.update(zip(rest, (x.tobytes() for x in self.whole(rest)), strict=True))
        if len(self.known) < KNOWN_CHUNKS:
            self.known.update(out)
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, and the number of each text's ids. Null counts as the empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self.irregular).to_numpy(zero_copy_only=False) if self.chunked else np.ones(len(texts), bool)
        if odd.all():
            parts = self.whole(texts.to_pylist())
            return np.concatenate([np.zeros(0, self.dtype), *parts]), np.array([len(x) for x in parts], np.int64)
        regular = texts.filter(pa.array(~odd)) if odd.any() else texts
        lists = pc.split_pattern(pc.replace_substring(pc.replace_substring_regex(regular, _LETTER_MARK, "\\1\0\\2"), " ", "\0 "), "\0")
        coded = lists.flatten().dictionary_encode()
        codes, chunks = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        found = list(map(self.known.get, chunks))
        if missing := [c for c, x in zip(chunks, found, strict=True) if x is None]:
            learned = self._learn(missing)
            found = [learned[c] if x is None else x for c, x in zip(chunks, found, strict=True)]
        ids, n = np.frombuffer(b"".join(found), self.dtype), np.array(list(map(len, found)), np.int64) // self.dtype.itemsize
        begins, each = (np.cumsum(n) - n)[codes], n[codes]
        ends = np.cumsum(each)
        kind = np.int32 if max(len(ids), int(ends[-1])) < 1 << 31 else np.int64
        at = np.repeat((begins - (ends - each)).astype(kind), each)
        at += np.arange(len(at), dtype=kind)
        flat = ids[at]
        upto = np.concatenate([[0], ends])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        lengths = np.diff(upto)
        if not odd.any():
            return flat, lengths
        found, own = iter(np.split(flat, upto[1:-1])), iter(self.whole(texts.filter(pa.array(odd)).to_pylist()))
        parts = [next(own if x else found) for x in odd.tolist()]
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, pa.Array]]:
    """(place of the first, texts): runs of about ``most`` bytes, or one longer text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield at, texts.slice(at, upto - at)
        at = upto


def _store(uri: str):
    """(file system, path) of a folder, for any store that Arrow reaches: file, hdfs, viewfs, gs, s3 (Hadoop's s3a is Arrow's s3)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class ShardWriter:
    def __init__(self, root: str, name: str, dtype, sequence: int):
        self.fs, folder = _store(root)
        self.fs.create_dir(folder, recursive=True)
        self.dtype, self.sequence = np.dtype(dtype), sequence
        self.ids_path, self.docs_path = f"{name}.ids.arrow", f"{name}.docs.arrow"
        kind = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())])
        self.files = [self.fs.open_output_stream(f"{folder}/{x}") for x in (self.ids_path, self.docs_path)]
        self.ids = pa.ipc.new_file(self.files[0], self.schema)
        self.index = pa.ipc.new_file(self.files[1], self.docs_schema)
        self.held, self.waiting, self.tokens, self.sequences, self.docs = [], 0, 0, 0, 0

    def _put(self, flat: np.ndarray, real: int) -> None:
        ids = pa.FixedSizeListArray.from_arrays(pa.array(flat), self.sequence)
        mask = pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(flat)) < real), self.sequence)
        self.ids.write_batch(pa.RecordBatch.from_arrays([ids, mask], schema=self.schema))
        self.sequences += len(ids)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, n: np.ndarray) -> None:
        """Documents in order: their ids one after another, and how many each has, end ids included."""
        offsets = self.tokens + np.cumsum(n) - n
        self.index.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(offsets), pa.array(n)], schema=self.docs_schema))
        self.tokens, self.docs, self.waiting = self.tokens + len(ids), self.docs + len(n), self.waiting + len(ids)
        self.held.append(ids)
        full = BATCH * self.sequence
        if self.waiting >= full:
            flat, at = np.concatenate(self.held), 0
            while len(flat) - at >= full:
                self._put(flat[at : at + full], full)
                at += full
            self.held, self.waiting = [flat[at:].copy()], len(flat) - at

    def close(self) -> None:
        if self.waiting:
            flat = np.concatenate(self.held)
            self._put(np.pad(flat, (0, -len(flat) % self.sequence)), len(flat))
        self.ids.close()
        self.index.close()
        for file in self.files:
            file.close()


class ShardReader:
    """Random access to a shard's sequences; local files are mapped, so that lists are views of them."""

    def __init__(self, root: str, ids_path: str, docs_path: str):
        store, folder = _store(root)
        local = store.type_name == "local"
        opened = [pa.memory_map(f"{folder}/{x}") if local else store.open_input_file(f"{folder}/{x}") for x in (ids_path, docs_path)]
        self.ids, self.index = map(pa.ipc.open_file, opened)
        self.sequence = self.ids.schema.field("ids").type.list_size
        self._at, self._flat = -1, np.zeros(0)

    def batch(self, i: int) -> np.ndarray:
        """The ids of record batch i, one after another."""
        if i != self._at:
            self._at, self._flat = i, self.ids.get_batch(i).column(0).flatten().to_numpy()
        return self._flat

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i."""
        batch = self.ids.get_batch(i // BATCH)
        ids, mask = batch.column(0)[i % BATCH], batch.column(1)[i % BATCH]
        return ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)

    def tokens(self, start: int, n: int) -> np.ndarray:
        full, out = BATCH * self.sequence, []
        while n > 0:
            part = self.batch(start // full)[start % full : start % full + n]
            out.append(part)
            start, n = start + len(part), n - len(part)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, np.uint16)

    def documents(self) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """(doc_ids, offsets, lengths), batch by batch."""
        for i in range(self.index.num_record_batches):
            batch = self.index.get_batch(i)
            yield batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()


def write(docs: DataFrame, vocabulary_path: str, scratch: Scratch, end_id: int | None = END_ID, sequence: int = SEQUENCE) -> tuple[DataFrame, str]:
    """Writes the texts of docs (doc_id, text) in ascending doc_id order; returns the manifest and the folder.

    Null and empty texts have the end id alone. Rows without doc_id come first; rows that repeat a doc_id follow each
    other in the order of their texts. An empty table gives no shard. The vocabulary is read on the driver and
    broadcast (some 2 MB).
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    root = scratch.path("tokens")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer, shard = None, None, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encode = Encoder(vocabulary.value)
                writer = ShardWriter(root, f"shard-{shard:06d}-{uuid.uuid4().hex}", encode.dtype, sequence)
            for at, texts in slices(batch.column(1)):
                ids, n = encode(texts)
                if end_id is not None:
                    ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
                writer.add(batch.column(0).slice(at, len(texts)), ids, n)
            pa.default_memory_pool().release_unused()
        if writer is not None:
            writer.close()
            values = [shard, writer.ids_path, writer.docs_path, writer.tokens, writer.sequences, writer.docs]
            kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [x.split()[0] for x in MANIFEST.split(", ")])

    in_order = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return scratch.keep(in_order.mapInArrow(run, MANIFEST), "manifest"), root


def read(manifest: DataFrame, root: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) for each document of the files; start counts the ids of all documents before."""
    before = F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")  # a row for each shard
    shards = manifest.select("ids_path", "docs_path", before.alias("before"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = ShardReader(root, row["ids_path"], row["docs_path"])
                for doc_ids, offsets, lengths in reader.documents():
                    crc = [zlib.crc32(reader.tokens(int(o), int(n)).astype("<u4").tobytes()) for o, n in zip(offsets, lengths, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids, pa.int64()), pa.array(offsets + row["before"]), pa.array(lengths), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    spread = shards.repartition(max(1, manifest.count()))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(*write(table(spark, sf_dir, "documents"), vocabulary_file(), Scratch(spark, "tokens")))
