"""Alignment of two tokenizers' tokens over the same bytes.

Tokens of both sides are the nodes of a graph, and two tokens are linked where their byte ranges overlap. A union-find
over that graph gives connected components, which are the least groups of tokens that cover the same bytes on both sides:
they end where a token of either side ends. The members of a component expand into its links.

Neither tokenizer joins what a single space divides, so texts are aligned as chunks that begin at such spaces, and a
chunk seen before isn't aligned again; texts with other runs of spaces are aligned whole. Then the documents that hold a
pair of ids linked are counted over all documents, and each document is scored with those counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.llm.bpetree import _byte_characters
from rollweave.llm.common import Scratch, process_cache, small_batches, table
from rollweave.llm.pieces import SPACE_MARK, Normaliser, _fields, model_file
from rollweave.llm.tokenfiles import _IRREGULAR, STRUNG, Encoder, slices, vocabulary_file

#: Bytes of text that are aligned at a time.
SLICE = 2 << 20
#: Chunks that a worker remembers at most, some 400 bytes each, and their greatest length.
KNOWN, KNOWN_LENGTH = 150_000, 48
#: Counted pairs that travel with the tasks at a time (some 17 MB); with more, documents meet one block of pairs after another.
BLOCK_PAIRS = 1_000_000


def union_find(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node of each node's component, over the edges (u, v)."""
    parent = np.arange(n)
    while True:
        a, b = parent[u], parent[v]
        apart = a != b
        if not apart.any():
            return parent
        u, v = u[apart], v[apart]
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (parent[parent] != parent).any():
            parent = parent[parent]


@dataclass
class Groups:
    """Components of one stretch of bytes: which component each token is in, counted from 0 in order, and the links."""

    of_a: np.ndarray
    of_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> Groups:
    """a_ends, b_ends: where each side's tokens end, increasing to the same last byte."""
    if not len(a_ends):
        none = np.zeros(0, np.int64)
        return Groups(none, none, none, none)
    n = len(a_ends)
    first_b = np.searchsorted(b_ends, np.concatenate([[0], a_ends[:-1]]), "right")  # holds a token's first byte
    last_b = np.searchsorted(b_ends, a_ends, "left")  # holds its last byte
    first_a = np.searchsorted(a_ends, np.concatenate([[0], b_ends[:-1]]), "right")
    # of two overlapping tokens one holds the first byte of the other
    root = union_find(n + len(b_ends), np.concatenate([np.arange(n), first_a]), np.concatenate([first_b, np.arange(len(b_ends))]) + n)
    number = np.cumsum(root[:n] == np.arange(n)) - 1  # a component's least node is its first token of side a
    of_a, of_b = number[root[:n]], number[root[n:]]
    # a member of side a expands into the members of side b from its first byte to its last
    each = last_b - first_b + 1
    ends = np.cumsum(each)
    link_b = np.repeat(first_b - (ends - each), each) + np.arange(ends[-1])
    return Groups(of_a, of_b, np.repeat(np.arange(n), each), link_b)


@dataclass
class Aligned:
    n_a: int
    n_b: int
    n_groups: int
    #: a1,a2|b1;a3|b2,b3
    text: str
    #: id of side a << 32 | id of side b for each link, as bytes
    links: bytes
    #: Both sides' bytes are those of the text.
    same: bool = True


NOTHING = Aligned(0, 0, 0, "", b"")
DIFFERENT = Aligned(0, 0, 0, "", b"", False)


class Aligner:
    """Side a: a byte-level vocabulary of the tokenizers library, given a space and the text; side b: a SentencePiece model, given the text."""

    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece

        self.a = Encoder(vocabulary, plain_special=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        to_byte = {c: b for b, c in _byte_characters().items()}
        entries = [self.a.tokenizer.id_to_token(i) or "" for i in range(self.a.tokenizer.get_vocab_size())]
        self.a_bytes = [bytes(map(to_byte.__getitem__, x)) if all(c in to_byte for c in x) else x.encode() for x in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace(SPACE_MARK, " ").encode() for i, x in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        normal = Normaliser.of_model(model)
        kind = dict(_fields(b"".join(v for k, v in _fields(model) if k == 2))).get(3, 1)
        self.chunked = (
            self.a.chunked
            and kind == 2  # merges of neighbours
            and not len(normal.chars.units)
            and (normal.add_dummy_prefix, normal.remove_extra_whitespaces, normal.escape_whitespaces) == (True, False, True)
            and not any(SPACE_MARK in x.lstrip(SPACE_MARK) for x in pieces)
        )
        self.irregular = f"{self.a.irregular}| $|{SPACE_MARK}"
        #: ids as text with what follows them: another of the group, the group's other side, the next group
        self.a_text = [f"{i}," for i in range(len(entries))] + [f"{i}|" for i in range(len(entries))]
        self.b_text = [f"{i}," for i in range(len(pieces))] + [f"{i};" for i in range(len(pieces))]
        self.known: dict[str, Aligned] = process_cache(f"aligned {zlib.crc32(vocabulary.encode())} {zlib.crc32(model)}")

    def _ids_a(self, texts: list[str], strung: bool) -> list[np.ndarray]:
        """Side a's ids of texts that begin with the space; ``strung``: they are chunks, and many are encoded as one text."""
        able = [strung and not x[-1].isspace() for x in texts]
        one = iter(self.a._strung([x for x, ok in zip(texts, able, strict=True) if ok]))
        other = iter(self.a.whole([x for x, ok in zip(texts, able, strict=True) if not ok]))
        return [np.frombuffer(next(one), self.a.dtype) if ok else next(other) for ok in able]

    def _ids_b(self, texts: list[str], strung: bool) -> list[np.ndarray]:
        step = STRUNG if strung else 1
        out = []
        parts = [texts[i : i + step] for i in range(0, len(texts), step)]
        for own, ids in zip(parts, self.b.encode(["".join(p)[1:] for p in parts], num_threads=1), strict=True):
            ids = np.array(ids, np.int64)
            if len(own) == 1:
                out.append(ids)
                continue
            ends, upto = np.cumsum(self.b_size[ids]), np.cumsum([len(x.encode()) for x in own])
            cuts = np.searchsorted(ends, upto)
            if len(ids) and cuts[-1] == len(ids) - 1 and (ends[cuts] == upto).all():
                out += np.split(ids, cuts[:-1] + 1)
            else:  # a piece that stands for other bytes than the text's
                out += [np.array(x, np.int64) for x in self.b.encode([x[1:] for x in own], num_threads=1)]
        return out

    def align(self, texts: list[str], strung: bool = False) -> list[Aligned]:
        """Texts with the space before them, all aligned at once: a text's end is a cut on both sides."""
        if not texts:
            return []
        sides = list(zip(self._ids_a(texts, strung), self._ids_b(texts, strung), strict=True))
        same = [
            text.encode() == b"".join(map(self.a_bytes.__getitem__, a.tolist())) == b"".join(map(self.b_bytes.__getitem__, b.tolist()))
            for text, (a, b) in zip(texts, sides, strict=True)
        ]
        kept = [x for x, ok in zip(sides, same, strict=True) if ok]
        if not kept:
            return [DIFFERENT] * len(texts)
        n_a, n_b = (np.array([len(x[side]) for x in kept]) for side in (0, 1))
        a, b = (np.concatenate([x[side] for x in kept]).astype(np.int64) for side in (0, 1))
        found = groups(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))
        total = int(found.of_a[-1]) + 1 if len(a) else 0
        a_in, b_in = np.bincount(found.of_a, minlength=total), np.bincount(found.of_b, minlength=total)
        # a group's tokens of side a, then those of side b
        place_a = np.arange(len(a)) + (np.cumsum(b_in) - b_in)[found.of_a]
        place_b = np.arange(len(b)) + np.cumsum(a_in)[found.of_b]
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[np.cumsum(a_in) - 1], last_b[np.cumsum(b_in) - 1] = True, True
        which = np.empty(len(a) + len(b), np.int64)
        which[place_a] = a + last_a * (len(self.a_text) // 2)
        which[place_b] = len(self.a_text) + b + last_b * (len(self.b_text) // 2)
        texts_of = self.a_text + self.b_text
        written = [texts_of[i] for i in which.tolist()]
        links = (a[found.link_a] << 32 | b[found.link_b]).astype("<i8").tobytes()
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        upto_links = np.searchsorted(found.link_a, upto_a, "left").tolist()
        upto_groups = np.concatenate([found.of_a, [total]])[upto_a].tolist()
        out, at, link, group = [], 0, 0, 0
        for na, nb, upto, upto_link, upto_group in zip(n_a.tolist(), n_b.tolist(), (upto_a + upto_b).tolist(), upto_links, upto_groups, strict=True):
            out.append(Aligned(na, nb, upto_group - group, "".join(written[at:upto])[:-1], links[8 * link : 8 * upto_link]))
            at, link, group = upto, upto_link, upto_group
        found_ = iter(out)
        return [next(found_) if ok else DIFFERENT for ok in same]

    def _regular(self, texts: pa.Array) -> Iterator[list[Aligned]]:
        """The chunks of texts with the space before them."""
        lists = pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0")
        coded, known = lists.flatten().dictionary_encode(), self.known
        codes, chunks = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        missing = [c for c in chunks if c and c not in known]
        learned = dict(zip(missing, self.align(missing, strung=True), strict=True)) | {"": NOTHING}
        found = [learned[c] if c in learned else known[c] for c in chunks]
        if len(known) < KNOWN:
            known.update((c, x) for c, x in learned.items() if c and len(c) <= KNOWN_LENGTH)
        offsets = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
        held = [found[i] for i in codes.tolist()]
        for i, j in zip(offsets, offsets[1:]):  # noqa: B905  one more offset than texts
            yield held[i + 1 : j]  # nothing stands before the first space

    def __call__(self, texts: pa.Array) -> Iterator[list[Aligned]]:
        """Each text's parts in order, none for texts without tokens: null, empty, or with other bytes on either side."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
        odd = pc.match_substring_regex(spaced, self.irregular).to_numpy(zero_copy_only=False) if self.chunked else np.ones(len(texts), bool)
        regular = self._regular(spaced.filter(pa.array(~odd & ~empty)))
        whole = iter(self.align(spaced.filter(pa.array(odd & ~empty)).to_pylist()))
        for none, own in zip(empty.tolist(), odd.tolist(), strict=True):
            parts = [] if none else [next(whole)] if own else next(regular)
            yield parts if all(x.same for x in parts) else []


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, a array<int>, b array<int>, times array<int>"


def aligned(rows: DataFrame, vocabulary_path: str, model_path: str) -> DataFrame:
    """rows (row struct, text string) -> row, n_a, n_b, n_groups, n_links, groups, and the distinct linked pairs: a, b, times.

    A row for each row, repeats included; names below ``row`` can't clash. Null and empty texts, and texts whose tokens'
    bytes aren't those of a space and the text, have zeros, the empty string and no pairs. Texts are aligned whole,
    however long. An empty table gives an empty one. Both files are read on the driver and broadcast (some 3 MB).
    """
    spark = rows.sparkSession
    small_batches(spark)
    with open(vocabulary_path, encoding="utf-8") as v, open(model_path, "rb") as m:
        files = spark.sparkContext.broadcast((v.read(), m.read()))

    def arrow(own: list[list[Aligned]]) -> Iterator[pa.Array]:
        for counts in zip(*((sum(x.n_a for x in p), sum(x.n_b for x in p), sum(x.n_groups for x in p), sum(len(x.links) for x in p) // 8) for p in own), strict=True):
            yield pa.array(counts, pa.int64())
        yield pa.array([";".join([x.text for x in p]) for p in own], pa.string())
        pairs = [np.unique(np.frombuffer(b"".join([x.links for x in p]), "<i8"), return_counts=True) for p in own]
        bounds = pa.array(np.concatenate([[0], np.cumsum([len(c) for c, _ in pairs])]), pa.int32())
        codes, times = (np.concatenate([x[i] for x in pairs]) for i in (0, 1))
        for values in (codes >> 32, codes & 0xFFFFFFFF, times):
            yield pa.ListArray.from_arrays(bounds, pa.array(values.astype(np.int32)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*files.value)
        names = [x.split()[0] for x in ALIGNED.split(", ")]
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *arrow(list(aligner(texts)))], ["row", *names])

    return rows.select("row", "text").mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {ALIGNED}")


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, documents, best): how many rows of found hold a pair, and whether no pair of the same a is in more. Counted within tasks first."""
    pairs = found.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b")
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("documents"))
    return counts.withColumn("best", F.col("documents") == F.max("documents").over(Window.partitionBy("a")))


def _scored(rows: DataFrame, block: DataFrame) -> DataFrame:
    """Adds n_best and count_sum over the links whose pair is in block, a table of some BLOCK_PAIRS rows, and leaves a, b and times out."""
    held = block.select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("code"), "documents", "best").toArrow()
    code, documents, best = (held.column(i).to_numpy() for i in range(3))
    order = np.argsort(code)
    counted = rows.sparkSession.sparkContext.broadcast((code[order], documents[order], best[order]))
    rest = [c for c in rows.columns if c not in ("a", "b", "times")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, documents, best = counted.value
        for batch in batches:
            a, b, times = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "times"))
            bounds = a.offsets.to_numpy() - a.offsets[0].as_py()
            own = a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy()
            at = np.minimum(np.searchsorted(code, own), max(len(code) - 1, 0))
            n = np.where(code[at] == own, times.flatten().to_numpy(), 0) if len(code) else np.zeros(len(own), np.int64)
            values = (n * documents[at], n * best[at]) if len(code) else (n, n)
            count_sum, n_best = (np.diff(np.concatenate([[0], np.cumsum(x)])[bounds]) for x in values)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())], [*rest, "n_best", "count_sum"])

    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in rest)
    return rows.mapInArrow(run, f"{kinds}n_best long, count_sum long")


def scored(found: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds n_best and count_sum to rows of aligned(), with the counts of pairs over all of them, and leaves a, b and times out.

    The counted pairs travel with the tasks where they are few; else in blocks, each with a pass of its own over the rows'
    pairs, whose sums are added up by row.
    """
    counts = scratch.keep(pair_counts(found), "counts")
    blocks = -(-counts.count() // BLOCK_PAIRS)
    if blocks <= 1:
        return _scored(found, counts)
    keyed = scratch.keep(found.withColumn("key", F.monotonically_increasing_id()), "keyed")  # written: a row keeps its number
    part = F.pmod(F.xxhash64("a", "b"), F.lit(blocks))
    passes = [_scored(keyed.select("key", "a", "b", "times"), counts.where(part == i)) for i in range(blocks)]
    every = passes[0]
    for other in passes[1:]:
        every = every.unionByName(other)
    sums = every.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return keyed.drop("a", "b", "times").join(sums, "key").drop("key")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "alignment")
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id").alias("row"), "text")
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    found = aligned(docs, vocabulary_file(), model_file())
    found = found.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "a", "b", "times")
    return scored(scratch.keep(found, "aligned"), scratch)
