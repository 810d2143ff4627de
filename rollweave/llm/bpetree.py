"""BPE encoding by tree concatenation, and decoding, for vocabularies of the tokenizers library.

What a vocabulary's own pattern doesn't split is one word, however long. A long word is cut in two, and those halves
again, down to leaves that are encoded on their own; where two encoded sides meet, the text around the join is encoded
anew, from a few tokens on each side to twice as many and so on, until the window's first token is the left side's and
its last token the right side's. That decides the whole: merges happen by rank, so a sequence of tokens is the encoding
of its text when each two neighbours are the encoding of theirs, and each pair lies in the left side, the window or the
right side. Only the last leaf of a word takes the vocabulary's end-of-word mark.

Texts of over LONG characters are cut into segments, at spaces and, where there is none for long, within a word; all
segments are encoded in parallel, and the joins within words follow where a document's segments meet again.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.llm.common import Scratch, process_cache, small_batches, table
from rollweave.llm.tokenfiles import slices

#: Characters of a word that are encoded at once; longer words are made by joins.
LEAF = 12
#: Tokens on each side of a join that are encoded anew at first.
WINDOW = 2
#: Characters of a text that is encoded as one, and of a segment of a longer one.
LONG, SEGMENT = 1 << 16, 1 << 15
#: Bytes of text that are encoded at a time.
SLICE = 4 << 20
#: Chunks, and words, that a worker remembers at most, and their greatest length.
KNOWN, KNOWN_LENGTH = 300_000, 64
#: The pattern of vocabularies that drop white space; its matches, and those of the normaliser below, never cross a space.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALISERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
#: Characters, but for these, that NFC leaves alone and whose class and lower case are the same in all versions of Unicode.
_UNSTABLE = r"[^\x{1}-\x{12F}\x{131}-\x{24F}\x{2010}-\x{2027}\x{2030}-\x{205E}]"
#: The pattern over such characters.
_STABLE_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\x09-\x0D \x85\xA0\p{L}\p{N}]+")
#: A Latin letter and the ASCII punctuation after it: no word goes on from one to the other.
_LETTER_MARK = r"([a-z\x{DF}-\x{F6}\x{F8}-\x{FF}])([!-/:-@\[-`{-~])"


def _byte_characters() -> dict[int, str]:
    """How byte-level vocabularies write each byte: visible characters of Latin-1 as themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def unpacked(ids: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(ids) // 4}I", ids)


@dataclass
class Part:
    """An encoded stretch of a word: its tokens, where each ends in the word, and where the stretch begins."""

    ids: list[int]
    ends: list[int]
    start: int


class Bpe:
    """Encodes whole texts as the library does with add_special_tokens=False, and decodes with skip_special_tokens=False."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary) | {"truncation": None, "padding": None}
        model, added = spec["model"], spec.get("added_tokens") or []
        if model.get("type") not in (None, "BPE") or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "fuse_unk")):
            raise ValueError("tree concatenation needs a BPE model whose merges depend on neighbours alone")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or (t["normalized"] and spec.get("normalizer")) for t in added):
            raise ValueError("added tokens that match more than their own characters are not supported")
        self.whole = Tokenizer.from_str(json.dumps(spec))
        bare = spec | {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "decoder": None, "added_tokens": []}
        #: Encodes a word, or the last part of one; and a part that the word goes on after.
        self.closing = Tokenizer.from_str(json.dumps(bare))
        self.opening = Tokenizer.from_str(json.dumps(bare | {"model": model | {"end_of_word_suffix": None}})) if model.get("end_of_word_suffix") else self.closing
        self.added = {t["content"]: t["id"] for t in added if t["content"]}
        self.cut_added = regex.compile("|".join(regex.escape(x) for x in sorted(self.added, key=len, reverse=True))) if self.added else None
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        #: Without a decoder, tokens are joined by spaces.
        self.joins_tokens = spec.get("decoder") is None
        #: Single spaces divide texts into chunks that are encoded, and decoded, on their own.
        self.spaced = (
            self.joins_tokens
            and (spec.get("normalizer") or {}).get("normalizers") == _NORMALISERS
            and pre[0] == {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}
            and len(pre) == 2
            and (pre[1]["type"], pre[1]["add_prefix_space"], pre[1]["use_regex"]) == ("ByteLevel", False, False)
            and not any(" " in x for x in self.added)
        )
        self.tokens = [self.whole.id_to_token(i) or "" for i in range(max([*model["vocab"].values(), *self.added.values()], default=-1) + 1)]
        self.byte_characters = _byte_characters()
        self.irregular = "|".join([_UNSTABLE, *("".join(f"\\x{{{ord(c):x}}}" for c in x) for x in self.added)])
        name = zlib.crc32(vocabulary.encode())
        #: Chunks of lower-cased text -> (ids, decoded); words in the vocabulary's characters -> ids.
        self.known: dict[str, tuple[bytes, str]] = process_cache(f"bpe chunks {name}")
        self.known_words: dict[str, bytes] = process_cache(f"bpe words {name}")

    # -- words ------------------------------------------------------------------------------------------------------

    def _split(self, text: str) -> Iterator[str]:
        """The words of a text without added tokens, in the vocabulary's own characters."""
        if self.whole.normalizer is not None:
            text = self.whole.normalizer.normalize_str(text)
        if self.whole.pre_tokenizer is None:
            yield from [text] if text else []
        else:
            yield from (word for word, _ in self.whole.pre_tokenizer.pre_tokenize_str(text) if word)

    def items(self, text: str) -> Iterator[str | int]:
        """A text's words, and the ids of the added tokens between them."""
        at = 0
        for found in self.cut_added.finditer(text) if self.cut_added else ():
            yield from self._split(text[at : found.start()])
            yield self.added[found[0]]
            at = found.end()
        yield from self._split(text[at:])

    # -- the tree ---------------------------------------------------------------------------------------------------

    def _encode(self, texts: list[str], last: list[bool]) -> list[tuple[list[int], list[int]]]:
        """(ids, ends) of each text; ``last``: the word ends there."""
        out: list = [None] * len(texts)
        for tokenizer, kind in ((self.opening, False), (self.closing, True)):
            at = [i for i, x in enumerate(last) if x is kind]
            for i, found in zip(at, tokenizer.encode_batch([texts[i] for i in at], add_special_tokens=False), strict=True):
                out[i] = found.ids, [end for _, end in found.offsets]
        return out

    def join(self, sides: list[tuple[str, Part, Part]]) -> list[Part]:
        """(word, left, right) -> the encoding of both together; the word's characters stand at the parts' places."""
        out: list = [None] * len(sides)
        left_over, tokens = list(range(len(sides))), WINDOW
        ends = [right.ends[-1] if right.ends else right.start for _, _, right in sides]
        while left_over:
            spans = []
            for i in left_over:
                word, left, right = sides[i]
                begin = left.ends[-tokens - 1] if tokens < len(left.ids) else left.start
                end = right.ends[tokens - 1] if tokens < len(right.ids) else ends[i]
                spans.append((begin, end))
            found = self._encode([sides[i][0][a:b] for i, (a, b) in zip(left_over, spans, strict=True)], [b == len(sides[i][0]) for i, (_, b) in zip(left_over, spans, strict=True)])
            again = []
            for i, (begin, _), (ids, upto) in zip(left_over, spans, found, strict=True):
                _, left, right = sides[i]
                whole_left, whole_right = tokens >= len(left.ids), tokens >= len(right.ids)
                if (whole_left or ids[:1] == left.ids[-tokens : len(left.ids) - tokens + 1]) and (whole_right or ids[-1:] == right.ids[tokens - 1 : tokens]):
                    before, after = (0 if whole_left else len(left.ids) - tokens), tokens
                    out[i] = Part(
                        left.ids[:before] + ids + right.ids[after:], left.ends[:before] + [begin + x for x in upto] + right.ends[after:], left.start
                    )
                else:
                    again.append(i)
            left_over, tokens = again, 2 * tokens
        return out

    def concatenated(self, words: list[str], parts: list[list[Part]]) -> list[Part]:
        """One part for each word, from its parts in order: neighbours are joined two and two until one is left."""
        while any(len(p) > 1 for p in parts):
            sides = [(word, p[i], p[i + 1]) for word, p in zip(words, parts, strict=True) for i in range(0, len(p) - 1, 2)]
            joined = iter(self.join(sides))
            parts = [[*(next(joined) for _ in range(len(p) // 2)), *p[len(p) // 2 * 2 :]] for p in parts]
        return [p[0] for p in parts]

    def trees(self, stretches: list[tuple[str, bool]]) -> list[Part]:
        """The encoding of each stretch of a word: (its characters, whether the word ends with it)."""
        leaves = [(text[i : i + LEAF], i, last and i + LEAF >= len(text)) for text, last in stretches for i in range(0, len(text), LEAF)]
        found = iter(zip(leaves, self._encode([x for x, _, _ in leaves], [x for _, _, x in leaves]), strict=True))
        parts = []
        for text, _ in stretches:
            own = [next(found) for _ in range(0, len(text), LEAF)]
            parts.append([Part(ids, [at + x for x in ends], at) for (_, at, _), (ids, ends) in own])
        # a stretch that the word goes on after is followed by a character that no window reaches
        return self.concatenated([text + ("" if last else "\0") for text, last in stretches], parts)

    def _learn(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words, as little-endian 32-bit integers."""
        out, long = [b""] * len(words), [i for i, w in enumerate(words) if len(w) > LEAF]
        short = [i for i, w in enumerate(words) if len(w) <= LEAF]
        for i, x in zip(short, self.closing.encode_batch_fast([words[i] for i in short], add_special_tokens=False), strict=True):
            out[i] = packed(x.ids)
        for i, part in zip(long, self.trees([(words[i], True) for i in long]), strict=True):
            out[i] = packed(part.ids)
        return out

    def words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Each word's ids; words are in the vocabulary's own characters."""
        known, words = self.known_words, list(dict.fromkeys(words))
        missing = [w for w in words if w not in known]
        learned = dict(zip(missing, self._learn(missing), strict=True))
        if len(known) < KNOWN:
            known.update((w, x) for w, x in learned.items() if len(w) <= KNOWN_LENGTH)
        return {w: learned[w] if w in learned else known[w] for w in words}

    # -- texts ------------------------------------------------------------------------------------------------------

    def decode(self, ids: bytes) -> str:
        numbers = unpacked(ids)
        return " ".join(map(self.tokens.__getitem__, numbers)) if self.joins_tokens else self.whole.decode(list(numbers), skip_special_tokens=False)

    def _general(self, text: str) -> tuple[bytes, str]:
        items = list(self.items(text))
        words = self.words(x for x in items if isinstance(x, str))
        ids = b"".join([words[x] if isinstance(x, str) else packed([x]) for x in items])
        return ids, self.decode(ids)

    def _learn_chunks(self, chunks: list[str]) -> Iterator[tuple[bytes, str]]:
        words = [[c] if c.isalpha() else _STABLE_WORDS.findall(c) for c in chunks]
        distinct = list({w for own in words for w in own})
        ids = dict(zip(distinct, self._learn([w.encode().decode("latin-1").translate(self.byte_characters) for w in distinct]), strict=True))
        for own in words:
            joined = ids[own[0]] if len(own) == 1 else b"".join([ids[w] for w in own])
            yield joined, self.decode(joined)

    def _regular(self, texts: pa.Array) -> Iterator[tuple[bytes, str]]:
        """Texts of stable characters, as chunks that no word crosses: each distinct one is looked up once."""
        marked = pc.replace_substring_regex(pc.utf8_lower(texts), _LETTER_MARK, "\\1\0\\2")
        lists = pc.split_pattern(pc.replace_substring(pc.replace_substring(marked, " ", "\0"), "\n", "\0"), "\0")
        coded, known = lists.flatten().dictionary_encode(), self.known
        codes, chunks = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        missing = [c for c in chunks if c not in known]
        learned = dict(zip(missing, self._learn_chunks(missing), strict=True))
        found = [learned[c] if c in learned else known[c] for c in chunks]
        if len(known) < KNOWN:
            known.update((c, x) for c, x in learned.items() if len(c) <= KNOWN_LENGTH)
        flat, each = np.frombuffer(b"".join([x for x, _ in found]), "<u4"), np.array([len(x) for x, _ in found], np.int64) // 4
        filled = each[codes] > 0  # not nothing, nor white space
        upto = np.concatenate([[0], np.cumsum(filled)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        codes = codes[filled]
        begins, n = (np.cumsum(each) - each)[codes], each[codes]
        ends = np.cumsum(n)
        raw = flat[np.repeat(begins - (ends - n), n) + np.arange(n.sum())].tobytes()
        strings = pa.array([x for _, x in found], pa.string()).take(pa.array(codes))
        decoded = pc.binary_join(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), strings), " ").to_pylist()
        cuts = (4 * np.concatenate([[0], ends])[upto]).tolist()
        return zip([raw[i:j] for i, j in zip(cuts, cuts[1:])], decoded, strict=True)  # noqa: B905  one more cut than texts

    def __call__(self, texts: pa.Array) -> list[tuple[bytes, str]]:
        """(ids as little-endian 32-bit integers, decoded text) of each text; null counts as the empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self.irregular).to_numpy(zero_copy_only=False) if self.spaced else np.ones(len(texts), bool)
        regular = self._regular(texts.filter(pa.array(~odd))) if not odd.all() else iter(())
        return [self._general(texts[i].as_py()) if x else next(regular) for i, x in enumerate(odd.tolist())]

    def segments(self, text: str) -> Iterator[tuple[str, list[str]]]:
        """(kind, strings): text to encode as it is; words; an added token's id; parts of one long word, the last of them its end."""
        at = 0
        while at < len(text):
            upto = len(text) if len(text) - at <= SEGMENT else text.rfind(" ", at, at + SEGMENT)
            if self.spaced and upto > at:
                yield "text", [text[at:upto]]
            else:  # one chunk that is longer than a segment, or a vocabulary whose chunks aren't known
                upto = text.find(" ", at + 1) if self.spaced else -1
                upto = len(text) if upto < 0 else upto
                held, size = [], 0
                for item in self.items(text[at:upto]):
                    long = isinstance(item, str) and len(item) > SEGMENT
                    if held and (not isinstance(item, str) or long or size > SEGMENT):
                        yield "words", held
                        held, size = [], 0
                    if not isinstance(item, str):
                        yield "added", [str(item)]
                    elif long:
                        for i in range(0, len(item), SEGMENT):
                            yield ("part" if i + SEGMENT < len(item) else "end"), [item[i : i + SEGMENT]]
                    else:
                        held.append(item)
                        size += len(item)
                if held:
                    yield "words", held
            at = upto + self.spaced

    def segment(self, kind: str, strings: list[str]) -> tuple[bytes, bytes]:
        """(ids, ends): ends only for parts of a word, in the part itself."""
        if kind == "text":
            return self(pa.array(strings))[0][0], b""
        if kind == "words":
            found = self.words(strings)
            return b"".join(found[w] for w in strings), b""
        if kind == "added":
            return packed([int(strings[0])]), b""
        part = self.trees([(strings[0], kind == "end")])[0]
        return packed(part.ids), np.array(part.ends, "<i8").tobytes()

    def together(self, segments: Iterable[tuple[str, str, bytes, bytes]]) -> bytes:
        """The ids of a document from its encoded segments in order: (kind, text of a part, ids, ends)."""
        out, word, parts, size = [], [], [], 0
        for kind, text, ids, ends in segments:
            if kind not in ("part", "end"):
                out.append(ids)
                continue
            parts.append(Part(list(unpacked(ids)), (np.frombuffer(ends, "<i8") + size).tolist(), size))
            word.append(text)
            size += len(text)
            if kind == "end":
                out.append(packed(self.concatenated(["".join(word)], [parts])[0].ids))
                word, parts, size = [], [], 0
        return b"".join(out)


def encoded(rows: DataFrame, vocabulary_path: str, scratch: Scratch) -> DataFrame:
    """rows (row struct, text string) -> row, ids (little-endian unsigned 32-bit integers) and decoded.

    A row for each row, repeats included. Null counts as the empty text, which has no ids and decodes to the empty text.
    Texts of over LONG characters are encoded by segments, each on its own; a document's segments meet in one task, which
    holds its ids. An empty table gives an empty one. Names below ``row`` can't clash. The vocabulary file is read on the
    driver and broadcast (some 2 MB).
    """
    spark = rows.sparkSession
    small_batches(spark)
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary.value)
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE):
                found = bpe(texts)
                columns = [batch.column(0).slice(first, len(texts)), pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "decoded"])

    long = F.coalesce(F.length("text") > LONG, F.lit(False))
    short_rows = rows.where(~long).select("row", "text").mapInArrow(run, f"row {kind}, ids binary, decoded string")
    # written, so that a row has the same number whichever task reads it
    long_rows = scratch.keep(rows.where(long).select(F.monotonically_increasing_id().alias("key"), "row", "text"), "long")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary.value)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for i, (sort, strings) in enumerate(bpe.segments(text.as_py())):
                    columns = [pa.array([key], pa.int64()), pa.array([i], pa.int32()), pa.array([sort]), pa.array([strings], pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "i", "kind", "strings"])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary.value)
        for batch in batches:
            for i, (sort, strings) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3), strict=True)):
                strings = strings.as_py()
                ids, ends = bpe.segment(sort, strings)
                text = strings[0] if sort in ("part", "end") else ""
                own = [pa.array([x], t) for x, t in ((text, pa.string()), (ids, pa.binary()), (ends, pa.binary()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in range(3)), *own], ["key", "i", "kind", "text", "ids", "ends"])

    def together(group: pd.DataFrame) -> pd.DataFrame:
        bpe, group = Bpe(vocabulary.value), group.sort_values("i")
        ids = bpe.together(zip(group["kind"], group["text"], map(bytes, group["ids"]), map(bytes, group["ends"]), strict=True))
        return pd.DataFrame({"key": group["key"].iloc[:1], "ids": [ids], "decoded": [bpe.decode(ids)]})

    segments = long_rows.select("key", "text").mapInArrow(cut, "key long, i int, kind string, strings array<string>")
    parts = segments.repartition("key", "i").mapInArrow(encode, "key long, i int, kind string, text string, ids binary, ends binary")
    whole = parts.groupBy("key").applyInPandas(together, "key long, ids binary, decoded string")
    return short_rows.unionByName(long_rows.select("key", "row").join(whole, "key").select("row", "ids", "decoded"))


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op12_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id").alias("row"), "text")
    return encoded(docs, vocabulary_file(), Scratch(spark, "bpe")).select(
        "row.doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
