from __future__ import annotations

import hashlib
import json
import random
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollweave.llm import bpetree
from rollweave.llm.common import Scratch

PATH = public_tokenizers.path("word_bpe_49k.json")


@lru_cache(2)
def held(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@lru_cache(2)
def plain(path: str) -> str:
    return json.dumps(held(path))


def vocabulary(path=PATH, **changes) -> str:
    return json.dumps(held(path) | changes) if changes else plain(path)


@pytest.fixture(scope="module")
def bpe():
    return bpetree.Bpe(vocabulary())


made_of = lru_cache(8)(Tokenizer.from_str)


def library(text: str, vocabulary_: str | None = None) -> tuple[bytes, str]:
    made = made_of(vocabulary_ or vocabulary())
    ids = made.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), made.decode(ids, skip_special_tokens=False)


ODD = [
    None, "", " ", "   ", "a  b", "\n a\t", "it's 's  'REally", "<|endoftext|>", "x<|endoftext|><|startoftext|> y", "<|ENDOFTEXT|>", "\x00 x", "é́  b", "日本 語 😀", "foo''s it'' x'y", "a²,b foo_ b",
    "İstanbul ıİ", "ǅ ΣΑΣ ς", "a\x1cb", "a b", "1234 ½⅓", "</w> a</w>b", "Å Å 가", "x" * 50_000, "abc!?" * 9000, "word " * 30_000, "é" * 70_000, "日本語" * 30_000,
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(bpe, text):
    assert bpe(pa.array([text], pa.string()))[0] == library(text)


def test_characters_that_take_the_short_way(bpe):
    made = Tokenizer.from_str(vocabulary())
    texts = [form % chr(c) for c in [*range(0x250), *range(0x2010, 0x2060), 0x2126, 0x3000] for form in ("a%sb", "'%ss", "%s", "1%s2", " %s ", "!%s!", "%sx's")]
    want = [np.array(x.ids, "<u4").tobytes() for x in made.encode_batch(texts, add_special_tokens=False)]
    assert [x for x, _ in bpe(pa.array(texts))] == want


def test_all_documents(spark, sf, bpe):
    texts = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    made = Tokenizer.from_str(vocabulary())
    for text, (ids, decoded) in zip(texts, bpe(pa.array(texts)), strict=True):
        want = made.encode(text or "", add_special_tokens=False).ids
        assert (list(bpetree.unpacked(ids)), decoded) == (want, made.decode(want, skip_special_tokens=False))


def test_trees_equal_the_whole_word(bpe):
    r = random.Random(5)
    words = ["".join(r.choices(letters, k=r.choice([13, 14, 40, 300, 2000]))) for letters in ("ab", "theandingrsou", "!?.-", "aaaaaaaaab", "åâĄģ") for _ in range(60)]
    got = bpe.trees([(w, last) for w in words for last in (False, True)])
    for part, (word, tokenizer) in zip(got, [(w, t) for w in words for t in (bpe.opening, bpe.closing)], strict=True):
        want = tokenizer.encode(word, add_special_tokens=False)
        assert (part.ids, part.ends) == (want.ids, [end for _, end in want.offsets])


def test_windows_decide(bpe, monkeypatch):
    word = "internationalisation" * 20
    want = bpe.closing.encode(word, add_special_tokens=False).ids
    assert bpe.trees([(word, True)])[0].ids == want
    monkeypatch.setattr(bpe, "join", lambda sides: [bpetree.Part(a.ids + b.ids, a.ends + b.ends, a.start) for _, a, b in sides])
    assert bpe.trees([(word, True)])[0].ids != want


@pytest.mark.parametrize(
    "changes",
    [{"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}, "normalizer": None}, {"decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}],
)
def test_other_vocabularies(changes):
    spec = vocabulary(**changes)
    own = bpetree.Bpe(spec)
    assert not own.spaced
    for text in ("a text that nothing splits, " * 50, "x<|endoftext|>  y", "", "été"):
        assert own(pa.array([text]))[0] == library(text, spec)
    for path in ("byte_bpe_50k.json",):
        spec = vocabulary(public_tokenizers.path(path))
        for text in ("it's  a text\n of words " * 20, "x" * 999, "<|endoftext|> a"):
            assert bpetree.Bpe(spec)(pa.array([text]))[0] == library(text, spec)


def test_models_that_need_more_than_neighbours():
    spec = json.loads(vocabulary())
    with pytest.raises(ValueError, match="neighbours"):
        bpetree.Bpe(json.dumps(spec | {"model": spec["model"] | {"dropout": 0.1}}))
    with pytest.raises(ValueError, match="added"):
        bpetree.Bpe(json.dumps(spec | {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]}))


def test_long_texts_by_segments(spark, monkeypatch, tmp_path):
    r = random.Random(6)
    texts = [None, "", "short one", "short one", "word's  " * 900, "x" * 3000 + " end", "日本語x" * 700, "<|endoftext|>" + "abc" * 800 + "<|endoftext|>!" + "q" * 500, " " * 4000]
    texts += ["".join(r.choices("abc de-'é", weights=[9, 9, 9, 1, 9, 9, 1, 1, 1], k=2500)) for _ in range(6)]
    rows = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "ids long, text string").select(F.struct("ids").alias("row"), "text")
    monkeypatch.setattr(bpetree, "LONG", 600)
    monkeypatch.setattr(bpetree, "SEGMENT", 200)
    got = {r["row"]["ids"]: (bytes(r["ids"]), r["decoded"]) for r in bpetree.encoded(rows, PATH, Scratch(spark, "t")).collect()}
    assert got == {(i if i else None): library(t) for i, t in enumerate(texts)}
    assert bpetree.encoded(rows.limit(0), PATH, Scratch(spark, "t")).count() == 0


def test_query(spark, sf):
    made = Tokenizer.from_str(vocabulary())
    rows = bpetree.op12_bpe_tree(spark, sf).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for row in rows:
        ids = made.encode(docs[row["doc_id"]], add_special_tokens=False).ids
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), made.decode(ids, skip_special_tokens=False).encode())]
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (len(ids), *digests)
