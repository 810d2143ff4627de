from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollweave.llm import alignment
from rollweave.llm.bpetree import _byte_characters
from rollweave.llm.common import Scratch

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a  b", " a", "a ", "a\n", "\n a", "it's 's  \t x", "<|endoftext|> hi <unk> <s> </s>", "x<|endoftext|>", "\x00 x", "é́  b", "日本 語 😀", "▁x ▁ y", "a▁b", "<0x41> b", "foo's it'' x' y",
    "a²,b foo_ b", "don't, 're.", "x\n\n y", "a\xa0 b", "tab\tb", "word " * 300, "x" * 5000, "🏳️‍🌈 zwj", "  u", "end.", "end.",
]


class Plain:
    """One token and one link after another."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.byte = {c: b for b, c in _byte_characters().items()}

    def piece(self, i: int) -> bytes:
        return bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()

    def __call__(self, text: str | None):
        a = self.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = self.b.encode(text or "")
        sides = [[bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a], [self.piece(i) for i in b]]
        if not text or any(b"".join(s) != (" " + text).encode() for s in sides):
            return 0, 0, 0, [], ""
        spans = [[], []]
        for side, out in zip(sides, spans, strict=True):
            at = 0
            for x in side:
                out.append((at, at + len(x)))
                at += len(x)
        links = []
        for i, (s, e) in enumerate(spans[0]):
            links += [(a[i], b[j]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        written = []
        for low, high in zip([0, *cuts], cuts):  # noqa: B905
            written.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, own, strict=True) if low <= s and e <= high) for ids, own in ((a, spans[0]), (b, spans[1]))))
        return len(a), len(b), len(cuts), links, ";".join(written)


def expected(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    plain, counts, found = Plain(), Counter(), []
    for i, text in rows:
        found.append((i, plain(text)))
        counts.update(set(found[-1][1][3]))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return [
        (i, n_a, n_b, n, len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if n_a else "")
        for i, (n_a, n_b, n, links, text) in found
    ]


COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def result(spark, rows, monkeypatch=None, **settings):
    for k, v in settings.items():
        monkeypatch.setattr(alignment, k, v)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_a string").select(F.struct("doc_id", "n_a").alias("row"), "text")
    scratch = Scratch(spark, "t")
    found = alignment.aligned(docs, A, B).withColumn("doc_id", F.col("row.doc_id")).withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(""))
    return sorted((tuple(r) for r in alignment.scored(scratch.keep(found), scratch).select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def aligner():
    with open(A, encoding="utf-8") as v, open(B, "rb") as m:
        return alignment.Aligner(v.read(), m.read())


def test_odd_texts(spark):
    rows = [(i if i else None, t) for i, t in enumerate(ODD)]
    assert result(spark, rows) == sorted(expected(rows), key=repr)


def test_blocks_of_counted_pairs(spark, monkeypatch):
    rows = [(1, "some text, some more"), (2, "more text"), (2, "more text"), (3, None), (4, "unbelievable text")]
    assert result(spark, rows, monkeypatch, BLOCK_PAIRS=4) == sorted(expected(rows), key=repr)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_chunks_equal_whole_texts(aligner):
    assert aligner.chunked
    r = random.Random(1)
    texts = ["".join(r.choices(["a", "the", "ing", " ", " ", ".", "\n", "é", "'s", "日", "🙂", ",", "_", "1"], k=60)) for _ in range(300)] + [t for t in ODD if t]
    for text, parts in zip(texts, aligner(pa.array(texts)), strict=True):
        (whole,) = aligner.align([" " + text])
        assert whole.same or not parts
        if whole.same:
            assert [sum(x.n_a for x in parts), sum(x.n_b for x in parts), sum(x.n_groups for x in parts)] == [whole.n_a, whole.n_b, whole.n_groups]
            assert ";".join(x.text for x in parts) == whole.text and b"".join(x.links for x in parts) == whole.links


def test_union_find():
    r = np.random.default_rng(1)
    for n, m in ((1, 0), (5, 3), (300, 150), (300, 400)):
        u, v = r.integers(0, n, m), r.integers(0, n, m)
        want = list(range(n))
        for _ in range(n):
            for x, y in zip(u.tolist(), v.tolist(), strict=True):
                want[x] = want[y] = min(want[x], want[y])
        assert alignment.union_find(n, u, v).tolist() == want
    n = 20_000  # one long chain
    assert (alignment.union_find(n, np.arange(n - 1), np.arange(1, n)) == 0).all()


def test_components_are_the_least_groups():
    r = np.random.default_rng(2)
    for _ in range(50):
        a, b = (np.unique(np.append(r.integers(1, 60, r.integers(1, 40)), 60)) for _ in range(2))
        found = alignment.groups(a, b)
        cuts = np.intersect1d(a, b)
        assert found.of_a.tolist() == np.searchsorted(cuts, a).tolist() and found.of_b.tolist() == np.searchsorted(cuts, b).tolist()
        starts = [np.concatenate([[0], x[:-1]]) for x in (a, b)]
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]]
        assert list(zip(found.link_a.tolist(), found.link_b.tolist(), strict=True)) == want


def test_the_components_decide(spark, monkeypatch):
    rows = [(1, "unbelievable antidisestablishmentarianism")]
    monkeypatch.setattr(alignment, "union_find", lambda n, u, v: np.arange(n))
    with pytest.raises(Exception):  # noqa: B017  tokens of side b are in no group
        assert result(spark, rows) == expected(rows)


def test_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in alignment.op11_alignment(spark, sf).select(*COLUMNS).collect()), key=repr) == sorted(expected(rows), key=repr)
