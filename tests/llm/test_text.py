from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollweave.llm import htmltext, langid, pieces, quality, tokenfiles
from rollweave.llm.common import Scratch

ODD = [
    None, "", " ", "a  b", "a   b", " a", "a ", "\n a", " \n", "it's 's  \t x", "<|endoftext|> hi <unk> <s>", "\x00 x", "é́  b", "日本 語 😀", "foo's it'' x' y", "a²,b foo_ b",
    "don't, 're.", "x\n", " ", "a\xa0 b", "a \x1cb", "▁x ▁ y", "word " * 3000, "x" * 50_000, "%%% ***\n| a | b",
]


# -- pages ------------------------------------------------------------------------------------------------------------------

PARAGRAPH = "A paragraph with some text, long enough to be content; it goes on for a while, as they do."


@pytest.mark.parametrize(
    ("source", "want"),
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"), ("<nav>only</nav>", ""), ("<!-- x --><script>var a='</p>'</script>", ""),
        (f"<article><h1>T &lt;1&gt;</h1><p><b>{PARAGRAPH}<br><p>x&nbsp; y</article><footer>f</footer>", f"T <1>\n{PARAGRAPH}\nx y"),
        (f"<body><header><h1>Site</h1></header><h1>Head</h1><div id=content><p>{PARAGRAPH}</p><ul><li>one<li>two</ul></div><aside>side</aside></body>", f"Head\n{PARAGRAPH}\none\ntwo"),
        (f"<main><p>{PARAGRAPH}</p><div class='cookie-notice'>{PARAGRAPH}</div><form>{PARAGRAPH}</form><section id=comments><p>{PARAGRAPH}</p></section><p>end</p></main>", f"{PARAGRAPH}\nend"),
        (f"<div><p>{PARAGRAPH} <span class=ad>Buy</span>now</p></div>", f"{PARAGRAPH} now"),
        (f"<table><tr><td>{PARAGRAPH}<td>b</table>", f"{PARAGRAPH}\nb"), ("<p>a < b & c", "a < b & c"), ("<p>a\n\t b</p><style>p{}</style><p hidden>no</p>", "a b"),
        (f"<body><ul><li><a href=x>Home</a><li><a href=y>News</a></ul><div><p>{PARAGRAPH}<ul><li><a href=z>z</a> said<li>two</ul></div>", f"{PARAGRAPH}\nz said\ntwo"),
        (f"<article><p>{PARAGRAPH}<ul><li><a>in</a><li><a>text</a></ul></article><div class='readerComments2'><p>{PARAGRAPH}</div>", f"{PARAGRAPH}\nin\ntext"),
        (f"<article><header><h1>T</h1><p>by line</p></header><p>{PARAGRAPH}</p></article>", f"T\n{PARAGRAPH}"),
    ],
)
def test_main_text(source, want):
    assert htmltext.main_text(source) == want


def test_hostile_pages_take_linear_time():
    for source in ("<" * 20_000, "<p " * 20_000, "<a href='" * 5_000, "&" * 50_000, "<b>" * 5_000 + "x", "<!--" * 10_000, "<div>" * 900 + "x" + "</p>" * 900):
        htmltext.main_text(source)


def test_every_page_of_the_sample(spark, sf):
    import html

    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inside = re.search(r"(?s)<article>(.*?)</article>", r["html"])[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert htmltext.main_text(r["html"]) == "\n".join(b for b in blocks if b)


# -- token files ----------------------------------------------------------------------------------------------------------------

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def encoder(path=VOCABULARY):
    with open(path, encoding="utf-8") as file:
        return tokenfiles.Encoder(file.read())


def test_chunks_give_the_library_s_ids(spark, sf):
    texts = ODD + [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    encode = encoder()
    assert encode.chunked
    for _ in range(2):  # the second time from memory
        ids, n = encode(pa.array(texts, pa.string()))
        want = encode.whole([t or "" for t in texts])
        assert n.tolist() == [len(x) for x in want] and (ids == np.concatenate(want)).all()


def test_ids_are_those_of_the_library_as_given():
    from tokenizers import Tokenizer

    texts = [t or "" for t in ODD] + ["see <|endoftext|> here", "a<|endoftext|>b", "<|endoftext|>", "<|endoftext|", "see <|endoftext |> here", "plain words, here."]
    want = [x.ids for x in Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    assert 50256 in want[-6]
    encode = encoder()
    for _ in range(2):
        ids, n = encode(pa.array(texts, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want


def test_added_tokens_with_spaces_are_never_made_of_chunks(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(VOCABULARY, encoding="utf-8") as file:
        spec = json.load(file)
    spec["added_tokens"].append(spec["added_tokens"][0] | {"id": 50257, "content": "two words", "special": False})
    path = tmp_path / "v.json"
    path.write_text(json.dumps(spec))
    texts = ["one two", "of words here", "has two words in"]
    ids, n = encoder(path)(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [x.ids for x in Tokenizer.from_file(str(path)).encode_batch(texts, add_special_tokens=False)]


def test_other_vocabularies_are_encoded_whole():
    encode = encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not encode.chunked
    ids, n = encode(pa.array(["A  b", None, "c"]))
    assert n.tolist() == [2, 0, 1] and len(ids) == 3


@pytest.mark.parametrize("sequence", [4, 2048])
def test_files_round_trip(spark, sequence):
    rows = [(i * 3 % 17, t) for i, t in enumerate(ODD)] + [(None, "nobody"), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    manifest, root = tokenfiles.write(docs, VOCABULARY, Scratch(spark, "t"), sequence=sequence)
    got = sorted(map(tuple, tokenfiles.read(manifest, root).collect()), key=lambda r: r[1])
    encode, at, want = encoder(), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] is not None, (r[1] or "").encode()))):
        ids = np.append(encode.whole([t or ""])[0], 2)
        want.append((i, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
        at += len(ids)
    assert got == want
    for m in manifest.collect():
        reader = tokenfiles.ShardReader(root, m["ids_path"], m["docs_path"])
        masks = np.concatenate([reader.row(i)[1] for i in range(m["sequences"])])
        assert masks.sum() == m["tokens"] and masks[: m["tokens"]].all() and len(masks) == m["sequences"] * sequence
        flat = np.concatenate([reader.row(i)[0] for i in range(m["sequences"])])
        assert (reader.tokens(0, m["tokens"]) == flat[: m["tokens"]]).all()


def test_no_documents_no_files(spark):
    manifest, root = tokenfiles.write(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY, Scratch(spark, "t"))
    assert tokenfiles.read(manifest, root).collect() == []


# -- pieces ---------------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    with open(pieces.model_file(), "rb") as file:
        return file.read()


def test_pieces_are_the_library_s(spark, sf, model):
    codec = pieces.Codec(model)
    texts = [t or "" for t in ODD] + [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    found = codec.encode(texts)
    assert [x.tolist() for x, _ in found] == codec.whole.encode(texts)
    assert codec.decode([x for x, _ in found]) == codec.whole.decode(codec.whole.encode(texts))
    for text, (ids, bounds) in zip(texts, found, strict=True):
        raw = text.encode()
        assert len(bounds) == len(ids) + 1 and bounds[0] == 0 and bounds[-1] == len(raw) and (np.diff(bounds) >= 0).all()
        for i, a, b in zip(ids.tolist(), bounds, bounds[1:]):  # noqa: B905
            piece = codec.whole.id_to_piece(i)
            if not codec.whole.is_byte(i):
                assert raw[a:b].decode().replace(" ", "▁") in (piece, piece.removeprefix("▁"))
            elif b > a:
                assert raw[a:b] == bytes([int(piece[3:5], 16)])


def double_array(entries: dict[bytes, bytes]) -> bytes:
    """A small compiled character map: every node gets a block of 256 of its own, which keeps the rule of the format."""
    trie: dict[bytes, set[int]] = {}
    for key in entries:
        for i in range(len(key)):
            trie.setdefault(key[:i], set()).add(key[i])
    blob, place = b"", {}
    for key, value in entries.items():
        place[key] = len(blob)
        blob += value + b"\0"
    base = {p: 256 * (k + 1) for k, p in enumerate([*trie, *(k for k in entries if k not in trie)])}
    units = [0] * (256 * (len(base) + 2))
    where = {b"": 0}

    def unit(at, prefix, label):
        offset = at ^ base[prefix]
        units[at] = (offset << 10) | (256 if prefix in entries else 0) | label if offset < 1 << 21 else 0
        if prefix in entries:
            units[base[prefix]] = place[prefix] | 1 << 31

    unit(0, b"", 0)
    for prefix in sorted(base, key=len):
        if prefix:
            at = base[prefix[:-1]] ^ prefix[-1]
            where[prefix] = at
            unit(at, prefix, prefix[-1])
    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + blob


@pytest.mark.parametrize(("prefix", "squeeze"), [(1, 1), (1, 0), (0, 1)])
def test_character_maps(model, prefix, squeeze):
    """The same model with a character map: the library's normaliser and this one must agree, on ids and on places."""
    entries = {"ﬁ".encode(): b"fi", "A".encode(): b"a", b"AB": b"xyz", "\u3000".encode(): b" ", b"q": b""}
    charsmap = double_array(entries)
    spec = b"\x12" + bytes(varint(len(charsmap))) + charsmap + bytes([0x18, prefix, 0x20, squeeze, 0x28, 1])
    codec = pieces.Codec(model + b"\x1a" + bytes(varint(len(spec))) + spec)
    texts = ["ﬁne A AB ABA", "  two   spaces ", "q", "", " ", "aq b", "x\u3000y", "AB ﬁ é"]
    for text, (ids, bounds) in zip(texts, codec.encode(texts), strict=True):
        proto = codec.whole.encode(text, return_type="proto").pieces
        assert ids.tolist() == codec.whole.encode(text)
        assert bounds[-1] <= len(text.encode()) and (np.diff(bounds) >= 0).all() and len(proto) == len(ids)
    assert codec.normalise.chars.longest(b"xABy", 1) == (2, b"xyz") and codec.normalise.chars.longest(b"xABy", 0) is None


def varint(n: int):
    while n > 127:
        yield n & 127 | 128
        n >>= 7
    yield n


def test_tokenised_rows(spark):
    import hashlib

    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(ODD)] + [(None, "x", 7)], "doc_id long, text string, row int")
    got = {r["doc_id"]: r for r in pieces.tokenised(docs).collect()}
    with open(pieces.model_file(), "rb") as file:
        codec = pieces.Codec(file.read())
    whole = codec.whole
    for i, t in enumerate(ODD):
        (_, bounds), = codec.encode([t or ""])
        assert bounds[0] == 0 and bounds[-1] == len((t or "").encode()) and got[i]["bounds_sha256"] == hashlib.sha256(",".join(map(str, bounds.tolist())).encode()).hexdigest()
        ids = whole.encode(t or "")
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(whole.decode(ids).encode()).hexdigest()
    assert pieces.tokenised(docs.limit(0)).collect() == []


# -- languages --------------------------------------------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark, sf):
    found = langid.op9_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)


def test_language_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et la souris", "fr"), (3, None, "fr"), (4, "123 ... !!", "en"), (5, "", None), (6, "the the " * 80_000, None), (7, "Ünïcode \U00010400", "xx"), (8, "the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, F.lit(True))
    assert model.langs == ["en", "fr", "xx"]
    got = {r["i"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs.select(F.struct(F.col("doc_id").alias("i")).alias("row"), "text"), model).select("row.i", "lang_pred", "score").collect()}
    assert [got[i][0] for i in (1, 2, 6)] == ["en", "fr", "en"] and all(got[i] == ("und", 0.0) for i in (3, 4, 5)) and all(0 <= s <= 1 for _, s in got.values())
    assert {r["doc_id"] for r in langid.identified(docs).collect()} == {1, 2, 6, 7, 8}
    assert langid.identified(docs.limit(0)).collect() == []
    none = langid.fit(docs, F.lit(False))
    assert none.langs == [] and {(r["lang_pred"], r["score"]) for r in langid.predict(docs.select(F.struct("text").alias("row")), none).collect()} == {("und", 0.0)}


def test_texts_with_letters_stay_where_nothing_was_learned(spark):
    rows = [(1, "the cat", None), (2, "123 ... !!", None), (3, "", None), (4, None, None), (5, "é", None), (6, "\U00010400", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identified(docs)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == {1, 5, 6}
    assert {r["doc_id"] for r in langid.identified(docs.withColumn("lang", F.when(F.col("doc_id") == 2, "en"))).collect()} == {1, 5, 6}


def test_segments_count_every_ngram_once(monkeypatch):
    letters, text = langid.letter_table(), "abc défg " * 40

    def counts():
        out = np.zeros(1 << 12, np.int64)
        for cp, begins in langid.segments(text, letters):
            for grams in langid.ngrams(cp, begins, 12):
                out += np.bincount(grams, minlength=1 << 12)
        return out

    whole = counts()
    monkeypatch.setattr(langid, "SEGMENT", 17)
    assert (counts() == whole).all()


# -- quality ------------------------------------------------------------------------------------------------------------------------


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = quality.op5_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert sum(r["quality"] == r["predicted"] for r in held) / len(held) > 0.93 and all(0 <= r["score"] <= 1 for r in found)
    assert quality.op5_quality(spark, sf).count() == 1000


def test_quality_edges(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["good words here", None, "", "x" * 100_000])] + [(None, "y")], "doc_id long, text string")
    rows = docs.select(F.struct("doc_id").alias("row"), "text")
    for labels, want in (([], 0.5), ([(0, 1), (0, 1), (3, None), (9, 7)], 2 / 3), ([(0, 1), (1, 0), (77, 0)], None)):
        model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, label int"))
        scores = [r["score"] for r in quality.scored(rows, model).collect()]
        assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
        if want is not None:
            assert scores == pytest.approx([want] * 5)


def test_calibration_orders():
    x = np.array([-1.0, -0.5, 0.5, 1, 0.4])
    beta, _, _ = quality.calibrate(x, np.array([0, 0, 1, 1, 1.0]), np.ones(5))
    assert beta[1] > 0 and np.isfinite(beta).all()
