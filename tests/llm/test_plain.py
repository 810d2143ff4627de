"""Classifiers against plain versions of themselves: loops, dictionaries and no Spark."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from rollweave.llm import langid, quality

# -- quality ----------------------------------------------------------------------------------------------------------------


def md5(i) -> str:
    return hashlib.md5(str(i).encode()).hexdigest()


def compressor(content: bytes):
    held = zstandard.ZstdCompressionDict(content)
    return zstandard.ZstdCompressor(level=3, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)


def plain_quality(docs, labels, sample):
    """doc texts and (doc_id, label) -> a function from text to score."""
    kinds = defaultdict(set)
    for i, x in labels:
        if i is not None and x in (0, 1):
            kinds[i].add(x)
    label = {i: next(iter(x)) for i, x in kinds.items() if len(x) == 1}
    chosen = [i for k in (0, 1) for i in sorted((i for i, x in label.items() if x == k), key=lambda i: (md5(i), i))[:sample]]
    groups, held_back = {0: defaultdict(list), 1: defaultdict(list)}, []
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, (d[1] or "").encode())):
        if i in chosen:
            spot = int(md5(i)[-2:], 16)
            if spot % 2:
                held_back.append((label[i], text))
            else:
                raw = (text or "").encode()
                groups[label[i]][spot // 2 % 8] += [raw[k : k + 1024] for k in range(0, len(raw), 1024)]

    def trained(pieces):
        try:
            return zstandard.train_dictionary(65_536, pieces, level=3).as_bytes()
        except zstandard.ZstdError:
            return b"".join(pieces)

    found = []
    for k in (1, 0):
        parts = [trained(groups[k][g]) for g in range(8) if groups[k][g]]
        whole = parts[0] if len(parts) == 1 else trained([p[j : j + 1024] for p in parts for j in range(0, len(p), 1024)])
        found.append(compressor(whole))

    def difference(text):
        raw = (text or "").encode()
        sizes = [sum(len(c.compress(raw[k : k + 1024])) for k in range(0, len(raw), 1024)) for c in found]
        return (sizes[1] - sizes[0]) / len(raw) if raw else 0.0

    # logistic regression by plain gradient steps on the standardised difference
    d, y = [difference(t) for _, t in held_back], [k for k, _ in held_back]
    mean = sum(d) / len(d)
    scale = math.sqrt(sum((x - mean) ** 2 for x in d) / len(d))
    z, n = [(x - mean) / scale for x in d], Counter(label.values())
    weight = [n[k] / y.count(k) * len(y) / sum(n.values()) for k in y]
    a = b = 0.0
    for _ in range(20_000):
        p = [1 / (1 + math.exp(-(a + b * x))) for x in z]
        a += 4 * sum(w * (k - q) for w, k, q in zip(weight, y, p, strict=True)) / sum(weight)
        b += 4 * (sum(w * (k - q) * x for w, k, q, x in zip(weight, y, p, z, strict=True)) / sum(weight) - 1e-3 * b)
    return lambda text: 1 / (1 + math.exp(-(a + b * (difference(text) - mean) / scale)))


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n)) + "."


def test_quality_is_that_of_a_plain_loop(spark):
    rng = random.Random(5)
    good, bad = (["".join(rng.choice(c) for _ in range(rng.randint(2, 7))) for _ in range(60)] for c in ("abcdefgh", "cdefghij"))
    docs = [(i, prose(rng, (bad, good)[rng.random() < (0.65 if i % 3 else 0.4)], rng.choice([5, 40, 300]))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, "x" * 50_000), (403, prose(rng, good, 40_000)), (7, "a second text of an id"), (None, "no id"), docs[9], docs[9]]
    labels = [(i, int(i % 3 > 0)) for i in range(250)] + [(402, 0), (403, 1), (7, 1), (8, 1 - int(8 % 3 > 0)), (12, 0), (12, 0), (20, None), (21, 5), (None, 1), (999, 1)]
    d, k = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, label int")
    for sample in (30, 3000):
        model, plain = quality.fit(d, k, sample), plain_quality(docs, labels, sample)
        got = quality.scored(d.select(F.struct("doc_id", "text").alias("row"), "text"), model).select("row.*", "score").collect()
        assert len(got) == len(docs)
        for r in got:
            assert r["score"] == pytest.approx(plain(r["text"]), abs=1e-6)


def test_all_text_of_a_labelled_document_teaches(spark):
    """What marks good documents stands in their last bytes only, far behind any prefix or sample of pieces."""
    rng = random.Random(2)
    noise = ["".join(rng.choice("klmnop") for _ in range(6)) for _ in range(3000)]
    good = [prose(rng, ["sunrise", "harbour", "lantern", "meadow"], 12) + f" end {i}." for i in range(40)]
    rows = [(i, prose(rng, noise, 9000) + (good[i] if i < 40 else "")) for i in range(80)]
    pieces = [x for _, t in rows[:40] for x in quality.cut(t.encode())]
    assert b"".join(pieces) == b"".join(t.encode() for _, t in rows[:40])
    found = quality.dictionary(pieces)
    assert b"harbour" in found
    batches = spark.createDataFrame([(1, 0, t) for _, t in rows[:40]], "label int, part int, text string")
    parts = [bytes(r["content"]) for r in batches.repartition(1).mapInArrow(quality._learned, "label int, part int, n int, content binary").collect()]
    assert len(parts) == 1 and b"harbour" in parts[0]


def test_slices_hand_on_all_text(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(quality, "SLICE", 3000)
    monkeypatch.setattr(quality, "dictionary", b"".join)
    texts = ["a" * 2500 + "b" * 2500, None, "", "c" * 4000]
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0, 0, 1], pa.int32()), pa.array([2, 2, 2, 5], pa.int32()), pa.array(texts)], ["label", "part", "text"])
    out = [r for b in quality._learned([batch, batch.slice(3)]) for r in b.to_pylist()]
    whole = defaultdict(bytes)
    for r in out:
        whole[r["label"], r["part"]] += r["content"]
    assert whole == {(0, 2): texts[0].encode(), (1, 5): 2 * texts[3].encode()}
    assert max(len(r["content"]) for r in out) <= 3000 + quality.PIECE


def test_quality_of_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, label int"))
    assert quality.scored(docs.select(F.struct("doc_id").alias("row"), "text"), model).collect() == []
    other = spark.createDataFrame([("x", "d", 0.1)], "text string, d string, score double")
    got = quality.scored(other.select(F.struct("d", "score").alias("row"), "text"), model).collect()
    assert got[0]["row"]["d"] == "d" and got[0]["score"] == pytest.approx(3 / 5)


# -- languages --------------------------------------------------------------------------------------------------------------


def grams(text):
    """n-grams of letters and single places between them, of the lower-cased text between two spaces."""
    t = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    for n in (1, 2, 3):
        for i in range(len(t) - n + 1):
            if t[i] != " " or (n > 1 and t[i + 1] != " "):
                yield t[i : i + n]


def plain_languages(rows):
    """Multinomial naive Bayes with a dictionary: (text, lang) -> a function from text to (lang, probability)."""
    counts, docs = defaultdict(Counter), Counter()
    for text, lang in rows:
        docs[lang] += 1
        counts[lang].update(grams(text or ""))
    size, half = 1 << langid.BITS, 0.5
    total = {x: sum(counts[x].values()) for x in docs}

    def judge(text):
        found = Counter(grams(text or ""))
        if not found:
            return "und", 0.0
        like = {
            x: math.log(docs[x] / sum(docs.values())) + sum(n * math.log((counts[x][g] + half) / (total[x] + half * size)) for g, n in found.items()) for x in docs
        }
        top = max(like.values())
        best = min(x for x in like if like[x] == top)
        return best, 1 / sum(math.exp(v - top) for v in like.values())

    return judge


WORDS = {
    "en": "the and of to in that is was for it with as his on be at by".split(), "fr": "le la les de et un une dans que qui pour sur pas au".split(),
    "de": "der die das und ist nicht ein eine mit auf für über".split(), "el": "και το να η του την που με για".split(), "vi": "và của là có được trong không một cho".split(),
}


@pytest.mark.parametrize("block", [2, 128])
def test_languages_are_those_of_a_plain_naive_bayes(spark, monkeypatch, block):
    """Also where the matrix is cut into blocks of two languages: the passes give the same."""
    monkeypatch.setattr(langid, "BLOCK", block)
    monkeypatch.setattr(langid, "BITS", 20)  # no two n-grams of the test in one bucket
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(WORDS[x]) for _ in range(rng.randint(3, 30))), x) for i, x in enumerate(rng.choices(list(WORDS), k=120))]
    rows += [(200, None, "fr"), (201, "1 2 3", "en"), (202, "le the der", None), (203, "", None), (204, "Über-the 𐐀 x", None), rows[3], rows[3], (None, "und das", None), (205, "q", "zz")]
    shape = "doc_id long, text string, lang string, best double, row string"
    docs = spark.createDataFrame([(*r, 0.5, "r") for r in rows], shape)
    plain = plain_languages([(t, x) for _, t, x in rows if x is not None])
    model = langid.fit(docs, F.lit(True))
    assert model.langs == sorted({*WORDS, "zz"})
    got = langid.predict(docs.select(F.struct("doc_id", "text", "best").alias("row")), model).select("row.*", "lang_pred", "score").collect()
    apart = langid.predict(docs.select(F.struct("doc_id").alias("row"), "text"), model).collect()
    assert len(got) == len(rows) and sorted(r["score"] for r in apart) == sorted(r["score"] for r in got)
    for r in got:
        lang, p = plain(r["text"])
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(p, abs=1e-6)


def test_the_language_stage_rejects_what_no_language_explains(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(WORDS[x]) for _ in range(30)), x) for i, x in enumerate(rng.choices(["en", "fr"], k=200))]
    odd = [(900, "日本語の文書です。これは学習されていません。" * 5, None), (901, "Тут совсем другая азбука и другой язык. " * 5, None), (902, "12 !!", "en"), (903, None, "en")]
    fine = [(910, "the and of that was with his", None), (911, "dans les que pour sur une", "en")]
    docs = spark.createDataFrame([(*r, 1) for r in rows + odd + fine], "doc_id long, text string, lang string, lang_pred int")
    got = langid.identified(docs)
    assert got.columns == docs.columns
    kept = {r["doc_id"]: r["lang"] for r in got.collect()}
    assert kept == {i: x for i, _, x in rows} | {910: "en", 911: "fr"}
