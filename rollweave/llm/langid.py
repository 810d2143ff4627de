"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of all learnable documents where they lie (one sparse table of counts for each partition, summed
by Spark) and makes a log-probability row of 2**BITS floats for each language. Scoring runs over Arrow batches in numpy:
texts are cut into segments of SEGMENT characters that overlap by the n-gram length, so memory doesn't grow with a text's
length. The matrix is broadcast in blocks of BLOCK languages, 32 MiB; with more languages than that, each further block
is a further pass that carries the best language so far and the sum of all likelihoods, so results are the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.llm.common import Scratch, small_batches, table, whole_row

ORDERS = (1, 2, 3)
BITS = 16
SEGMENT = 1 << 18
ALPHA = 0.5
UNDETERMINED = "und"
#: Languages whose counts one training task holds at a time; more are handed on and begun anew.
LANGS_HELD = 64
#: Languages whose rows the driver and each Python worker hold at a time.
BLOCK = 128


def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(1 << 16)), bool, 1 << 16)


def code_points(text: str, letters: np.ndarray) -> np.ndarray:
    """Code points of the text with everything that isn't a letter as a space."""
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    low = cp < (1 << 16)
    keep = letters[np.where(low, cp, 0)]
    if not low.all():
        for c in np.unique(cp[~low]):
            keep[cp == c] = chr(c).isalpha()
    return np.where(keep, cp, np.uint32(32))


def ngrams(cp: np.ndarray, begins: int, bits: int) -> Iterator[np.ndarray]:
    """Hashed n-grams of each order that start among the first ``begins`` code points; runs of spaces give none."""
    with np.errstate(over="ignore"):
        x = cp.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for n in ORDERS:
            m = max(0, min(begins, len(cp) - n + 1))
            h = x[:m].copy()
            for j in range(1, n):
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + x[j : j + m]
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB + 2 * n)
            # an n-gram counts where it starts with a letter, or with a space before a letter
            real = cp[:m] != 32 if n == 1 else (cp[:m] != 32) | (cp[1 : m + 1] != 32)
            yield (h[real] >> np.uint64(64 - bits)).astype(np.int64)


def segments(text: str, letters: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(code points, how many of them begin n-grams); the text in lower case between two spaces."""
    text = f" {text.lower()} "
    for at in range(0, len(text), SEGMENT):
        yield code_points(text[at : at + SEGMENT + max(ORDERS) - 1], letters), SEGMENT


def counter(bits: int):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, held = letter_table(), {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in held and len(held) >= LANGS_HELD:
                    yield from out()
                into = held.setdefault(lang, np.zeros(1 << bits, np.int64))
                for cp, begins in segments(text.as_py() or "", letters):
                    for grams in ngrams(cp, begins, bits):
                        into += np.bincount(grams, minlength=1 << bits)
        yield from out()

    return count


@dataclass
class Block:
    langs: list[str]
    #: buckets x languages
    logp: np.ndarray
    prior: np.ndarray
    bits: int = BITS

    def totals(self, text: str, letters: np.ndarray) -> tuple[np.ndarray, int, bool]:
        """Log-likelihood with prior of each language, the number of n-grams, and whether the text has a letter."""
        total, size, any_letter = self.prior.astype(np.float64).copy(), 0, False
        for cp, begins in segments(text, letters):
            for n, grams in zip(ORDERS, ngrams(cp, begins, self.bits), strict=True):
                any_letter |= n == 1 and len(grams) > 0
                size += len(grams)
                if len(grams) > 1 << self.bits:  # sparse counts once they are fewer than the n-grams
                    counts = np.bincount(grams, minlength=1 << self.bits)
                    at = np.flatnonzero(counts)
                    total += counts[at].astype(np.float64) @ self.logp[at]
                else:
                    total += self.logp[grams].sum(axis=0, dtype=np.float64)
        return total, size, any_letter


@dataclass
class Model:
    """langs in code point order, the log of each one's share of the learned documents, and a table (lang, logp) of their rows."""

    langs: list[str]
    prior: np.ndarray
    rows: DataFrame
    bits: int = BITS

    def blocks(self) -> Iterator[Block]:
        flat = np.full(1 << self.bits, -self.bits * np.log(2.0), "<f4")  # a language that has a prior only
        for at in range(0, len(self.langs), BLOCK):
            langs = self.langs[at : at + BLOCK]
            found = {r["lang"]: np.frombuffer(r["logp"], "<f4") for r in self.rows.where(F.col("lang").isin(langs)).collect()}
            yield Block(langs, np.ascontiguousarray(np.stack([found.get(x, flat) for x in langs], axis=1)), self.prior[at : at + BLOCK], self.bits)


def _log_row(bits: int):
    def log_row(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(1 << bits)
        counts[group["bucket"].to_numpy()] = group["n"].to_numpy()
        logp = np.log((counts + ALPHA) / (counts.sum() + ALPHA * (1 << bits))).astype("<f4")
        return pd.DataFrame({"lang": [key[0]], "logp": [logp.tobytes()]})

    return log_row


def fit(docs: DataFrame, learnable: Column) -> Model:
    """A model of the rows that are learnable and have a lang. Null texts teach nothing but the language's prior.

    Rows that repeat a document teach as often as they occur. The driver receives each language's name and number of
    documents. Without learnable rows, as of an empty table, the model knows no language.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(learnable & F.col("lang").isNotNull()).select("lang", "text")
    seen = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect())
    counts = rows.mapInArrow(counter(BITS), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table_ = counts.groupBy("lang").applyInPandas(_log_row(BITS), "lang string, logp binary")
    if len(seen) > BLOCK:  # read once for each block
        table_ = Scratch(docs.sparkSession, "langid").keep(table_, "rows")
    n = np.array([n for _, n in seen], np.float64)
    return Model([lang for lang, _ in seen], np.log(n / n.sum()) if seen else np.zeros(0), table_, BITS)


_STATE = [("lang_pred", pa.string()), ("best", pa.float64()), ("rest", pa.float64()), ("margin", pa.float64())]


def _passed(rows: DataFrame, block: Block, carry: bool) -> DataFrame:
    """rows (row, text unless row has it, and what the last pass found unless it is the first) with what this block's languages change.

    best: the best language's likelihood; rest: the log of the sum of all; margin: by how much an n-gram is likelier in
    the best language than at random. ``carry``: text is handed on.
    """
    apart, later = "text" in rows.columns, "best" in rows.columns
    shared = rows.sparkSession.sparkContext.broadcast((block.langs, block.logp, block.prior, block.bits))
    kept = ["row", *(["text"] if apart and carry else [])]

    def judged(own: Block, text: str, before: dict | None, letters: np.ndarray) -> tuple[str, float, float, float]:
        total, size, any_letter = own.totals(text, letters)
        if not any_letter:
            return UNDETERMINED, 0.0, 0.0, 0.0
        at = int(np.argmax(total))
        best, rest = float(total[at]), float(np.logaddexp.reduce(total))
        margin = (best - float(own.prior[at])) / size + own.bits * float(np.log(2.0))
        if before and before["best"] >= best:
            return before["lang_pred"], before["best"], float(np.logaddexp(rest, before["rest"])), before["margin"]
        return own.langs[at], best, float(np.logaddexp(rest, before["rest"])) if before else rest, margin

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, own = letter_table(), Block(*shared.value)
        for batch in batches:
            texts = batch.column("text") if apart else pc.struct_field(batch.column("row"), "text")
            before = batch.select([name for name, _ in _STATE]).to_pylist() if later else [None] * batch.num_rows
            found = [judged(own, text.as_py() or "", x, letters) for text, x in zip(texts, before, strict=True)]
            state = [pa.array([x[i] for x in found], kind) for i, (_, kind) in enumerate(_STATE)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + state, kept + [name for name, _ in _STATE])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(run, kinds + ", lang_pred string, best double, rest double, margin double")


def predict(rows: DataFrame, model: Model) -> DataFrame:
    """rows (row struct, and text string unless row has it) -> row, lang_pred, score and margin; repeats give equal rows.

    lang_pred is ``und`` with score 0 where the text is null or has no letter, or nothing was learned; else score is the
    posterior probability, and margin the log by which an n-gram of the text is on average likelier in lang_pred than
    drawn at random: below zero, the language doesn't explain the text. Ties go to the language that is first in code
    point order.
    """
    small_batches(rows.sparkSession)
    if not model.langs:
        zero = F.lit(0.0)
        return rows.select("row", F.lit(UNDETERMINED).alias("lang_pred"), zero.alias("score"), zero.alias("margin"))
    passes = math.ceil(len(model.langs) / BLOCK)
    scratch = Scratch(rows.sparkSession, "langid") if passes > 1 else None
    rows = rows.select("row", "text") if "text" in rows.columns else rows.select("row")
    for i, block in enumerate(model.blocks(), 1):
        rows = _passed(rows, block, i < passes)
        if i < passes:
            rows = scratch.keep(rows, "passed")
    score = F.when(F.col("lang_pred") == UNDETERMINED, 0.0).otherwise(F.least(F.exp(F.col("best") - F.col("rest")), F.lit(1.0)))
    return rows.select("row", "lang_pred", score.alias("score"), "margin")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of doc_id as text modulo ``of``; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


#: Rounding of float32 sums, for a language that is itself random.
_ROUNDING = 1e-4


def identified(docs: DataFrame) -> DataFrame:
    """The rows of docs whose text is in a language that docs' own labels teach; ``lang`` becomes the predicted one.

    Texts without a letter go, and so do texts that no learned language explains better than chance, such as those in a
    script that none of them uses. Where docs have no label at all nothing was learned: texts with a letter stay as they
    are. All other columns stay as they are; repeats stay or go alike.
    """
    model = fit(docs, F.lit(True))
    rows = docs.select(whole_row(docs).alias("row"))
    if not model.langs:
        return rows.where(F.col("row.text").rlike(r"\p{L}")).select("row.*")
    found = predict(rows, model).where((F.col("lang_pred") != UNDETERMINED) & (F.col("margin") >= -_ROUNDING))
    return found.select(F.col("row").withField("lang", F.col("lang_pred")).alias("row")).select("row.*")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 4) == 2
    model = fit(docs, ~held)
    rows = docs.select(F.struct("doc_id", held.alias("held_out")).alias("row"), "text")
    return predict(rows, model).select("row.doc_id", "row.held_out", "lang_pred", "score")
