"""From raw documents to token digests: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return docs' columns. run() writes what a
stage returns as Parquet in the shared folder and reads it again for the next; a stage's own tables, and its input, are
deleted once its result is written.

In every stage null texts count as empty, texts of any length are taken whole, further columns stay whatever they are
called, and an empty table gives an empty one. Rows that repeat a document are ties: where one of them stays it is one of
equals, so it doesn't matter which.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollweave.llm import exactdedup, langid, mixing, neardedup, pieces
from rollweave.llm.common import Scratch, released, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose text is in a learned language, which becomes their lang; texts without a letter (null and empty ones too) and those that no language explains go; repeated rows all stay or all go."""
    return langid.identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of equal texts, that with the least doc_id (rows without doc_id last), and one row of those that repeat it. Null and empty texts are equal."""
    return exactdedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by a similarity of 0.8 or more on five-word shingles, that with the least doc_id. Texts without words link with nothing and stay."""
    return neardedup.deduplicated(docs, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source up to its target: a row for each time that the mix takes a document. Null is a source of its own; ties of keys go by doc_id and size."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and bounds_sha256 for each row of the mix, repeats included; empty texts have no tokens."""
    return pieces.tokenised(docs)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("tokenise", tokenise)]

#: Near-duplicate groups by sketches, naive Bayes and SentencePiece have no SQL form; tests/llm hold a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with released(spark):
            before, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
