"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations alone.

A source's documents are ordered by exponential keys -ln(u) / w, u from a hash of doc_id, w from the document's quality.
A target of more than the source's size first takes complete epochs of every document; what remains is a prefix of the
ordered documents. The prefix is found in two steps, so that a source with a third of all rows is never in one task:
keys fall into buckets of about BUCKET documents, bucket sums are prefix-summed, and only the documents from the
bucket in which the budget ends to the one that is sure to fill it, were its largest document passed over, are ordered
and summed one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollweave.llm.common import WORD, Scratch, table, whole_row

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
BUCKET = 1024
#: Sources are broadcast up to this many (some 10 MB); beyond, rows meet them in a salted join.
BROADCAST_SOURCES = 100_000
#: Documents around the ends of budgets, some 1000 a source, are broadcast up to this many (some 40 MB).
BROADCAST_CHOSEN = 300_000
SALTS = 64
#: Characters that prose has few of. Against the quality labels of the sample data, the share of others has an AUC of 0.97.
RARE = "#$%&*|!<>{}[]^~=+@ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_BITS = 52


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.5 (rare characters only, empty or null) to 1 (none), by the fourth power of the others' share.

    The bounds keep keys of one source within a factor of two of each other, so that buckets of keys stay even.
    """
    share = F.coalesce(F.try_divide(F.length(F.translate(text, RARE, "")), F.length(text)), F.lit(0.0))
    return F.lit(0.5) + F.lit(0.5) * ((share * share) * (share * share))


def uniform(doc_id: Column, seed: str = "") -> Column:
    """In (0, 1), from 52 bits of MD5 of seed and doc_id; null counts as the empty text."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, _BITS // 4)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << _BITS))


def measured(docs: DataFrame, seed: str = "") -> DataFrame:
    """docs' columns below ``row``, with the columns that the mix needs: skey, doc_id, size, key, tie."""
    text = F.col("text")
    return docs.select(
        whole_row(docs).alias("row"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("skey"),
        F.col("doc_id"),
        words(text).alias("size"),
        (-F.ln(uniform(F.col("doc_id"), seed)) / quality_weight(text)).alias("key"),
        F.xxhash64(text).alias("tie"),
    )


def source_targets(rows: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """A row for each source: skey, source_size, docs, weight and target.

    Sources in code point order, null last, take the weights in turn. All sizes are shared by weight; a source that
    would get more than ``most`` times its size gets that, and the others share the rest by weight: one level, found by
    going through the sources in the order in which a rising level meets their limits.
    """
    sums = rows.groupBy("skey").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    in_order = Window.orderBy(F.desc(F.substring("skey", 1, 1)), "skey")  # s before n: null last
    turn = F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1
    sums = sums.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")).cast("long"))
    limit = F.col("source_size") * most
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "skey")
    sums = sums.withColumns(
        {
            "rest": F.sum("source_size").over(Window.partitionBy())
            - F.coalesce(F.sum(limit).over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "rest_weight": F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)),
            "place": F.row_number().over(by_limit),
        }
    )
    held = F.col("rest") * F.col("weight") <= limit * F.col("rest_weight")
    at = F.min(F.when(held, F.struct("place", "rest", "rest_weight"))).over(Window.partitionBy())
    share = at["rest"] * F.col("weight") / at["rest_weight"]
    target = F.when(at.isNull() | (F.col("place") < at["place"]), limit.cast("double")).otherwise(share)
    return sums.select("skey", "source_size", "docs", "weight", target.cast("double").alias("target"))


def _meet(rows: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    if few:
        return rows.join(F.broadcast(sources), "skey")
    salt = F.pmod(F.xxhash64("doc_id", "tie"), F.lit(SALTS)).cast("int")
    many = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", salt).join(many, ["skey", "salt"]).drop("salt")


def _bucket() -> Column:
    n = F.greatest(F.lit(1.0), F.ceil(F.col("docs") / F.lit(BUCKET)).cast("double"))
    return F.floor(n * (F.lit(1.0) - F.exp(-F.col("key")))).cast("long")


def mixed(rows: DataFrame, scratch: Scratch, narrow: DataFrame | None = None, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """measured() rows with source_size, target and copies, the times that the mix takes the row.

    ``narrow``: the same rows without ``row`` where that is cheaper to read. Empty documents, and sources of size 0,
    take nothing. Where a budget ends, documents that no longer fit are passed over for later ones that do, three
    times, and one last document is taken if that comes nearer to the target. Rows with equal keys (repeats of a doc_id)
    go by doc_id, size and a hash of the text; full repeats are taken alike. ``rows`` is read once.
    """
    narrow = rows.drop("row") if narrow is None else narrow
    sources = scratch.keep(source_targets(narrow, weights, most), "sources")
    few = sources.count() <= BROADCAST_SOURCES
    size = F.col("source_size")
    epochs = F.when(size == 0, F.lit(0)).otherwise(F.least(F.lit(most), F.floor(F.col("target") / size))).cast("long")
    sources = sources.withColumns({"epochs": epochs}).withColumn("budget", F.col("target") - F.col("epochs") * size)
    sums = _meet(narrow, sources, few).groupBy("skey", "budget", _bucket().alias("bucket")).agg(F.sum("size").alias("words"), F.max("size").alias("most"))
    running = Window.partitionBy("skey").orderBy("bucket")
    sums = sums.withColumns({"upto": F.sum("words").over(running), "most": F.max("most").over(Window.partitionBy("skey"))})
    sums = sums.where("upto > budget").groupBy("skey").agg(
        F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("end"),
        F.coalesce(F.min(F.when(F.col("upto") > F.col("budget") + 2 * F.col("most"), F.col("bucket"))), F.max("bucket")).alias("last_bucket"),
    )
    ends = scratch.keep(
        sources.join(sums, "skey", "left").select("skey", "source_size", "docs", "target", "epochs", "last_bucket",
            F.col("end.bucket").alias("end_bucket"), (F.col("budget") - F.col("end.before")).alias("left")), "ends"
    )
    inside = F.expr("coalesce(bucket between end_bucket and last_bucket, false)")
    chosen = scratch.keep(_chosen(_meet(narrow, ends, few).withColumn("bucket", _bucket()).where(inside)), "chosen")
    met = _meet(rows, ends, few).withColumns({"bucket": _bucket(), "id_key": _id_key()})
    met = met.join(F.broadcast(chosen) if chosen.count() <= BROADCAST_CHOSEN else chosen, ["skey", "id_key", "tie"], "left")
    # a source whose target is a whole number of epochs, or that has no words, takes nothing more
    more = F.expr("coalesce(bucket < end_bucket, false)") & (F.col("epochs") < most)
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("epochs") + F.when(inside, F.col("chosen").isNotNull()).otherwise(more).cast("int"))
    return met.withColumn("copies", copies.cast("long")).drop("end_bucket", "last_bucket", "left", "bucket", "epochs", "docs", "id_key", "chosen")


def _id_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def _chosen(split: DataFrame) -> DataFrame:
    """(skey, id_key, tie, chosen) of the documents that fill what is ``left`` of their source's budget. Full repeats are peers of the order: all are chosen or none."""
    order = [F.col("key"), F.col("doc_id"), F.col("size"), F.col("tie")]
    by_source = Window.partitionBy("skey")
    split = split.withColumn("more", F.lit(False))
    for turn in range(3):
        fits = ~F.col("more") & (F.col("size") <= F.col("left")) if turn else ~F.col("more")
        upto = F.sum(F.when(fits, F.col("size")).otherwise(0)).over(by_source.orderBy(*order))
        split = split.withColumn("take", fits & (upto <= F.col("left")))
        split = split.withColumn("left", F.col("left") - F.sum(F.when(F.col("take"), F.col("size")).otherwise(0)).over(by_source))
        split = split.withColumn("more", F.col("more") | F.col("take")).drop("take")
    spare = F.when(F.col("more") | (F.col("size") == 0), F.lit(1)).otherwise(0)
    nearest = F.rank().over(by_source.orderBy(spare, F.col("size"), *order)) == 1
    taken = F.col("more") | (nearest & (spare == 0) & (F.col("size") < 2 * F.col("left")))
    return split.withColumn("taken", taken).where("taken").select("skey", _id_key().alias("id_key"), "tie", F.lit(True).alias("chosen")).distinct()


def mix(docs: DataFrame, seed: str = "") -> DataFrame:
    """The mixed corpus: docs' rows with docs' columns, each as many times as the mix takes it; those not taken go."""
    scratch = Scratch(docs.sparkSession, "mix")
    rows = measured(docs, seed)
    found = mixed(rows, scratch, scratch.keep(rows.drop("row"), "measured"))
    return found.where("copies > 0").withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "mix")
    rows = scratch.keep(measured(table(spark, sf_dir, "documents")).drop("row"), "measured")
    found = mixed(rows, scratch)
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
