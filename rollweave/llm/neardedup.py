"""Near-duplicate detection over word shingles: SetSketch bands find candidates, full sets confirm the links.

1. One scan makes a narrow table: for each document a digest of its word sequence, its set's size and its registers.
   If a doc_id is held by different word sequences, rows get keys of (doc_id, digest) in that order instead of doc_ids.
2. Documents with one word sequence are one class; its least doc_id stands for it from here on.
3. Documents that share a band of registers share a bucket. Every bucket links its members with its least document,
   so a bucket of any size costs a row for each member. Registers are joined first: the likelihood estimate drops what
   can't reach the similarity. Only the pairs that are left meet their texts, and the full sets confirm the rest.
4. Connected components of the confirmed links. A bucket whose members are all in one component is done. In the others
   every member outside the bucket's largest component is compared with every member of other components, in blocks of
   some BLOCK by BLOCK documents, fewer if they are long; a pair is compared in the first band that it shares. Blocks
   of registers say which documents have a likely partner there, and only those come again with their texts. No pair
   becomes a row: a block returns at most a link for each document and component.
5. Components over all links.

A pair at the similarity p is missed with probability (1 - p**5)**32: 7e-9 at 0.85, 3e-6 at 0.8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollweave.llm import setsketch
from rollweave.llm.common import Scratch, salted, table, whole_row
from rollweave.llm.components import connected_components

SHINGLE = 5
#: Documents, and shingles of all documents, on one side of a block of comparisons.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
SALTS = 64
#: A bucket of more members is met in SALTS parts; a member is a row of 24 bytes.
HOT = 1_000_000
#: Ids are broadcast up to this many (some 10 MB with their hash table); beyond, the join shuffles.
BROADCAST_IDS = 250_000
#: Bytes of text whose sets a task holds at a time.
SLICE = 2 << 20
_KNOWN_WORDS = 200_000
#: Standard deviations between the similarity asked for and the least estimate that is still confirmed.
_MARGIN = 6.0


class WordHashes(dict):
    """64-bit hashes of words; forgets when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        self[word] = out = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case: what bytes.lower and bytes.split do."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of SHINGLE words; fewer words are one shingle, none is no shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array([known[w] for w in words], np.uint64)
    width = min(SHINGLE, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = setsketch.mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(out)])
    return np.unique(out)


def digest_of(words: list[bytes]) -> bytes | None:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def _with_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, row) -> (doc_id, copy, row); ``copy`` as in sketches, but empty where those have null."""
    for batch in batches:
        copies = pa.array([digest_of(words_of(x.as_py())) or b"" for x in batch.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), copies, batch.column(2)], ["doc_id", "copy", "row"])


def _digested(rows: DataFrame) -> DataFrame:
    return rows.mapInArrow(_with_digests, f"doc_id long, copy binary, row {rows.schema['row'].dataType.simpleString()}")


def _sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        first, size, sets, copies = 0, 0, [], []
        for i, text in enumerate(texts):
            words = words_of(text.as_py())
            sets.append(shingles(words, known))
            copies.append(digest_of(words))
            size += 8 * len(words)
            if size < SLICE and i + 1 < len(texts):
                continue
            sizes = np.array([len(x) for x in sets], np.int64)
            registers = [b""] * len(sets)
            if real := np.flatnonzero(sizes).tolist():
                found = setsketch.sketch(np.concatenate([sets[k] for k in real]), sizes[real])
                for k, x in zip(real, found, strict=True):
                    registers[k] = x.tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, len(sets)), pa.array(copies, pa.binary()), pa.array(sizes), pa.array(registers, pa.binary())],
                ["doc_id", "copy", "n_shingles", "registers"],
            )
            first, size, sets, copies = i + 1, 0, [], []


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, setsketch.M)


def _banded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = setsketch.band_keys(_registers(batch.column(2)))
            ids, n = (np.repeat(batch.column(k).to_numpy(), setsketch.BANDS) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids), pa.array(n)], ["key", "doc_id", "n"])


def _least_estimate(percent: int) -> float:
    p = percent / 100
    return p - _MARGIN * (p * (1 - p) / setsketch.M) ** 0.5


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _likely(percent: int) -> Callable:
    """Rows (a, b, registers_a, registers_b, n_a, n_b) -> the (a, b) that the estimate doesn't rule out."""

    def likely(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = setsketch.likeliest(_registers(batch.column(2)), _registers(batch.column(3)), batch.column(4).to_numpy(), batch.column(5).to_numpy())
                yield batch.select([0, 1]).filter(pa.array(found >= _least_estimate(percent)))

    return likely


def _confirmer(percent: int) -> Callable:
    """Rows (a, b, text_a, text_b) -> the (a, b) whose full sets link."""

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, kept = WordHashes(), {}
        for batch in batches:
            b, ok = batch.column(1).to_pylist(), []
            for i in range(batch.num_rows):
                if b[i] not in kept:
                    kept = {b[i]: shingles(words_of(batch.column(3)[i].as_py()), known)}
                ok.append(linked(shingles(words_of(batch.column(2)[i].as_py()), known), kept[b[i]], percent))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return confirm


def _candidates(band: int, rows: list[dict], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each outsider of a block the members of other components that it may link with, where ``band`` is the first band that they share."""
    registers = np.frombuffer(b"".join(r["registers"] for r in rows), np.uint16).reshape(-1, setsketch.M)
    keys, n = setsketch.band_keys(registers), np.array([r["n"] for r in rows])
    component, member = np.array([r["component"] for r in rows]), np.array([r["member"] for r in rows])
    least = _least_estimate(percent)
    for o in [i for i, r in enumerate(rows) if r["outsider"]]:
        at = member & (component != component[o])
        at &= (100 * np.minimum(n, n[o]) >= percent * np.maximum(n, n[o])) & ~(keys[:, :band] == keys[o, :band]).any(axis=1)
        at = np.flatnonzero(at)
        if len(at):
            same = np.broadcast_to(registers[o], (len(at), setsketch.M))
            at = at[setsketch.likeliest(same, registers[at], np.full(len(at), n[o]), n[at]) >= least]
        if len(at):
            yield o, at


def needed_of_block(band: int, rows: list[dict], percent: int) -> list[int]:
    """The rows of a block that have a likely partner in it."""
    return sorted({int(x) for o, at in _candidates(band, rows, percent) for x in (o, *at)})


def compare_block(band: int, rows: list[dict], percent: int, known: WordHashes) -> list[tuple[int, int]]:
    """Links between the block's outsiders and its members of other components, where ``band`` is the first that they share."""
    sets: dict[int, np.ndarray] = {}

    def of(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingles(words_of(rows[i].pop("text")), known)
        return sets[i]

    out = []
    for o, at in _candidates(band, rows, percent):
        joined: set[int] = set()
        for m in at.tolist():
            if (c := rows[m]["component"]) not in joined and linked(of(o), of(m), percent):
                joined.add(c)
                out.append((rows[o]["doc_id"], rows[m]["doc_id"]))
    return out


def _by_block(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one block (key, part, other) after another; one block is held at a time."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            block = row["key"], row["part"], row["other"]
            if block != at:
                if held:
                    yield held
                at, held = block, []
            held.append(row)
    if held:
        yield held


_SPOT = "key long, part int, other int, doc_id long, component long, member boolean, outsider boolean, n long"


def _block_screener(percent: int) -> Callable:
    """Rows sorted by block -> those that have a likely partner in their block, without registers."""
    names = [x.split()[0] for x in _SPOT.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches):
            if needed := needed_of_block(_band_of(rows[0]["key"], rows[0]), rows, percent):
                yield pa.RecordBatch.from_pylist([{c: rows[i][c] for c in names} for i in needed], schema=_SPOT_ARROW)

    return run


_SPOT_ARROW = pa.schema([(c, {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[t]) for c, t in (x.split() for x in _SPOT.split(", "))])


def _block_comparer(percent: int) -> Callable:
    """Rows sorted by block, with registers and text -> links."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for rows in _by_block(batches):
            found = compare_block(_band_of(rows[0]["key"], rows[0]), rows, percent, known)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], ["a", "b"])

    return run


def _band_of(key: int, row: dict) -> int:
    keys = setsketch.band_keys(np.frombuffer(row["registers"], np.uint16).reshape(1, -1))[0]
    return int(np.flatnonzero(keys == key)[0])


def _with_ids(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """df semi- or anti-joined on doc_id; the ids are broadcast only if they are counted to be few."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def components_of(docs: DataFrame, scratch: Scratch, percent: int = 85) -> DataFrame:
    """(doc_id, copy, n_shingles, component_id, first) for every row of docs (doc_id, text); ``first``: it stands for its class.

    Null and empty texts and texts of white space have n_shingles 0, their own doc_id as component_id, and link with
    nothing. A row without doc_id links with nothing and has no component_id. Rows that repeat doc_id and words share
    all values; rows of one doc_id with different words are documents of their own, told apart by ``copy``.
    """
    return _found(docs, scratch, percent)[0]


def _found(docs: DataFrame, scratch: Scratch, percent: int) -> tuple[DataFrame, bool]:
    """components_of, and whether any doc_id is held by different words."""
    docs = docs.select("doc_id", "text")
    sketches = scratch.keep(docs.mapInArrow(_sketched, "doc_id long, copy binary, n_shingles long, registers binary"), "sketches")
    sketches = sketches.withColumn("copy", F.coalesce("copy", F.lit(b"")))
    held = sketches.where("doc_id is not null").groupBy("doc_id").agg(F.min("copy").alias("least"), F.max("copy").alias("most"))
    if held.where("least <> most").isEmpty():
        return _components(docs, sketches, scratch, percent), False
    keys = sketches.where("doc_id is not null").select("doc_id", "copy").distinct().orderBy("doc_id", "copy")
    keys = scratch.keep(keys.withColumn("key", F.monotonically_increasing_id()), "keys")
    texts = _digested(docs.select("doc_id", "text", F.struct("text").alias("row"))).join(keys, ["doc_id", "copy"])
    texts = scratch.keep(texts.select(F.col("key").alias("doc_id"), "row.text"), "keyed_texts")
    keyed = sketches.join(keys, ["doc_id", "copy"], "left").select(F.col("key").alias("doc_id"), "copy", "n_shingles", "registers")
    found = _components(texts, scratch.keep(keyed, "keyed_sketches"), scratch, percent)
    own = keys.select(F.col("doc_id").alias("own_id"), F.col("key").alias("doc_id"))
    of = keys.select(F.col("doc_id").alias("of_id"), F.col("key").alias("component_id"))
    found = found.join(own, "doc_id", "left").join(of, "component_id", "left")
    return found.select(F.col("own_id").alias("doc_id"), "copy", "n_shingles", F.col("of_id").alias("component_id"), "first"), True


def _components(docs: DataFrame, sketches: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """components_of where every doc_id has one word sequence."""
    n, words = sketches.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    banded, text = 32 * setsketch.BANDS * n, 8 * words  # bytes of all band rows, and of texts
    known = sketches.where("doc_id is not null and n_shingles > 0")
    salt = salted(F.col("doc_id"), SALTS).alias("salt")
    part = known.groupBy("copy", salt).agg(F.min("doc_id").alias("least"))
    least = part.groupBy("copy").agg(F.min("least").alias("rep"), F.collect_list("salt").alias("salts"))
    least = least.select("copy", "rep", F.explode("salts").alias("salt"))
    classes = scratch.keep(known.select("doc_id", "copy", salt).join(least, ["copy", "salt"]).select("doc_id", "rep"), "classes", 16 * n)
    copies = classes.where("doc_id <> rep").select("doc_id").distinct()
    reps = _with_ids(known.select("doc_id", F.col("n_shingles").alias("n"), "registers"), copies, "left_anti").dropDuplicates(["doc_id"])
    bands = scratch.keep(reps.mapInArrow(_banded, "key long, doc_id long, n long"), "bands", banded)
    buckets = bands.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "n")).alias("p")).where("c > 1")
    buckets = buckets.select("key", "c", F.col("p.doc_id").alias("p_id"), F.col("p.n").alias("p_n"))
    members = scratch.keep(_members(bands, buckets), "members", banded)
    scratch.drop(bands)
    facts = scratch.keep(_with_ids(reps, members.select("doc_id").distinct(), "left_semi"), "facts", 2 * setsketch.M * n)
    alike = f"100 * least(n, p_n) >= {percent} * greatest(n, p_n)"
    pairs = members.where("doc_id <> p_id and " + alike).select(F.col("doc_id").alias("a"), F.col("p_id").alias("b")).distinct()
    likely = _meet(pairs, facts.select("doc_id", "registers", "n")).select("a", "b", "registers_a", "registers_b", "n_a", "n_b")
    likely = scratch.keep(likely.mapInArrow(_likely(percent), "a long, b long"), "likely", banded)
    texts = _texts_of(docs, likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    both = _meet(likely, scratch.keep(texts, "texts", text)).select("a", "b", "text_a", "text_b")
    links = scratch.keep(both.mapInArrow(_confirmer(percent), "a long, b long"), "links", 8 * text)
    found = scratch.keep(connected_components(links, scratch, size=banded), "components", 16 * n)

    more = _residual(members, found, facts, docs, percent, scratch, banded)
    more = None if more is None else scratch.keep(more, "more", 8 * text)
    scratch.drop(members, facts)
    if more is not None and not more.isEmpty():
        found = scratch.keep(connected_components(links.unionByName(more), scratch, size=banded), "components", 16 * n)
    of_class = classes.distinct().join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    of_class = of_class.select("doc_id", "rep", F.coalesce("component", "rep").alias("component"))
    out = sketches.select("doc_id", "copy", "n_shingles").join(of_class, "doc_id", "left")
    return out.select(
        "doc_id", "copy", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("first"),
    )


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text), a row for each of these ids."""
    return _with_ids(docs.select("doc_id", "text"), ids, "left_semi").dropDuplicates(["doc_id"])


def _members(bands: DataFrame, buckets: DataFrame) -> DataFrame:
    """The rows of bands whose bucket is listed, with the bucket's columns. Buckets of more than HOT members are met in SALTS parts."""
    hot = buckets.where(f"c > {HOT}")
    if bands.count() <= HOT * setsketch.BANDS or hot.isEmpty():  # a table of fewer documents has no such bucket
        return bands.join(buckets, "key")
    spread = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = bands.withColumn("salt", salted(F.col("doc_id"), SALTS)).join(spread, ["key", "salt"], "left").drop("salt")
    rest = met.where("c is null").select(*bands.columns).join(buckets.where(f"c <= {HOT}"), "key")
    return met.where("c is not null").unionByName(rest)


def _meet(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """pairs (a, b) with the columns of facts (doc_id, ..) for both, as x_a and x_b. A document that is b of many pairs is met in SALTS parts."""
    names = [c for c in facts.columns if c != "doc_id"]
    side = lambda x: facts.select(F.col("doc_id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in names))
    cut = pairs.select("a", "b", salted(F.col("a"), SALTS).alias("salt"))
    spread = cut.select("b", "salt").distinct().join(side("b"), "b")
    return cut.join(side("a"), "a").join(spread, ["b", "salt"]).drop("salt")


def _in_blocks(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select("key", "part", "other", *columns).repartition("key", "part", "other").sortWithinPartitions("key", "part", "other")


def _residual(members: DataFrame, found: DataFrame, facts: DataFrame, docs: DataFrame, percent: int, scratch: Scratch, size: int) -> DataFrame | None:
    """Links that the least documents of the buckets don't show, from the buckets whose members are in several components; None where there can't be any."""
    known = members.where("c > 2").join(found.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    known = known.select("key", "doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
    sizes = known.groupBy("key", "component").agg(F.sum(F.lit(1.0 / BLOCK) + F.col("n") / F.lit(BLOCK_SHINGLES)).alias("blocks"), F.count(F.lit(1)).alias("c"))
    mixed = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("c", "component")).alias("main"), F.max_by("blocks", F.struct("c", "component")).alias("most"), F.sum("blocks").alias("all"), F.count(F.lit(1)).alias("components")
    )
    blocks = lambda x: F.ceil(x - F.lit(1e-6)).cast("int")
    mixed = mixed.where("components > 1").select(
        "key", "main", F.greatest(blocks(F.col("all")), F.lit(1)).alias("parts"), F.greatest(blocks(F.col("all") - F.col("most")), F.lit(1)).alias("out_parts")
    )
    mixed = scratch.keep(mixed, "mixed", size)  # read from a table, so that the join below can split a large bucket
    if mixed.isEmpty():
        return None
    rows = known.join(mixed, "key").withColumn("h", F.xxhash64("doc_id"))
    own, out_own = F.expr("cast(pmod(h, parts) as int)"), F.expr("cast(pmod(shiftright(h, 20), out_parts) as int)")
    outsider = F.col("component") != F.col("main")
    # as a member: its own part meets every part of outsiders; as an outsider: its own part meets every part of members
    as_member = F.transform(F.sequence(F.lit(0), F.col("out_parts") - 1), lambda x: F.struct(own.alias("part"), x.alias("other"), F.lit(True).alias("member"), F.lit(False).alias("outsider")))
    as_outsider = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct(x.alias("part"), out_own.alias("other"), F.lit(False).alias("member"), F.lit(True).alias("outsider")))
    spots = F.when(outsider, F.concat(as_member, as_outsider)).otherwise(as_member)
    rows = rows.select("key", "doc_id", "n", "component", F.explode(spots).alias("s")).select("key", "doc_id", "n", "component", "s.*")
    columns, registers = ["doc_id", "component", "member", "outsider", "n"], facts.select("doc_id", "registers")
    screened = _in_blocks(rows.join(registers, "doc_id"), [*columns, "registers"]).mapInArrow(_block_screener(percent), _SPOT)
    screened = scratch.keep(screened, "screened", size)
    if screened.isEmpty():
        return None
    texts = _texts_of(docs, screened.select("doc_id").distinct())
    rows = screened.join(registers.join(texts, "doc_id"), "doc_id")
    return _in_blocks(rows, [*columns, "registers", "text"]).mapInArrow(_block_comparer(percent), "a long, b long")


def deduplicated(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each component, that with the least doc_id, with docs' own columns; unlinked documents stay."""
    scratch = Scratch(docs.sparkSession, "near")
    found, shared = _found(docs, scratch, percent)
    by = ["doc_id", "copy"] if shared else ["doc_id"]  # digests only where ids don't tell documents apart
    gone = scratch.keep(found.where("not first").select(*(F.col(c).alias(f"gone_{c}") for c in by)).distinct(), "gone", 32 * docs.count())
    ids = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    rows = _digested(docs.select("doc_id", "text", whole_row(docs).alias("row"))) if shared else docs.select("doc_id", whole_row(docs).alias("row"))
    return rows.join(ids, [F.col(c) == F.col(f"gone_{c}") for c in by], "left_anti").select("row.*")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components_of(table(spark, sf_dir, "documents"), Scratch(spark, "near"), 85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
