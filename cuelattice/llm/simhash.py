"""SimHash fingerprints, their links by multi-index hashing, and groups.

Links of op3 (64 bits, at most 2 differ). A fingerprint is two segments of 32 bits.
Two fingerprints at distance 2 or less differ by at most 1 bit in the high segment
or by none in the low one, so it is enough to look up the ball of radius 1 around
the high segment and the low segment itself; each hit is verified on all 64 bits.
Of the ball only the keys with one more bit set are enumerated: of two segments
that differ in one bit, one reaches the other that way. A key with very many
fingerprints is not paired off: its fingerprints emit the 65 points of their own
ball of radius 1 instead, since two fingerprints are at distance 2 or less exactly
if these balls meet, and no point lies in more than 65 of them. So links are exact
and rows stay in proportion to the fingerprints.

Near-duplicate groups of the pipeline (five-word shingles, Jaccard 0.8) start from the same
fingerprints and links, on five-word shingles; each link is verified on the full shingle sets.
Close copies are found so, but at Jaccard 0.8 two fingerprints differ in ten bits of 64 on
average, more than balls can enumerate. The rest is therefore found by a prefix filter: in one
order of all shingles, with frequent ones last, similar texts share a shingle among the first
fifth of theirs. With the links, each shingle first proposes its members with one of them, in
rows in proportion to the documents; then those of its members that are not yet joined are
paired off whose places in their texts' order allow the similarity. All candidates are
verified, and the groups are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuelattice.llm.common import arrow_batches, distinct_texts, materialise, release, repeats, text_tag
from cuelattice.llm.graph import components

SEED = 42
#: Fingerprints and probes of one key that are still paired off in place.
PAIRED = 128


def words(text: str) -> list[bytes]:
    """Words between space and \\t to \\r, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8").lower().split()


def shingle_hashes(parts: list[bytes], size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``size`` words joined by spaces; of fewer words, the whole sequence; of none, nothing."""
    if not parts:
        return np.empty(0, dtype=np.uint64)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= size:
        return np.array([digest(joined, seed)], dtype=np.uint64)
    starts = [0, *accumulate(len(p) + 1 for p in parts)]
    return np.array([digest(joined[a : b - 1], seed) for a, b in zip(starts, starts[size:])], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = np.ascontiguousarray(hashes[at : at + (1 << 16)])
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def stirred(hashes: np.ndarray, turn: int) -> np.ndarray:
    """Further 64 bits of the same features."""
    if not turn:
        return hashes
    h = hashes + np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prints(docs: DataFrame, size: int = 3, blocks: int = 1) -> DataFrame:
    """doc_id, fp0 .. (signed longs) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, blocks), dtype=np.uint64)
            for i, text in enumerate(batch.column(1).to_pylist()):
                h = shingle_hashes(words(text or ""), size)
                if len(h):
                    found[i] = [majority(stirred(h, t)) for t in range(blocks)]
            columns = [pa.array(np.ascontiguousarray(found[:, t]).view(np.int64)) for t in range(blocks)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *[f"fp{t}" for t in range(blocks)]])

    kind = dict(docs.dtypes)["doc_id"]
    return arrow_batches(docs.select("doc_id", "text"), scan, f"doc_id {kind}, " + ", ".join(f"fp{t} long" for t in range(blocks)))


def low(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(0xFFFFFFFF))


def high(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def ball(segment: Column) -> Column:
    """The segment of 32 bits and every segment with one more bit set."""
    more = F.transform(F.array(*[F.lit(1 << b) for b in range(32)]), lambda bit: F.when(segment.bitwiseAND(bit) == 0, segment.bitwiseOR(bit)))
    return F.array_compact(F.concat(F.array(segment), more))


def links(fps: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column fp) at 2 or fewer differing bits; every linked pair is joined by a path of edges."""
    entries = fps.select(
        "fp",
        F.explode(
            F.concat(
                F.transform(ball(high(F.col("fp"))), lambda k, i: F.struct(k.alias("key"), F.lit(0).alias("segment"), (i == 0).alias("own"))),
                F.array(F.struct(low(F.col("fp")).alias("key"), F.lit(1).alias("segment"), F.lit(True).alias("own"))),
            )
        ).alias("e"),
    ).select("fp", "e.key", "e.segment", "e.own")
    entries = materialise(entries, "segments")
    sizes = entries.groupBy("segment", "key").agg(F.count("*").alias("n"), F.count_if("own").alias("owned")).where("n > 1 AND owned > 0")
    shared = entries.join(sizes, ["segment", "key"])
    members = shared.where(F.col("n") <= paired).groupBy("segment", "key").agg(F.collect_list(F.struct("own", "fp")).alias("all"))
    # table entries against all that look them up; a pair of entries is taken once
    pairs = members.select(F.explode(F.filter("all", lambda x: x["own"])).alias("a"), "all").select(F.col("a.fp").alias("u"), F.explode("all").alias("b"))
    near = pairs.where((~F.col("b.own") | (F.col("u") > F.col("b.fp"))) & (distance(F.col("u"), F.col("b.fp")) <= 2)).select("u", F.col("b.fp").alias("v"))
    crowded = shared.where(F.col("n") > paired).select("fp").distinct()
    bits = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(64)])
    points = crowded.select("fp", F.explode(bits).alias("bit")).select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("point"))
    meet = points.groupBy("point").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)  # at most 65
    stars = meet.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u")).where("u <> v").select("u", "v")
    return near.union(stars)


def groups(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fingerprint, component_id of every row.

    ``component_id`` is the smallest doc_id reachable over links, the row's own
    included; null doc_ids reach others but are never smallest, and a component of
    nulls alone has null. A null or blank text has fingerprint zero and links like any
    other; repeated rows share a component; an empty table gives an empty result;
    other columns are not read.
    """
    marked = materialise(prints(docs, size).withColumnRenamed("fp0", "fp"), "prints")
    classes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes.select("fp"))).withColumnRenamed("node", "fp")
    labelled = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    known = labelled.select("fp", "root").join(least, "root").select("fp", "component_id")
    return marked.join(known, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Shingles that count as frequent: documents that are sampled, times one is met among them, and how many are kept.
SAMPLED, OFTEN, FREQUENT = 100_000, 3, 500_000


def frequent(docs: DataFrame, size: int) -> np.ndarray:
    """Hashes (ascending) of shingles that many of the sampled documents hold, at most FREQUENT of them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingle_hashes(words(t or ""), size)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64))], names=["key"])

    one_in = max(1, docs.count() // SAMPLED)
    some = arrow_batches(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0).select("text"), scan, "key long")
    often = some.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "key").limit(FREQUENT)
    return np.sort(often.select("key").toArrow().column(0).to_numpy().view(np.uint64))


def prefixes(docs: DataFrame, size: int, similar: float) -> DataFrame:
    """doc_id, fp, n, prefix: a text's fingerprint, the number of its shingles and the first of them in one order of all shingles.

    Texts of Jaccard similarity ``similar`` share a shingle of their prefixes, whatever
    the order is. Frequent shingles come last, so prefixes hold rare ones.
    """
    late = docs.sparkSession.sparkContext.broadcast(frequent(docs, size))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = late.value
        for batch in batches:
            sizes, found, fps = [], [], []
            for t in batch.column(1).to_pylist():
                h = shingle_hashes(words(t or ""), size)
                fps.append(majority(h) if len(h) else 0)
                h = np.unique(h)
                if len(often):
                    at = np.minimum(np.searchsorted(often, h), len(often) - 1)
                    h = h[np.argsort(often[at] == h, kind="stable")]
                sizes.append(len(h))
                found.append(h[: prefix_length(len(h), similar)].view(np.int64))
            fp = pa.array(np.array(fps, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp, pa.array(sizes, pa.int32()), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "fp", "n", "prefix"])

    kind = dict(docs.dtypes)["doc_id"]
    return arrow_batches(docs.select("doc_id", "text"), scan, f"doc_id {kind}, fp long, n int, prefix array<long>")


def prefix_length(n: int, similar: float) -> int:
    return n - math.ceil(similar * n - 1e-9) + 1 if n else 0


def _enough(pairs: DataFrame, similar: float) -> DataFrame:
    """(u, v) of rows (u, v, u_n, v_n), one for each shared shingle of the prefixes, that share enough of them.

    Up to the prefix that ends first, all common shingles are in both prefixes; later
    ones are in the rest of that text, which has similar x n shingles less one.
    """
    rest = F.greatest(*[F.ceil(F.lit(similar) * F.col(n) - 1e-9) for n in ("u_n", "v_n")]) - 1
    need = F.lit(similar / (1 + similar)) * (F.col("u_n") + F.col("v_n")) - 1e-6
    counted = pairs.where(F.least("u_n", "v_n") >= F.lit(similar) * F.greatest("u_n", "v_n") - 1e-9)
    return counted.groupBy("u", "v", "u_n", "v_n").agg(F.count("*").alias("common")).where(F.col("common") + rest >= need).select("u", "v")


def print_pairs(marked: DataFrame) -> DataFrame:
    """(u, v) that may be similar: texts (doc_id, fp) with the least one of their fingerprint, and the least ones of linked fingerprints."""
    least = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "least-of-print")
    same = marked.select("doc_id", "fp").join(least, "fp").where("doc_id <> least").select(F.col("doc_id").alias("u"), F.col("least").alias("v"))
    side = lambda at: least.select(F.col("fp").alias(at), F.col("least").alias(f"{at}_least"))
    near = links(least.select("fp")).join(side("u"), "u").join(side("v"), "v")
    return same.union(near.select(F.greatest("u_least", "v_least"), F.least("u_least", "v_least")))


def hub_pairs(shared: DataFrame, similar: float) -> DataFrame:
    """(u, v) that may be similar: each key's members (doc_id, n, key) with the key's least doc_id."""
    hubs = shared.groupBy("key").agg(F.min(F.struct(F.col("doc_id").alias("id"), "n")).alias("hub"))
    both = shared.join(hubs, "key").where("doc_id <> hub.id")
    return _enough(both.select(F.col("doc_id").alias("u"), F.col("hub.id").alias("v"), F.col("n").alias("u_n"), F.col("hub.n").alias("v_n")), similar)


def open_pairs(shared: DataFrame, roots: DataFrame, similar: float) -> DataFrame:
    """(u, v) that may be similar and are not joined yet: members of a key with different roots (node, root) whose places allow it.

    After a pair's first common shingle come all others, so that both texts have at least the
    common shingles that the similarity asks of their sizes from there on. Of a shingle that
    many texts have in a late place, as frequent ones are, no pair is left; and the shorter
    text of a pair has its first common shingle among the first 1 - 2 similar / (1 + similar).
    """
    rooted = shared.join(roots, F.col("doc_id") == F.col("node"), "left").select("key", "doc_id", "n", "pos", F.coalesce("root", "doc_id").alias("root"))
    parted = rooted.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("other")).where("one <> other").select("key")
    left = materialise(rooted.join(parted, "key"), "open")
    side = lambda at: left.select("key", F.col("doc_id").alias(at), F.col("n").alias(f"{at}_n"), F.col("pos").alias(f"{at}_pos"), F.col("root").alias(f"{at}_root"))
    share = similar / (1 + similar)
    need = F.lit(share) * (F.col("u_n") + F.col("v_n")) - 1e-6
    allowed = (F.col("u_n") - F.col("u_pos") >= need) & (F.col("v_n") - F.col("v_pos") >= need) & (F.col("v_n") >= F.lit(similar) * F.col("u_n") - 1e-6)
    shorter = (F.col("u_n") > F.col("v_n")) | ((F.col("u_n") == F.col("v_n")) & (F.col("u") > F.col("v")))
    early = side("v").where(F.col("v_n") - F.col("v_pos") >= F.lit(2 * share) * F.col("v_n") - 1e-6)
    # a sort-merge join streams a crowded key, and adaptive execution splits it
    both = side("u").join(early.hint("merge"), "key").where(shorter & allowed & (F.col("u_root") != F.col("v_root")))
    return both.select("u", "v").distinct()


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, shingles: the distinct hashes (64 bits each, ascending) of the text's word shingles."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(words(t or ""), size)).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])

    kind = dict(docs.dtypes)["doc_id"]
    return arrow_batches(docs.select("doc_id", "text"), scan, f"doc_id {kind}, shingles binary")


def verified(docs: DataFrame, pairs: DataFrame, size: int, similar: float) -> DataFrame:
    """The pairs (u, v) whose full shingle sets reach the similarity."""
    wanted = pairs.select(F.col("u").alias("want_id")).union(pairs.select("v")).distinct()
    sets = materialise(shingle_sets(docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("want_id"), "left_semi"), size), "sets")
    side = lambda at: sets.select(F.col("doc_id").alias(at), F.col("shingles").alias(f"{at}_set"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(both > 0 and both >= similar * (len(a) + len(b) - both))
            kept = batch.filter(pa.array(ok, pa.bool_()))
            yield kept.select(["u", "v"])

    kind = dict(docs.dtypes)["doc_id"]
    return arrow_batches(pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "u_set", "v_set"), scan, f"u {kind}, v {kind}")


def similar_links(docs: DataFrame, size: int = 5, similar: float = 0.8, told: bool | None = None) -> DataFrame:
    """(u, v), structs (doc_id, tag), of texts whose ``size``-word shingle sets have a Jaccard similarity of at least ``similar``.

    Every such pair is in the result or joined by a path of others that are. A text is a
    doc_id and, where doc_ids are repeated (``told``), the hash of its text.
    """
    known = distinct_texts(docs, repeats(docs) if told is None else told).select(F.struct("doc_id", "tag").alias("doc_id"), "text")
    marked = materialise(prefixes(known, size, similar).where("n > 0"), "prefixes")
    entries = marked.select("doc_id", "n", F.posexplode("prefix").alias("pos", "key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = materialise(entries.join(sizes, "key"), "shared")
    first_look = materialise(print_pairs(marked).union(hub_pairs(shared, similar)).distinct(), "candidates")
    found = materialise(verified(known, first_look, size, similar), "found")
    further = materialise(open_pairs(shared, components(found), similar), "further")
    release(shared, marked)
    return found.union(verified(known, further, size, similar))


def drop_near(docs: DataFrame, size: int = 5, similar: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group of similar texts, the least (doc_id, text hash).

    A group is a connected component of similar pairs. Rows without doc_id, and null or
    blank texts, are in no group and stay; rows that repeat doc_id and text stay or go together,
    rows that repeat the doc_id alone are texts of their own; doc_ids may be numbers or
    strings; an empty table gives an empty result.
    """
    told = repeats(docs)
    gone = components(similar_links(docs, size, similar, told)).where("node <> root").select(F.col("node.doc_id").alias("gone_id"), F.col("node.tag").alias("gone_tag"))
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(gone, (F.col("row.doc_id") == F.col("gone_id")) & (text_tag("row.text", told) == F.col("gone_tag")), "left_anti").select("row.*")
