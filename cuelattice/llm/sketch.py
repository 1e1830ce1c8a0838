"""Threshold-scaled document sketches.

A text's shingles are its runs of 16 code points (a shorter text is one shingle).
Every shingle hash below a fixed fraction of the hash range is retained, whatever
the length, so sketches of very unequal texts still give containment, and the
sketch of a union is the union of sketches. A fingerprint is the text's XXH64 (16
hex digits), a colon and the retained hashes (ascending, 8 hex digits each).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cuelattice.llm.common import arrow_batches, partitions, whole_text
from cuelattice.llm.sharding import order_number

#: Code points of a shingle (a power of two) and the retained share of hashes, one in SCALE.
SHINGLE, SCALE = 16, 16
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def retained(text: str, scale: int = SCALE) -> np.ndarray:
    """The sketch: upper halves of the retained hashes, ascending and distinct."""
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if not len(h):
        return np.empty(0, dtype=np.uint32)
    if len(h) < SHINGLE:
        h = np.array([xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))], dtype=np.uint64)
    else:
        width, base = 1, _BASE
        while width < SHINGLE:  # a run of 2w is two runs of w
            h = h[:-width] * np.uint64(base) + h[width:]
            width, base = 2 * width, base * base & _MASK
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return np.unique((h[h < np.uint64((1 << 64) // scale)] >> np.uint64(32)).astype(np.uint32))


def fingerprint(text: str, sketch: np.ndarray) -> str:
    return xxhash.xxh64_hexdigest(text.encode("utf-8", "surrogatepass")) + ":" + sketch.astype(">u4").tobytes().hex()


def parse(mark: str) -> tuple[str, np.ndarray]:
    """The digest and the sketch of a fingerprint."""
    digest, _, rest = mark.partition(":")
    return digest, np.frombuffer(bytes.fromhex(rest), dtype=">u4").astype(np.uint32)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    return np.union1d(a, b)


def likeness(a: np.ndarray, b: np.ndarray, equal: bool) -> float:
    """Jaccard estimate. Two empty sketches tell nothing: then 1 if the digests are equal, else 0."""
    if not len(a) and not len(b):
        return float(equal)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated share of a's shingles that b has; 0 for an empty sketch."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 0.0


def edited(text: str, following: str) -> str:
    """The last quarter (floor) replaced by the start of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows (bucket, copy, key, doc_id, text), hash-partitioned by bucket and sorted: after each row comes its follower.

    Identifiers are cut at approximate quantiles into 4 x partitions buckets; the
    first row of every bucket is copied to the end of the bucket before it, and the
    very first to the end of the last. So a follower needs no global order and every
    text is shuffled once.
    """
    spark = docs.sparkSession
    n = 4 * partitions(spark)
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.coalesce(order_number("doc_id", kind).cast("long"), F.lit((1 << 63) - 1)).alias("key"), "doc_id", whole_text().alias("text"))
    edges = rows.agg(F.percentile_approx("key", F.array(*[F.lit(i / n) for i in range(1, n)]), 20 * n)).first()[0]
    edges = sorted(set(edges or []))
    steps = ", ".join(str(1 << b) for b in range(max(1, len(edges)).bit_length() - 1, -1, -1))
    found = f"aggregate(array({steps}), 0, (p, s) -> IF(p + s <= {len(edges)} AND element_at(edges, least(p + s, {max(1, len(edges))})) <= key, p + s, p))"
    rows = rows.withColumn("edges", F.array(*[F.lit(e) for e in edges]) if edges else F.array(F.lit(0).cast("long"))).withColumn("bucket", F.expr(found)).drop("edges")
    firsts = [(r["bucket"], r["key"]) for r in rows.groupBy("bucket").agg(F.min("key").alias("key")).orderBy("bucket").collect()]  # at most n rows
    before = [(key, firsts[i - 1][0]) for i, (_, key) in enumerate(firsts)]
    before = spark.createDataFrame(before, "first_key long, before int")
    places = F.when(F.col("before").isNull(), F.array(F.struct("bucket", F.lit(False).alias("copy")))).otherwise(
        F.array(F.struct("bucket", F.lit(False).alias("copy")), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("copy")))
    )
    placed = rows.join(F.broadcast(before), F.col("key") == F.col("first_key"), "left").withColumn("place", F.explode(places))
    placed = placed.select("place.bucket", "place.copy", "key", "doc_id", "text")
    return placed.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "copy", "key", F.col("doc_id").asc_nulls_last(), "text")


def fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """One row per document with its fingerprint, its edited text's, and the likenesses.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (Jaccard estimates), inside_edited, inside_next (containment
    of the document's sketch in the other's). The follower is the next row by doc_id, then text;
    null doc_ids come last; string doc_ids follow one another by their bytes; after the last comes the first, so a single document
    follows itself. A null text counts as empty: no shingles, equal only to its like.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = None
        for batch in batches:
            out: list[tuple] = []
            for bucket, copy, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if copy and (pending is None or pending[0] != bucket):
                    continue  # a further row with the key of the first copy
                sketch = retained(text, scale)
                mark = fingerprint(text, sketch)
                if pending is not None:
                    out.append(_row(*pending, text, sketch, mark, scale))
                pending = None if copy else (bucket, doc_id, text, sketch, mark)
            yield _batch(out, batch.schema.field(2).type)
        if pending is not None:
            raise RuntimeError(f"no follower for the document {pending[1]}")

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, inside_edited double, inside_next double"
    return arrow_batches(neighbours(docs).select("bucket", "copy", "doc_id", "text"), scan, schema)


def _row(bucket, doc_id, text, sketch, mark, following, next_sketch, next_mark, scale) -> tuple:
    other = edited(text, following)
    other_sketch = sketch if other == text else retained(other, scale)
    other_mark = fingerprint(other, other_sketch)
    return (
        doc_id,
        len(text),
        hashlib.sha256(other.encode("utf-8")).hexdigest(),
        mark,
        other_mark,
        likeness(sketch, other_sketch, mark == other_mark),
        likeness(sketch, next_sketch, mark == next_mark),
        containment(sketch, other_sketch),
        containment(sketch, next_sketch),
    )


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 9
    types = [kind, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "inside_edited", "inside_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
