"""Keyed records: resume, completeness, last-wins, retry and job status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(records: DataFrame, key: str, seq: str) -> DataFrame:
    """One row per key: the values of its last record, and ``first_pos``, where it first came."""
    rest = [c for c in records.columns if c != key]
    return records.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("last"), F.min(seq).alias("first_pos")).select(key, "last.*", "first_pos")


def done_ids(checkpoint: DataFrame, key: str = "id") -> DataFrame:
    return checkpoint.select(key).distinct()


def pending(chunks: DataFrame, checkpoint: DataFrame, key: str = "id") -> DataFrame:
    """Chunks without a record."""
    return chunks.join(done_ids(checkpoint, key), key, "left_anti")


def missing(chunks: DataFrame, records: DataFrame, key: str, by: list[str], pos: str) -> DataFrame:
    """Per group how many chunks lack a record, and the first of them."""
    return pending(chunks, records, key).groupBy(*by).agg(F.count("*").alias("missing"), F.min_by(key, pos).alias("first_missing"))


def require_complete(chunks: DataFrame, records: DataFrame, key: str = "id", pos: str = "chunk_pos") -> None:
    """Raise with the count and the first missing id, as a guard before strict joins."""
    r = pending(chunks, records, key).agg(F.count("*").alias("n"), F.min_by(key, pos).alias("first")).first()
    if r["n"]:
        raise ValueError(f"missing {r['n']} records; first: {r['first']}")


def is_fallback(method: Column) -> Column:
    return F.contains(F.coalesce(F.lower(method), F.lit("")), F.lit("fallback"))


def purge_fallbacks(records: DataFrame, method: str = "method") -> DataFrame:
    """Records without those of a failed edit, so that a rerun takes them up again."""
    return records.where(~is_fallback(F.col(method)))


def duplicate_ids(jobs: DataFrame, key: str = "id") -> DataFrame:
    return jobs.groupBy(key).agg(F.count("*").alias("times")).where("times > 1")


def completeness(chunks: DataFrame, records: DataFrame, by: str, key: str) -> DataFrame:
    """Chunks, distinct recorded ids, record lines and whether all are there, per group. Distinct ids decide: a repeated line hides no gap."""
    have = records.groupBy(key).agg(F.count("*").alias("lines"))
    joined = chunks.select(by, key).join(have, key, "left")
    return joined.groupBy(by).agg(
        F.count("*").alias("chunks"),
        F.count("lines").alias("recorded"),
        F.coalesce(F.sum("lines"), F.lit(0)).cast("long").alias("lines"),
        (F.count("*") == F.count("lines")).alias("complete"),
    )


def unfinished(jobs: DataFrame, status: DataFrame, key: str = "id") -> DataFrame:
    """Jobs without a completion row."""
    return jobs.join(status.select(key).distinct(), key, "left_anti")
