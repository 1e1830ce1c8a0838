"""Exact duplicates by a content sort.

Normalised texts are range-partitioned at sampled splitters and sorted on disk
within each range; equal texts then lie side by side, neighbours are compared in
full, and the smallest identifier of a run stays. Every text is shuffled once.

A text that fills a large share of the table cannot be cut by its own bytes. Such
texts are found on a sample (their number is bounded by the sample rule, not by
the corpus), counted over all rows with map-side aggregation, their least and greatest
text are compared in full, and their rows enter the sort spread by identifier, so no range holds more than its part. Where the
sample misses one, the result is the same and only that range is longer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cuelattice.llm.common import normal_spaces, partitions, whole_text

#: Rows of the sample that looks for hot texts.
SAMPLE_ROWS = 50_000
#: Characters of a text that order it; texts with equal heads are ordered by digest and then in full.
HEAD = 64


def hot_texts(docs: DataFrame) -> list[str]:
    """SHA-256 of texts that hold over a quarter of a partition's share of the rows; at most 4 x partitions of them."""
    total = docs.count()
    if not total:
        return []
    share = min(1.0, SAMPLE_ROWS / total)
    least = max(16.0, share * total / (4 * partitions(docs.sparkSession)))
    seen = docs.sample(share, seed=7) if share < 1 else docs
    seen = seen.select(F.sha2(normal_spaces(whole_text()).cast("binary"), 256).alias("sha"))
    return [r["sha"] for r in seen.groupBy("sha").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("sha").collect()]


def _runs(docs: DataFrame, carry: bool) -> DataFrame:
    """The result columns of ``groups`` as ``g`` and, if ``carry``, the whole row as ``row``."""
    hot = hot_texts(docs)
    rows = docs.select("doc_id", *([F.struct("*").alias("row")] if carry else []), normal_spaces(whole_text()).alias("norm"))
    rows = rows.withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256)).withColumn("hot", F.col("sha").isin(hot) if hot else F.lit(False))
    # splitters sampled for the driver are heads and digests, not whole texts; the spread is no key where nothing is hot
    keys = ["head", "sha", *(["part"] if hot else [])]
    spread = F.when(F.col("hot"), F.xxhash64("doc_id")).otherwise(F.lit(0))
    ranges = rows.withColumn("head", F.substring("norm", 1, HEAD)).withColumn("part", spread).repartitionByRange(partitions(docs.sparkSession), *keys)
    run = W.partitionBy("norm", *keys)
    ordered = run.orderBy(F.col("doc_id").asc_nulls_last())
    runs = ranges.withColumn("rn", F.row_number().over(ordered)).withColumn("first_id", F.first("doc_id").over(ordered)).withColumn("n", F.count("*").over(run)).drop("norm", "head")
    if hot:
        # the least and the greatest text of a digest are compared in full; if they are equal, all are
        one = F.when(F.min("norm") == F.max("norm"), F.count("*")).otherwise(F.raise_error(F.lit("two texts have one SHA-256")).cast("long"))
        known = rows.where("hot").groupBy(F.col("sha").alias("hot_sha")).agg(F.min("doc_id").alias("hot_id"), one.alias("hot_n"))
        runs = (
            runs.join(F.broadcast(known), F.col("sha") == F.col("hot_sha"), "left")  # at most 4 x partitions rows
            .withColumn("first_id", F.when(F.col("hot"), F.col("hot_id")).otherwise(F.col("first_id")))
            .withColumn("n", F.when(F.col("hot"), F.col("hot_n")).otherwise(F.col("n")))
        )
    result = F.struct(
        "doc_id",
        F.col("first_id").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("rn") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return runs.select(*(["row"] if carry else []), result.alias("g"))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Texts are equal when identical after each run of white space became one space;
    null counts as empty. ``keep_id`` is the smallest doc_id of the group, null only
    if all are null. Rows that repeat one doc_id and text are rows of their own, of
    which one is kept. An empty table gives an empty result; other columns are not read.
    """
    return _runs(docs, carry=False).select("g.*")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``groups`` keeps, with all their columns, whatever these are called.

    Null texts are one group with empty and blank ones only as far as these are equal after
    normalisation; of rows that repeat a text, the one of the smallest doc_id stays, null
    doc_ids last; rows that repeat a doc_id with other texts all stay; an empty table gives
    an empty result.
    """
    return _runs(docs, carry=True).where("g.kept").select("row.*")
