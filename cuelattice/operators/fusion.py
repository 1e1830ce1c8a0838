"""Word timing: repair of missing times, anchors between two transcripts, fused words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Candidates on either side that vote, largest offset (s), largest distance from the vote (s), longest word (s).
NEIGHBOURS, MAX_OFFSET, MAX_SPREAD, MAX_WORD = 4, 4.0, 0.8, 1.5


def repair_times(words: DataFrame, duration: Column) -> DataFrame:
    """Words without a start go; an open end is the chunk's."""
    return words.where(F.col("start").isNotNull()).withColumn("end", F.coalesce("end", duration))


def absolute(offset: Column, time: Column) -> Column:
    return F.round(offset + time, 3)


def compose(a_to_q: DataFrame, q_to_w: DataFrame, key: list[str]) -> DataFrame:
    """(key, a, q, w) where both maps have a link: rows (key, i, j) joined on the middle index."""
    left = a_to_q.select(*key, F.col("i").alias("a_idx"), F.col("j").alias("q_idx"))
    right = q_to_w.select(*key, F.col("i").alias("q_idx"), F.col("j").alias("w_idx"))
    return left.join(right, [*key, "q_idx"])


def anchors(candidates: DataFrame, key: list[str], index: str = "a_idx", within: Sequence[str] = ()) -> DataFrame:
    """Candidates with ``accepted``: the own offset is plausible and near the upper median of plausible neighbours.

    The neighbourhood is four candidates to either side, not four words, and of the same values of ``within``.
    """
    near = W.partitionBy(*key, *within).orderBy(index).rowsBetween(-NEIGHBOURS, NEIGHBOURS)
    plausible = F.abs("delta") <= MAX_OFFSET
    votes = F.sort_array(F.collect_list(F.when(plausible, F.col("delta"))).over(near))
    rows = candidates.withColumn("votes", votes).withColumn("median", F.expr("try_element_at(votes, cast(size(votes) div 2 + 1 AS int))"))
    return rows.withColumn("accepted", F.coalesce(plausible & (F.abs(F.col("delta") - F.col("median")) <= MAX_SPREAD), F.lit(False))).drop("votes")


def accepted(words: DataFrame, key: list[str], index: str = "pos") -> DataFrame:
    """Words with ``accepted`` of ``anchors`` where they have a ``delta`` and a key; null where they are no candidate.

    Words with and without a delta are parts of their own in one partition, so that no
    candidate is taken out of the words and joined to them again.
    """
    known = F.col("delta").isNotNull()
    for k in key:
        known = known & F.col(k).isNotNull()
    rows = anchors(words.withColumn("known", known), key, index, within=["known"])
    return rows.withColumn("accepted", F.when(F.col("known"), F.col("accepted"))).drop("known", "median")


def fuse(words: DataFrame, key: list[str], pos: str = "pos") -> DataFrame:
    """Start and end of every word, from rows with start, end, w_start, w_end and accepted (null: no candidate).

    Starts never fall; an accepted anchor may widen a word; an end stops at the next
    start and a word lasts 1.5 s at most. Running maxima and one lead, one shuffle.
    """
    order = W.partitionBy(*key).orderBy(pos)
    taken = F.coalesce(F.col("accepted"), F.lit(False))
    first = F.when(taken, F.least("start", "w_start")).otherwise(F.col("start"))
    last = F.when(taken, F.greatest("end", "w_end")).otherwise(F.col("end"))
    rows = words.withColumn("new_start", F.round(F.max(first).over(order.rowsBetween(W.unboundedPreceding, 0)), 3))
    rows = rows.withColumn("wide", F.greatest(F.round(last, 3), F.col("new_start"))).withColumn("next", F.lead("new_start").over(order))
    cap = F.col("new_start") + MAX_WORD
    upper = F.when(F.col("next") > F.col("new_start"), F.least(cap, F.col("next"))).otherwise(cap)
    return rows.withColumn("new_end", F.round(F.least("wide", upper), 3)).drop("wide", "next")
