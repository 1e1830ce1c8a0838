"""Surface tokens (with case and punctuation) put back on aligned items by character ranges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelattice.functions.text import normal_token


def restore(surfaces: DataFrame, items: DataFrame, key: str = "id") -> DataFrame:
    """(key, pos, text, start, end, restored) of every word.

    ``surfaces`` has (key, pos, text), ``items`` (key, pos, text, start, end). A chunk is
    restored if both sides have the same characters, at least one, and every surface token
    overlaps an item; it takes the first item's start and the last one's end. Otherwise its
    items come back as they are, as do items without a key. A token without letters or digits
    has an empty range, overlaps nothing at an item's edge, and so leaves its chunk unrestored.

    Both sides are dealt by chunk, unless they are so already, and meet chunk by chunk in
    Arrow tables. Items and tokens lie on one line of characters: a token asks for the item
    at its first and at its last character, which is the last item that begins there or
    before. So the work is in proportion to the words, and a task holds one chunk.
    """
    kinds = dict(items.dtypes)
    side = lambda d, *more: d.select(F.col(key).alias(key), F.col("pos").cast("long").alias("pos"), "text", *more, normal_token(F.col("text")).alias("norm")).groupBy(key)
    schema = f"`{key}` {kinds[key]}, pos long, text string, start {kinds['start']}, end {kinds['end']}, restored boolean"
    return side(surfaces).cogroup(side(items, "start", "end")).applyInArrow(_restored, schema)


def _restored(tokens: pa.Table, items: pa.Table) -> pa.Table:
    """One chunk: its tokens with the items' times, or its items."""
    tokens, items = tokens.sort_by("pos"), items.sort_by("pos")
    times = _times(tokens, items)
    names = [*items.schema.names[:5], "restored"]
    if times is None:
        return pa.Table.from_arrays([*items.columns[:5], pa.array(np.zeros(len(items), bool))], names=names)
    return pa.Table.from_arrays([*tokens.columns[:3], *times, pa.array(np.ones(len(tokens), bool))], names=names)


def _times(tokens: pa.Table, items: pa.Table) -> tuple[pa.ChunkedArray, pa.ChunkedArray] | None:
    """Start and end of every token; None if the chunk cannot be restored."""
    if not len(tokens) or not len(items) or tokens.column(0).null_count or tokens["norm"].null_count:
        return None
    letters = "".join(tokens["norm"].to_pylist())
    if not letters or letters != "".join(n or "" for n in items["norm"].to_pylist()):
        return None
    items = items.filter(pc.greater(pc.binary_length(items["norm"]), 0))
    (lo, hi), (item_lo, item_hi) = _line(tokens), _line(items)
    empty = lo == hi  # such a token asks for the item around its place
    first, last = (np.searchsorted(item_lo, at, side="right") - 1 for at in (np.where(empty, lo - 1, lo), hi - 1))
    if (empty & ((first < 0) | (item_hi[first] <= hi))).any():
        return None
    return items["start"].take(pa.array(first)), items["end"].take(pa.array(last))


def _line(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Where the normal form of every row begins and ends on the line of characters."""
    size = pc.binary_length(rows["norm"]).to_numpy().astype(np.int64)
    hi = np.cumsum(size)
    return hi - size, hi
