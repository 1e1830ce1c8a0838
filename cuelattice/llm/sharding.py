"""Sharding along a Hilbert curve over document metadata.

Each dimension is quantised by its own quantiles (one aggregate over the table,
``dimensions`` x 2^bits numbers to the driver), the levels give a cell of the
curve, and the rows in curve order are cut into runs whose counts differ by one
at most. Neighbours on the curve are close in every dimension, so each shard
spans short ranges of all of them and min/max statistics prune files.

The global position of a row is a counting sort, not one sorted partition: rows
are counted by (cell, sub), where ``sub`` is a hash of the identifier that splits
cells which a hot source fills; counts are summed along the curve in three levels
(at most 4,096 stretches, the cells of one stretch, the subs of one cell), and rows
are numbered within (cell, sub). Only identifier, size, checksum and cell are shuffled, never
texts. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cuelattice.llm.common import partitions, whole_text

#: Bits of each dimension; four dimensions make 2^20 cells.
BITS = 5
#: Stretches of the curve in the first level of the sums.
STRETCH_BITS = 12


def order_number(column: str, kind: str, shared: int = 0) -> Column:
    """A number that sorts like the column: numbers as they are, strings by the seven bytes after the first ``shared``."""
    if kind != "string":
        return F.col(column).cast("double" if kind in ("double", "float") else "long")
    head = F.hex(F.substring(F.col(column).cast("binary"), shared + 1, 7))
    return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("long")


def shared_bytes(least: str | None, most: str | None) -> int:
    """The length of the prefix that all values between the least and the greatest have."""
    a, b = (least or "").encode(), (most or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def hilbert(levels: str, n: int, bits: int) -> str:
    """SQL for the curve index of an array column of ``n`` levels of ``bits`` bits (transposed form, untangled bit by bit)."""
    steps = ", ".join(str(1 << b) for b in range(bits - 1, 0, -1)) or "1"
    axes = ", ".join(map(str, range(n)))
    undone = f"""aggregate(array({steps}), {levels}, (x, q) -> aggregate(array({axes}), x, (y, i) ->
        transform(y, (v, k) -> CASE WHEN (y[i] & q) <> 0 THEN IF(k = 0, v ^ (q - 1), v)
                                    WHEN i > 0 AND (k = 0 OR k = i) THEN v ^ ((y[0] ^ y[i]) & (q - 1)) ELSE v END)))"""
    gray = f"transform({undone}, (v, k) -> v)"
    # one-element arrays stand in for local names, so that nothing is worked out twice
    return f"""transform(transform(array({gray}),
            u -> transform(u, (v, k) -> aggregate(slice(u, 1, k + 1), 0, (s, w) -> s ^ w))),
            g -> aggregate(sequence({bits * n - 1}, 0), 0L, (acc, p) -> acc * 2 +
                (shiftright(g[{n - 1} - p % {n}] ^ aggregate(array({steps}), 0, (t, q) -> IF((g[{n - 1}] & q) <> 0, t ^ (q - 1), t)), p div {n}) & 1)))[0]"""


def level(value: Column, edges: list) -> Column:
    """How many edges the value has reached; 0 for null."""
    if not edges:
        return F.lit(0)
    return F.coalesce(F.when(value.isNotNull(), F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= value))), F.lit(0))


def cells(rows: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """``rows`` with ``cell``: the curve index of the quantised dimensions. Null is level 0, like the least value.

    A string counts by the seven bytes after the prefix that all values of its column share;
    values that agree so far have one level. Levels come from approximate quantiles over all
    rows, exact to one row in 10,000, within which another order of merging may move an edge.
    """
    kinds = dict(rows.dtypes)
    texts = [c for c in dimensions if kinds[c] == "string"]
    ends = rows.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(texts) for n, f in (("min", F.min), ("max", F.max))]).first() if texts else None
    shared = {c: shared_bytes(ends[f"min_{i}"], ends[f"max_{i}"]) for i, c in enumerate(texts)}
    cuts = 1 << bits
    share = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    found = rows.agg(*[F.percentile_approx(order_number(c, kinds[c], shared.get(c, 0)), share, 10_000).alias(f"d{i}") for i, c in enumerate(dimensions)]).first()
    levels = [level(order_number(c, kinds[c], shared.get(c, 0)), sorted(set(found[f"d{i}"] or []))) for i, c in enumerate(dimensions)]
    return rows.withColumn("levels", F.array(*levels)).withColumn("cell", F.expr(hilbert("levels", len(dimensions), bits))).drop("levels")


def shard(docs: DataFrame, shards: int = 16, dimensions: tuple[str, ...] = ("source", "lang", "n_chars", "doc_id"), bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law (``rows``), shard, slot, grown_shard (null), cell of every row.

    Sizes are UTF-8 bytes plus 1; a null text has size 1 and the checksum of no bytes.
    A null in a dimension counts as its least value; equal rows are rows of their own
    and take neighbouring slots; fewer rows than shards leave the last shards empty;
    an empty table gives an empty result; columns beside text and dimensions are not read.
    """
    names = list(dict.fromkeys(["doc_id", "text", *dimensions]))
    rows = cells(docs.select(*names), list(dimensions), bits)
    subs = max(16, partitions(docs.sparkSession))
    shift = max(0, bits * len(dimensions) - STRETCH_BITS)
    rows = rows.select(
        "doc_id",
        (F.octet_length(whole_text()) + 1).cast("long").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
        "cell",
        F.pmod(F.xxhash64("doc_id"), F.lit(subs)).alias("sub"),
    )
    counts = rows.groupBy("cell", "sub").agg(F.count("*").alias("n"))
    in_cells = counts.groupBy("cell").agg(F.sum("n").alias("n")).withColumn("stretch", F.shiftright("cell", shift))
    before = lambda *by: F.coalesce(F.sum("n").over(W.partitionBy(by[0]).orderBy(by[1]).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    whole = W.orderBy("stretch")  # at most 2^STRETCH_BITS rows
    starts = (
        in_cells.groupBy("stretch")
        .agg(F.sum("n").alias("n"))
        .select("stretch", (F.sum("n").over(whole) - F.col("n")).alias("start"), F.sum("n").over(whole.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("total"))
    )
    by_cell = in_cells.select("cell", "stretch", before("stretch", "cell").alias("inner")).join(starts, "stretch").select("cell", (F.col("inner") + F.col("start")).alias("start"), "total")
    offsets = counts.select("cell", "sub", before("cell", "sub").alias("inner")).join(by_cell, "cell").select("cell", "sub", (F.col("inner") + F.col("start")).alias("base"), "total")
    placed = (
        rows.withColumn("rn", F.row_number().over(W.partitionBy("cell", "sub").orderBy("doc_id", "text_crc32", "size")))
        .join(offsets, ["cell", "sub"])
        .withColumn("position", F.col("base") + F.col("rn") - 1)
    )
    few, more = F.expr(f"total div {shards}"), F.expr(f"total % {shards}")
    placed = placed.withColumn("few", few).withColumn("edge", more * (few + 1)).withColumn("more", more)
    long_run = F.col("position") < F.col("edge")
    number = F.when(long_run, F.expr("position div (few + 1)")).otherwise(F.col("more") + F.expr("(position - edge) div greatest(few, 1)"))
    slot = F.when(long_run, F.expr("position % (few + 1)")).otherwise(F.expr("(position - edge) % greatest(few, 1)"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        number.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "cell",
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, **options) -> None:
    """The table itself in folders ``shard=N``, rows in slot order, each as a struct ``row`` so that no column's name clashes.

    ``docs`` needs unique doc_ids (one null among them counts as an identifier); an empty table writes an empty one.
    """
    plan = shard(docs, shards, **options).select(F.col("doc_id").alias("key"), "shard", "slot")
    rows = docs.select(F.struct("*").alias("row")).join(plan, F.col("row.doc_id").eqNullSafe(F.col("key"))).select("row", "shard", "slot")
    rows.repartitionByRange(shards * 4, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
