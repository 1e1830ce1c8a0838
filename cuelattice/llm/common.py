"""Helpers that the text operators share: inputs, scratch tables, Arrow batches."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the text contracts, as a regular-expression class (the same in Java, Python and DuckDB).
SPACES = r"[\x20\x09-\x0D]+"
#: Rows and bytes of the batches that a function works on at once.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parted(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows and, where a batch has several rows, ``size`` bytes."""
    for batch in batches:
        todo = [batch.slice(at, rows) for at in range(0, batch.num_rows, rows)][::-1]
        while todo:
            some = todo.pop()
            if some.num_rows > 1 and some.nbytes > size:
                half = some.num_rows // 2
                todo += [some.slice(half), some.slice(0, half)]
            else:
                yield some


def arrow_batches(df: DataFrame, scan: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``df.mapInArrow(scan, schema)`` whose batches are bounded in rows and bytes in the worker.

    What crosses from the engine is bounded by its own settings (10,000 rows and 64 MB); no
    setting of the session is changed.
    """
    return df.mapInArrow(lambda batches: scan(parted(batches, rows)), schema)


def repeats(docs: DataFrame) -> bool:
    """Whether several rows share a doc_id. Only identifiers are shuffled."""
    return not docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def text_tag(text: str, told: bool) -> Column:
    """What tells rows of one doc_id apart: the hash of the text, or 0 where no doc_id is repeated (not ``told``)."""
    return F.xxhash64(text) if told else F.lit(0).cast("long")


def distinct_texts(docs: DataFrame, told: bool) -> DataFrame:
    """doc_id, tag, text of every row with a doc_id; rows that repeat doc_id and text are one.

    Only rows that are repeated are shuffled with their texts.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", text_tag("text", told).alias("tag"), "text")
    if not told:
        return rows
    times = rows.groupBy(F.col("doc_id").alias("twice_id"), F.col("tag").alias("twice_tag")).agg(F.count("*").alias("times")).where("times > 1")
    twice = materialise(times.drop("times"), "twice")
    same = (F.col("doc_id") == F.col("twice_id")) & (F.col("tag") == F.col("twice_tag"))
    # written first, so that one of each is taken before anything meets by its key
    again = materialise(rows.join(twice, same, "left_semi"), "repeated")
    return rows.join(twice, same, "left_anti").union(again.groupBy("doc_id", "tag").agg(F.any_value("text").alias("text")))


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only where it is unset and Spark runs in one process."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = getattr(spark.sparkContext, "_cuelattice_scratch", None) or tempfile.mkdtemp(prefix="cuelattice-")
        spark.sparkContext._cuelattice_scratch = found
    return found.rstrip("/")


#: Shuffle files of a finished write go at once instead of when the driver's memory is next swept.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts lineage and keeps a costly step from running twice. The files are
    replicated like any other of that store, so that a lost executor loses none. They go with
    ``release``, or at the end of the process.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    _written.add(path)
    if len(_written) == 1:
        atexit.register(_remove_all, spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._cuelattice_path = path
    return out


#: Folders of this process that are still there.
_written: set[str] = set()


def release(*tables: DataFrame) -> None:
    """Delete what ``materialise`` wrote for these; nothing that is still to run may read them."""
    for table in tables:
        _remove(table.sparkSession, table._cuelattice_path)
        _written.discard(table._cuelattice_path)


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _remove_all(spark: SparkSession) -> None:
    try:
        for path in sorted(_written):
            _remove(spark, path)
    except Exception:  # noqa: BLE001  the session may have ended before the process; the folder is scratch
        pass


def whole_text(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def normal_spaces(text: Column) -> Column:
    """Each run of white space replaced by one space."""
    return F.regexp_replace(text, SPACES, " ")


def crc32(data: bytes) -> int:
    """Unsigned CRC-32."""
    return zlib.crc32(data) & 0xFFFFFFFF
