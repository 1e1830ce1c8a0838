"""Sinks: checkpoints, rendered captions, reports, hashes and completion rows.

Rendered files are ordered within a book. A book's lines go to one file by a hash
partition on the book and a sort within it, so many books are written by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cuelattice.operators import captions
from cuelattice.operators.records import purge_fallbacks


def append_records(rows: DataFrame, path: str) -> None:
    """New checkpoint files; a commit is all or nothing, and streaming readers see new files only."""
    rows.write.mode("append").json(path)


def write_records(rows: DataFrame, path: str, order: str = "first_pos") -> None:
    """A record set in first-seen order."""
    rows.sort(order).drop(order).write.mode("overwrite").json(path)


def write_manifest(chunks: DataFrame, path: str, audio: str, target: float = 210.0, search: float = 30.0, longest: float = 270.0) -> None:
    """One manifest of a book's chunks in ``chunk_pos`` order."""
    fields = [c for c in chunks.columns if c not in ("chunk_pos", "book_id")]
    listed = F.transform(F.sort_array(F.collect_list(F.struct("chunk_pos", F.struct(*fields).alias("c")))), lambda x: x["c"])
    head = [F.lit(v).alias(k) for k, v in (("audio", audio), ("sample_rate", 16_000), ("target_seconds", target), ("search_seconds", search), ("max_seconds", longest))]
    chunks.agg(listed.alias("chunks")).select(*head, "chunks").coalesce(1).write.mode("overwrite").json(path)


def write_blocks(blocks: DataFrame, path: str, book: str, position: str, column: str = "block", head: str | None = None) -> None:
    """Text files of blocks, one folder for each book, in order of position; ``head`` opens each book. Blocks end with a line break."""
    if head:
        top = blocks.select(book).distinct().select(book, F.lit(-1).cast(dict(blocks.dtypes)[position]).alias(position), F.lit(head).alias(column))
        blocks = top.union(blocks.select(book, position, column))
    rows = blocks.select(book, position, column).repartition(book).sortWithinPartitions(book, position)
    rows.select(book, F.regexp_replace(column, r"\n\z", "").alias(column)).write.mode("overwrite").partitionBy(book).text(path)


def write_transcripts(parts: DataFrame, path: str, book: str) -> None:
    """One text for each book from its parts (book, chunk_pos, part)."""
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_pos", "part"))), lambda p: p["part"]), "")
    parts.groupBy(book).agg(whole.alias("text")).write.mode("overwrite").partitionBy(book).text(path)


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of files."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def mark_complete(spark: SparkSession, path: str, job: str) -> None:
    """The job's completion row, written last."""
    spark.createDataFrame([(job,)], "id string").write.mode("append").parquet(path)


def purge(spark: SparkSession, source: str, target: str, schema: str) -> DataFrame:
    """A version of a checkpoint without failed edits, at a path of its own: the old one is the backup."""
    kept = purge_fallbacks(spark.read.schema(schema).json(source))
    kept.write.mode("errorifexists").json(target)
    return spark.read.schema(schema).json(target)


def write_named(lines: DataFrame, position: str, column: str, path: str) -> None:
    """One text file of exactly that name, from lines in order of position; a file of that name is replaced. For the outputs of a single book."""
    spark = lines.sparkSession
    folder = f"{path}.parts"
    lines.select(position, column).repartition(1).sortWithinPartitions(position).select(F.col(column).alias("value")).write.mode("overwrite").text(folder)
    jvm = spark.sparkContext._jvm
    parts, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(path)
    store = parts.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [f.getPath() for f in store.listStatus(parts) if f.getPath().getName().startswith("part-")]
    store.delete(target, False)
    if found:
        if not store.rename(found[0], target):
            raise OSError(f"cannot write {path}")
    else:
        store.create(target).close()
    store.delete(parts, True)


def write_book(cue: DataFrame, words: DataFrame, chunks: DataFrame, report: DataFrame, out: str, basename: str, book: str) -> None:
    """The files of one book: <basename>.en.srt, .en.vtt, .transcript.txt, .word_timestamps.json, subtitle_qc.json and SHA256SUMS of the captions."""
    spark = cue.sparkSession
    bare = lambda blocks: blocks.withColumn("block", F.regexp_replace("block", r"\n\z", ""))
    one = lambda position, text: spark.createDataFrame([(position, text)], "cue long, block string")
    write_named(bare(captions.srt_blocks(cue, book)), "cue", "block", f"{out}/{basename}.en.srt")
    write_named(one(-1, "WEBVTT\n").union(bare(captions.vtt_blocks(cue, book)).select(F.col("cue").cast("long"), "block")), "cue", "block", f"{out}/{basename}.en.vtt")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk_pos", "part"))), lambda p: p["part"]), "")
    write_named(captions.transcript_parts(chunks, book).groupBy(book).agg(whole.alias("text")), book, "text", f"{out}/{basename}.transcript.txt")
    last = F.lead("pos").over(W.partitionBy(book).orderBy("pos")).isNull()
    listed = words.select(F.col("pos").cast("long").alias("cue"), F.concat(F.lit("  "), F.to_json(F.struct("text", "start", "end")), F.when(last, "").otherwise(",")).alias("block"))
    write_named(one(-1, "[").union(listed).union(one((1 << 62), "]")), "cue", "block", f"{out}/{basename}.word_timestamps.json")
    metrics = [c for c in report.columns if c not in (book, "inverted_cues")]
    write_named(report.select(F.lit(0).alias("cue"), F.to_json(F.struct(*metrics), {"ignoreNullFields": "false"}).alias("block")), "cue", "block", f"{out}/subtitle_qc.json")
    sums = hashes(spark, f"{out}/{basename}.en.{{srt,vtt}}").select(F.regexp_extract("path", r"([^/]+)\z", 1).alias("name"), "sha256")
    write_named(sums.select("name", F.concat("sha256", F.lit("  "), F.col("name")).alias("line")), "name", "line", f"{out}/SHA256SUMS")
