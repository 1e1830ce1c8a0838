"""Sources: records, manifests, chapters, glossaries, audio, media probes and the job queue."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from cuelattice.functions import text as T
from cuelattice.operators.records import last_wins
from cuelattice.sources import schemas


def records(spark: SparkSession, path: str, schema: str, key: str = "id", missing_ok: bool = False) -> DataFrame:
    """Keyed JSON lines, blank lines skipped, last record of a key wins; malformed lines fail.

    The order of lines is theirs within a file, and that of file names across files.
    """
    try:
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line"))
    except AnalysisException:
        if not missing_ok:
            raise
        return spark.createDataFrame([], schema).withColumn("first_pos", F.lit(None).cast("struct<_file:string,_line:bigint>"))
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    rows = lines.where(F.trim("value") != "").select(parsed.alias("r"), F.struct("_file", "_line").alias("_seq")).select("r.*", "_seq")
    return last_wins(rows, key, "_seq")


def manifest(spark: SparkSession, path: str, book: Column | None = None) -> DataFrame:
    """Chunks of a manifest with ``chunk_pos``, the only authoritative order."""
    rows = spark.read.schema(schemas.MANIFEST).option("multiLine", True).option("mode", "FAILFAST").json(path)
    book = F.col("audio") if book is None else book
    return rows.select(book.alias("book_id"), F.posexplode("chunks").alias("chunk_pos", "chunk")).select("book_id", "chunk_pos", "chunk.*")


def chapters(spark: SparkSession, path: str, rate: int = 16_000) -> DataFrame:
    """Chapters of a probe with frames and title; a probe without the key fails."""
    rows = spark.read.schema(schemas.PROBE).option("multiLine", True).json(path)
    listed = F.when(F.col("chapters").isNull(), F.raise_error(F.lit("the probe has no chapters"))).otherwise(F.col("chapters"))
    return described_chapters(rows.select(F.explode(listed).alias("c")), rate)


def described_chapters(rows: DataFrame, rate: int = 16_000) -> DataFrame:
    """chapter_id, chapter_title, start_frame, end_frame from rows of a chapter struct ``c``; other columns stay."""
    rest = [x for x in rows.columns if x != "c"]
    return rows.select(
        *rest,
        F.col("c.id").alias("chapter_id"),
        T.chapter_title(F.col("c.tags"), F.col("c.id")).alias("chapter_title"),
        T.frames(F.col("c.start_time").cast("double"), rate).alias("start_frame"),
        T.frames(F.col("c.end_time").cast("double"), rate).alias("end_frame"),
    )


def glossary(spark: SparkSession, path: str | None) -> str:
    """A small optional text, stripped; empty if there is none."""
    if not path:
        return ""
    row = spark.read.text(path, wholetext=True).first()
    return row["value"].strip() if row else ""


def audio(spark: SparkSession, path: str, rate: int = 16_000, block: int = 1 << 20) -> DataFrame:
    """(path, start_frame, samples array<float>) blocks of 16-bit WAV files; anything but mono at ``rate`` fails."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"]):
                with wave.open(io.BytesIO(content)) as w:
                    if w.getnchannels() != 1 or w.getframerate() != rate or w.getsampwidth() != 2:
                        raise ValueError(f"expected mono {rate} Hz 16-bit, got {w.getnchannels()} channels at {w.getframerate()} Hz")
                    for at in range(0, w.getnframes(), block):
                        w.setpos(at)
                        data = np.frombuffer(w.readframes(min(block, w.getnframes() - at)), dtype="<i2").astype(np.float32) / 32768
                        yield pd.DataFrame({"path": [name], "start_frame": [at], "samples": [data]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(scan, "path string, start_frame long, samples array<float>")


#: Names of jobs and outputs, environment variables: whole-string patterns.
SAFE_NAME, VARIABLE = r"\A[A-Za-z0-9][A-Za-z0-9._-]*\z", r"\A[A-Za-z_][A-Za-z0-9_]*\z"


def _resolved(value: Column, root: str) -> Column:
    return F.when(F.startswith(value, F.lit("/")), value).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), value))


def described_jobs(jobs: DataFrame, root: str) -> DataFrame:
    """Jobs with defaults, resolved paths and ``violation`` (null if there is none): the first rule that is broken."""
    empty = lambda c: F.col(c).isNull() | (T.strip(F.col(c)) == "")
    broken = lambda c: F.coalesce(F.rlike(T.strip(F.col(c)), F.lit(r"[\t\r\n]")), F.lit(False))
    basename = F.coalesce(T.strip(F.col("output_basename")), T.strip(F.col("id")))
    times = jobs.groupBy(T.strip(F.col("id")).alias("_id")).agg(F.count("*").alias("_times"))
    rows = jobs.join(times, T.strip(F.col("id")) == F.col("_id"), "left")
    violation = (
        F.when(empty("id"), "id must be a non-empty string")
        .when(broken("id"), "id must not contain tabs or newlines")
        .when(~F.rlike(T.strip(F.col("id")), F.lit(SAFE_NAME)), "id has unsafe characters")
        .when(F.col("_times") > 1, "duplicate job id")
        .when(empty("source"), "source must be a non-empty string")
        .when(~F.rlike(basename, F.lit(SAFE_NAME)), "output_basename has unsafe characters")
    )
    path = lambda c, default: _resolved(F.coalesce(T.strip(F.col(c)), F.concat(F.lit(default), T.strip(F.col("id")))), root)
    glossary_file = F.when(F.coalesce(T.strip(F.col("glossary_file")), F.lit("")) != "", _resolved(T.strip(F.col("glossary_file")), root))
    return rows.select(
        T.strip(F.col("id")).alias("id"), _resolved(T.strip(F.col("source")), root).alias("source"), path("work_dir", "work/").alias("work_dir"),
        path("output_dir", "output/").alias("output_dir"), basename.alias("basename"), glossary_file.alias("glossary"), violation.alias("violation"),
    )


def queue(spark: SparkSession, path: str, root: str) -> tuple[DataFrame, dict, dict]:
    """Jobs, editor and runtime settings of a queue file. Raises at the first violation; a queue is small."""
    row = spark.read.schema(schemas.CONFIG).option("multiLine", True).option("mode", "FAILFAST").json(path).first()
    if row is None or not row["jobs"]:
        raise ValueError("config.jobs must be a non-empty array")
    jobs = described_jobs(spark.createDataFrame(row["jobs"], schemas.JOB), root)
    bad = jobs.where("violation IS NOT NULL").first()
    if bad:
        raise ValueError(f"{bad['violation']}: {bad['id']}")
    editor = (row["editor"].asDict() if row["editor"] else {}) or {}
    editor = {"script": editor.get("script"), "model": editor.get("model"), "base_url_env": editor.get("base_url_env") or "EDITOR_BASE_URL"}
    runtime = (row["runtime"].asDict() if row["runtime"] else {}) or {}
    runtime = {k: d if runtime.get(k) is None else runtime[k] for k, d in (("qwen_batch_size", 2), ("whisper_batch_size", 2), ("whisper_input_group_size", 1))}
    if min(runtime.values()) < 1:
        raise ValueError("runtime batch sizes must be positive integers")
    import re

    if not re.fullmatch(VARIABLE.replace(r"\A", "").replace(r"\z", ""), editor["base_url_env"]):
        raise ValueError("editor.base_url_env must be a valid environment variable name")
    return jobs, editor, runtime


def verification(probes: DataFrame, source_duration: Column) -> DataFrame:
    """The verification report from probe rows (schemas.MEDIA)."""
    return probes.select(
        source_duration.cast("double").alias("source_duration"), F.col("format.duration").cast("double").alias("output_duration"),
        F.col("format.size").cast("long").alias("output_size"), "streams", F.size("chapters").alias("chapter_count"),
    )
