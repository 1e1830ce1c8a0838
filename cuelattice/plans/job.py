"""One book from chapters to captions, and a queue of books.

Every relational stage is a table under the job's work folder, written once; a model
stage records its chunks in waves. A rerun reads what is there and goes on after it. The
completion row is written last, so a job without it is taken up again, and a job with it
is skipped.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cuelattice.functions import sequence as S
from cuelattice.functions import text as T
from cuelattice.operators import backends, captions, chunks, fusion, reconcile, records, surface
from cuelattice.sources import readers, sinks


@dataclass(frozen=True)
class Models:
    """The pluggable parts: two recognisers, an aligner (it finds the chunk's ``text``) and an editor with its label."""

    first: Callable[[], backends.Recogniser]
    second: Callable[[], backends.Recogniser]
    aligner: Callable[[], backends.Recogniser]
    editor: reconcile.Editor
    label: str


def spread_text(chunk: dict) -> tuple[str, list[tuple]]:
    """A stand-in aligner: the consensus tokens, spread evenly over the chunk."""
    words = str(chunk["text"]).split()
    step = chunk["duration"] / max(1, len(words))
    return chunk["text"], [(w, i * step, (i + 1) * step) for i, w in enumerate(words)]


STAND_INS = Models(backends.even_spread_factory, backends.even_spread_factory, lambda: spread_text, backends.second_candidate, "remote:stand-in")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def stage(spark: SparkSession, work: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The stage's table, made only if it was not completed before."""
    path = f"{work}/{name}"
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def restored(aligned: DataFrame) -> DataFrame:
    """Aligned chunks with the surface tokens of ``text`` in place of the items, where the characters agree."""
    items = aligned.select("id", F.posexplode("words").alias("pos", "w")).select("id", "pos", "w.*")
    tokens = aligned.select("id", F.posexplode(T.tokens(F.col("text"))).alias("pos", "text"))
    word = F.struct("pos", F.struct("text", "start", "end").alias("w"))
    done = surface.restore(tokens, items, "id").groupBy("id").agg(F.transform(F.sort_array(F.collect_list(word)), lambda x: x["w"]).alias("words"), F.bool_and("restored").alias("surface_restored"))
    rows = aligned.withColumn("raw_word_count", F.size("words")).withColumn("surface_word_count", F.size(T.tokens(F.col("text")))).drop("words").join(done, "id", "left")
    return rows.withColumn("surface_restored", F.coalesce("surface_restored", F.lit(False))).withColumn("words", F.coalesce("words", F.expr("cast(array() as array<struct<text:string,start:double,end:double>>)")))


def fused(aligned: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Aligned chunks with fused word times and ``fused_word_timings``."""
    texts = lambda c: F.transform(c, lambda w: w["text"])
    rows = aligned.select("id", "words").join(a.select("id", F.col("words").alias("q")), "id").join(b.select("id", F.col("words").alias("w")), "id")
    maps = rows.select("id", S.index_map(texts(F.col("words")), texts(F.col("q"))).alias("aq"), S.index_map(texts(F.col("q")), texts(F.col("w"))).alias("qw"))
    links = fusion.compose(maps.select("id", F.inline("aq")), maps.select("id", F.inline("qw")), ["id"])
    at = lambda d, c, p: d.select("id", F.posexplode(c).alias(f"{p}_idx", p))
    found = links.join(at(rows, "q", "q"), ["id", "q_idx"]).join(at(rows, "w", "w"), ["id", "w_idx"])
    found = found.select("id", F.col("a_idx").alias("pos"), (F.col("w.start") - F.col("q.start")).alias("delta"), F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end"))
    anchors = fusion.anchors(found, ["id"], "pos").select("id", "pos", "accepted", "w_start", "w_end")
    words = rows.select("id", F.posexplode("words").alias("pos", "x")).select("id", "pos", "x.*").join(anchors, ["id", "pos"], "left")
    word = F.struct("pos", F.struct("text", F.col("new_start").alias("start"), F.col("new_end").alias("end")).alias("w"))
    done = fusion.fuse(words, ["id"]).groupBy("id").agg(F.transform(F.sort_array(F.collect_list(word)), lambda x: x["w"]).alias("fused"), F.count_if("accepted").cast("int").alias("n"))
    out = aligned.join(done, "id", "left").withColumn("words", F.coalesce("fused", "words")).withColumn("fused_word_timings", F.coalesce("n", F.lit(0)))
    return out.drop("fused", "n")


#: Chunks that a model stage records at once.
WAVE = 256


def recorded(spark: SparkSession, path: str) -> DataFrame | None:
    """All records of a model stage with the wave that wrote them; None before the first."""
    return spark.read.option("basePath", path).parquet(f"{path}/wave=*") if exists(spark, path) else None


def by_waves(spark: SparkSession, path: str, chunks_: DataFrame, work: Callable[[DataFrame], DataFrame], wave: int, retry: bool = False) -> DataFrame:
    """The records of a model stage, one for each chunk; those of earlier runs are kept.

    Chunks without a record are worked off in waves of ``wave`` in their order, each a
    folder that appears as a whole, so a run that breaks off loses one wave at most. With
    ``retry``, failed edits of earlier runs are taken up again; of several records the last counts.
    """
    known = recorded(spark, path)
    first = 0
    todo = chunks_.select("id", "chunk_pos")
    if known is not None:
        first = known.agg(F.max("wave")).first()[0] + 1
        todo = records.pending(todo, records.purge_fallbacks(known) if retry else known)
    ids = [r["id"] for r in todo.orderBy("chunk_pos").collect()]  # the chunks of one book
    for number, at in enumerate(range(0, len(ids), wave), first):
        some = spark.createDataFrame([(i,) for i in ids[at : at + wave]], "id string")
        work(chunks_.join(F.broadcast(some), "id", "left_semi")).write.mode("overwrite").parquet(f"{path}/wave={number}")
    known = recorded(spark, path)
    if known is None:
        raise ValueError("no chunks")
    return records.last_wins(known, "id", "wave").drop("first_pos")


def prepared_media(spark: SparkSession, job: dict) -> tuple[DataFrame, DataFrame]:
    """Chapters and audio blocks of a job: ``source`` is a mono 16 kHz WAV file, and source.json beside it (same name) its probe.

    Other media need a decoder, which is not part of the library.
    """
    chapters = readers.chapters(spark, job["source"].rsplit(".", 1)[0] + ".json").withColumn("book_id", F.lit(job["id"]))
    return chapters, readers.audio(spark, job["source"]).select(F.lit(job["id"]).alias("book_id"), "start_frame", "samples")


Media = Callable[[SparkSession, dict], tuple[DataFrame, DataFrame]]


@dataclass
class Book:
    """A job whose recognisers are done."""

    job: dict
    plan: DataFrame
    first: DataFrame
    second: DataFrame


def prepare(spark: SparkSession, job: dict, models: Models = STAND_INS, media: Media = prepared_media, rate: int = 16_000, wave: int = WAVE) -> Book:
    """Plan and both transcripts of a job, or what is left of them to do."""
    work = job["work_dir"]

    def planned() -> DataFrame:
        rows = chunks.plan(*media(spark, job), rate=rate)
        return rows.withColumn("chunk_pos", F.row_number().over(W.partitionBy("book_id").orderBy("start_frame")) - 1)

    plan = stage(spark, work, "chunks", planned)
    chunks.summary(plan).collect()
    if not exists(spark, f"{work}/manifest/_SUCCESS"):
        sinks.write_manifest(plan, f"{work}/manifest", job.get("source") or job["id"])
    a = by_waves(spark, f"{work}/first", plan, lambda rows: backends.transcribe(rows, models.first, "first"), wave)
    b = by_waves(spark, f"{work}/second", plan, lambda rows: backends.transcribe(rows, models.second, "second"), wave)
    return Book(job, plan, a, b)


def edit(spark: SparkSession, book: Book, models: Models = STAND_INS, wave: int = WAVE) -> DataFrame:
    """The consensus of a prepared job; failed edits of earlier runs are asked for again."""
    for side in (book.first, book.second):
        records.require_complete(book.plan, side)
    terms = readers.glossary(spark, book.job.get("glossary"))

    def work(rows: DataFrame) -> DataFrame:
        pairs = reconcile.candidate_pairs(rows.select("id", "chapter_title", "part"), book.first, book.second)
        return reconcile.records(reconcile.consensus(pairs, models.editor, models.label, glossary=terms), models.label)

    return by_waves(spark, f"{book.job['work_dir']}/consensus", book.plan, work, wave, retry=True)


def finish(spark: SparkSession, book: Book, text: DataFrame, models: Models = STAND_INS, wave: int = WAVE) -> DataFrame:
    """Alignment, fusion, captions and files of an edited job; returns its report."""
    job, work, out = book.job, book.job["work_dir"], book.job["output_dir"]
    records.require_complete(book.plan, text)
    with_text = book.plan.join(text.select("id", "text"), "id")
    aligned = by_waves(spark, f"{work}/aligned", with_text, lambda rows: restored(backends.transcribe(rows, models.aligner, "aligner")), wave)
    records.require_complete(book.plan, aligned)
    final = stage(spark, work, "fused", lambda: fused(aligned, book.first, book.second))
    words = final.select("book_id", "chunk_pos", F.posexplode("words").alias("word_pos", "w")).select("book_id", "chunk_pos", "word_pos", "w.*")
    cut = stage(spark, work, "words", lambda: captions.segment(captions.islands(captions.sorted_words(words, "book_id"), "book_id"), "book_id"))
    cue = stage(spark, work, "cues", lambda: captions.wrapped(captions.repair(captions.timed(captions.cues(cut, "book_id"), "book_id"), "book_id")))
    report = stage(spark, work, "report", lambda: captions.report(cue, cut, final, "book_id"))
    sinks.write_book(cue, cut, final, report, out, job.get("basename") or job["id"], "book_id")
    sinks.mark_complete(spark, f"{work}/complete", job["id"])
    return report


def run_job(spark: SparkSession, job: dict, models: Models = STAND_INS, media: Media = prepared_media, rate: int = 16_000, wave: int = WAVE) -> DataFrame:
    """All stages of one job (id, source, work_dir, output_dir, basename, glossary, as ``readers.queue`` describes it); returns its report.

    A rerun takes up what is missing: whole tables of relational stages, single chunks of
    model stages.
    """
    book = prepare(spark, job, models, media, rate, wave)
    return finish(spark, book, edit(spark, book, models, wave), models, wave)


def run_queue(spark: SparkSession, jobs: list[dict], models: Models = STAND_INS, media: Media = prepared_media, rate: int = 16_000, wave: int = WAVE) -> list[str]:
    """Run the jobs that are not complete; returns their ids.

    While a job is edited, which waits for another machine, the next one is transcribed;
    then the first is finished.
    """
    done: list[str] = []
    with ThreadPoolExecutor(1) as aside:
        before = None
        for job in jobs:
            if exists(spark, f"{job['work_dir']}/complete/_SUCCESS"):
                continue
            book = prepare(spark, job, models, media, rate, wave)
            edited = aside.submit(inheritable_thread_target(spark)(edit), spark, book, models, wave)
            if before is not None:
                finish(spark, before[0], before[1].result(), models, wave)
                done.append(before[0].job["id"])
            before = (book, edited)
        if before is not None:
            finish(spark, before[0], before[1].result(), models, wave)
            done.append(before[0].job["id"])
    return done
