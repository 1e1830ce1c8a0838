"""The engine's registered queries; their DuckDB SQL is in ``oracles``.

Queries of sources and sinks write files below the shared scratch folder and read them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cuelattice.functions import sequence as S
from cuelattice.functions import text as T
from cuelattice.operators import captions, chunks, fusion, reconcile, records, surface
from cuelattice.plans import fixtures as X
from cuelattice.plans.oracles import ORACLES
from cuelattice.sources import readers, schemas, sinks
from cuelattice.sources.scratch import scratch
from cuelattice.streaming import incremental

__all__ = ["ORACLES", "QUERIES"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def long(c: Column) -> Column:
    return c.cast("long")


@query
def lexical_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and lexical words of every document (flagship)."""
    text = F.coalesce("text", F.lit(""))
    return X.table(spark, sf_dir, "documents").select("doc_id", long(F.size(T.tokens(text))).alias("tokens"), long(F.size(T.lexical_words(text))).alias("lexical_words"))


@query
def token_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each normal form occurs."""
    return X.tokens(spark, sf_dir).groupBy(T.normal_token(F.col("text")).alias("norm")).agg(F.count("*").alias("n"))


@query
def clean_generation_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.raw_outputs(spark, sf_dir).select("doc_id", T.clean_local(F.col("raw")).alias("cleaned"))


@query
def clean_generation_remote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.raw_outputs(spark, sf_dir).select("doc_id", T.clean_remote(F.col("raw")).alias("cleaned"))


@query
def sentence_clause_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.tokens(spark, sf_dir).groupBy("doc_id").agg(F.count_if(T.ends_sentence(F.col("text"))).alias("sentence_ends"), F.count_if(T.ends_clause(F.col("text"))).alias("clause_ends"))


@query
def timestamp_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("event_id") * F.lit(7.1234) - 5
    return X.table(spark, sf_dir, "events").select("event_id", T.timestamp(at).alias("srt_time"), T.timestamp(at, False).alias("vtt_time"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine words a line, cut from each text where it is."""
    text = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))
    nine = F.regexp_extract_all(text, F.lit("[^ ]++(?: [^ ]++){0,8}+"), F.lit(0))
    return X.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(nine).alias("line", "text")).select("doc_id", long(F.col("line")).alias("line"), "text")


@query
def wrap_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("doc_id", "line", T.wrap_balanced(F.col("text")).alias("wrapped"), T.can_wrap(F.col("text")).alias("fits"))


@query
def chunk_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.described(X.chunks(spark, sf_dir)).withColumns({c: long(F.col(c)) for c in ("chapter_id", "part", "start_frame", "end_frame")})


@query
def chunk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.summary(chunks.described(X.chunks(spark, sf_dir)))


@query
def config_defaults_and_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("s_suppkey")
    jobs = X.table(spark, sf_dir, "supplier").select(
        F.when(n % 11 == 0, "Job 1").when(n % 13 == 0, "twin").otherwise(F.concat(F.lit("job-"), n.cast("string"))).alias("id"),
        F.when(n % 17 == 0, " ").when(n % 2 == 0, F.concat(F.lit("/media/"), n.cast("string"))).otherwise(F.concat(F.lit("in/"), n.cast("string"))).alias("source"),
        F.when(n % 3 == 0, F.lit("/scratch/w")).alias("work_dir"),
        F.lit(None).cast("string").alias("output_dir"),
        F.when(n % 7 == 0, F.lit("../up")).when(n % 5 == 0, F.lit("book.v1")).alias("output_basename"),
        F.when(n % 4 == 0, F.lit("terms.txt")).alias("glossary_file"),
    )
    return readers.described_jobs(jobs, "/srv/project")


@query
def pending_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.pending(X.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), X.table(spark, sf_dir, "labels"), "doc_id")


@query
def missing_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.missing(X.table(spark, sf_dir, "documents"), X.table(spark, sf_dir, "labels"), "doc_id", ["source"], "doc_id")


@query
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.completeness(X.table(spark, sf_dir, "documents"), X.table(spark, sf_dir, "labels"), "source", "doc_id")


@query
def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as jobs, those with an order as complete."""
    jobs = X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return records.unfinished(jobs, X.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")))


@query
def last_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.last_wins(X.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


@query
def duplicate_job_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.duplicate_ids(X.table(spark, sf_dir, "events").select(F.col("user_id").alias("id")))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.turn_pairs(spark, sf_dir).withColumn("id", F.concat_ws("/", "book_id", T.chunk_id(F.col("chapter_id"), F.col("part"))))
    side = lambda c: rows.select("id", F.col(c).alias("text"))
    return reconcile.candidate_pairs(rows.select("id", "conv_id", "chunk_pos", "chapter_title", "part"), side("a_text"), side("b_text"))


@query
def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("id", long(F.size("a_words")).alias("a_count"), long(F.size("b_words")).alias("b_count"), "identical")


@query
def prompt_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.turn_pairs(spark, sf_dir)
    terms = F.when(F.col("conv_id") % 2 == 0, "Ada, Bly").otherwise(" ")
    return rows.select("book_id", long(F.col("chunk_pos")).alias("chunk_pos"), T.prompt(F.col("chapter_title"), F.col("part"), F.col("a_text"), F.col("b_text"), terms).alias("prompt"))


@query
def count_bounds_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.turn_pairs(spark, sf_dir).withColumn("text", F.when(F.col("chunk_pos") % 5 == 0, F.concat("a_text", F.lit(" ```"))).otherwise(F.col("a_text")))
    return rows.select("book_id", long(F.col("chunk_pos")).alias("chunk_pos"), S.valid_by_counts(F.col("text"), F.col("a_text"), F.col("b_text")).alias("within"))


def _methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 5
    method = F.when(kind == 0, "remote-mechanical-FALLBACK").when(kind == 1, "remote-error-fallback").when(kind == 2, "identical").when(kind == 3, "remote:m")
    return X.table(spark, sf_dir, "events").select("event_id", method.alias("method"))


@query
def retry_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.purge_fallbacks(_methods(spark, sf_dir))


@query
def null_timestamp_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = X.timed_words(spark, sf_dir).select("doc_id", long(F.col("pos")).alias("pos"), F.when(F.col("pos") % 13 != 0, F.col("start")).alias("start"), F.when(F.col("pos") % 7 != 0, F.col("end")).alias("end"))
    fixed = fusion.repair_times(words, F.lit(9999.0))
    return fixed.select("doc_id", "pos", fusion.absolute(F.lit(0.5), F.col("start")).alias("start"), fusion.absolute(F.lit(0.5), F.col("end")).alias("end"))


@query
def words_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of eight-word chunks whose odd chunks come 300 ms early, so that neighbouring chunks interleave."""
    early = F.when(F.expr("(pos div 8) % 2 = 1"), 300).otherwise(0)
    words = X.timed_words(spark, sf_dir).select(
        "doc_id", "text", ((F.col("start_ms") - early) / 1000.0).alias("start"), ((F.col("end_ms") - early) / 1000.0).alias("end"), F.expr("pos div 8").alias("chunk_pos"), (F.col("pos") % 8).alias("word_pos")
    )
    return captions.sorted_words(words, "doc_id").withColumns({c: long(F.col(c)) for c in ("chunk_pos", "word_pos", "pos")})


@query
def gap_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = captions.islands(X.timed_words(spark, sf_dir), "doc_id")
    return marked.groupBy("doc_id", "island").agg(F.count("*").alias("words"), F.min("start").alias("start"), F.max("end").alias("end"))


@query
def event_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(60_000_000.0)
    marked = captions.event_islands(X.table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", minutes, "event_id", 480.0)
    return marked.groupBy("user_id", "island").agg(F.count("*").alias("events"), F.min("event_id").alias("least_event"), F.max("event_id").alias("last_event"))


@query
def anchor_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fusion.anchors(X.candidates(spark, sf_dir).where("delta IS NOT NULL"), ["doc_id"], "pos")
    return found.select("doc_id", long(F.col("pos")).alias("pos"), "delta", "median", "accepted")


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.fuse(fusion.accepted(X.candidates(spark, sf_dir), ["doc_id"], "pos"), ["doc_id"])


@query
def fused_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(spark, sf_dir).select("doc_id", long(F.col("pos")).alias("pos"), F.coalesce("accepted", F.lit(False)).alias("accepted"), "new_start", "new_end")


@query
def fusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("words"), F.count_if("accepted").alias("fused"), F.count_if(~F.col("accepted")).alias("rejected_matches"))


def _cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.cut(X.timed_words(spark, sf_dir), "doc_id")


@query
def cue_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cues(spark, sf_dir)


@query
def cue_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.timed(_cues(spark, sf_dir), "doc_id").select("doc_id", "cue", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.wrapped(captions.repair(captions.timed(_cues(spark, sf_dir), "doc_id"), "doc_id"))


@query
def cue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(spark, sf_dir).select("doc_id", "cue", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


@query
def srt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.srt_blocks(_final(spark, sf_dir), "doc_id")


@query
def vtt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.vtt_blocks(_final(spark, sf_dir), "doc_id")


@query
def transcript_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions.transcript_parts(X.chunks(spark, sf_dir), "book_id").withColumn("chunk_pos", long(F.col("chunk_pos")))


@query
def qc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of every document taken as a book of one chunk."""
    parts = X.table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("chunk_pos"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), (F.col("doc_id") % 3 != 0).alias("surface_restored"))
    out = captions.report(_final(spark, sf_dir), X.timed_words(spark, sf_dir), parts, "doc_id")
    return out.withColumns({c: F.round(c, 3) for c in ("first_cue_start", "last_cue_end", "max_cue_duration")}).withColumn("surface_restore_failures", F.array_join("surface_restore_failures", ","))


@query
def surface_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens restored from items: normal forms cut in two; every fourth document lacks its first item."""
    words = X.timed_words(spark, sf_dir)
    norm = T.normal_token(F.col("text"))
    half = F.expr("length(norm) div 2")
    halves = words.withColumn("norm", norm).where("norm <> ''").select(
        "doc_id", "pos", F.explode(F.array(
            F.struct(F.lit(0).alias("k"), F.substring("norm", F.lit(1), half).alias("text"), F.col("start").alias("start"), ((F.col("start") + F.col("end")) / 2).alias("end")),
            F.struct(F.lit(1).alias("k"), F.substring("norm", half + 1, F.length("norm")).alias("text"), ((F.col("start") + F.col("end")) / 2).alias("start"), F.col("end").alias("end")),
        )).alias("h")
    )
    items = halves.where("h.text <> '' AND NOT (doc_id % 4 = 0 AND pos = 0)").select("doc_id", (F.col("pos") * 2 + F.col("h.k")).alias("pos"), "h.text", "h.start", "h.end")
    out = surface.restore(X.dealt_tokens(spark, sf_dir), items, "doc_id")
    return out.select("doc_id", long(F.col("pos")).alias("pos"), "text", F.round("start", 4).alias("start"), F.round("end", 4).alias("end"), "restored")


@query
def rms_quiet_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values of a user as a signal: windows of four, the quiet one nearest to the fifth."""
    order = W.partitionBy("user_id").orderBy("event_id")
    signal = X.table(spark, sf_dir, "events").select("user_id", "value", (F.row_number().over(order) - 1).alias("frame"))
    levels = chunks.window_rms(signal, ["user_id"], "frame", "value", 4).withColumn("target", F.lit(5.0))
    found = chunks.quiet_windows(levels, ["user_id"], "target")
    return found.select("user_id", long(F.col("window")).alias("window"), F.round("threshold", 6).alias("threshold"), "windows")


@query
def chunk_planner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation a book of a short and a long chapter, whose end is told too late, over a deterministic wave of 100 frames a second in blocks."""
    nations = X.table(spark, sf_dir, "nation").select(F.col("n_name").alias("book_id"), F.col("n_nationkey").alias("k"), (F.col("n_nationkey") * 4000 + 20_000).cast("long").alias("frames"))
    chapter = lambda i, title, start, end: F.struct(F.lit(i).alias("chapter_id"), F.lit(title).alias("chapter_title"), start.cast("long").alias("start_frame"), end.cast("long").alias("end_frame"))
    parts = F.array(chapter(0, "Preface", F.lit(0), F.lit(5001)), chapter(1, "The rest", F.lit(5001), F.col("frames") + 999))
    blocks = nations.select("book_id", "k", "frames", F.explode(F.sequence(F.lit(0).cast("long"), F.col("frames") - 1, F.lit(4096).cast("long"))).alias("start_frame"))
    wave = F.transform(F.sequence(F.col("start_frame"), F.least(F.col("start_frame") + 4095, F.col("frames") - 1)), lambda i: (((i * 7919 + F.col("k") * 31) % 1000) / 1000.0).cast("float"))
    audio = blocks.select("book_id", "start_frame", wave.alias("samples"))
    out = chunks.plan(nations.select("book_id", F.explode(parts).alias("c")).select("book_id", "c.*"), audio, rate=100)
    return out.withColumns({c: long(F.col(c)) for c in ("chapter_id", "part", "start_frame", "end_frame")})


@query
def seq_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("id", F.round(S.seq_ratio("a_words", "b_words"), 6).alias("similarity"))


@query
def index_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.turn_pairs(spark, sf_dir)
    return rows.select("book_id", "chunk_pos", F.explode(S.index_map(T.tokens(F.col("a_text")), T.tokens(F.col("b_text")))).alias("m")).select("book_id", "chunk_pos", "m.i", "m.j")


@query
def mechanical_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.turn_pairs(spark, sf_dir).select("book_id", "chunk_pos", S.mechanical_merge("a_text", "b_text").alias("text"))


@query
def valid_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.turn_pairs(spark, sf_dir).withColumn("text", F.col("b_text"))
    return reconcile.valid(rows.select("book_id", "chunk_pos", "text", "a_text", "b_text")).select("book_id", "chunk_pos", "valid")


@query
def consensus_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole reconcile stage with a stand-in editor."""
    from cuelattice.operators.backends import second_candidate

    # a number of its own, which adaptive execution does not lessen by bytes
    pairs = _pairs(spark, sf_dir).repartition(X.matched_parts(spark, sf_dir), "id")
    return reconcile.records(reconcile.consensus(pairs, second_candidate, "remote:stand-in"), "stand-in")


@query
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of files: a JSON file of each nation, written and read again by the sink's way."""
    nations = X.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("part"), F.col("n_name").alias("value"))
    path = scratch(spark, "hashed")
    nations.repartition("part").write.partitionBy("part").text(path)
    found = sinks.hashes(spark, f"{path}/part=*/*.txt")
    return found.select(long(F.regexp_extract("path", r"part=(\d+)/", 1)).alias("nationkey"), "sha256")


@query
def verification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as probed media: probes are written as JSON, a chapter for each line item, and read with the explicit schema."""
    items = X.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    text = lambda c: F.concat(c.cast("long").cast("string"), F.lit(".5"))
    probe = items.select(
        F.struct(text(F.col("q")).alias("duration"), F.col("q").cast("long").cast("string").alias("size"), F.col("l_orderkey").cast("string").alias("filename")).alias("format"),
        F.array(F.struct(F.lit(0).alias("index"), F.lit("subrip").alias("codec_name"), F.lit("subtitle").alias("codec_type"))).alias("streams"),
        F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda i: F.struct(i.alias("id"))).alias("chapters"),
    )
    path = scratch(spark, "probes")
    probe.write.json(path)
    read = spark.read.schema(schemas.MEDIA).json(path)
    out = readers.verification(read, F.col("format.duration").cast("double") - 0.25)
    return out.groupBy("source_duration", "output_duration", "output_size", F.col("streams")[0]["codec_name"].alias("codec"), long(F.col("chapter_count")).alias("chapter_count")).agg(F.count("*").alias("orders"))


@query
def incremental_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive as files in two halves that overlap, with a run after each and one that finds nothing new."""
    docs = X.table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("long").alias("n_chars"))
    path = scratch(spark, "incremental")
    schema = "doc_id long, n_chars long, run int"
    for run, part in enumerate(("doc_id % 2 = 0", "doc_id % 3 = 0 OR doc_id % 2 = 1", "false")):
        docs.where(part).withColumn("run", F.lit(run)).write.mode("append").json(f"{path}/in")
        incremental.resume(spark, f"{path}/in", schema, lambda d: d.select("doc_id", (F.col("n_chars") + 1).alias("n_plus"), "run"), f"{path}/out", f"{path}/state", "doc_id")
    return incremental.results(spark, f"{path}/out").select("doc_id", "n_plus", long(F.col("run")).alias("run"))


@query
def checkpoint_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records appended in two commits, some keys twice, read back with the last one winning; blank lines do not count."""
    events = X.table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"), "event_id")
    path = scratch(spark, "records")
    for name, newest in (("a", F.min("event_id")), ("b", F.max("event_id"))):
        one = events.groupBy("id").agg(newest.alias("event_id")).where(F.col("event_id") % 3 != (0 if name == "a" else 1))
        sinks.append_records(one, f"{path}/{name}")
    spark.createDataFrame([("",), (" ",)], "value string").write.mode("append").text(f"{path}/a")
    return readers.records(spark, f"{path}/*", "id string, event_id long").select("id", "event_id")


@query
def composed_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two index maps through their middle index: line items by order and number, then by part and number."""
    items = X.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i"), (F.col("l_partkey") % 7).alias("j")).groupBy("k", "i").agg(F.min("j").alias("j"))
    back = items.select("k", F.col("j").alias("i"), (F.col("i") * 10).alias("j")).groupBy("k", "i").agg(F.min("j").alias("j"))
    out = fusion.compose(items, back, ["k"])
    return out.select("k", long(F.col("a_idx")).alias("a_idx"), long(F.col("q_idx")).alias("q_idx"), long(F.col("w_idx")).alias("w_idx"))


@query
def purged_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checkpoint without its failed edits, as a version of its own beside the old one."""
    path = scratch(spark, "purge")
    sinks.append_records(_methods(spark, sf_dir).withColumn("id", F.col("event_id").cast("string")), f"{path}/v1")
    kept = sinks.purge(spark, f"{path}/v1", f"{path}/v2", "id string, method string")
    before = spark.read.schema("id string, method string").json(f"{path}/v1")
    return before.select("id").join(kept.select("id", F.lit(True).alias("kept")), "id", "left").select(long(F.col("id")).alias("event_id"), F.coalesce("kept", F.lit(False)).alias("kept"))


@query
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as chunks of a book, written as its manifest and read back in the manifest's order."""
    order = W.orderBy("n_nationkey")  # 25 rows
    n = F.col("n_nationkey").cast("long")
    rows = X.table(spark, sf_dir, "nation").select(
        F.lit("book").alias("book_id"), (F.row_number().over(order) - 1).alias("chunk_pos"), n.cast("int").alias("chapter_id"), F.col("n_name").alias("chapter_title"),
        F.lit(1).alias("part"), (n * 48_000).alias("start_frame"), (n * 48_000 + 40_000).alias("end_frame"),
    )
    path = scratch(spark, "manifest")
    plan = chunks.described(rows).join(rows.select("chapter_id", "chunk_pos"), "chapter_id")
    sinks.write_manifest(plan, path, "book.wav")
    back = readers.manifest(spark, path)
    return back.select("book_id", long(F.col("chunk_pos")).alias("chunk_pos"), "id", "chapter_title", "start", "end", "duration")


@query
def chapter_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probes of regions, a chapter for each nation, every third without a title, written as JSON and read as chapters."""
    n = F.col("n_nationkey").cast("int")
    tags = F.when(n % 3 != 0, F.create_map(F.lit("title"), F.col("n_name"))).otherwise(F.create_map(F.lit("lang"), F.lit("en")))
    chapter = F.struct(n.alias("id"), F.format_string("%d.%05d", n * 60, n * 1111).alias("start_time"), F.format_string("%d.5", n * 60 + 55).alias("end_time"), tags.alias("tags"))
    probes = X.table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list(chapter).alias("chapters"))
    path = scratch(spark, "probe")
    probes.repartition("n_regionkey").write.partitionBy("n_regionkey").json(path)  # a probe is a file of its own
    return readers.chapters(spark, f"{path}/*").select(long(F.col("chapter_id")).alias("chapter_id"), "chapter_title", "start_frame", "end_frame")


@query
def stand_in_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks through a recogniser backend: the words of the title, spread evenly, in absolute time."""
    from cuelattice.operators import backends

    out = backends.transcribe(chunks.described(X.chunks(spark, sf_dir)), backends.even_spread_factory, "stand-in")
    return out.select("book_id", "id", "model", "text", long(F.size("words")).alias("words"), F.col("words")[0]["start"].alias("first_start"), F.element_at("words", -1)["end"].alias("last_end"))


@query
def completed_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations whose region's job has no completion row; every second region has one."""
    path = scratch(spark, "complete")
    for r in X.table(spark, sf_dir, "region").where("r_regionkey % 2 = 0").orderBy("r_regionkey").collect():  # five rows at every scale
        sinks.mark_complete(spark, path, f"r{r['r_regionkey']}")
    jobs = X.table(spark, sf_dir, "nation").select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("id"), "n_name")
    return records.unfinished(jobs, spark.read.parquet(path))
