"""Stage records built from the given tables, which hold no audio. Times are integer milliseconds until the last step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cuelattice.functions import text as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, pos, text: every token of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.tokens(F.coalesce("text", F.lit("")))).alias("pos", "text"))


#: Bytes of files that make a partition of dealt documents: some million words, which a sort holds in memory.
DEALT_BYTES = 8 << 20


def dealt_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tokens`` with the words of a document in one partition, in order.

    Texts are dealt before they are cut into words, so what follows by document moves no
    words, and a sort by document and place finds them sorted.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // DEALT_BYTES))
    docs = docs.repartition(parts, "doc_id").sortWithinPartitions("doc_id")
    return docs.select("doc_id", F.posexplode(T.tokens(F.coalesce("text", F.lit("")))).alias("pos", "text"))


def timed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, pos, text, start_ms, end_ms, start, end. Every fifth document is spoken three times as slowly."""
    t = dealt_tokens(spark, sf_dir)
    slow = F.when(F.col("doc_id") % 5 == 0, 3).otherwise(1)
    spoken = ((F.length("text") * 60 + 40) * slow).cast("long")
    pause = F.when(T.ends_sentence(F.col("text")), F.when(F.col("pos") % 3 == 0, 1200).otherwise(350)).otherwise(0)
    order = W.partitionBy("doc_id").orderBy("pos")
    rows = t.withColumn("spoken", spoken).withColumn("start_ms", F.sum(F.col("spoken") + pause).over(order) - F.col("spoken") - pause)
    rows = rows.withColumn("end_ms", F.col("start_ms") + F.col("spoken"))
    return rows.select("doc_id", "pos", "text", "start_ms", "end_ms", (F.col("start_ms") / 1000.0).alias("start"), (F.col("end_ms") / 1000.0).alias("end"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as chunks: four turns are a chapter, a character lasts 960 frames."""
    turns = table(spark, sf_dir, "conversations")
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = (F.length(F.coalesce("text", F.lit(""))) * 960 + 8000).cast("long")
    rows = turns.withColumn("chunk_pos", F.row_number().over(order) - 1).withColumn("end_frame", F.sum(size).over(order.rowsBetween(W.unboundedPreceding, 0)))
    return rows.select(
        F.col("conv_id").cast("string").alias("book_id"), "conv_id", "chunk_pos", F.expr("chunk_pos div 4").cast("int").alias("chapter_id"),
        F.concat(F.lit("Chapter "), F.expr("chunk_pos div 4").cast("string")).alias("chapter_title"), (F.col("chunk_pos") % 4 + 1).alias("part"),
        (F.col("end_frame") - size).alias("start_frame"), "end_frame", F.coalesce("text", F.lit("")).alias("text"), "role",
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with a synthetic anchor: every 17th has none, every 11th is 4.3 s off, the others within 0.45 s."""
    jitter = ((F.col("pos") * 7919 + F.col("doc_id") * 104729) % 901 - 450) + F.when(F.col("pos") % 11 == 0, 4300).otherwise(0)
    rows = timed_words(spark, sf_dir).withColumn("off", F.when(F.col("pos") % 17 != 0, jitter))
    return rows.select("*", ((F.col("start_ms") + F.col("off")) / 1000.0).alias("w_start"), ((F.col("end_ms") + F.col("off")) / 1000.0).alias("w_end"), (F.col("off") / 1000.0).alias("delta"))


#: Turns that make a partition where their texts are matched, which takes far longer than their bytes tell.
MATCHED_TURNS = 1000


def matched_parts(spark: SparkSession, sf_dir: str) -> int:
    """Partitions in proportion to the turns, counted from the files' footers."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table(spark, sf_dir, "conversations").count() // MATCHED_TURNS))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with the next turn's text as the second candidate; every third pair takes its own text with vowels in upper case."""
    order = W.partitionBy("conv_id").orderBy("chunk_pos")
    rows = chunks(spark, sf_dir).withColumn("following", F.lead("text").over(order)).where("following IS NOT NULL")
    own = (F.col("conv_id") + F.col("chunk_pos")) % 3 == 0
    return rows.withColumn("a_text", F.col("text")).withColumn("b_text", F.when(own, F.translate("text", "aeiou", "AEIOU")).otherwise(F.col("following")))


def raw_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with thought blocks, fences and labels around them."""
    text = F.coalesce("text", F.lit(""))
    kind = F.col("doc_id") % 4
    raw = (
        F.when(kind == 0, F.concat(F.lit("<think>plan</think> Corrected transcript: "), text))
        .when(kind == 1, F.concat(F.lit("<THINK>a\nb</THINK>`"), text, F.lit("`")))
        .when(kind == 2, F.concat(F.lit("<think>never closed "), text))
        .otherwise(F.concat(F.lit("Final transcript: "), text))
    )
    return table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"))
