"""Words to captions: islands, cues, timing, repair, rendering and quality report."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cuelattice.functions import text as T

#: Fixed values of the segmentation: characters of a line and a cue, seconds of a cue, seconds of a hard gap.
MAX_LINE, MAX_CUE, MAX_SECONDS, GAP = 42, 78, 6.5, 1.0
_SENTENCE, _CLAUSE = re.compile(T.SENTENCE_END), re.compile(T.CLAUSE_END)


def sorted_words(words: DataFrame, book: str) -> DataFrame:
    """Words with text, numbered by (start, end, chunk_pos, word_pos) within the book."""
    order = W.partitionBy(book).orderBy("start", "end", "chunk_pos", "word_pos")
    return words.where(F.trim("text") != "").withColumn("pos", F.row_number().over(order) - 1)


def islands(words: DataFrame, book: str, pos: str = "pos") -> DataFrame:
    """Words with ``island``: a gap of a second or more always parts cues, whatever came before."""
    order = W.partitionBy(book).orderBy(pos)
    opens = F.coalesce(F.col("start") - F.lag("end").over(order) >= GAP, F.lit(True)).cast("int")
    return words.withColumn("opens", opens).withColumn("island", F.sum("opens").over(order)).drop("opens")


def two_lines(text: str) -> bool:
    """Whether the text fits one line or two."""
    if len(text) <= MAX_LINE:
        return True
    parts = text.split()
    left, total = -1, sum(map(len, parts)) + len(parts) - 1
    for p in parts[:-1]:
        left += len(p) + 1
        if left > MAX_LINE:
            return False
        if total - left - 1 <= MAX_LINE:
            return True
    return False


class Cutter:
    """Decides word by word where a cue ends."""

    def __init__(self):
        self.text: str | None = None
        self.start = self.end = 0.0
        self.last = ""
        self.plain = True  # whether single spaces are all white space of the text

    def takes(self, text: str, start: float, end: float) -> bool:
        """Add a word; False if it opens a new cue."""
        plain = text.split() == [text]
        same = self.text is not None and not self._parts(text, start, end, plain and self.plain)
        if same:
            self.text += " " + text
            self.plain = plain and self.plain
        else:
            self.text, self.start, self.plain = text, start, plain
        self.end, self.last = end, text
        return same

    def _parts(self, text: str, start: float, end: float, plain: bool) -> bool:
        if start - self.end >= GAP:
            return True
        so_far = self.text if plain else self.text.strip()
        size = len(so_far) + 1 + len(text)
        if size > MAX_CUE:
            return True
        if size > MAX_LINE and not plain and not two_lines(f"{so_far} {text}"):
            return True
        if size > MAX_LINE and plain:
            # of plain words, the longest first line leaves the shortest second one
            at = len(so_far) if len(so_far) <= MAX_LINE else so_far.rfind(" ", 0, MAX_LINE + 1)
            if at < 0 or size - 1 - at > MAX_LINE:
                return True
        lasted = self.end - self.start
        if lasted < 1.0:
            return False
        if end - self.start > MAX_SECONDS:
            return True
        tail = self.last[-3:]
        if len(so_far) >= 20 and _SENTENCE.search(tail):
            return True
        return lasted >= 3.5 and len(so_far) >= 48 and bool(_CLAUSE.search(tail))


def segment(words: DataFrame, book: str) -> DataFrame:
    """Words (book, pos, island, text, start, end) with ``cue``, numbered from 1 within the book.

    Words without a text, a start or an end belong to no cue and are left out (``sorted_words`` and
    ``fusion.repair_times`` do so before).

    The greedy rules look back at the open cue, so an island is read in order. Islands
    are dealt over the cluster and streamed in Arrow batches with constant state; a fold
    over arrays inside one row would hold a book and copy its state at every word.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cut = None, Cutter()
        for batch in batches:
            opens = []
            for b, island, text, start, end in zip(*(_values(batch.column(i)) for i in (0, 2, 3, 4, 5))):
                if (b, island) != at:
                    at, cut = (b, island), Cutter()
                opens.append(not cut.takes(text, start, end))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(opens, pa.bool_())], names=[*batch.schema.names, "opens"])

    rows = words.where("text IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL").select(book, "pos", "island", "text", "start", "end")
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", opens boolean"
    cut = rows.repartition(book, "island").sortWithinPartitions(book, "island", "pos").mapInArrow(scan, schema)
    return cut.withColumn("cue", F.sum(F.col("opens").cast("long")).over(W.partitionBy(book).orderBy("pos"))).drop("opens")


def _in_order(rows: DataFrame, book: str, by: str) -> DataFrame:
    """Rows numbered by ``by`` within the book, so that a book lies in one partition and in order; rows that lie so already stay."""
    return rows.withColumn("nth", F.row_number().over(W.partitionBy(book).orderBy(by)))


def cut(words: DataFrame, book: str) -> DataFrame:
    """``cues`` of words (book, pos, text, start, end), without a table of words that know their cue.

    A pause of a second parts cues by the rules themselves, so no islands are needed. Books
    are read in order, in Arrow batches with constant state, and only cues are written.
    Words without a text, a start or an end are left out.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, number, first, top, n, cutter = None, 0, 0.0, 0.0, 0, Cutter()
        schema = None
        for batch in batches:
            kinds = [batch.schema.field(i).type for i in (0, 3, 4)]
            schema = pa.schema(list(zip(names, [kinds[0], pa.int64(), kinds[1], kinds[2], pa.int64(), pa.string()])))
            done = []
            for b, text, start, end in zip(*(_values(batch.column(i)) for i in (0, 2, 3, 4))):
                if b != at:
                    if cutter.text is not None:
                        done.append((at, number, first, top, n, cutter.text.strip(" ")))
                    at, number, cutter = b, 0, Cutter()
                before = cutter.text
                if cutter.takes(text, start, end):
                    n += 1
                    top = max(top, end)
                    continue
                if before is not None:
                    done.append((at, number, first, top, n, before.strip(" ")))
                number, first, top, n = number + 1, start, end, 1
            yield _rows(done, schema)
        if cutter.text is not None:
            yield _rows([(at, number, first, top, n, cutter.text.strip(" "))], schema)

    names = [book, "cue", "start", "raw_end", "n_words", "text"]
    rows = words.where("text IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL").select(book, "pos", "text", "start", "end")
    rows = _in_order(rows, book, "pos").select(book, "nth", "text", "start", "end")
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(scan, f"`{book}` {kinds[book]}, cue long, start {kinds['start']}, raw_end {kinds['end']}, n_words long, text string")


def cues(words: DataFrame, book: str) -> DataFrame:
    """One row per cue: start, raw_end, n_words, text (joined, not wrapped)."""
    grouped = words.groupBy(book, "cue").agg(
        F.min_by("start", "pos").alias("start"), F.max("end").alias("raw_end"), F.count("*").alias("n_words"), F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("parts")
    )
    return grouped.select(book, "cue", "start", "raw_end", "n_words", T.join_words(F.transform("parts", lambda p: p["text"])).alias("text"))


def timed(cue: DataFrame, book: str) -> DataFrame:
    """Cues with ``end``: stretched for reading, short of the next cue."""
    following = F.coalesce(F.lead("start").over(W.partitionBy(book).orderBy("cue")), F.col("raw_end") + 1.0)
    rows = cue.withColumn("next", following)
    wanted = F.least(F.greatest(F.col("raw_end") + 0.08, F.col("start") + 0.8), F.col("start") + MAX_SECONDS)
    end = F.when(F.col("next") > F.col("start") + 0.08, F.least(wanted, F.col("next") - 0.04)).otherwise(F.least("raw_end", F.col("start") + MAX_SECONDS))
    return rows.withColumn("end", F.greatest(end, F.col("start") + 0.08)).drop("next")


class Mender:
    """Settles cues one after another: the next cue decides the open one's end and may be moved itself."""

    def __init__(self):
        self.start: float | None = None
        self.end = 0.0

    def follows(self, start: float, end: float) -> tuple[float, float] | None:
        """Start and end of the cue before, now that the next one is known."""
        settled = None
        if self.start is not None:
            settled = (self.start, self.end)
            if self.end >= start and start <= self.start:
                held = min(self.start + MAX_SECONDS, max(self.end, self.start + 0.8))
                settled, start = (self.start, held), held + 0.04
            elif self.end >= start:
                settled = (self.start, max(self.start + 0.01, start - 0.04))
        self.start, self.end = start, end
        return settled


def repair(cue: DataFrame, book: str) -> DataFrame:
    """Cues without overlap after one forward pass; a coincident start is moved, which the next cue sees.

    Books are dealt over the cluster, unless they are so already, and read in order, in
    Arrow batches with constant state: one open cue. Every cue is written, with all its
    columns, when its follower is known.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mender, held = None, Mender(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            done = []
            for b, start, end in zip(*(_values(batch.column(i)) for i in (0, 1, 2))):
                if mender.start is not None and b != at:
                    done.append((mender.start, mender.end))
                    mender = Mender()
                settled = mender.follows(start, end)
                if settled is not None:
                    done.append(settled)
                at = b
            last = batch.num_rows - 1
            yield from (with_times(part, done[first : first + part.num_rows]) for part, first in ((held, 0), (batch.slice(0, last), held is not None)) if part is not None)
            held = batch.slice(last)
        if held is not None:
            yield with_times(held, [(mender.start, mender.end)])

    def with_times(batch: pa.RecordBatch, times: list[tuple]) -> pa.RecordBatch:
        both = [pa.array(c, batch.column(i).type) for i, c in zip((1, 2), list(zip(*times)) or [(), ()])]
        return pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[4:], *both], names=[book, *others, "start", "end"])

    others = [c for c in cue.columns if c not in (book, "start", "end")]
    rows = _in_order(cue, book, "cue").select(book, "start", "end", "nth", *others)
    kinds = dict(rows.dtypes)
    fixed = rows.mapInArrow(scan, ", ".join(f"`{c}` {kinds[c]}" for c in [book, *others, "start", "end"]))
    return fixed.select(book, "cue", *(c for c in others if c != "cue"), "start", "end")


def _values(column: pa.Array) -> list:
    """The values as Python's; arrays without nulls go the quick way."""
    return column.to_pylist() if column.null_count else column.to_numpy(zero_copy_only=False).tolist()


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], names=schema.names)


def wrapped(cue: DataFrame) -> DataFrame:
    return cue.withColumn("text", T.wrap_balanced(F.col("text")))


def srt_blocks(cue: DataFrame, book: str) -> DataFrame:
    times = F.concat(T.timestamp(F.col("start")), F.lit(" --> "), T.timestamp(F.col("end")))
    return cue.select(book, "cue", F.concat_ws("\n", F.col("cue").cast("string"), times, F.col("text"), F.lit("\n")).alias("block"))


def vtt_blocks(cue: DataFrame, book: str) -> DataFrame:
    """Blocks without number; the file header is the sink's."""
    times = F.concat(T.timestamp(F.col("start"), False), F.lit(" --> "), T.timestamp(F.col("end"), False))
    return cue.select(book, "cue", F.concat_ws("\n", times, F.col("text"), F.lit("\n")).alias("block"))


def transcript_parts(chunks: DataFrame, book: str) -> DataFrame:
    """(book, chunk_pos, part): the chunk's text and a space; a new chapter first has its title."""
    order = W.partitionBy(book).orderBy("chunk_pos")
    first = F.row_number().over(order) == 1
    changed = ~F.lag("chapter_id").over(order).eqNullSafe(F.col("chapter_id"))
    head = F.when(first | changed, F.concat(F.when(first, "").otherwise("\n\n"), F.col("chapter_title"), F.lit("\n\n"))).otherwise("")
    return chunks.select(book, "chunk_pos", F.concat(head, T.strip(F.col("text")), F.lit(" ")).alias("part"))


def report(cue: DataFrame, words: DataFrame, chunks: DataFrame, book: str) -> DataFrame:
    """The thirteen metrics of every book that has chunks, and ``inverted_cues`` (end before start).

    Cues, words and chunks are each counted by book; these counts are one union under one
    aggregate, so no rows are sorted or moved for the report but those of cues for their followers.
    """
    order = W.partitionBy(book).orderBy("cue")
    length = F.col("end") - F.col("start")
    rows = cue.select(book, F.col("cue").cast("long").alias("number"), F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), F.lead("start").over(order).alias("next"), "text")
    wide = F.array_max(F.transform(F.split("text", "\n"), F.length)).cast("long")
    rows = rows.withColumn("cps", T.characters_per_second(F.col("text"), length)).withColumn("wide", wide)
    by_cues = rows.groupBy(book).agg(
        F.count("*").alias("cues"),
        F.min_by("start", "number").alias("first_cue_start"),
        F.max_by("end", "number").alias("last_cue_end"),
        F.max("wide").alias("max_line_length"),
        F.max(length).alias("max_cue_duration"),
        F.count_if(F.col("end") >= F.col("next")).alias("overlap_count"),
        F.count_if(F.col("cps") > 25).alias("cues_over_25_cps"),
        F.round(F.max("cps"), 3).alias("max_cps"),
        F.count_if(length < 0).alias("inverted_cues"),
    )
    by_words = words.groupBy(book).agg(
        F.count("*").alias("words"),
        F.count_if(F.col("end") == F.col("start")).alias("zero_duration_words_from_aligner_quantization"),
        F.count_if(F.col("end") < F.col("start")).alias("negative_word_timings"),
    )
    failed = F.sort_array(F.collect_list(F.when(~F.col("surface_restored"), F.struct(F.col("chunk_pos").cast("long").alias("number"), "id"))))
    by_chunks = chunks.groupBy(book).agg(F.count("*").alias("chunks"), F.transform(failed, lambda x: x["id"]).alias("surface_restore_failures"))
    rows = by_chunks.unionByName(by_words, allowMissingColumns=True).unionByName(by_cues, allowMissingColumns=True)
    one = lambda c: F.first(c, ignorenulls=True)  # noqa: E731  each side has one row for a book at most
    names = ["chunks", "surface_restore_failures", *by_words.columns[1:], *by_cues.columns[1:]]
    plain = {"surface_restore_failures", "first_cue_start", "last_cue_end"}
    out = rows.groupBy(book).agg(*((one(c) if c in plain else F.coalesce(one(c), F.lit(0))).alias(c) for c in names))
    return out.where("chunks > 0")


def event_islands(rows: DataFrame, key: str, time: Column, seq: str, gap: float) -> DataFrame:
    """Rows with ``island``: a pause of ``gap`` or more in ``time`` since the key's last row opens one."""
    order = W.partitionBy(key).orderBy("_time", seq)
    marked = rows.withColumn("_time", time)
    opens = F.coalesce(F.col("_time") - F.lag("_time").over(order) >= gap, F.lit(True)).cast("int")
    return marked.withColumn("_opens", opens).withColumn("island", F.sum("_opens").over(order)).drop("_opens", "_time")
