"""Text expressions: tokens, normal forms, cleaning, wrapping, rendering. All are Column -> Column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Caption line limit in characters.
MAX_LINE = 42
#: A mark that ends a sentence or a clause, with at most one closing quote or bracket after it.
SENTENCE_END, CLAUSE_END = "[.!?][\"'’”)]?$", "[,;:][\"'’”)]?$"
LOCAL_LABELS = ("corrected transcript", "transcript")
REMOTE_LABELS = ("final transcript", "corrected transcript", "transcript")


def normal_token(token: Column) -> Column:
    """Lower case, ASCII letters and digits only."""
    return F.regexp_replace(F.lower(token), "[^a-z0-9]+", "")


def tokens(text: Column) -> Column:
    """Tokens between white space, without empty ones."""
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def lexical_words(text: Column) -> Column:
    """Normal forms of the tokens, without empty ones."""
    return F.filter(F.transform(tokens(text), normal_token), lambda x: x != "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _tidy(text: Column, labels: tuple[str, ...]) -> Column:
    bare = strip(F.regexp_replace(strip(text), "^`+|`+$", ""))
    bare = F.regexp_replace(bare, rf"(?i)^({'|'.join(labels)})\s*:\s*", "")
    bare = F.regexp_replace(bare, "([.!?][\"'’”)]?)([A-Z])", "$1 $2")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def clean_local(text: Column) -> Column:
    """Raw editor output without closed thought blocks, fences and labels; an unclosed block stays."""
    return _tidy(F.regexp_replace(text, r"(?is)<think>.*?</think>", ""), LOCAL_LABELS)


def clean_remote(text: Column) -> Column:
    """What follows the last thought block; a block that is never closed leaves nothing."""
    after = F.when(F.contains(text, F.lit("</think>")), F.substring_index(text, "</think>", -1)).when(F.contains(text, F.lit("<think>")), F.lit("")).otherwise(text)
    return _tidy(after, REMOTE_LABELS)


def ends_sentence(token: Column) -> Column:
    return F.rlike(token, F.lit(SENTENCE_END))


def ends_clause(token: Column) -> Column:
    return F.rlike(token, F.lit(CLAUSE_END))


def join_words(words: Column) -> Column:
    return F.trim(F.array_join(words, " "))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _halves(text: Column, limit: int) -> Column:
    """The most even two lines of the words; null if there are none within the limit.

    The longer line plus 0.2 x the difference grows with the distance from the middle, so
    the best space is the last one up to the middle or the first one after it; of two at
    the same distance the first. If its lines are too long, so are those of any other.
    """

    def parted(words: Column, size: Column, middle: Column) -> Column:
        back, ahead = F.locate(" ", F.reverse(F.substring(words, F.lit(1), middle))), F.locate(" ", F.substring(words, middle + 1, size))
        spaces = F.struct(F.when(back > 0, middle - back + 1).alias("left"), F.when(ahead > 0, middle + ahead).alias("right"))
        nearer = lambda s: F.when(s["right"].isNull() | (size + 1 - s["left"] * 2 <= s["right"] * 2 - size - 1), s["left"]).otherwise(s["right"])
        lines = lambda at: F.when((at - 1 <= limit) & (size - at <= limit), F.concat(F.substring(words, F.lit(1), at - 1), F.lit("\n"), F.substring(words, at + 1, size)))
        return _bound(spaces, lambda s: _bound(nearer(s), lines))

    words = F.trim(F.regexp_replace(text, r"\s+", " "))
    return _bound(words, lambda w: _bound(F.length(w), lambda n: parted(w, n, F.floor((n + 1) / 2).cast("int"))))


def can_wrap(text: Column, limit: int = MAX_LINE) -> Column:
    """Whether the text fits one line or two."""
    return (F.length(text) <= limit) | F.when(text.isNotNull(), _halves(text, limit).isNotNull())


def wrap_balanced(text: Column, limit: int = MAX_LINE) -> Column:
    """The most even two lines within the limit; unchanged if there are none."""
    return F.when(F.length(text) <= limit, text).otherwise(F.coalesce(_halves(text, limit), text))


def timestamp(seconds: Column, comma: bool = True) -> Column:
    """HH:MM:SS,mmm (or with a dot), milliseconds rounded half to even, never negative, hours unbounded."""
    millis = F.greatest(F.lit(0).cast("long"), F.rint(seconds * 1000).cast("long"))
    at = lambda unit, wrap: (F.floor(millis / unit) % wrap if wrap else F.floor(millis / unit)).cast("long")
    return F.format_string(f"%02d:%02d:%02d{',' if comma else '.'}%03d", at(3_600_000, 0), at(60_000, 60), at(1000, 60), (millis % 1000).cast("long"))


def chunk_id(chapter: Column, part: Column) -> Column:
    return F.format_string("c%02d_p%02d", chapter, part)


def chapter_title(tags: Column, chapter: Column) -> Column:
    return F.coalesce(F.try_element_at(tags, F.lit("title")), F.concat(F.lit("Chapter "), chapter.cast("string")))


def frames(seconds: Column, rate: int = 16_000) -> Column:
    return F.rint(seconds * rate).cast("long")


def seconds(frame: Column, rate: int | Column = 16_000) -> Column:
    return F.round(frame / rate, 3)


def characters_per_second(text: Column, duration: Column) -> Column:
    return F.length(F.replace(text, F.lit("\n"), F.lit(""))) / F.greatest(duration, F.lit(0.001))


def url_join(base: Column, suffix: str) -> Column:
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit(suffix))


def prompt(title: Column, part: Column, a: Column, b: Column, glossary: Column, lead: str = "") -> Column:
    """The editor's user message. An empty or null glossary has no block."""
    words = F.coalesce(F.trim(glossary), F.lit(""))
    block = F.when(words != "", F.concat(F.lit("Reference spellings and domain terms:\n"), words, F.lit("\n\n"))).otherwise("")
    return F.concat(
        F.lit(f"{lead}Section: "), title, F.lit(", part "), part.cast("string"), F.lit("\n"), block,
        F.lit("CANDIDATE A:\n"), a, F.lit("\n\nCANDIDATE B:\n"), b, F.lit("\n\nReturn only the faithful consensus transcript."),
    )


def within_counts(count: Column, a: Column, b: Column) -> Column:
    """Whether a consensus has 0.90 x the shorter to 1.05 x the longer candidate's words (each at least 1)."""
    least, most = F.least(a, b), F.greatest(a, b)
    one = lambda x: F.when(x == 0, 1).otherwise(x)
    return (count >= F.lit(0.90) * one(least)) & (count <= F.lit(1.05) * one(most))
