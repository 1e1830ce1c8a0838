"""Two transcripts of one interval to a consensus, with a pluggable editor."""

from __future__ import annotations

import pickle
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelattice.functions import sequence as S
from cuelattice.functions import text as T

#: An editor: (prompt, attempt from 0) -> (raw text, whether it was cut off by the token budget).
Editor = Callable[[str, int], tuple[str, bool]]
#: Fixed labels of a record's method.
MERGED, FAILED = "mechanical-fallback", "error-fallback"
SIMILAR = 0.70


def candidate_pairs(chunks: DataFrame, a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """Chunks with a_text, b_text, their lexical words and whether these are identical. Strict: use require_complete first."""
    side = lambda d, n: d.select(key, T.strip(F.col("text")).alias(f"{n}_text"))
    rows = chunks.join(side(a, "a"), key).join(side(b, "b"), key)
    rows = rows.withColumn("a_words", T.lexical_words(F.col("a_text"))).withColumn("b_words", T.lexical_words(F.col("b_text")))
    return rows.withColumn("identical", F.col("a_words") == F.col("b_words"))


def valid(rows: DataFrame, text: str = "text") -> DataFrame:
    """Rows (text, a_text, b_text) with ``valid``: counts and the length bound first, matching only where they pass."""
    words = T.lexical_words(F.col(text))
    side = lambda n: T.lexical_words(F.col(f"{n}_text"))
    bound = F.greatest(S.ratio_bound(words, side("a")), S.ratio_bound(words, side("b")))
    possible = S.valid_by_counts(F.col(text), F.col("a_text"), F.col("b_text")) & (bound >= SIMILAR)
    # what cannot pass is matched as two empty arrays, so the rows are read once
    kept = lambda words: F.when(possible, words).otherwise(F.array().cast("array<string>"))
    ratio = F.greatest(S.seq_ratio(kept(words), kept(side("a"))), S.seq_ratio(kept(words), kept(side("b"))))
    return rows.withColumn("valid", F.coalesce(possible, F.lit(False)) & (ratio >= SIMILAR))


def consensus(pairs: DataFrame, editor: Editor, label: str, clean: str = "remote", glossary: str = "", attempts: int = 2, at_once: int = 4) -> DataFrame:
    """Pairs with text, method and similarity (6 digits).

    Identical pairs take b's text and never reach the editor: they are a branch of the
    plan of their own, not a condition around a function. Of the others, an answer that
    passes the checks stays; it is asked again only if it was cut off; an invalid one or
    an error gives the mechanical merge. A task asks for ``at_once`` pairs at a time;
    ``elapsed_seconds`` is each pair's own. ``pairs`` should be a written table, since both
    branches read it.
    """
    pairs = pairs.withColumn("similarity", F.lit(None).cast("double"))
    same = pairs.where("identical").withColumn("text", F.col("b_text")).withColumn("method", F.lit("identical")).withColumn("elapsed_seconds", F.lit(0.0)).withColumn("similarity", F.lit(1.0))
    rest = pairs.where("NOT identical").withColumn("similarity", F.round(S.seq_ratio("a_words", "b_words"), 6))
    rest = rest.withColumn("prompt", T.prompt(F.col("chapter_title"), F.col("part"), F.col("a_text"), F.col("b_text"), F.lit(glossary)))

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            # every thread has an editor of its own, and so a connection of its own
            with ThreadPoolExecutor(at_once, initializer=lambda: setattr(own, "editor", pickle.loads(sent))) as pool:
                asked = lambda p, a, b: _timed(own.editor, p, a, b, label, clean, attempts)
                found = list(pool.map(asked, frame["prompt"], frame["a_text"], frame["b_text"]))
            yield frame.drop(columns="prompt").assign(text=[t for t, _, _ in found], method=[m for _, m, _ in found], elapsed_seconds=[s for _, _, s in found])

    sent, own = cloudpickle.dumps(editor), _Own()
    schema = ", ".join(f"`{n}` {t}" for n, t in rest.drop("prompt").dtypes) + ", text string, method string, elapsed_seconds double"
    return same.unionByName(rest.mapInPandas(scan, schema))


class _Own(threading.local):
    """What a thread keeps; it is not sent to workers with its contents."""

    def __reduce__(self):
        return _Own, ()


def _timed(editor: Editor, *pair) -> tuple[str, str, float]:
    began = time.monotonic()
    return *_ask(editor, *pair), round(time.monotonic() - began, 3)


def _ask(editor: Editor, prompt: str, a: str, b: str, label: str, clean: str, attempts: int) -> tuple[str, str]:
    try:
        for attempt in range(attempts):
            raw, cut = editor(prompt, attempt)
            text = cleaned(raw, clean)
            if acceptable(text, a, b):
                return text, label
            if not cut:
                break
    except Exception:  # noqa: BLE001  whatever an editor raises, the pair keeps a text
        return S.merged(a, b), f"{label.partition(':')[0]}-{FAILED}"
    return S.merged(a, b), f"{label.partition(':')[0]}-{MERGED}"


def cleaned(raw: str, variant: str) -> str:
    """Plain-Python twin of clean_local / clean_remote, for editors that run inside a task."""
    import re

    labels = T.LOCAL_LABELS if variant == "local" else T.REMOTE_LABELS
    if variant == "local":
        raw = re.sub(r"(?is)<think>.*?</think>", "", raw)
    elif "</think>" in raw:
        raw = raw.rpartition("</think>")[2]
    elif "<think>" in raw:
        return ""
    raw = re.sub(rf"(?i)^({'|'.join(labels)})\s*:\s*", "", raw.strip().strip("`").strip())
    return " ".join(re.sub("([.!?][\"'’”)]?)([A-Z])", r"\1 \2", raw).split())


def acceptable(text: str, a: str, b: str) -> bool:
    """Plain-Python twin of ``valid``."""
    words, x, y = ([n for t in s.split() if (n := S.normal(t))] for s in (text, a, b))
    least, most = min(len(x), len(y)) or 1, max(len(x), len(y)) or 1
    if not text or "```" in text or not 0.90 * least <= len(words) <= 1.05 * most:
        return False
    return max(S.matcher(words, x).ratio(), S.matcher(words, y).ratio()) >= SIMILAR


def records(pairs: DataFrame, editor_model: str) -> DataFrame:
    """Consensus records: word counts beside text, method and similarity."""
    size = lambda c: F.size(c).cast("long")
    return pairs.select(
        "id", F.lit(editor_model).alias("editor_model"), "method", "similarity", size("a_words").alias("a_word_count"), size("b_words").alias("b_word_count"),
        size(T.lexical_words(F.col("text"))).alias("consensus_word_count"), "text", "elapsed_seconds",
    )
