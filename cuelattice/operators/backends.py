"""Interfaces to speech, alignment and editing models, with deterministic stand-ins.

A backend is a picklable factory that is called once per worker and returns a function
over one chunk; no model ships with the library. ``transcribe`` and ``align`` deal the
chunks to Arrow batches, so a real model is loaded lazily where the data is.
"""

from __future__ import annotations

import http.client
import json
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelattice.sources.schemas import WORD

#: (chunk as a dict) -> (text, [(word, start, end)] in seconds from the chunk's start; start or end may be None)
Recogniser = Callable[[dict], tuple[str, list[tuple]]]


def transcribe(chunks: DataFrame, factory: Callable[[], Recogniser], model: str) -> DataFrame:
    """Chunks with model, text, absolute words and elapsed_seconds (of a batch, shared by its chunks): words without a start go, an open end is the chunk's duration."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recognise = None
        for frame in frames:
            recognise = recognise or factory()
            began = time.monotonic()
            found = [recognise(c) for c in frame.to_dict("records")]
            each = round((time.monotonic() - began) / max(1, len(found)), 3)
            words = [[{"text": t, "start": s, "end": e} for t, s, e in w] for _, w in found]
            yield frame.drop(columns=["text", "words", "elapsed_seconds"], errors="ignore").assign(text=[t for t, _ in found], words=words, elapsed_seconds=each)

    kept = [(n, t) for n, t in chunks.dtypes if n not in ("text", "words", "elapsed_seconds")]
    schema = ", ".join(f"`{n}` {t}" for n, t in kept) + f", text string, words array<{WORD}>, elapsed_seconds double"
    rows = chunks.mapInPandas(scan, schema).withColumn("model", F.lit(model))
    timed = F.transform(
        F.filter("words", lambda w: w["start"].isNotNull()),
        lambda w: F.struct(w["text"].alias("text"), F.round(F.col("start") + w["start"], 3).alias("start"), F.round(F.col("start") + F.coalesce(w["end"], F.col("duration")), 3).alias("end")),
    )
    return rows.withColumn("words", timed)


def even_spread(chunk: dict) -> tuple[str, list[tuple]]:
    """A stand-in: the words of the chunk's title, spread evenly over it."""
    words = str(chunk["chapter_title"]).split()
    step = chunk["duration"] / max(1, len(words))
    return " ".join(words), [(w, i * step, (i + 1) * step) for i, w in enumerate(words)]


def even_spread_factory() -> Recogniser:
    return even_spread


def second_candidate(prompt: str, attempt: int) -> tuple[str, bool]:
    """A stand-in editor: answers with candidate B."""
    return prompt.rpartition("CANDIDATE B:\n")[2].rpartition("\n\nReturn only")[0], False


#: Fixed values of a request: token budgets of the first and the second attempt, seconds to connect and to read, what a second attempt adds.
BUDGETS, CONNECT, READ = (4096, 8192), 15, 900
AGAIN = "\nDo not include analysis; keep the answer within the candidate length."


class HttpEditor:
    """An editor behind an HTTP server: called with (prompt, attempt), it returns (text, whether the budget cut it off).

    ``style`` is "completions" (POST base/chat/completions) or "chat" (POST base/api/chat). A
    worker keeps one connection and opens it again once when the server has closed it; other
    failures are the caller's. A prompt is sent as it is, with ``system`` before it.
    """

    def __init__(self, base: str, model: str, system: str = "", style: str = "completions", lead: str = "", budgets: tuple[int, ...] = BUDGETS, connect: float = CONNECT, read: float = READ):
        if style not in ("completions", "chat"):
            raise ValueError(f"unknown style: {style}")
        self.url = base.rstrip("/") + ("/chat/completions" if style == "completions" else "/api/chat")
        self.model, self.system, self.style, self.lead = model, system, style, lead
        self.budgets, self.connect, self.read = budgets, connect, read
        self._open: http.client.HTTPConnection | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_open": None}  # connections stay with their worker

    def __call__(self, prompt: str, attempt: int) -> tuple[str, bool]:
        body = self._post(self.payload(prompt, attempt))
        if self.style == "chat":
            return body.get("message", {}).get("content", ""), body.get("done_reason") == "length"
        choice = (body.get("choices") or [{}])[0]
        return choice.get("message", {}).get("content", ""), choice.get("finish_reason") == "length"

    def payload(self, prompt: str, attempt: int) -> dict:
        budget = self.budgets[min(attempt, len(self.budgets) - 1)]
        user = self.lead + prompt + (AGAIN if attempt and self.style == "completions" else "")
        messages = [{"role": "system", "content": self.system}, {"role": "user", "content": user}]
        if self.style == "chat":
            return {"model": self.model, "messages": messages, "stream": False, "think": False, "options": {"temperature": 0, "num_predict": budget}}
        return {"model": self.model, "messages": messages, "temperature": 0, "max_tokens": budget}

    def _post(self, payload: dict) -> dict:
        at, data = urlsplit(self.url), json.dumps(payload).encode()
        for last in (False, True):
            fresh = self._open is None
            if fresh:
                kind = http.client.HTTPSConnection if at.scheme == "https" else http.client.HTTPConnection
                self._open = kind(at.netloc, timeout=self.connect)
                self._open.connect()
                self._open.sock.settimeout(self.read)
            try:
                self._open.request("POST", at.path, data, {"Content-Type": "application/json"})
                answer = self._open.getresponse()
                content = answer.read()
            except (http.client.RemoteDisconnected, ConnectionError):
                self._open = None
                if fresh or last:
                    raise
                continue  # a kept connection that the server has closed
            except Exception:
                self._open = None
                raise
            if answer.status >= 400:
                raise OSError(f"the editor answered {answer.status}")
            return json.loads(content)
        raise AssertionError
