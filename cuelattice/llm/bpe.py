"""Byte-pair token counts by a heap and a linked list, without emitting identifiers.

Each piece of the pre-tokeniser starts as one symbol per byte. A heap holds every
adjacent pair that the merge table knows, keyed by rank and place; the lowest is
popped, stale entries are skipped, and the two symbols are joined in a doubly
linked list. The count is the initial symbols minus the merges. Long pieces
(a hundred thousand letters without a space) take n log n steps.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelattice.llm.common import arrow_batches

#: Fixed values of the byte-level format: Unicode white space and the split pattern.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WHITE + r"\p{L}\p{N}]+|[" + WHITE + r"]+(?![^" + WHITE + r"])|[" + WHITE + r"]+"
#: A coarser split whose parts end where parts of SPLIT end: it never looks inside a run without white space.
COARSE = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Entries of one generation of a worker's memo; there are two generations, so memory is bounded.
MEMO = 400_000


def byte_letters() -> list[str]:
    """The printable letter that the byte-level format writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Memo:
    """What a worker has worked out for short strings; when the new generation is full, the old one goes."""

    def __init__(self, entries: int = MEMO, longest: int = 64):
        self.new: dict = {}
        self.old: dict = {}
        self.entries, self.longest = entries, longest

    def keep(self, key, value):
        if len(key) <= self.longest:
            if len(self.new) >= self.entries:
                self.old, self.new = self.new, {}
            self.new[key] = value
        return value


class PairCounter:
    """Counts tokens of one ``.json`` byte-level BPE file. Symbols are small integers, bytes first."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        back = {ord(c): b for b, c in enumerate(byte_letters())}
        number = {bytes([b]): b for b in range(256)}
        self.ranks: dict[int, int] = {}
        self.joined: list[int] = []
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = (x.translate(back).encode("latin-1") for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.ranks[number[left] << 32 | number[right]] = rank
            self.joined.append(number.setdefault(left + right, len(number)))
        added = sorted((t["content"] for t in data.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.split = regex.compile(SPLIT)
        self.coarse, self.fine = Memo(), Memo()

    def merge(self, piece: str) -> int:
        """Tokens of one pre-tokeniser piece. An agenda entry is rank and place in one integer."""
        symbols = list(piece.encode("utf-8"))
        n = len(symbols)
        if n == 1:
            return 1
        rank_of, joined = self.ranks.get, self.joined
        agenda = [r << 32 | i for i in range(n - 1) if (r := rank_of(symbols[i] << 32 | symbols[i + 1])) is not None]
        heapq.heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while agenda:
            entry = heapq.heappop(agenda)
            i = entry & 0xFFFFFFFF
            if (left := symbols[i]) < 0 or (j := after[i]) >= n or rank_of(left << 32 | symbols[j]) != entry >> 32:
                continue  # one of the two has been merged since
            symbols[i] = new = joined[entry >> 32]
            symbols[j] = -1
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(new << 32 | symbols[k])) is not None:
                    heapq.heappush(agenda, r << 32 | i)
            if (h := before[i]) >= 0 and (r := rank_of(symbols[h] << 32 | new)) is not None:
                heapq.heappush(agenda, r << 32 | h)
        return n - merges

    def run(self, part: str) -> int:
        """Tokens of one part of the coarse split."""
        total, fine = 0, self.fine
        for piece in self.split.findall(part):
            n = fine.new.get(piece)
            if n is None and (n := fine.old.get(piece)) is None:
                n = fine.keep(piece, self.merge(piece))
            total += n
        return total

    def count(self, text: str) -> int:
        """Tokens of a whole text; a special string inside it counts as one token, as the library has it."""
        if self.special and (found := self.special.findall(text)):
            return len(found) + sum(self.count_plain(x) for x in self.special.split(text))
        return self.count_plain(text)

    def count_plain(self, text: str) -> int:
        total, memo = 0, self.coarse
        known = memo.new.get
        for part in COARSE.findall(text):
            n = known(part)
            if n is None:
                if (n := memo.old.get(part)) is None:
                    n = self.run(part)
                memo.keep(part, n)
                known = memo.new.get
            total += n
        return total


_counters: dict[str, PairCounter] = {}


def counter(path: str) -> PairCounter:
    """The worker's counter for a vocabulary file; it lives as long as the worker."""
    if path not in _counters:
        _counters[path] = PairCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row.

    ``path`` is the vocabulary file's place on the executors. Nothing is shuffled.
    A null text counts as empty (0 tokens); repeated rows are counted each; a null
    doc_id stays null; other columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens = [count(t) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    read = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    kind = dict(read.dtypes)["doc_id"]
    return arrow_batches(read, scan, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
