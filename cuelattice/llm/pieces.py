"""SentencePiece encoding with seeded merge-dropout, and decoding.

The vocabulary is a public merge-type model; its pieces and scores come from the
sentencepiece library. A text is parted before each run of the space mark, which no
piece crosses. In a part, an agenda holds the adjacent symbols that make a piece,
best score first, then leftmost; each candidate that is taken is skipped when its
keyed hash falls below the dropout rate, else the symbols are joined. The key is drawn
from the seed, the document and the place of the part, and the hash from the key, the
piece and the place in the part: every occurrence of a word meets skips of its own, and a
document has the same segmentation in every run and retry.

The agendas of all short parts of a batch are worked off side by side: each turn takes
the best candidate of every part that has one, as array operations over a linked list
per part. The agenda of a long part is a heap. Both take the same candidates in the same
order. Nothing is remembered between batches, so memory and speed do not hang on how
often words repeat. Characters without a piece become byte pieces, so whatever was
skipped, the identifiers decode to the text.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelattice.llm.common import arrow_batches, crc32

SPACE = "▁"
_M1, _M2, _MASK = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, (1 << 64) - 1

#: Characters of the parts that are worked off side by side, by the width of their arrays, and parts in one go.
WIDTHS, ROWS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 48, 63), 1 << 15
#: Characters that are encoded at once; longer texts are cut between parts.
CHUNK = 1 << 20
#: What is no candidate, and a symbol that was joined to the left.
_NONE, _GONE = np.int32((1 << 31) - 1), np.int32(-1)


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def opens_of(chars: np.ndarray) -> np.ndarray:
    """Whether a part opens at each character: at the first of a run of space marks, and at the start."""
    mark = chars == ord(SPACE)
    opens = mark & ~np.r_[False, mark[:-1]]
    opens[:1] = True
    return opens


def between_parts(normal: str, size: int) -> Iterator[str]:
    """The normal form in stretches of about ``size`` characters that end where parts end."""
    at = 0
    while len(normal) - at > size:
        cut = normal.find(SPACE, at + size)
        while cut > 0 and normal[cut - 1] == SPACE:
            cut = normal.find(SPACE, cut + 1)
        if cut < 0:
            break
        yield normal[at:cut]
        at = cut
    yield normal[at:]


class Pairs:
    """Which two symbols make which piece: an open-addressing table that is read by arrays."""

    def __init__(self, pairs: dict[int, int]):
        bits = max(10, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        keys, values = [_MASK] * (1 << bits), [0] * (1 << bits)
        for key, value in pairs.items():
            at = (key * _M1 & _MASK) >> (64 - bits)
            while keys[at] != _MASK:
                at = at + 1 & self.mask
            keys[at], values[at] = key, value
        self.keys, self.values = np.array(keys, np.uint64), np.array(values, np.int32)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of each two symbols, -1 if they make none."""
        key = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = (key * np.uint64(_M1) >> self.shift).astype(np.int64)
        there = self.keys[at]
        hit = there == key
        out = np.where(hit, self.values[at], np.int32(-1))
        left_over = np.flatnonzero(~hit & (there != np.uint64(_MASK)))
        while len(left_over):
            at[left_over] = at[left_over] + 1 & self.mask
            there = self.keys[at[left_over]]
            hit = there == key[left_over]
            out[left_over[hit]] = self.values[at[left_over[hit]]]
            left_over = left_over[~hit & (there != np.uint64(_MASK))]
        return out


class Segmenter:
    """Encoder and decoder of one ``.model`` file. A piece's symbol is its rank; characters without a piece come after."""

    def __init__(self, path: str, dropout: float = 0.1, seed: int = 0):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(size)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_unused(i) for i in range(size)]
        plain = [i for i in range(size) if not special[i] and not library.is_byte(i)]
        crossing = [names[i] for i in plain if SPACE in names[i].lstrip(SPACE)]
        if crossing:
            raise ValueError(f"pieces cross a space mark: {crossing[:3]}")
        order = sorted(plain, key=lambda i: (-library.get_score(i), i))
        self.ranks = {names[i]: r for r, i in enumerate(order)}
        self.ids = np.array(order, dtype="<i4")
        symbols = dict(self.ranks)
        for name in self.ranks:
            for c in name:
                symbols.setdefault(c, len(symbols))
        self.unknown = len(symbols)
        self.first = np.full(0x110000, self.unknown, np.int32)  # the symbol of each character
        for name, s in symbols.items():
            if len(name) == 1:
                self.first[ord(name)] = s
        pairs = {}
        for name, r in self.ranks.items():
            for k in range(1, len(name)):
                if (a := symbols.get(name[:k])) is not None and (b := symbols.get(name[k:])) is not None:
                    pairs[a << 32 | b] = r
        self.pairs = Pairs(pairs)
        self.bytes = {int(names[i][3:5], 16): i for i in range(size) if library.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces, so not every text has a lossless encoding")
        # what each identifier stands for; control pieces stand for nothing
        meaning = [b"" if special[i] else names[i].replace(SPACE, " ").encode() for i in range(size)]
        for value, i in self.bytes.items():
            meaning[i] = bytes([value])
        self.meaning = np.frombuffer(b"".join(meaning), dtype=np.uint8)
        self.sizes = np.array([len(m) for m in meaning])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.mark = np.array([self.bytes[b] for b in SPACE.encode()], dtype="<i4")
        self.prefix = library.normalize("a") != "a"
        self.dropout, self.seed = int(dropout * (1 << 32)), seed

    def skipped(self, keys: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each candidate is skipped: drawn from its part's key, its piece and its place."""
        entry = ranks.astype(np.uint64) << np.uint64(32) | places.astype(np.uint64)
        return ((keys ^ entry * np.uint64(_M1)) * np.uint64(_M2) >> np.uint64(32)) < np.uint64(self.dropout)

    def short(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray, keys: np.ndarray) -> None:
        """Join the symbols of parts [begin, begin + size) in place, all parts side by side."""
        n, width = len(begin), int(size.max())
        row = np.arange(width, dtype=np.int64)[:, None]
        there = row < size
        s = np.where(there, symbols[np.minimum(begin + row, len(symbols) - 1)], self.unknown).astype(np.int32)
        found = self.pairs.find(s[:-1].ravel(), s[1:].ravel()).reshape(width - 1, n)
        # an agenda entry is rank and place in one number; the least is the best
        agenda = np.where((found >= 0) & there[1:], found << 6 | np.arange(width - 1, dtype=np.int32)[:, None], _NONE).astype(np.int32)
        after = np.repeat(np.arange(1, width + 1, dtype=np.int8)[:, None], n, axis=1)
        before = np.repeat(np.arange(-1, width - 1, dtype=np.int8)[:, None], n, axis=1)
        flat, after, before = s.ravel(), after.ravel(), before.ravel()
        part = np.arange(n)  # of the columns that are still in the agenda
        while True:
            best = agenda.min(axis=0)
            at = np.flatnonzero(best != _NONE)
            if not len(at):
                break
            if 2 * len(at) < len(part):
                agenda, part, best = np.ascontiguousarray(agenda[:, at]), part[at], best[at]
                at = np.arange(len(at))
            rank, i = best[at] >> 6, best[at] & 63
            if self.dropout:
                skip = self.skipped(keys[part[at]], rank, i)
                agenda[i[skip], at[skip]] = _NONE
                at, rank, i = at[~skip], rank[~skip], i[~skip]
            p = part[at]
            here = i * n + p
            j = after[here].astype(np.int64)
            k = after[j * n + p].astype(np.int64)
            flat[here], flat[j * n + p] = rank, _GONE
            after[here] = k
            inner = j < width - 1
            agenda[j[inner], at[inner]] = _NONE
            more = k < size[p]
            before[k[more] * n + p[more]] = i[more]
            agenda[i, at] = _NONE
            self._offer(agenda, i[more], at[more], rank[more], flat[k[more] * n + p[more]])
            h = before[here].astype(np.int64)
            less = h >= 0
            h = h[less]
            agenda[h, at[less]] = _NONE
            self._offer(agenda, h, at[less], flat[h * n + p[less]], rank[less])
        symbols[(begin + row)[there]] = s[there]

    def _offer(self, agenda: np.ndarray, place: np.ndarray, column: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        found = self.pairs.find(left, right)
        ok = found >= 0
        agenda[place[ok], column[ok]] = found[ok] << 6 | place[ok].astype(np.int32)

    def long(self, text: str, key: int) -> list[str]:
        """Symbols of a long part, by a heap and a linked list; a symbol is a span [i, end[i]), end 0 if joined to the left."""
        n, rank_of, dropout = len(text), self.ranks.get, self.dropout
        agenda = [r << 32 | i for i in range(n - 1) if (r := rank_of(text[i : i + 2])) is not None]
        heapq.heapify(agenda)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            entry = heapq.heappop(agenda)
            i = entry & 0xFFFFFFFF
            j = end[i]
            if not j or j >= n or rank_of(text[i : (k := end[j])]) != entry >> 32:
                continue  # one of the two has been joined since
            if dropout and (key ^ entry * _M1 & _MASK) * _M2 >> 32 & 0xFFFFFFFF < dropout:
                continue
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
                if (r := rank_of(text[i : end[k]])) is not None:
                    heapq.heappush(agenda, r << 32 | i)
            if (h := before[i]) >= 0 and (r := rank_of(text[h:k])) is not None:
                heapq.heappush(agenda, r << 32 | h)
        return [text[i : end[i]] for i in range(n) if end[i]]

    def normals(self, text: str) -> list[str]:
        """The library's normal form of the text between space marks; a mark in the text itself is written as bytes."""
        if SPACE not in text:
            return [self.library.normalize(text) if text else ""]
        out = []
        for k, piece in enumerate(text.split(SPACE)):
            normal = self.library.normalize(piece) if piece else ""
            if piece and k and self.prefix:
                normal = normal[len(SPACE) :]
            elif not piece and not k and self.prefix:
                normal = SPACE
            out.append(normal)
        return out

    def encode_all(self, texts: list[str], keys: list[str]) -> list[np.ndarray]:
        """Identifiers (int32) of whole texts. A text's key (its document) draws what is skipped."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, str, int, int]] = []  # text, characters, drawn key, parts before in the stretch

        def work_off() -> None:
            ids, ends = self.encode_stretches([h[1] for h in held], [h[2] for h in held], [h[3] for h in held])
            for h, x in zip(held, np.split(ids, ends[:-1])):
                out[h[0]].append(x)
            held.clear()

        room = CHUNK
        for t, (text, key) in enumerate(zip(texts, keys)):
            for k, normal in enumerate(self.normals(text)):
                drawn, before = xxhash.xxh64_intdigest(f"{key}/{k}", self.seed & _MASK), 0
                for m, some in enumerate(between_parts(normal, CHUNK)):
                    if held and len(some) > room:
                        work_off()
                        room = CHUNK
                    if k and not m:
                        held.append((t, "", drawn, -1))  # where the mark goes
                    held.append((t, some, drawn, before))
                    room -= len(some)
                    if len(some) < len(normal):
                        before += int(opens_of(characters(some)).sum())
        if held:
            work_off()
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def encode_stretches(self, stretches: list[str], drawn: list[int], before: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """All identifiers of normal forms, one after another, and where each ends. ``before`` is the number of each one's first part, -1 for a space mark of the text."""
        lengths = np.array([len(x) for x in stretches], dtype=np.int64)
        chars, base = characters("".join(stretches)), np.array(before, dtype=np.int64)
        first = np.cumsum(lengths) - lengths
        opens = opens_of(chars)
        opens[first[lengths > 0]] = True
        begin = np.flatnonzero(opens)
        size = np.diff(np.r_[begin, len(chars)])
        stretch = np.searchsorted(first, begin, side="right") - 1
        number = np.arange(len(begin)) - np.searchsorted(begin, first)[stretch] + base[stretch]
        keys = (np.array(drawn, np.uint64)[stretch] + number.astype(np.uint64)) * np.uint64(_M1)
        keys = (keys ^ keys >> np.uint64(30)) * np.uint64(_M2)
        keys ^= keys >> np.uint64(27)
        symbols = self.first[chars]
        by_width = np.searchsorted(WIDTHS, size)
        order = np.argsort(by_width, kind="stable")
        bounds = np.searchsorted(by_width[order], np.arange(len(WIDTHS) + 1))
        for lo, hi in zip(bounds, bounds[1:]):
            for at in range(lo, hi, ROWS):
                some = order[at : min(at + ROWS, hi)]
                some = some[size[some] > 1]
                if len(some):
                    self.short(symbols, begin[some], size[some], keys[some])
        for p in order[bounds[-1] :].tolist():
            b, n = int(begin[p]), int(size[p])
            text = chars[b : b + n].tobytes().decode("utf-32-le", "surrogatepass")
            symbols[b : b + n] = _GONE
            at = b
            for x in self.long(text, int(keys[p])):
                symbols[at] = self.ranks[x] if x in self.ranks else self.first[ord(x)]
                at += len(x)
        ids, ends = self._identified(symbols, chars, np.cumsum(lengths))
        marks = np.flatnonzero(base < 0)
        if len(marks):
            ids = np.insert(ids, np.repeat(ends[marks], len(self.mark)), np.tile(self.mark, len(marks)))
            ends = ends + len(self.mark) * np.cumsum(base < 0)
        return ids, ends

    def _identified(self, symbols: np.ndarray, chars: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(chars):
            return np.empty(0, "<i4"), np.zeros(len(ends), np.int64)
        times = (symbols != _GONE).astype(np.int64)
        bare = np.flatnonzero(symbols >= len(self.ids))  # characters without a piece
        spelled = {c: [self.bytes[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in np.unique(chars[bare]).tolist()}
        for c, x in spelled.items():
            times[bare[chars[bare] == c]] = len(x)
        stop = np.cumsum(times)
        out = np.empty(int(stop[-1]), "<i4")
        known = (symbols != _GONE) & (symbols < len(self.ids))
        out[stop[known] - 1] = self.ids[symbols[known]]
        for c, x in spelled.items():
            at = bare[chars[bare] == c]
            for k, i in enumerate(x):
                out[stop[at] - len(x) + k] = i
        return out, np.r_[0, stop][ends]

    def encode(self, text: str, key: str = "") -> bytes:
        """Identifiers of one text, four bytes each, little-endian."""
        return self.encode_all([text], [key])[0].tobytes()

    def decode(self, ids: bytes | np.ndarray) -> bytes:
        """The UTF-8 of identifiers."""
        ids = np.frombuffer(ids, dtype="<i4") if isinstance(ids, bytes) else ids
        sizes = self.sizes[ids]
        total = int(sizes.sum())
        from_ = np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes)
        data = self.meaning[from_ + np.arange(total)].tobytes()
        return data[1:] if self.prefix and data.startswith(b" ") else data


_segmenters: dict[tuple, Segmenter] = {}


def segmenter(path: str, dropout: float, seed: int) -> Segmenter:
    at = (path, dropout, seed)
    if at not in _segmenters:
        _segmenters.clear()
        _segmenters[at] = Segmenter(*at)
    return _segmenters[at]


def encode(docs: DataFrame, path: str, dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """doc_id, ids array<int> of every row. A null or empty text has no identifiers; nothing is shuffled."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = segmenter(path, dropout, seed)
        for batch in batches:
            data = tool.encode_all([t or "" for t in batch.column(1).to_pylist()], [str(d) for d in batch.column(0).to_pylist()])
            offsets = pa.array(np.r_[0, np.cumsum([len(x) for x in data])].astype(np.int32))
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, "<i4"), *data])))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return arrow_batches(docs.select("doc_id", "text"), scan, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of every row of (doc_id, ids). Null identifiers give a null text; bytes that are no UTF-8 become U+FFFD."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = segmenter(path, 0.0, 0)
        for batch in batches:
            texts = [None if x.values is None else tool.decode(x.values.to_numpy(zero_copy_only=False)).decode("utf-8", "replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = dict(encoded.dtypes)["doc_id"]
    return arrow_batches(encoded.select("doc_id", "ids"), scan, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, dropout: float = 0.1, seed: int = 0) -> DataFrame:
    """doc_id, n_ids, ids_crc32, decoded_crc32, lossless of every row: each text encoded and decoded again.

    A null text counts as empty (no identifiers); repeated rows get equal segmentations;
    a null doc_id draws as the word None; other columns are not read; an empty table gives
    an empty result.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = segmenter(path, dropout, seed)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes, sums, back, same = [], [], [], []
            for text, ids in zip(texts, tool.encode_all(texts, [str(d) for d in batch.column(0).to_pylist()])):
                data = tool.decode(ids)
                sizes.append(len(ids))
                sums.append(crc32(ids.tobytes()))
                back.append(crc32(data))
                same.append(data == text.encode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(back, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "n_ids", "ids_crc32", "decoded_crc32", "lossless"])

    kind = dict(docs.dtypes)["doc_id"]
    return arrow_batches(docs.select("doc_id", "text"), scan, f"doc_id {kind}, n_ids long, ids_crc32 long, decoded_crc32 long, lossless boolean")
