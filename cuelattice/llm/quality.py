"""Document quality by attention over passages (multiple-instance learning).

A document is a bag of passages (512 code points each, all of them). A passage is
encoded from its characters: shares of character classes, hashed character pairs,
word lengths, repeated words. A layer turns each into a representation, gated
attention weighs them (tanh branch times sigmoid branch, softmax within the
document), and the weighted sum is scored. Only documents carry labels; which
passages matter is learned from them.

Learning runs on a bounded sample of labelled rows (``sample`` rows and ``passages``
passages, documented parameters: the rows of the least identifier hashes, whole texts), so the
driver holds some megabytes whatever the corpus. Scoring is one pass without a shuffle and
standardises and clips features as learning does. Texts of over a million code points
are turned into features in stretches; a stretch begins a new word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuelattice.llm.common import arrow_batches, materialise

PASSAGE = 512
#: Labelled rows that learning takes at most, and passages of all of them together (360 bytes each).
SAMPLE, PASSAGES = 6_000, 120_000
#: Standardised features beyond this count as this.
CLIP = 8.0
#: Code points that are turned into features at once.
CHUNK = 1 << 20
PAIRS = 64
_CLASSES = 20


def _class_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)
    for c in range(256):
        ch = chr(c)
        if "a" <= ch <= "z":
            table[c] = 1
        elif "A" <= ch <= "Z":
            table[c] = 2
        elif ch.isdigit():
            table[c] = 3
        elif ch == "\n":
            table[c] = 4
        elif ch.isspace():
            table[c] = 5
        elif c >= 128:
            table[c] = 6 if ch.isalpha() else 7
        else:
            marks = ".,!?;:'\"-|#*"
            table[c] = 8 + marks.index(ch) if ch in marks[:11] else 19
    return table


_TABLE = _class_table()
_WEIGHTS = np.random.default_rng(5).integers(1, 1 << 62, 64, dtype=np.uint64) | np.uint64(1)
WIDTH = _CLASSES + PAIRS + 6


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of passage features, and how many rows each text has (at least one)."""
    out, sizes, at = [], [], 0
    while at < len(texts):
        if len(texts[at]) > CHUNK:  # in stretches of whole passages; the words of one are known to the next
            known = np.empty(0, np.uint64)
            rows = 0
            for a in range(0, len(texts[at]), CHUNK):
                x, n, known = _features([texts[at][a : a + CHUNK]], known)
                out.append(x)
                rows += int(n[0])
            sizes.append(np.array([rows]))
            at += 1
            continue
        total, end = len(texts[at]), at + 1
        while end < len(texts) and total + len(texts[end]) <= CHUNK:
            total, end = total + len(texts[end]), end + 1
        x, n, _ = _features(texts[at:end])
        out.append(x)
        sizes.append(n)
        at = end
    return (np.concatenate(out), np.concatenate(sizes)) if out else (np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64))


def _features(texts: list[str], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Features and rows of texts; ``known`` are hashes of words that a single text has had before, and are returned with its own."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    rows = np.maximum(1, -(-lengths // PASSAGE))
    first_row, first_char = np.cumsum(rows) - rows, np.cumsum(lengths) - lengths
    doc = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(c)) - first_char[doc]
    row = first_row[doc] + place // PASSAGE
    n = int(rows.sum())
    kind = np.where(c < 256, _TABLE[np.minimum(c, 255)], 6)
    size = np.maximum(1, np.bincount(row, minlength=n)).astype(np.float64)
    by_class = np.bincount(row * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES) / size[:, None]
    lower = np.where(kind == 2, c + 32, c)
    pair = (lower[:-1] * 31 + lower[1:] * 17 + (kind[:-1] * 5)) % PAIRS if len(c) > 1 else np.zeros(0, np.int64)
    same = row[:-1] == row[1:] if len(c) > 1 else np.zeros(0, bool)
    by_pair = np.bincount(row[:-1][same] * PAIRS + pair[same], minlength=n * PAIRS).reshape(n, PAIRS) / size[:, None] if len(c) > 1 else np.zeros((n, PAIRS))
    extra = np.zeros((n, 6))
    solid = (kind != 4) & (kind != 5)
    begins = np.flatnonzero(solid & np.r_[True, ~solid[:-1] | (doc[1:] != doc[:-1])]) if len(c) else np.zeros(0, np.int64)
    if len(begins):
        word_row, word_doc = row[begins], doc[begins]
        spans = np.diff(np.r_[begins, len(c)])
        offset = np.arange(begins[0], len(c)) - np.repeat(begins, spans)
        mixed = (lower[begins[0] :].astype(np.uint64) + np.uint64(7)) * _WEIGHTS[offset & 63] * solid[begins[0] :].astype(np.uint64)
        hashes = np.add.reduceat(mixed, begins - begins[0]) ^ (word_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        letters = np.add.reduceat(solid[begins[0] :].astype(np.int64), begins - begins[0])
        new = np.zeros(len(begins), dtype=bool)
        new[np.unique(hashes, return_index=True)[1]] = True
        if known is not None:
            new &= ~np.isin(hashes, known)
            known = np.union1d(known, hashes)
        count = np.bincount(word_row, minlength=n).astype(np.float64)
        safe = np.maximum(1, count)
        extra[:, 0] = count / size
        extra[:, 1] = np.bincount(word_row, letters, minlength=n) / safe / 10
        extra[:, 2] = np.bincount(word_row, ~new & (letters > 4), minlength=n) / safe
        extra[:, 3] = np.bincount(word_row, letters > 15, minlength=n) / safe
        again = np.r_[False, hashes[1:] == hashes[:-1]]
        extra[:, 5] = np.bincount(word_row, again, minlength=n) / safe
    extra[:, 4] = np.log1p(size) / 6
    return np.hstack([by_class, by_pair, extra]).astype(np.float32), rows, known


@dataclass
class Model:
    """Standardisation, encoder, gated attention and scorer."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def standardised(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -CLIP, CLIP).astype(np.float32)

    def forward(self, x: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, dict]:
        """Logits of the documents whose passages are ``rows`` consecutive rows of standardised ``x`` each."""
        w = self.weights
        starts = np.cumsum(rows) - rows
        h = np.tanh(x @ w["E"] + w["e"])
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        raw = (t * s) @ w["a"]
        top = np.maximum.reduceat(raw, starts)
        p = np.exp(raw - np.repeat(top, rows))
        p /= np.repeat(np.add.reduceat(p, starts), rows)
        z = np.add.reduceat(h * p[:, None], starts)
        return z @ w["o"] + w["c"][0], {"h": h, "t": t, "s": s, "p": p, "z": z, "starts": starts}

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 for each text."""
        if not texts:
            return np.zeros(0)
        x, rows = features(texts)
        logits, _ = self.forward(self.standardised(x), rows)
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def gradients(model: Model, x: np.ndarray, rows: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss of documents (standardised passages, labels), by weight."""
    w = model.weights
    logits, k = model.forward(x, rows)
    d = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - y) / len(rows)
    dz = np.repeat(d[:, None] * w["o"], rows, axis=0)
    pull = (dz * k["h"]).sum(1)
    by_share = k["p"] * (pull - np.repeat(np.add.reduceat(pull * k["p"], k["starts"]), rows))
    gate = by_share[:, None] * w["a"]
    dt, ds = gate * k["s"] * (1 - k["t"] ** 2), gate * k["t"] * k["s"] * (1 - k["s"])
    dh = (dz * k["p"][:, None] + dt @ w["V"].T + ds @ w["U"].T) * (1 - k["h"] ** 2)
    return {"E": x.T @ dh, "e": dh.sum(0), "V": k["h"].T @ dt, "U": k["h"].T @ ds, "a": (k["t"] * k["s"]).T @ by_share, "o": k["z"].T @ d, "c": np.array([d.sum()])}


def learn(x: np.ndarray, rows: np.ndarray, y: np.ndarray, width: int = 24, gates: int = 12, epochs: int = 40, seed: int = 11, decay: float = 1e-3) -> Model:
    """Adam on the logistic loss of the documents, gradients by hand."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    draw = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    w = {"E": draw(x.shape[1], width), "e": np.zeros(width, np.float32), "V": draw(width, gates), "U": draw(width, gates), "a": draw(gates), "o": draw(width), "c": np.zeros(1, np.float32)}
    model = Model(mean, scale, w)
    x = model.standardised(x)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v2 = {k: np.zeros_like(v) for k, v in w.items()}
    starts = np.cumsum(rows) - rows
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            n = rows[some]
            take = np.concatenate([np.arange(starts[i], starts[i] + rows[i]) for i in some])
            xs = x[take]
            g = gradients(model, xs, n, y[some])
            step += 1
            rate = 3e-3 * (1 - 0.9 * epoch / epochs)
            for name in w:
                grad = g[name] + decay * w[name] * (name in "EVUo")
                m[name] = 0.9 * m[name] + 0.1 * grad
                v2[name] = 0.999 * v2[name] + 0.001 * grad * grad
                w[name] = (w[name] - rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v2[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, passages: int = PASSAGES) -> Model | None:
    """A model from at most ``sample`` labelled rows, with at most ``passages`` passages, that are not held out; None where there are none.

    Rows come in the order of their identifiers' hashes; one that does not fit any more is
    passed over. Labels that are null, and labels of null or unknown doc_ids, are not used. Of a repeated
    label the greatest counts; of rows that repeat a doc_id, the one whose features have the least checksum.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("label_id")).select("label_id", "label", "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = features([t or "" for t in batch.column(2).to_pylist()])
            cuts = np.r_[0, np.cumsum(n)]
            data = [x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["label_id", "label", "x"])

    kind = dict(docs.dtypes)["doc_id"]
    bags = arrow_batches(rows, scan, f"label_id {kind}, label int, x binary")
    # a driver that holds whole bags asks for their sizes first
    bags = materialise(bags.withColumn("order", F.xxhash64("label_id")).withColumn("passages", (F.octet_length("x") / (4 * WIDTH)).cast("int")).withColumn("crc", F.crc32("x")), "bags")
    taken, room = [], passages
    sizes = bags.groupBy("order", "label_id").agg(F.min(F.struct("crc", "passages")).alias("one")).orderBy("order", "label_id")
    for r in sizes.collect():  # at most `sample` rows
        if r["one"]["passages"] <= room:
            room -= r["one"]["passages"]
            taken.append((r["label_id"], r["one"]["crc"]))
    if not taken:
        return None
    wanted = docs.sparkSession.createDataFrame(taken, f"label_id {kind}, crc long")
    some = bags.join(F.broadcast(wanted), ["label_id", "crc"]).dropDuplicates(["label_id"]).select("order", "label_id", "label", "x")
    found = sorted(some.collect(), key=lambda r: (r["order"], r["label_id"]))
    bag = [np.frombuffer(r["x"], dtype=np.float32).reshape(-1, WIDTH) for r in found]
    return learn(np.concatenate(bag), np.array([len(b) for b in bag]), np.array([float(r["label"] > 0) for r in found]))


def _scored(docs: DataFrame, model: Model | None, keep_row: bool) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            score = model.score(texts) if model else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score.astype(np.float64))], names=["first", "score"])

    first = F.struct("*") if keep_row else F.col("doc_id")
    rows = docs.select(first.alias("first"), F.col("text").alias("text"))
    return arrow_batches(rows, scan, f"first {dict(rows.dtypes)['first']}, score double")


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    A null text counts as empty and is scored like any other; a null doc_id is not
    held out; repeated rows get equal scores; without any label every score is 0.5;
    other columns are not read.
    """
    out = _scored(docs, fit(docs, labels, sample), keep_row=False)
    return out.select(F.col("first").alias("doc_id"), held_out(F.col("first")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least: float = 0.5) -> DataFrame:
    """The rows that score at least ``least``, with all their columns, whatever these are called.

    A null text is scored like an empty one and a row without doc_id like any other; rows
    that repeat a text stay or go together; without any label every row scores 0.5 and
    stays at the default; an empty table gives an empty result.
    """
    return _scored(docs, fit(docs, labels, sample), keep_row=True).where(F.col("score") >= least).select("first.*")
