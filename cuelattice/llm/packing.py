"""Best-fit packing of token sequences by a configuration linear program.

1. Every text becomes identifiers (end mark included) and is cut only where it is
   longer than a sequence. Only (doc_id, piece, start, length, checksum) leave the
   workers, and they are written once.
2. The histogram of piece lengths has at most ``capacity`` entries whatever the
   corpus. A *configuration* is a multiset of lengths that fits one sequence. The
   linear program (fewest sequences, in fractions, that cover every length) is solved
   by multiplicative weights: the price of a length falls exponentially with the share
   of its demand that is covered; a knapsack over the capacity (dynamic programming)
   finds the configuration of the highest price, which is taken by a step. The prices
   of any round, divided by that knapsack's value, bound every solution from below.
3. The fractions are moved to a vertex of the program, with as many configurations as
   lengths at most and no greater total, and rounded down; what is then left, at most
   one sequence of each configuration, goes by best fit on the histogram.
4. Pieces are numbered within their length by a salted window, and the plan, which
   is bounded by the capacity and not by the corpus, turns (length, number) into
   (sequence, offset).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cuelattice.llm.bpe import SPLIT, byte_letters
from cuelattice.llm.common import arrow_batches, crc32, materialise, partitions

CAPACITY = 2048
#: Rounds of multiplicative weights, with few lengths and with many (over FEW), whose knapsacks take longer.
ROUNDS, FEW, MANY_ROUNDS = 1500, 64, 400
#: What a round takes of a length's demand at most (more, if the rounds would not do), and how fast prices fall with the share that is covered.
STEP, ETA = 0.005, 8.0
#: Lengths up to which fractions are moved to a vertex.
VERTEX = 256


class Encoder:
    """Identifiers of a ``.json`` byte-level BPE file, as the tokenizers library gives them.

    The same merges run in tiktoken, which is several times as fast on texts of many
    rare words; what it cannot take (very long runs of one character) goes to the
    library itself. Tests hold the two against each other.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        back = {ord(c): b for b, c in enumerate(byte_letters())}
        ranks = {t.translate(back).encode("latin-1"): i for t, i in self.library.get_vocab().items() if t not in added}
        self.quick = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)
        self.added = set(added)

    def encode(self, text: str) -> bytes:
        """Four bytes for each identifier, little-endian."""
        try:
            ids = self.quick.encode_to_numpy(text, allowed_special=self.added, disallowed_special=())
        except BaseException as error:
            if type(error).__name__ != "PanicException":  # what its native code raises; it derives from BaseException alone
                raise
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids)
        return ids.astype("<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of every row's identifiers plus ``end_id``; of a longer one only the first piece may be short."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, mark = encoder(path), struct.pack("<I", end_id)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for doc_id, text in zip(ids, batch.column(1).to_pylist()):
                data = tool.encode(text or "") + mark
                n = len(data) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, k, a, b - a, crc32(data[4 * a : 4 * b])))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return arrow_batches(docs.select("doc_id", "text"), scan, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def knapsack(price: dict[int, float], capacity: int) -> tuple[dict[int, int], float]:
    """The configuration {length: times} of the highest total price, and that price."""
    price = {l: v for l, v in price.items() if v > 0 and l <= capacity}
    if len(price) > FEW:
        return _knapsack_by_capacity(price, capacity)
    best, steps = np.zeros(capacity + 1), []
    for l, v in price.items():
        times = 1
        while times * l <= capacity:  # doubled copies stand for any number of them
            more = best[: capacity + 1 - times * l] + times * v
            take = more > best[times * l :]
            best[times * l :] = np.maximum(more, best[times * l :])
            steps.append((l, times, take))
            times *= 2
    out: dict[int, int] = {}
    c = capacity
    for l, times, take in reversed(steps):
        if c >= times * l and take[c - times * l]:
            out[l] = out.get(l, 0) + times
            c -= times * l
    return out, float(best[capacity])


def _knapsack_by_capacity(price: dict[int, float], capacity: int) -> tuple[dict[int, int], float]:
    value = np.full(capacity, -1.0)
    value[np.array(list(price)) - 1] = list(price.values())
    take = np.zeros(capacity + 1, dtype=np.int64)
    best, back = np.zeros(capacity + 1), np.zeros(capacity + 1)  # back is best in reverse
    for c in range(1, capacity + 1):
        total = back[capacity - c + 1 :] + value[:c]
        k = int(total.argmax())
        if total[k] > best[c - 1]:
            best[c], take[c] = total[k], k + 1
        else:
            best[c] = best[c - 1]
        back[capacity - c] = best[c]
    out: dict[int, int] = {}
    c = capacity
    while c > 0:
        if t := int(take[c]):
            out[t] = out.get(t, 0) + 1
            c -= t
        else:
            c -= 1
    return out, float(best[capacity])


Config = tuple[tuple[int, int], ...]


def weights(demand: dict[int, int], capacity: int) -> tuple[dict[Config, float], float]:
    """Amounts of configurations by multiplicative weights, and a lower bound of every solution.

    No length is covered beyond its demand. With few lengths all of it is covered; with
    many, what the rounds leave is left to best fit.
    """
    lengths = np.array(sorted(demand))
    n = np.array([demand[l] for l in lengths.tolist()], dtype=float)
    place = {l: i for i, l in enumerate(lengths.tolist())}
    left, found, bound = n.copy(), {}, 0.0
    rounds = ROUNDS if len(lengths) <= FEW else MANY_ROUNDS
    step = min(1.0, max(STEP, 2 * len(lengths) / rounds))
    for _ in range(rounds):
        live = left > 1e-9 * n
        if not live.any():
            break
        covered = 1 - left / n
        price = lengths / capacity * np.exp(-ETA * (covered - covered.min()))
        config, value = knapsack({l: p for l, p, some in zip(lengths.tolist(), price.tolist(), live.tolist()) if some}, capacity)
        if live.all():
            bound = max(bound, float((n * price).sum()) / value)
        key = tuple(sorted(config.items()))
        i, a = np.array([place[l] for l, _ in key]), np.array([k for _, k in key], dtype=float)
        amount = float((np.minimum(left[i], step * n[i]) / a).min())
        found[key] = found.get(key, 0.0) + amount
        left[i] = np.maximum(0.0, left[i] - a * amount)
    return found, bound


def vertex(found: dict[Config, float], demand: dict[int, int], capacity: int) -> tuple[dict[Config, float], float]:
    """The same cover by at most as many configurations as there are lengths, no greater in total; and its own lower bound.

    Along any combination of configurations that covers nothing, amounts are moved the way
    that lowers the total until one of them is zero.
    """
    lengths = sorted(demand)
    place = {l: i for i, l in enumerate(lengths)}
    keys = sorted(found, key=lambda k: (-found[k], k))
    columns = np.zeros((len(lengths), len(keys)))
    for j, key in enumerate(keys):
        for l, a in key:
            columns[place[l], j] = a
    x = np.array([found[k] for k in keys])
    while True:
        on = np.flatnonzero(x > 1e-9)
        if len(on) <= len(lengths):
            break
        some = on[np.argsort(x[on], kind="stable")][: 2 * len(lengths) + 1]
        _, sizes, turned = np.linalg.svd(columns[:, some])
        nothing = turned[int((sizes > 1e-9 * sizes[0]).sum()) :].T.copy()
        y = x[some]
        while nothing.shape[1]:
            totals = nothing.sum(0)
            c = int(np.abs(totals).argmax())
            z = nothing[:, c] * (-1 if totals[c] > 0 else 1)
            falls = np.flatnonzero(z < -1e-12)
            if not len(falls):
                nothing = np.delete(nothing, c, axis=1)
                continue
            far = y[falls] / -z[falls]
            j = int(falls[far.argmin()])
            y = np.maximum(y + far.min() * z, 0.0)
            y[j] = 0.0
            nothing = np.delete(nothing - np.outer(nothing[:, c], nothing[j] / nothing[j, c]), c, axis=1)
        x[some] = y
    out = {keys[j]: float(x[j]) for j in on}
    dual = np.maximum(0.0, np.linalg.lstsq(columns[:, on].T, np.ones(len(on)), rcond=None)[0])
    _, value = knapsack(dict(zip(lengths, dual.tolist())), capacity)
    return out, float(sum(demand[l] * p for l, p in zip(lengths, dual.tolist()))) / value if value > 0 else 0.0


def refill(config: dict[int, int], left: np.ndarray, capacity: int) -> dict[int, int]:
    """Best fit: while something fits, the longest length that does."""
    config = dict(config)
    room = capacity - sum(l * a for l, a in config.items())
    while room > 0:
        spare = left[: room + 1].copy()
        for l, a in config.items():
            if l <= room:
                spare[l] -= a
        there = np.flatnonzero(spare > 0)
        if not len(there):
            break
        l = int(there[-1])
        a = min(int(spare[l]), room // l)
        config[l] = config.get(l, 0) + a
        room -= l * a
    return config


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(configuration, times)] for what is left, longest first; ``left`` ends empty.

    Every step leaves less of some length than one sequence takes of it, so there are at
    most capacity / length + 1 steps for each length whatever the numbers are.
    """
    plan = []
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        config = refill({longest: 1}, left, capacity)
        times = max(1, int(min(left[l] // a for l, a in config.items())))
        plan.append((config, times))
        for l, a in config.items():
            left[l] -= a * times
    return plan


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[dict[int, int], int]], float]:
    """[(configuration, times)] that take every piece of the histogram exactly once, and a lower bound of the number of sequences.

    The plan has at most ROUNDS + capacity x (ln capacity + 2) configurations. Should best
    fit alone ever need fewer sequences, its plan is taken.
    """
    demand = {l: n for l, n in histogram.items() if n > 0}
    if not demand:
        return [], 0.0
    found, bound = weights(demand, capacity)
    bound = max(bound, sum(l * n for l, n in demand.items()) / capacity, sum(n for l, n in demand.items() if 2 * l > capacity))
    if len(demand) <= VERTEX:
        found, other = vertex(found, demand, capacity)
        bound = max(bound, other)
    left = np.zeros(capacity + 1, dtype=np.int64)
    for l, n in demand.items():
        left[l] = n
    alone, plan = best_fit(left.copy(), capacity), []
    for key, amount in sorted(found.items(), key=lambda x: (-x[1], x[0])):
        config = refill(dict(key), left, capacity) if all(left[l] >= a for l, a in key) else dict(key)
        times = min([int(amount + 1e-6), *(int(left[l] // a) for l, a in config.items())])
        if times > 0:
            plan.append((config, times))
            for l, a in config.items():
                left[l] -= a * times
    plan += best_fit(left, capacity)
    return (plan if sum(t for _, t in plan) <= sum(t for _, t in alone) else alone), bound


def slots(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """For each length its slots, ascending: (first number, first sequence, first offset, times in one sequence)."""
    sequence, number, out = 0, {}, {}
    for config, times in plan:
        offset = 0
        for l in sorted(config, reverse=True):
            at = number.get(l, 0)
            out.setdefault(l, []).append((at, sequence, offset, config[l]))
            number[l] = at + config[l] * times
            offset += config[l] * l
        sequence += times
    return sorted(out.items())


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text counts as empty and gives one piece, the end mark; repeated rows and
    equal or null doc_ids are packed as rows of their own; an empty table gives an
    empty result; other columns are not read.
    """
    spark = docs.sparkSession
    cut = materialise(pieces(docs, path, capacity, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    placed_lengths = slots(solve(histogram, capacity)[0])
    plan = spark.createDataFrame(placed_lengths, "length long, slots array<struct<at:long,sequence:long,offset:long,times:long>>")
    most = max([1, *(len(x) for _, x in placed_lengths)])
    salts = max(64, partitions(spark))
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    base = cut.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.withColumn("rank", F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1)
    # binary search for the last slot that begins at or before the number
    steps = ", ".join(str(1 << b) for b in range(most.bit_length() - 1, -1, -1))
    slot = F.expr(f"slots[aggregate(array({steps}), 0, (p, s) -> IF(p + s < size(slots) AND slots[least(p + s, size(slots) - 1)].at <= number, p + s, p))]")
    placed = (
        ranked.join(base, ["length", "salt"])
        .withColumn("number", F.col("rank") + F.col("base"))
        .join(F.broadcast(plan), "length")  # bounded by the capacity, see ``solve``
        .withColumn("slot", slot)
        .withColumn("step", F.col("number") - F.col("slot.at"))
    )
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("slot.sequence") + F.floor(F.col("step") / F.col("slot.times"))).cast("long").alias("sequence_id"),
        (F.col("slot.offset") + (F.col("step") % F.col("slot.times")) * F.col("length")).cast("long").alias("offset"),
    )
