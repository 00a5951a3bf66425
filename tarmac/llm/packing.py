"""Pattern packing: token pieces into sequences, by non-negative least squares on their lengths.

Only the histogram of piece lengths matters for a packing, and it has at most ``capacity``
entries however many documents there are. The driver enumerates patterns of a few length
classes that fill a sequence, fits their repeat counts to the histogram by non-negative least
squares, rounds them down, realises each pattern with exact lengths (the last gaps by best
fit), and packs what is left by best fit, longest first. The plan is a table of intervals:
"pieces of length L with ranks a to b go to sequences s, s+1, ... at offset o". Pieces get their
rank within their length from counts by length and salt, so no length is sorted in one task,
and look their place up by themselves.

A document's ids are those of the tokenizer and one end id, so an empty or null text is one
piece of one token. Only documents longer than ``capacity`` are cut. Every row is a document,
repeated ids included. No rows give no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.text import BLOCK_BYTES, blocks, gathered, prepare, shuffle_width, text_column
from tarmac.llm.wordpieces import word_encoder
from tarmac.session import settle

CAPACITY, END_ID = 4096, 1


@dataclass(frozen=True)
class Patterns:
    """``classes`` of lengths, and at most ``parts`` of them in a pattern that leaves ``slack`` classes free at most.

    A pattern whose exact lengths leave more than ``spare`` tokens free is not used further: its
    pieces go to the residuals.
    """

    classes: int = 64
    parts: int = 4
    slack: int = 2
    spare: int = 4


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in gathered(batches, "text", 2 * BLOCK_BYTES):
            column = text_column(batch, "text")
            for lo, hi in blocks(column, 2 * BLOCK_BYTES):
                ids, at = encoder.encode_column(column.slice(lo, hi - lo))
                # Each text's ids, then its end.
                rows = np.arange(hi - lo)
                whole = np.full(len(ids) + hi - lo, END_ID, dtype="<u4")
                whole[np.arange(len(ids)) + np.repeat(rows, np.diff(at))] = ids
                first, size = at[:-1] + rows, np.diff(at) + 1
                many = -(-size // capacity)
                row = np.repeat(rows, many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(size[row] - start, capacity)
                data, begin = memoryview(whole.tobytes()), 4 * (first[row] + start)
                crc = [zlib.crc32(data[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                ], names=_NAMES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def enumerate_patterns(shape: Patterns) -> np.ndarray:
    """One column for each pattern: how many pieces of each class it takes. Classes count from 1 to ``classes``."""
    found: list[tuple[int, ...]] = []

    def extend(taken: tuple[int, ...], most: int, room: int) -> None:
        if taken and (room <= shape.slack or len(taken) <= 2):
            found.append(taken)
        if len(taken) < shape.parts:
            for c in range(min(most, room), 0, -1):
                # The parts still to come are no larger than this one: skip what can't fill the sequence.
                if len(taken) < 2 or c * (shape.parts - len(taken)) >= room - shape.slack:
                    extend((*taken, c), c, room - c)

    extend((), shape.classes, shape.classes)
    table = np.zeros((shape.classes, len(found)))
    for j, taken in enumerate(found):
        for c in taken:
            table[c - 1, j] += 1
    return table


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """x >= 0 that makes ``a @ x`` nearest to ``b``, by active sets."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tolerance:
            break
        free[best] = True
        while True:
            chosen = np.flatnonzero(free)
            solved = np.linalg.lstsq(a[:, chosen], b, rcond=None)[0]
            if (solved > 1e-12).all():
                x[:] = 0
                x[chosen] = solved
                break
            now = x[chosen]
            low = solved <= 1e-12
            step = float((now[low] / np.maximum(now[low] - solved[low], 1e-300)).min())
            x[chosen] = now + step * (solved - now)
            free[chosen[low & (x[chosen] <= 1e-12)]] = False
            if not free.any():
                break
            x[~free] = 0
    return x


class Stock:
    """Pieces not yet packed, by length."""

    def __init__(self, histogram: np.ndarray):
        self.left = histogram.astype(np.int64).tolist()
        self.lengths = [n for n, count in enumerate(self.left) if count]

    def largest(self, room: int, used: dict[int, int], least: int = 1) -> int:
        """The largest length from ``least`` to ``room`` that is left besides those used; 0 if none."""
        at = bisect_right(self.lengths, room) - 1
        while at >= 0 and self.lengths[at] >= least:
            n = self.lengths[at]
            if self.left[n] > used.get(n, 0):
                return n
            at -= 1
        return 0

    def take(self, used: dict[int, int], times: int) -> None:
        for n, k in used.items():
            self.left[n] -= k * times
            if not self.left[n]:
                del self.lengths[bisect_right(self.lengths, n) - 1]


def plan(histogram: np.ndarray, capacity: int = CAPACITY, shape: Patterns = Patterns()) -> np.ndarray:
    """Rows of (length, first rank, first sequence, offset, pieces of the length in a sequence).

    ``histogram[n]`` is the number of pieces of length n. A row holds from its first rank to the
    next row's of that length.
    """
    stock, width = Stock(histogram), capacity / shape.classes
    classes = np.zeros(shape.classes)
    np.add.at(classes, np.minimum(shape.classes - 1, np.ceil(np.arange(1, capacity + 1) / width).astype(int) - 1), histogram[1:])
    weight = np.arange(1, shape.classes + 1, dtype=float)
    patterns = enumerate_patterns(shape)
    repeats = np.floor(nonnegative_least_squares(patterns * weight[:, None], classes * weight) + 1e-6).astype(np.int64)
    rows, ranks, sequence = [], [0] * (capacity + 1), 0

    def pack(parts: list[int], wanted: int | None) -> int:
        """One kind of sequence, as often as it can be had; returns how often."""
        nonlocal sequence
        used: dict[int, int] = {}
        room = capacity
        for c in parts:
            n = stock.largest(min(room, int(c * width)), used, int((c - 1) * width) + 1)
            if n:
                used[n] = used.get(n, 0) + 1
                room -= n
        while room and (n := stock.largest(room, used)):
            many = max(1, min(room // n, stock.left[n] - used.get(n, 0)))
            used[n] = used.get(n, 0) + many
            room -= n * many
        if parts and room > shape.spare:
            return 0
        times = min(stock.left[n] // k for n, k in used.items())
        times = times if wanted is None else min(times, wanted)
        offset = 0
        for n, k in used.items():
            rows.append((n, ranks[n], sequence, offset, k))
            ranks[n] += k * times
            offset += n * k
        stock.take(used, times)
        sequence += times
        return times

    for j in sorted(np.flatnonzero(repeats), key=lambda j: -int(np.flatnonzero(patterns[:, j]).max())):
        parts = [int(c) + 1 for c in np.flatnonzero(patterns[:, j])[::-1] for _ in range(int(patterns[c, j]))]
        wanted = int(repeats[j])
        while wanted and stock.lengths and (times := pack(parts, wanted)):
            wanted -= times
    while stock.lengths:
        pack([], None)
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, shape: Patterns = Patterns()) -> DataFrame:
    """Every piece with its sequence and its offset there: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    prepare(spark)
    salts = shuffle_width(spark)
    cut = settle(pieces(docs, tokenizer, capacity), "pieces").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counted = cut.groupBy("length", "salt").count()
    before = counted.withColumn("earlier", F.coalesce(F.sum("count").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in counted.groupBy("length").agg(F.sum("count").alias("n")).collect():  # one row for each length
        histogram[row["length"]] = row["n"]
    shared = spark.sparkContext.broadcast(plan(histogram, capacity, shape))
    place = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("within", F.row_number().over(place) - 1).join(before, ["length", "salt"]).select(
        *_NAMES, (F.col("earlier") + F.col("within")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        keys = (rows[:, 0] << 46) + rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            own = rows[np.searchsorted(keys, (length << 46) + rank, side="right") - 1]
            since = rank - own[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.drop_columns(["rank"]).columns, pa.array(own[:, 2] + since // own[:, 4]), pa.array(own[:, 3] + since % own[:, 4] * length)],
                names=[*_NAMES, "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
