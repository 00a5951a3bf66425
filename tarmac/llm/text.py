"""Helpers of the operators: Arrow text columns as bytes, words as hashes, session settings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Kinds of bytes: white space, letters and digits (all bytes of other scripts too), marks.
KINDS = np.where(SPACE, 0, 2).astype(np.uint8)
KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
PLAIN = np.where(SPACE, 0, 1).astype(np.uint8)
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Base of the polynomial word hash and its inverse modulo 2**64.
BASE = 0x5851F42D4C957F2D
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20


def repeated(df: DataFrame, times: str, step: int = 1024) -> DataFrame:
    """Every row as often as its column ``times`` says, by two small sequences and not one as long as the number."""
    outer = df.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col(times) - 1, F.lit(step).cast("long"))))
    return outer.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(step), F.col(times) - F.col("__from"))))).drop("__from", "__copy")


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions: what work is dealt out over."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def prepare(spark: SparkSession) -> None:
    """Settings that the operators need.

    Python gets a few hundred rows at a time: long texts make batches of thousands too large for a
    worker. And a union never counts as partitioned like its parts: over bucketed tables that
    gave partial groups as final ones (seen with Spark 4.1).
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit of 64-bit values over the result (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column as bytes without nulls; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(col.cast(pa.large_binary()), b"")


def gathered(batches: Iterator[pa.RecordBatch], name: str, limit: int = 8 * BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches put together until their texts reach about ``limit`` bytes: what is done once for each distinct word pays off more."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(name)).nbytes
        if size >= limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield lo, hi
        lo = hi


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a ``large_binary`` column, and the offset of each row (one more than rows)."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK_BYTES + 65536), base, dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        _powers[base] = have
    return have[:n]


def spans(column: pa.Array, marks_apart: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z as a-z, the first and past-the-last place of every word, and each row's first word (one more than rows).

    A word is a run of bytes other than white space; with ``marks_apart`` a run of marks is a
    word of its own.
    """
    data, at = raw(column)
    kinds = (KINDS if marks_apart else PLAIN)[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:-1])
    edge[at] = True
    cuts = np.flatnonzero(edge)
    solid = kinds[cuts[:-1]] != 0
    first = cuts[:-1][solid]
    return LOWER[data], first, cuts[1:][solid], np.searchsorted(first, at).astype(np.int64)


def hashed(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(BASE, len(data)), out=sums[1:])
    return mix((sums[last] - sums[first]) * _power_table(BASE_INVERSE, len(data) + 1)[first])


def words(column: pa.Array, marks_apart: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, in order, and the first word's place of each row (one more than rows)."""
    data, first, last, at = spans(column, marks_apart)
    return hashed(data, first, last), at
