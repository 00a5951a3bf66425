"""Embedding whitening by bit-sliced scatter.

Entries become whole numbers, x = floor(scale * c) + offset. Each distinct x vector counts once in the fit.
A task takes blocks of distinct vectors, subtracts each dimension's smallest value in the block,
and packs every bit of every dimension across the rows into 64-bit words (a *bit plane*). The
cross-product of two dimensions is the sum over pairs of their planes of 2**(a + b) times the
number of set bits of plane a AND plane b; the block's smallest values are added back in whole
numbers. Sums of blocks are added up by pair of dimensions, which is
all that reaches the driver: n, sums and cross-products. There n * cross - sum * sum is formed in
whole numbers, so nothing cancels, and only then divided for ``eigh``.

A block's planes are as many as the bits of its ranges, so their memory is bounded by rows x dimensions x 64 bits.

Rows whose vector is null or holds null or non-finite entries, or an entry too large for a
64-bit x, take no part and are not returned; nor are rows whose vector's length is not the most
frequent one (the shorter of equally frequent ones). Repeated rows are each returned; rows without an id too. A
component whose eigenvalue is below ``smallest`` times the largest has no variance to scale by
and is not returned, so a single distinct vector gives no rows. ``deviation`` is null where it
does not fit in 64 bits. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import prepare
from tarmac.session import settle


@dataclass(frozen=True)
class Settings:
    scale: int = 64
    offset: int = 1_000_000
    components: int = 16
    block_rows: int = 4096
    smallest: float = 1e-10


@dataclass(frozen=True)
class Fit:
    """What is learned: n, sums (whole numbers), components as columns, their eigenvalues, the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float


OUTPUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double"


def whole(vectors: DataFrame, vec_id: str, embedding: str, settings: Settings) -> DataFrame:
    """(vec_id, x) of the rows that take part; x is an array of 64-bit numbers."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")).where("v IS NOT NULL AND size(v) > 0")
    # Beyond this a double has no x of 64 bits; NaN compares as larger than all.
    sound = rows.where(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= F.lit((2.0**62 - settings.offset) / settings.scale))))
    sizes = sound.groupBy(F.size("v").alias("n")).count().collect()  # one row for each length of vector
    if sizes:
        sound = sound.where(F.size("v") == max(sizes, key=lambda r: (r["count"], -r["n"]))["n"])
    return sound.select("vec_id", F.transform("v", lambda c: F.floor(c * settings.scale).cast("long") + settings.offset).alias("x"))


def planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative numbers (rows x dimensions): packed words, and each plane's dimension and bit."""
    words = -(-len(x) // 64)
    bits = [int(top).bit_length() for top in x.max(axis=0, initial=0)]
    dims = np.repeat(np.arange(x.shape[1]), bits)
    places = np.concatenate([np.arange(b) for b in bits]) if bits else np.zeros(0, np.int64)
    out = np.zeros((len(dims), words), dtype=np.uint64)
    for p, (d, b) in enumerate(zip(dims, places, strict=True)):
        packed = np.packbits(((x[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
        out[p].view(np.uint8)[: len(packed)] = packed
    return out, dims, places


def scatter(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums, and exact cross-products of all pairs of dimensions, of whole numbers (rows x dimensions)."""
    rows, size = x.shape
    low = x.min(axis=0)
    bits, dims, places = planes((x - low).astype(np.uint64))
    # 64-bit sums where they can't overflow, Python's whole numbers where they could.
    top = int(places.max(initial=0)) + 1
    kind = np.int64 if 2 * top + rows.bit_length() < 62 else object
    lows = [int(v) for v in low]
    shifted, cross = np.zeros(size, dtype=kind), np.zeros((size, size), dtype=kind)
    for p, (d, b) in enumerate(zip(dims.tolist(), places.tolist(), strict=True)):
        # One plane against all from its own on: AND, count, weigh by both places.
        both = np.bitwise_count(bits[p:] & bits[p]).sum(axis=1, dtype=np.int64).astype(kind)
        shifted[d] += both[0] << b
        both <<= (places[p:] + b).astype(kind)
        both[1:][dims[p + 1 :] == d] *= 2
        np.add.at(cross[d], dims[p:], both)
    shifted, cross = shifted.tolist(), cross.tolist()
    sums = [s + rows * m for s, m in zip(shifted, lows, strict=True)]
    for i in range(size):
        for j in range(i, size):
            cross[i][j] += lows[i] * shifted[j] + lows[j] * shifted[i] + rows * lows[i] * lows[j]
    return sums, cross


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _scattered(distinct: DataFrame, settings: Settings) -> DataFrame:
    """(i, j, limb, total) with i <= j: exact cross-products; j = -1: the sum of dimension i; i = -1: the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        totals: dict[tuple[int, int], int] = {}

        def add() -> None:
            x = np.concatenate(held)
            held.clear()
            sums, cross = scatter(x)
            totals[-1, -1] = totals.get((-1, -1), 0) + len(x)
            for i, s in enumerate(sums):
                totals[i, -1] = totals.get((i, -1), 0) + s
                for j in range(i, len(sums)):
                    totals[i, j] = totals.get((i, j), 0) + cross[i][j]

        for batch in batches:
            if batch.num_rows:
                held.append(_matrix(batch.column(0)))
            if sum(map(len, held)) >= settings.block_rows:
                add()
        if held:
            add()
        # In limbs of 40 bits, since a sum of squares may pass 64 bits; Spark adds up limb by limb.
        limbs = [(i, j, k, part) for (i, j), t in totals.items() for k, part in enumerate(_limbs(t))]
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in limbs], t) for c, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["i", "j", "limb", "total"])

    return distinct.select("x").mapInArrow(run, "i int, j int, limb int, total bigint").groupBy("i", "j", "limb").agg(F.sum("total").alias("total"))


def _limbs(value: int) -> list[int]:
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value or not out:
        out.append(sign * (value & ((1 << 40) - 1)))
        value >>= 40
    return out


def fit(distinct: DataFrame, settings: Settings = Settings()) -> Fit | None:
    """Components of the covariance of distinct x vectors (a column ``x``); None without rows."""
    totals: dict[tuple[int, int], int] = {}
    for r in _scattered(distinct, settings).collect():  # a few rows for each pair of dimensions
        totals[r["i"], r["j"]] = totals.get((r["i"], r["j"]), 0) + (r["total"] << 40 * r["limb"])
    n = totals.get((-1, -1), 0)
    if not n:
        return None
    size = max(i for i, _ in totals) + 1
    sums = [totals[i, -1] for i in range(size)]
    covariance = np.empty((size, size))
    for i in range(size):
        for j in range(i, size):
            # Centred as whole numbers; Python divides them with one rounding.
            covariance[i, j] = covariance[j, i] = (n * totals[i, j] - sums[i] * sums[j]) / (n * n)
    scale = float(np.abs(covariance).max()) or 1.0
    values, components = np.linalg.eigh(covariance / scale)
    values, components = values[::-1] * scale, components[:, ::-1]
    trace = sum(n * totals[i, i] - sums[i] * sums[i] for i in range(size)) / (n * n)
    kept = int((values[: settings.components] > max(0.0, settings.smallest * values[0])).sum())
    return Fit(n, sums, components[:, :kept].copy(), values[:kept].copy(), trace)


def whitened(x: np.ndarray, model: Fit) -> tuple[np.ndarray, list[int | None]]:
    """Whitened components (rows x components), and each row's exact deviation (None beyond 64 bits)."""
    far = max(max(abs(int(v)) for v in x.max(axis=0)), max(abs(int(v)) for v in x.min(axis=0))) * model.n + max(map(abs, model.sums))
    if far < 1 << 62:
        centred = model.n * x - np.array(model.sums, dtype=np.int64)
        values = centred.astype(float)
        if x.shape[1] * int(np.abs(centred).max()) ** 2 < 1 << 63:
            deviation = (centred * centred).sum(axis=1).tolist()
        else:
            deviation = [sum(v * v for v in row) for row in centred.tolist()]
    else:
        rows = [[model.n * v - s for v, s in zip(row, model.sums, strict=True)] for row in x.tolist()]
        values = np.array([[float(v) for v in row] for row in rows])
        deviation = [sum(v * v for v in row) for row in rows]
    return values / model.n @ model.components / np.sqrt(model.values), [d if d < 1 << 63 else None for d in deviation]


def _identity_error(distinct: DataFrame, model: Fit) -> float:
    """The largest entry, by size, of the whitened fit list's covariance less the identity."""
    size = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                w, _ = whitened(_matrix(batch.column(0)), model)
                n, sums, cross = n + len(w), sums + w.sum(axis=0), cross + w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums.tolist()], pa.list_(pa.float64())), pa.array([cross.ravel().tolist()], pa.list_(pa.float64()))], names=["n", "sums", "cross"])

    parts = distinct.select("x").mapInArrow(run, "n bigint, sums array<double>, cross array<double>")
    each = lambda c, k: F.array(*[F.sum(F.col(c)[i]) for i in range(k)]).alias(c)
    r = parts.agg(F.sum("n").alias("n"), each("sums", size), each("cross", size * size)).first()
    mean = np.array(r["sums"]) / r["n"]
    return float(np.abs(np.array(r["cross"]).reshape(size, size) / r["n"] - np.outer(mean, mean) - np.eye(size)).max())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every row and component."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = whole(vectors, vec_id, embedding, settings)
    distinct = settle(rows.select("x").distinct(), "distinct")
    model = fit(distinct, settings)
    if model is None or not len(model.values):
        return spark.createDataFrame([], OUTPUT + ", identity_error double")
    shared, explained = spark.sparkContext.broadcast(model), (model.values / model.trace).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        size = len(own.values)
        for batch in batches:
            if not batch.num_rows:
                continue
            w, deviation = whitened(_matrix(batch.column(1)), own)
            many = len(w)
            place = pa.array(np.repeat(np.arange(many), size))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(place), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), many)), pa.array(np.full(many * size, own.n, np.int64)),
                pa.array(deviation, pa.int64()).take(place), pa.array(w.ravel()), pa.array(np.tile(explained, many)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return rows.mapInArrow(run, OUTPUT).withColumn("identity_error", F.lit(_identity_error(distinct, model)))
