"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by pseudo-rotations (three rounds of random signs and a fast Hadamard
transform) and assigned to the nearest signed axis, once for each table. A query looks into its
nearest axis and the next ones of every table (multiprobe); what it finds is ranked by the exact
inner product, in double precision, on the original vectors. Each query looks into ``least_probes``
axes of every table, and goes on to further ones until the buckets it looks into hold ``candidates``
entries, or all: so one whose surroundings are sparse is answered as well as others, and how large
the table is has no say in it.

Equal vectors are one *entry* with their smallest ids (as many as a result can show), so a vector
that a third of all rows share costs no more than others. Buckets larger than ``bucket_rows``
entries, or with more than ``query_rows`` queries, are split, and each part answers with its
best; the parts are spread over the tasks.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those
whose length is not the most frequent one (the shorter of equally frequent ones), nor rows
without an id. Rows of one id are one row, with the first of their vectors by bytes. Ties go to
the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.text import shuffle_width, prepare
from tarmac.session import settle


@dataclass(frozen=True)
class Settings:
    neighbours: int = 20
    tables: int = 8
    least_probes: int = 10
    candidates: int = 6000
    bucket_rows: int = 4096
    query_rows: int = 1024
    seed: int = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, whose length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def signed_axes(vectors: np.ndarray, settings: Settings, most: int) -> np.ndarray:
    """For each row and table the ``most`` nearest signed axes, nearest first: rows x tables x most."""
    axes = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    # A common factor keeps very large and very small vectors from overflow.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = np.zeros((len(vectors), axes))
    unit[:, : vectors.shape[1]] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    signs = np.random.default_rng(settings.seed).choice([-1.0, 1.0], (settings.tables, 3, axes))
    out = np.empty((len(vectors), settings.tables, most), dtype=np.int32)
    for t in range(settings.tables):
        turned = unit
        for s in signs[t]:
            turned = hadamard(turned * s)
        both = np.concatenate([turned, -turned], axis=1)
        if most == 1:
            out[:, t, 0] = both.argmax(axis=1)
        else:
            some = np.argpartition(-both, most - 1, axis=1)[:, :most] if most < both.shape[1] else np.tile(np.arange(both.shape[1]), (len(both), 1))
            out[:, t] = np.take_along_axis(some, np.argsort(-np.take_along_axis(both, some, axis=1), axis=1, kind="stable"), axis=1)
    return out


def valid(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    sound = rows.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0))
    sizes = sound.groupBy(F.size("vector").alias("n")).count().collect()  # one row for each length of vector
    if not sizes:
        return sound
    return sound.where(F.size("vector") == max(sizes, key=lambda r: (r["count"], -r["n"]))["n"])


def _matrix(packed: list[bytes]) -> np.ndarray:
    """Packed vectors as rows of doubles. The first byte tells the width of a component."""
    width = packed[0][0]
    return np.frombuffer(b"".join(v[1:] for v in packed), dtype=f"<f{width}").reshape(len(packed), -1).astype(float)


def _packed(rows: DataFrame) -> DataFrame:
    """(vec_id, vector as bytes); zeros of either sign are one. Floats stay floats: half the bytes, no rounding."""
    single = rows.schema["vector"].dataType.elementType.simpleString() == "float"
    kind, lead = ("<f4", b"\x04") if single else ("<f8", b"\x08")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)
            width = len(flat) // max(1, len(column))
            data = [lead + flat[i * width : (i + 1) * width].tobytes() for i in range(len(column))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["vec_id", "vector"])

    return rows.select("vec_id", "vector").mapInArrow(run, "vec_id bigint, vector binary")


def _slotted(entries: DataFrame, settings: Settings, most: int) -> DataFrame:
    """(entry, vector, slots): a slot is a table and a signed axis."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(1).to_pylist())
            axes = 2 << max(1, (vectors.shape[1] - 1).bit_length())
            slots = (signed_axes(vectors, settings, most) + (np.arange(settings.tables, dtype=np.int32) * axes)[None, :, None]).reshape(len(vectors), -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(slots), pa.list_(pa.int32()))], names=["entry", "vector", "slots"])

    return entries.select("entry", "vector").mapInArrow(run, "entry bigint, vector binary, slots array<int>")


def _asked(queries: DataFrame, stored: DataFrame, settings: Settings, axes: int) -> DataFrame:
    """(entry, vector, slots) of queries: as many probes as meet ``candidates`` stored entries, repeats counted."""
    sizes = np.zeros(2 * axes * settings.tables, dtype=np.int64)
    for row in stored.groupBy("slot").count().collect():  # one row for each slot
        sizes[row["slot"]] = row["count"]
    least = min(settings.least_probes, 2 * axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(1).to_pylist())
            slots = signed_axes(vectors, settings, 2 * axes) + (np.arange(settings.tables, dtype=np.int32) * 2 * axes)[None, :, None]
            met = sizes[slots].sum(axis=1).cumsum(axis=1)
            probes = np.minimum(2 * axes, np.maximum(least, 1 + (met < settings.candidates).sum(axis=1)))
            found = [own[:, :n].reshape(-1) for own, n in zip(slots, probes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=["entry", "vector", "slots"])

    return queries.select("entry", "vector").mapInArrow(run, "entry bigint, vector binary, slots array<int>")


def _best(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``most`` nearest vectors of each query: (query, id, exact score)."""
    found = ([], [], [])
    for lo in range(0, len(queries), 256):
        rough = queries[lo : lo + 256] @ vectors.T
        if len(ids) > most:
            least = -np.partition(-rough, most - 1, axis=1)[:, most - 1]
            # Products are summed in another order below: whatever may still be among the best goes on.
            margin = 1e-12 * np.linalg.norm(queries[lo : lo + 256], axis=1) * np.linalg.norm(vectors, axis=1).max()
            a, b = np.nonzero(rough >= (least - margin)[:, None])
        else:
            a, b = np.nonzero(np.ones_like(rough, dtype=bool))
        exact = (queries[lo + a] * vectors[b]).sum(axis=1)
        order = np.lexsort((ids[b], -exact, a))
        a, b, exact = a[order], b[order], exact[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        keep = rank < most
        for values, x in zip(found, (query_ids[lo + a[keep]], ids[b[keep]], exact[keep]), strict=True):
            values.append(x)
    return tuple(np.concatenate(x) for x in found)


def _searched(dealt: DataFrame, most: int) -> DataFrame:
    """The best of every bucket part: (query, entry, score). Rows come sorted by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query", pa.int64()), ("entry", pa.int64()), ("score", pa.float64())])
        key, held = None, ([], [])

        def out() -> pa.RecordBatch:
            if not held[0] or not held[1]:
                return pa.RecordBatch.from_pylist([], schema=schema)
            sides = [(np.array([i for i, _ in side]), _matrix([v for _, v in side])) for side in held]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _best(*sides[0], *sides[1], most)], schema=schema)

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("slot", "part", "group", "asks", "entry", "vector")]
            for slot, part, group, asks, entry, vector in zip(*columns, strict=True):
                if key != (slot, part, group):
                    if key is not None:
                        yield out()
                    key, held = (slot, part, group), ([], [])
                held[asks].append((entry, vector))
        if key is not None:
            yield out()

    return dealt.mapInArrow(run, "query bigint, entry bigint, score double")


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the nearest rows found for each query, its own left out.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    spark = vectors.sparkSession
    prepare(spark)
    most = settings.neighbours + 1  # a query's own row may be among them
    rows = settle(_packed(valid(vectors, vec_id, embedding)).groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    entries = settle(rows.groupBy("vector").agg(F.min("vec_id").alias("entry"), F.max(is_query).alias("asks")), "entries")
    smallest = rows.withColumn("n", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("n") <= most).drop("n")
    first = rows.head()
    if first is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size = (len(first["vector"]) - 1) // first["vector"][0]
    axes = 1 << max(1, (size - 1).bit_length())

    each = lambda df: df.select("entry", "vector", F.explode("slots").alias("slot"))
    stored = each(settle(_slotted(entries, settings, 1), "stored"))
    asked = each(settle(_asked(entries.where("asks"), stored, settings, axes), "asked"))
    parts = stored.groupBy("slot").agg(F.ceil(F.count("*") / settings.bucket_rows).cast("int").alias("parts"))
    groups = asked.groupBy("slot").agg(F.ceil(F.count("*") / settings.query_rows).cast("int").alias("groups"))
    # One row for each slot, of which there are 2 * axes * tables.
    split = F.broadcast(parts.join(groups, "slot"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    pick = lambda n: F.pmod(F.xxhash64("entry"), F.col(n)).cast("int")
    dealt = stored.join(split, "slot").select("slot", pick("parts").alias("part"), spread("groups").alias("group"), F.lit(0).alias("asks"), "entry", "vector").unionByName(
        asked.join(split, "slot").select("slot", spread("parts").alias("part"), pick("groups").alias("group"), F.lit(1).alias("asks"), "entry", "vector"))
    width = 2 * shuffle_width(spark)
    found = _searched(dealt.repartition(width, "slot", "part", "group").sortWithinPartitions("slot", "part", "group"), most)

    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    near = found.groupBy("query", "entry").agg(F.max("score").alias("score")).withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= most)
    ids = entries.join(smallest, "vector").select("entry", "vec_id")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = near.join(ids, "entry").withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= most).select("query", "vec_id", "score")
    queries = rows.where(is_query).join(entries, "vector").select(
        F.col("vec_id").alias("query_id"), F.col("entry").alias("query"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        queries.join(listed, "query").where("query_id <> vec_id").withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= settings.neighbours).select("query_id", "rank", "vec_id", "score")
    )
