"""Document fingerprints by order MinHash.

A text's k-mers of code points are numbered by occurrence (the second "abc" differs from the
first). Each of ``functions`` random permutations picks the ``picks`` smallest of them; the
picked ones, in the order in which they stand in the text, are hashed to one component.
Two texts agree in a component only if the same k-mers come in the same order, so the share
of equal components falls with the edit distance, also where sets of k-mers stay the same.

A text shorter than ``k`` is one k-mer; a null or empty text has one fixed fingerprint of its
own. Equal texts have equal fingerprints. Every row is fingerprinted, repeated ones too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.llm.text import ODD, mix, shuffle_width, prepare, text_column

#: Elements of one table of (function, k-mer) values, and the least number of minima kept.
CELLS, WIDTH = 1 << 18, 48


@dataclass(frozen=True)
class Sketch:
    """``k`` code points make a k-mer, ``picks`` k-mers one of ``functions`` 16-bit components."""

    k: int = 7
    picks: int = 2
    functions: int = 32


@lru_cache(maxsize=8)
def _factors(functions: int) -> np.ndarray:
    """An odd factor for each function."""
    return np.random.default_rng(functions).integers(0, 2**32, functions, dtype=np.uint32) | np.uint32(1)


_kept: list[np.ndarray] = []


def _buffer(cells: int) -> np.ndarray:
    if cells > CELLS:
        return np.empty(cells, dtype=np.uint32)
    if not _kept:
        _kept.append(np.empty(CELLS, dtype=np.uint32))
    return _kept[0]


def _numbered(points: np.ndarray, sketch: Sketch) -> np.ndarray:
    """A 64-bit value for each k-mer together with the number of equal ones before it."""
    k = min(sketch.k, len(points))
    n = len(points) - k + 1
    wide = points.astype(np.uint64)
    kmers = wide[:n] * ODD
    for j in range(1, k):
        kmers += wide[j : j + n]
        kmers *= ODD
    kmers = mix(kmers)
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    # The upper bits hold the k-mer, the lower ones its place: sorting brings equal ones together, in order.
    packed = np.sort((kmers >> bits << bits) | np.arange(n, dtype=np.uint64))
    place = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    heads = packed >> bits
    new = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]]))
    earlier = np.arange(n) - np.repeat(new, np.diff(np.append(new, n)))
    kmers[place] += earlier.astype(np.uint64) * ODD
    return mix(kmers)


def _smallest(low: np.ndarray, picks: int, factors: np.ndarray) -> np.ndarray:
    """For each function (a multiplication modulo 2**32) the places of its ``picks`` smallest values.

    The row of values is folded in halves to ``width`` minima, each over every ``width``-th
    value. The smallest values lie below the ``picks`` smallest minima, and only these are
    looked at one by one. Values tie only if 32 bits of two k-mers do; the choice between
    them then depends on nothing but the text.
    """
    n = len(low)
    folds = max(0, (n // WIDTH).bit_length() - 1)
    width = -(-n // (1 << folds))
    # Whatever is missing repeats earlier values: a repeated value changes no minimum.
    filled = np.resize(low, width << folds)
    least = np.empty((len(factors), width), dtype=np.uint32)
    step = max(1, CELLS // len(filled))
    buffer = _buffer(max(CELLS, len(filled)))
    for lo in range(0, len(factors), step):
        some = factors[lo : lo + step, None]
        # One buffer for all texts: fresh pages for every table would cost more than the arithmetic.
        rows = buffer[: len(some) * len(filled)].reshape(len(some), -1)
        np.multiply(filled, some, out=rows)
        for k in range(folds - 1, -1, -1):
            rows = np.minimum(rows[:, : width << k], rows[:, width << k : width << k + 1], out=rows[:, : width << k])
        least[lo : lo + step] = rows
    below = _lowest(least, min(picks, width))
    at = (below[:, :, None] + np.arange(0, width << folds, width)).reshape(len(factors), -1)
    values = np.where(at < n, filled[at] * factors[:, None], np.uint32(0xFFFFFFFF))
    return np.take_along_axis(at, _lowest(values, picks), axis=1)


def _lowest(table: np.ndarray, picks: int) -> np.ndarray:
    """The columns of the ``picks`` smallest values of each row; the table is used up."""
    rows, found = np.arange(len(table)), []
    for _ in range(picks):
        found.append(table.argmin(axis=1))
        table[rows, found[-1]] = np.uint32(0xFFFFFFFF)
    return np.stack(found, axis=1)


def components(text: bytes, sketch: Sketch = Sketch()) -> np.ndarray:
    """The fingerprint as 16-bit numbers."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    if not len(points):
        return np.zeros(sketch.functions, dtype=np.uint16)
    kmers = _numbered(points, sketch)
    places = _smallest((kmers >> np.uint64(32)).astype(np.uint32), min(sketch.picks, len(kmers)), _factors(sketch.functions))
    picks = places.shape[1]
    places.sort(axis=1)
    mixed = np.full(sketch.functions, picks, dtype=np.uint64)
    for j in range(picks):
        mixed = mix(mixed * ODD + kmers[places[:, j]])
    return (mixed >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal components, 0 to 1."""
    return float((a == b).mean())


def with_fingerprint(docs: DataFrame, text: str = "text", into: str = "fingerprint", sketch: Sketch = Sketch()) -> DataFrame:
    """The rows with their fingerprint, in hexadecimal; a column of that name is replaced."""
    prepare(docs.sparkSession)
    docs = docs.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [components(t, sketch).tobytes().hex() for t in text_column(batch, text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, StringType())]))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the following one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def compare_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sketch: Sketch = Sketch()) -> DataFrame:
    """Each text's fingerprint beside those of its edited text and of the next document by id.

    Documents are dealt out by ranges of their ids, found from quantiles, and each range also
    gets the first document of the range after it: one shuffle of the texts, and every task
    streams over its sorted rows. The first document follows the last. Null ids come first;
    rows of one id are ordered by text. A single document follows itself. No rows give no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = 2 * shuffle_width(spark)
    share = ", ".join(str(i / parts) for i in range(1, parts))
    ids = rows.select("doc_id").agg(
        F.expr(f"percentile_approx(doc_id, array({share}), 100000)").alias("cuts") if parts > 1 else F.array().cast("array<bigint>").alias("cuts")
    )
    cuts = sorted(set(ids.first()["cuts"] or []))
    # The range of an id: how many cuts are not above it. Null ids belong to the first.
    spot = F.coalesce(F.expr(f"size(filter(array({', '.join(f'{c}L' for c in cuts)}), c -> c <= doc_id))") if cuts else F.lit(0), F.lit(0))
    ranged = rows.withColumn("spot", spot)
    # At most one id for each range.
    firsts = sorted((r["spot"], r["missing"], r["low"]) for r in ranged.groupBy("spot").agg(
        F.max(F.col("doc_id").isNull()).alias("missing"), F.min("doc_id").alias("low")).collect())
    if not firsts:
        return spark.createDataFrame([], _SCHEMA)
    # The first id of each range goes to the range before it, too: a row for each range.
    handed = spark.createDataFrame([(None if missing else low, firsts[i - 1][0]) for i, (_, missing, low) in enumerate(firsts)], "first bigint, spot int")
    copies = (
        rows.join(F.broadcast(handed), F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("spot").agg(F.min("text").alias("text")).select(F.lit(None).cast("long").alias("doc_id"), "text", "spot", F.lit(True).alias("after"))
    )
    dealt = (
        ranged.withColumn("after", F.lit(False)).unionByName(copies)
        .repartition(parts, "spot").sortWithinPartitions("spot", "after", F.asc_nulls_first("doc_id"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            out = []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "text", "after")]
            for key, value, after in zip(*columns, strict=True):
                own = components(value.encode(), sketch)
                if held is not None:
                    out.append(_row(*held, value, own, sketch))
                held = None if after else (key, value, own)
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return dealt.select("doc_id", "text", "after").mapInArrow(run, _SCHEMA)


_SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _row(key: int | None, value: str, own: np.ndarray, following: str, next_own: np.ndarray, sketch: Sketch) -> dict:
    changed = edited(value, following).encode()
    other = components(changed, sketch)
    return {
        "doc_id": key, "n_chars": len(value), "edited_sha256": sha256(changed).hexdigest(), "fingerprint": own.tobytes().hex(),
        "edited_fingerprint": other.tobytes().hex(), "near_edited": likeness(own, other), "near_next": likeness(own, next_own),
    }
