"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are compared: one of the target (texts labelled good)
and one of all texts. A document's weight is the ratio of its probabilities under the two, and
a sample of the documents is drawn without replacement in proportion to it: Gumbel noise is
added to each log weight, and the k largest keys are taken.

An n-gram counts once for each document. Where the two models do not clearly differ (by
``least_z`` standard errors and a factor of ``least_ratio``), both take the raw frequency, so
that the many rare n-grams of a long text do not drown the few that tell. Raw counts cover all
documents and are hashed to buckets, where rare n-grams are lost among chance neighbours. The labelled
sample is small enough for exact counts: an n-gram that its bad texts hold clearly more often than
their share of it (by the same bounds, and ``least_bad`` of them) takes its log ratio under the good
and all texts of the sample, if that is the lower one.
The raw model covers all documents; the target is fitted on at most ``labelled`` labelled documents, the first by hash
of their id, of which every fourth one is held back to place the threshold. k is the number of
documents above the threshold, so the share that is kept follows the data.

Null or empty texts have no n-grams and the weight 1. Rows of one id are scored each for
itself. Ids without a document, null ids and null labels are passed over. Without labels of
both kinds nothing can be told apart, and all rows are kept. Noise depends on id and text
only, so a rerun draws the same sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import ODD, blocks, mix, prepare, text_column, words
from tarmac.session import settle


@dataclass(frozen=True)
class Settings:
    buckets_log2: int = 18
    labelled: int = 20_000
    least_z: float = 3.3
    least_ratio: float = 2.0
    least_bad: int = 3
    pseudo: float = 0.5
    good_loss: float = 0.005
    sharpness: float = 8.0
    seed: int = 7


def _grams(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram) of each row's distinct words and pairs of neighbouring words, as ``2 * bits`` bits."""
    hashes, at = words(column, marks_apart=True)
    rows = np.repeat(np.arange(len(column), dtype=np.int64), np.diff(at))
    pairs = mix(hashes[:-1] * ODD + hashes[1:])
    same = rows[:-1] == rows[1:]
    wide = 2 * bits
    shift = np.uint64(64 - wide)
    # How much a text repeats itself: three more grams, of the share of words seen just before and of pairs seen before.
    many = np.maximum(np.diff(at), 1)
    near = [np.bincount(rows[d:][(hashes[d:] == hashes[:-d]) & (rows[d:] == rows[:-d])], minlength=len(column)) / many for d in (1, 2)]
    coded = np.sort((rows[:-1][same] << 40) | (pairs[same] >> np.uint64(24)).astype(np.int64))
    fresh = np.bincount(coded[np.flatnonzero(np.diff(coded, prepend=-1))] >> 40, minlength=len(column)) / many
    every = np.arange(len(column), dtype=np.int64)[many > 1]
    shape = [mix((np.floor(x[every] * 16) + 64 * k + 1).astype(np.uint64)) for k, x in enumerate((*near, fresh))]
    codes = np.concatenate([
        (rows << wide) | (hashes >> shift).astype(np.int64), ((rows[:-1] << wide) | (pairs >> shift).astype(np.int64))[same],
        *((every << wide) | (x >> shift).astype(np.int64) for x in shape),
    ])
    codes = np.sort(codes)
    if len(codes):
        codes = codes[np.concatenate([[True], codes[1:] != codes[:-1]])]
    return codes >> wide, codes & ((1 << wide) - 1)


def _cells(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two buckets of each gram: one in each half of a table."""
    return grams >> bits, (grams & ((1 << bits) - 1)) + (1 << bits)


def _labels(labels: DataFrame, settings: Settings) -> DataFrame:
    """At most ``labelled`` ids: ``good``, and whether they are for fitting."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(((F.col("quality") < 1) | F.coalesce(F.col("toxic") > 0, F.lit(False))).cast("int")).alias("bad"))
    order = F.xxhash64("doc_id", F.lit(settings.seed))
    return known.orderBy(order, "doc_id").limit(settings.labelled).select(
        "doc_id", (F.col("bad") == 0).alias("good"), (F.pmod(F.xxhash64("doc_id", F.lit(settings.seed + 1)), F.lit(4)) != 0).alias("fitting"))


class Evidence(NamedTuple):
    """What a gram tells: a log ratio for each bucket, and one for each of some exact grams (sorted)."""

    table: np.ndarray
    grams: np.ndarray
    ratios: np.ndarray

    def of(self, grams: np.ndarray, bits: int) -> np.ndarray:
        a, b = (self.table[cell] for cell in _cells(grams, bits))
        # A bucket's ratio counts only if both buckets have one, and no more than the weaker one: chance neighbours in a bucket don't count.
        ratio = np.where(a * b > 0, np.where(np.abs(a) < np.abs(b), a, b), 0.0)
        if not len(self.grams):
            return ratio
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, np.minimum(ratio, self.ratios[at]), ratio)


def fit_bad(docs: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray]:
    """Exact grams that tell of bad texts, sorted, and their log ratios, from the labelled texts for fitting.

    Only these texts are counted, so what reaches the driver is bounded as the labels are.
    """
    bits, none = settings.buckets_log2, (np.zeros(0, np.int64), np.zeros(0))
    sample = docs.where("fitting")
    size = {r["good"]: r["count"] for r in sample.groupBy("good").count().collect()}
    if len(size) < 2:
        return none
    share = size[False] / (size[False] + size[True])

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = text_column(batch, "text")
            for lo, hi in blocks(column):
                grams, n = np.unique(_grams(column.slice(lo, hi - lo), bits)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n)], names=["gram", "n"])

    # A gram of bad texts alone is clear from this count on; no gram is clear with less.
    least = max(settings.least_bad, settings.least_z**2 * share / (1 - share))
    total = F.sum("n").alias("n")
    bad = sample.where("NOT good").select("text").mapInArrow(every, "gram bigint, n bigint").groupBy("gram").agg(total).where(F.col("n") >= F.lit(float(least))).toArrow()
    if not len(bad):
        return none
    order = np.argsort(bad["gram"].to_numpy())
    known, n_bad = bad["gram"].to_numpy()[order], bad["n"].to_numpy()[order]
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            column = text_column(batch, "text")
            for lo, hi in blocks(column):
                grams = _grams(column.slice(lo, hi - lo), bits)[1]
                at = np.minimum(np.searchsorted(shared.value, grams), len(counts) - 1)
                counts += np.bincount(at[shared.value[at] == grams], minlength=len(counts))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["place", "n"])

    good = sample.where("good").select("text").mapInArrow(chosen, "place bigint, n bigint").groupBy("place").agg(total).toArrow()
    n_good = np.zeros(len(known))
    n_good[good["place"].to_numpy()] = good["n"].to_numpy()
    n = n_good + n_bad
    ratios = np.log((n_good + settings.pseudo) / (n * (1 - share) + settings.pseudo))
    clear = (n_bad - n * share >= settings.least_z * np.sqrt(n * share * (1 - share))) & (ratios <= -np.log(settings.least_ratio))
    return known[clear], ratios[clear]


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray | None:
    """The log ratio of each bucket (two for each gram) under target and raw model; None if there is no target.

    ``docs`` has doc_id, text, good and fitting. One pass over all texts counts both models;
    what reaches the driver are the buckets that tell, of a fixed number.
    """
    bits = settings.buckets_log2

    cells = 2 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, cells + 1), dtype=np.int64)
        for batch in batches:
            column = text_column(batch, "text")
            target = batch.column(batch.schema.get_field_index("target")).to_numpy(zero_copy_only=False).astype(bool)
            counts[0, -1] += len(target)
            counts[1, -1] += int(target.sum())
            for lo, hi in blocks(column):
                rows, grams = _grams(column.slice(lo, hi - lo), bits)
                chosen = target[lo:hi][rows]
                for cell in _cells(grams, bits):
                    counts[0, :-1] += np.bincount(cell, minlength=cells)
                    counts[1, :-1] += np.bincount(cell[chosen], minlength=cells)
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(seen, pa.int64()), "n_raw": pa.array(counts[0][seen]), "n_target": pa.array(counts[1][seen])})

    target = F.coalesce(F.col("good") & F.col("fitting"), F.lit(False)).alias("target")
    total = settle(
        docs.select("text", target).mapInArrow(run, "bucket bigint, n_raw bigint, n_target bigint")
        .groupBy("bucket").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target")), "grams")
    size = total.where(F.col("bucket") == cells).first()
    if size is None or not size["n_target"]:
        return None
    expected = F.col("n_raw") * F.lit(size["n_target"] / size["n_raw"])
    ratio = F.ln((F.col("n_target") + settings.pseudo) / (expected + settings.pseudo))
    clear = (F.abs(F.col("n_target") - expected) >= settings.least_z * F.sqrt(expected + 1)) & (F.abs(ratio) >= float(np.log(settings.least_ratio)))
    found = total.where((F.col("bucket") < cells) & clear).select("bucket", ratio.alias("ratio")).toArrow()
    out = np.zeros(cells)
    out[found["bucket"].to_numpy()] = found["ratio"].to_numpy()
    return out


def _noise(settings: Settings):
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")), F.lit(settings.seed))


def _weigh(batch: pa.RecordBatch, evidence: Evidence, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Log weight and sample key of each row; the column ``__noise`` holds 64 random bits."""
    column, weights = text_column(batch, "text"), [np.zeros(0)]
    for lo, hi in blocks(column):
        rows, grams = _grams(column.slice(lo, hi - lo), settings.buckets_log2)
        weights.append(np.bincount(rows, evidence.of(grams, settings.buckets_log2), minlength=hi - lo))
    weight = np.concatenate(weights)
    draw = batch.column(batch.schema.get_field_index("__noise")).to_numpy().astype(np.int64).view(np.uint64)
    uniform = ((draw >> np.uint64(11)).astype(float) + 0.5) / 2**53
    return weight, settings.sharpness * weight - np.log(-np.log(uniform))


def score(docs: DataFrame, evidence: Evidence, settings: Settings = Settings()) -> DataFrame:
    """Each row's log weight and its key with Gumbel noise: doc_id, log_weight, sample_key, good, fitting."""
    shared = docs.sparkSession.sparkContext.broadcast(evidence)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, key = _weigh(batch, shared.value, settings)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "good", "fitting")]
            yield pa.RecordBatch.from_arrays(
                [kept[0], pa.array(weight), pa.array(key), *kept[1:]], names=["doc_id", "log_weight", "sample_key", "good", "fitting"])

    return docs.select("doc_id", "text", "good", "fitting", _noise(settings).alias("__noise")).mapInArrow(
        run, "doc_id bigint, log_weight double, sample_key double, good boolean, fitting boolean")


def threshold(scored: DataFrame, good_loss: float, width: float = 0.25) -> float:
    """The log weight that best parts the labels held back: most good above plus most bad below, in
    shares, among those that at most ``good_loss`` of the good fall below.

    Weights are counted in steps of ``width`` from -50 to 50, so the driver gets a few hundred rows.
    """
    step = F.floor(F.least(F.greatest(F.col("log_weight"), F.lit(-50.0)), F.lit(50.0)) / width)
    counts = scored.where("good IS NOT NULL AND NOT fitting").groupBy(step.cast("int").alias("step"), "good").count().toPandas()
    good, bad = (counts[counts.good == g].groupby("step")["count"].sum() for g in (True, False))
    if good.empty or bad.empty:
        return -np.inf
    steps = range(int(counts.step.min()), int(counts.step.max()) + 2)
    lost = [good[good.index < s].sum() / good.sum() for s in steps]
    gain = [bad[bad.index < s].sum() / bad.sum() - x if x <= good_loss else -1.0 for s, x in zip(steps, lost, strict=True)]
    best = [s for s, g in zip(steps, gain, strict=True) if g >= max(gain) - 1e-9]
    return best[len(best) // 2] * width if best[0] * width > -50 else -np.inf


def kth_largest(frame: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value, by counting in ever finer bins: a few passes over numbers, no sort."""
    low, high = frame.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return np.inf
    above = 0
    while True:
        width = (high - low) / bins
        inside = frame.where(F.col(column).between(low, high))
        if width <= 0 or low + width == low:
            return low
        spot = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        counts = inside.groupBy(spot.alias("spot")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for row in sorted(counts, key=lambda r: -r["spot"]):
            if above + row["n"] >= k:
                if row["lo"] == row["hi"] or row["n"] == 1:
                    return row["lo"]
                low, high = row["lo"], row["hi"]
                break
            above += row["n"]
        else:
            return low


def _sampled(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[Evidence, DataFrame, float]:
    """The fitted evidence, all scored rows, and the key from which a row is in the sample."""
    prepare(docs.sparkSession)
    bounded = F.broadcast(_labels(labels, settings))
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(bounded, "doc_id", "left")
    ratios = fit(joined, labels, settings)
    told = (np.zeros(0, np.int64), np.zeros(0)) if ratios is None else fit_bad(joined, settings)
    evidence = Evidence(np.zeros(2 << settings.buckets_log2) if ratios is None else ratios, *told)
    scored = settle(score(joined, evidence, settings), "weights")
    least = threshold(scored, settings.good_loss) if ratios is not None else -np.inf
    k = scored.where(F.col("log_weight") >= F.lit(float(least))).count()
    return evidence, scored, float(kth_largest(scored, "sample_key", k))


def resample(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """For each document its log weight, key and whether it is in the sample: doc_id, log_weight, sample_key, kept.

    ``docs`` needs doc_id and text, ``labels`` doc_id, quality and toxic (0 or 1).
    """
    _, scored, key = _sampled(docs, labels, settings)
    return scored.select("doc_id", "log_weight", "sample_key", (F.col("sample_key") >= F.lit(key)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows that the sample holds, unchanged. They are weighed again rather than joined: no text is shuffled."""
    evidence, _, key = _sampled(docs, labels, settings)
    shared = docs.sparkSession.sparkContext.broadcast(evidence)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = pa.array(_weigh(batch, shared.value, settings)[1] >= key)
            yield batch.drop_columns(["__noise"]).filter(kept)

    return docs.withColumn("__noise", _noise(settings)).mapInArrow(run, docs.schema)
