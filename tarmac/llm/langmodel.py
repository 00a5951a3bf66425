"""Language model scoring: a hashed maximum-entropy model with class-factored softmax.

The probability of a token is that of its class given the two words before it, times that of the
word in its class. Classes are the most frequent words, one each, and endings for all others.
The class softmax has three hashed features: the word before (n-gram), the pair of words before
(n-gram), and the word before that (skip); frequent words stand for themselves there, others for
their last bytes. Words within a class have their smoothed relative frequency.

Training goes over all training texts: every task runs minibatch gradient steps over its rows,
starting from the shared weights, and gives out the rows of the weight table that it moved; these
are averaged by how often each was used, and the next round starts there. Tasks are as many as run at once, or as
``task_tokens`` asks for, so the tables that they hand on don't grow with the input's files. The number of contexts
grows with the training tokens, up to a bound on what a task holds; that of the classes is fixed. Counts of all words
are kept in a table and never gathered whole: only those frequent enough that at most
``frequent`` words are (a bound by count) are sent to the tasks; for the rest a document's
distinct words are joined with the counts. Scoring is one pass in sparse numpy batches.

Null or empty texts are one token, the end. Rows without an id take part in training. Repeated
rows each count and are each returned. If there is no training text every count is 0, and both
scores are those of unknown tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import ODD, blocks, hashed, mix, prepare, repeated, spans, text_column
from tarmac.session import settle


@dataclass(frozen=True)
class Settings:
    own_classes: int = 24
    ending_classes: int = 24
    own_contexts: int = 2048
    contexts_log2: int = 12
    frequent: int = 1 << 17
    rounds: int = 2
    tokens_per_context: int = 2000
    most_contexts_log2: int = 17
    task_tokens: int = 1 << 28
    rate: float = 0.3
    batch: int = 8192

    @property
    def classes(self) -> int:
        return self.own_classes + self.ending_classes

    @property
    def rows(self) -> int:
        """Rows of the weight table: three features, and one row for the bias."""
        return 3 * (1 << self.contexts_log2) + 1


def grown(settings: Settings, words: Vocabulary) -> Settings:
    """The settings with as many contexts as the training counts bear, between those given and the most.

    Words with ``tokens_per_context`` tokens stand for themselves, up to half of the contexts. The
    most contexts bound what a task holds and hands on: it does so for every row that it moves.
    """
    log2 = int(words.total // settings.tokens_per_context).bit_length()
    log2 = max(settings.contexts_log2, min(log2, settings.most_contexts_log2))
    own = int((words.counts >= settings.tokens_per_context).sum())
    return replace(settings, contexts_log2=log2, own_contexts=max(settings.own_contexts, min(own, 1 << (log2 - 1))))


END = np.uint64(0x1234567887654321)
#: Leading bits by which frequent words are looked up.
LEAD = 20


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, their last three bytes, and each row's first token (one more than rows).

    Every row ends with the end token.
    """
    data, first, last, at = spans(column)
    rows = len(column)
    place = np.arange(len(first)) + np.repeat(np.arange(rows), np.diff(at))
    starts = at + np.arange(rows + 1)
    values = np.full(len(first) + rows, END, dtype=np.uint64)
    values[place] = hashed(data, first, last)
    endings = np.zeros(len(values), dtype=np.int64)
    for k in range(3):
        seen = last - 1 - k >= first
        endings[place[seen]] |= data[last[seen] - 1 - k].astype(np.int64) << (8 * k)
    return values, endings, starts


@dataclass
class Vocabulary:
    """What the tasks know: counts of frequent words (sorted by hash), the classes' own words, totals."""

    hashes: np.ndarray
    counts: np.ndarray
    rank: np.ndarray  # by falling count
    total: int
    distinct: int
    class_total: np.ndarray
    class_distinct: np.ndarray
    starts: np.ndarray | None = None  # made where it is used

    def known(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each token its place among the frequent words, and whether it is one."""
        if not len(self.hashes):
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        # Words with the same leading bits stand together; most often there is one at most.
        if self.starts is None:
            self.starts = np.searchsorted(self.hashes, np.arange(1 << LEAD, dtype=np.uint64) << np.uint64(64 - LEAD)).astype(np.int32)
        at = self.starts.take((values >> np.uint64(64 - LEAD)).view(np.int64)).astype(np.int64)
        last = len(self.hashes) - 1
        np.minimum(at, last, out=at)
        behind = np.flatnonzero(self.hashes.take(at) < values)
        while len(behind):
            at[behind] += 1
            behind = behind[at[behind] <= last]
            behind = behind[self.hashes.take(at.take(behind)) < values.take(behind)]
        np.minimum(at, last, out=at)
        return at, self.hashes.take(at) == values


def ending_class(endings: np.ndarray, settings: Settings) -> np.ndarray:
    return (mix((endings & 0xFFFF).astype(np.uint64)) % np.uint64(settings.ending_classes)).astype(np.int64)


def classes_and_features(values: np.ndarray, endings: np.ndarray, starts: np.ndarray, at: np.ndarray, seen: np.ndarray, words: Vocabulary, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The class of each token, and the rows of the weight table that its three features use."""
    rank = np.where(seen, words.rank[at] if len(words.rank) else 0, 1 << 40)
    classes = np.where(rank < settings.own_classes, rank, settings.own_classes + ending_class(endings, settings))
    size = 1 << settings.contexts_log2
    others = size - settings.own_contexts - 1
    context = np.where(rank < settings.own_contexts, rank, settings.own_contexts + (mix(endings.astype(np.uint64)) % np.uint64(others)).astype(np.int64))
    before = np.full((2, len(values)), size - 1, dtype=np.int64)  # the last context is what precedes a text
    before[0, 1:] = context[:-1]
    before[1, 2:] = context[:-2]
    before[0, starts[:-1]] = size - 1
    before[1, starts[:-1]] = size - 1
    second = starts[:-1] + 1
    second = second[second < starts[1:]]
    before[1, second] = size - 1
    pair = (mix(before[0].astype(np.uint64) * ODD + before[1].astype(np.uint64)) >> np.uint64(64 - settings.contexts_log2)).astype(np.int64)
    return classes, np.stack([before[0], size + pair, 2 * size + before[1]])


def _raw_scores(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    z = weights.take(features[0], axis=0)
    z += weights.take(features[1], axis=0)
    z += weights.take(features[2], axis=0)
    z += weights[-1]
    z -= z.max(axis=1, keepdims=True)
    return z


def log_softmax(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Natural log probabilities of all classes for each token."""
    z = _raw_scores(weights, features)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def summed_rows(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sums of the rows from each head to the next; two single-precision columns are added as one complex number."""
    if values.shape[1] % 2:
        return np.add.reduceat(values, heads, axis=0)
    return np.add.reduceat(values.view(np.complex64), heads, axis=0).view(np.float32)


def descend(weights: np.ndarray, squares: np.ndarray, used: np.ndarray, classes: np.ndarray, features: np.ndarray, settings: Settings) -> None:
    """Gradient steps over minibatches, with a step size for each weight that falls with its past gradients."""
    size = 1 << settings.contexts_log2
    small = np.uint16 if settings.contexts_log2 <= 16 else np.int64
    for lo in range(0, len(classes), settings.batch):
        y, f = classes[lo : lo + settings.batch], features[:, lo : lo + settings.batch]
        slope = _raw_scores(weights, f)
        np.exp(slope, out=slope)
        slope /= -slope.sum(axis=1, keepdims=True)
        slope[np.arange(len(y)), y] += 1
        for k in range(3):
            own = (f[k] - k * size).astype(small)
            order = np.argsort(own, kind="stable")
            own = own.take(order)
            heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            rows, many = own.take(heads).astype(np.int64) + k * size, np.diff(np.append(heads, len(own)))
            step = summed_rows(slope.take(order, axis=0), heads)
            step /= np.sqrt(many, dtype=np.float32)[:, None]
            past = squares.take(rows, axis=0)
            past += step * step
            squares[rows] = past
            past += np.float32(1.0)
            step *= np.float32(settings.rate)
            step /= np.sqrt(past, out=past)
            step += weights.take(rows, axis=0)
            weights[rows] = step
            used[rows] += many


def _round(texts: DataFrame, weights: np.ndarray, words: Vocabulary, settings: Settings) -> np.ndarray:
    """One pass of distributed updates: the average of what the tasks moved, by use."""
    shared = texts.sparkSession.sparkContext.broadcast((weights, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, vocabulary = shared.value
        own = start.copy()
        squares, used = np.zeros_like(own), np.zeros(len(own), dtype=np.int64)
        for batch in batches:
            column = text_column(batch, "text")
            for lo, hi in blocks(column):
                values, endings, starts = tokens(column.slice(lo, hi - lo))
                at, seen = vocabulary.known(values)
                descend(own, squares, used, *classes_and_features(values, endings, starts, at, seen, vocabulary, settings), settings)
        moved = np.flatnonzero(used)
        yield pa.RecordBatch.from_pydict({"row": pa.array(moved), "used": pa.array(used[moved]), "weights": pa.array([w.tobytes() for w in own[moved]], pa.binary())})

    def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def folded() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rows, many, sums = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(rows, kind="stable")
            heads = np.flatnonzero(np.concatenate([[True], np.diff(rows[order]) != 0]))
            return rows[order[heads]], np.add.reduceat(many[order], heads), np.add.reduceat(sums.take(order, axis=0), heads, axis=0)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows, many = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            table = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32).reshape(len(rows), -1)
            held.append((rows, many, table * many[:, None].astype(float)))
            if len(held) >= 64:
                held = [folded()]
        if held:
            rows, many, sums = folded()
            yield pa.RecordBatch.from_pydict({"row": pa.array(rows), "weights": pa.array([w.tobytes() for w in (sums / many[:, None]).astype(np.float32)], pa.binary())})

    # Every task hands on the rows that it moved, so there are no more tasks than can run at once, unless they'd read too much.
    context = texts.sparkSession.sparkContext
    tasks = max(context.defaultParallelism, -(-words.total // settings.task_tokens))
    moved = texts.coalesce(tasks).mapInArrow(run, "row bigint, used bigint, weights binary")
    found = moved.repartition("row").mapInArrow(averaged, "row bigint, weights binary").toArrow()  # at most the rows of the table
    out = weights.copy()
    if found.num_rows:
        out[found["row"].to_numpy()] = np.frombuffer(b"".join(found["weights"].to_pylist()), np.float32).reshape(found.num_rows, -1)
    return out


def count_words(texts: DataFrame, settings: Settings) -> DataFrame:
    """(word, n, ending) for all words of the texts; tasks add up their own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            values, counts, ends = (np.concatenate(x) for x in zip(*held, strict=True))
            own, first, back = np.unique(values, return_index=True, return_inverse=True)
            return own, np.bincount(back, counts).astype(np.int64), ends[first]

        def out() -> pa.RecordBatch:
            own, counts, ends = merged()
            return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(counts), pa.array(ends)], names=["word", "n", "ending"])

        for batch in batches:
            column = text_column(batch, "text")
            for lo, hi in blocks(column):
                values, endings, _ = tokens(column.slice(lo, hi - lo))
                held.append((values, np.ones(len(values)), ending_class(endings, settings)))
                if len(held) >= 8:
                    held = [merged()]
                    if len(held[0][0]) > 400_000:
                        yield out()
                        held = []
        if held:
            yield out()

    return texts.mapInArrow(run, "word bigint, n bigint, ending bigint").groupBy("word").agg(F.sum("n").alias("n"), F.min("ending").alias("ending"))


def vocabulary(counts: DataFrame, settings: Settings) -> Vocabulary:
    """Totals, and the words frequent enough that no more than ``frequent`` are."""
    k, own = settings.ending_classes, settings.own_classes
    totals = {r["ending"]: (r["n"], r["v"]) for r in counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    # How many words have a count, in steps of an eighth of an octave: some hundred rows.
    step = F.floor(8 * F.log2("n"))
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("v"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    least, words = None, 0
    for r in steps:
        words += r["v"]
        if words > settings.frequent:
            break
        least = r["least"]
    top = counts.where(F.col("n") >= F.lit(least)).toArrow() if least is not None else None
    class_total, class_distinct = np.zeros(own + k), np.zeros(own + k)
    for e, (n, v) in totals.items():
        class_total[own + e], class_distinct[own + e] = n, v
    if top is None:
        empty = np.zeros(0, np.int64)
        return Vocabulary(empty.astype(np.uint64), empty, empty, sum(n for n, _ in totals.values()), sum(v for _, v in totals.values()), class_total, class_distinct)
    hashes, n, ending = (top[c].to_numpy() for c in ("word", "n", "ending"))
    hashes = hashes.view(np.uint64)
    order = np.lexsort((hashes, -n))
    for i, w in enumerate(order[:own]):
        class_total[i], class_distinct[i] = n[w], 1
        class_total[own + ending[w]] -= n[w]
        class_distinct[own + ending[w]] -= 1
    rank = np.empty(len(n), dtype=np.int64)
    rank[order] = np.arange(len(n))
    by_hash = np.argsort(hashes)
    return Vocabulary(hashes[by_hash], n[by_hash], rank[by_hash], int(sum(n for n, _ in totals.values())), int(sum(v for _, v in totals.values())), class_total, class_distinct)


def train(texts: DataFrame, words: Vocabulary, settings: Settings) -> np.ndarray:
    """The weight table. It starts with the classes' relative frequencies as bias."""
    weights = np.zeros((settings.rows, settings.classes), dtype=np.float32)
    mass = words.class_total + 0.5 * (words.class_distinct + 1)
    weights[-1] = np.log(mass / mass.sum())
    for _ in range(settings.rounds if words.total else 0):
        weights = _round(texts, weights, words, settings)
    return weights


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Scores of all rows: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Rows whose id has the CRC-32 remainder 1 modulo 5 are held out from training.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False)))
    training = rows.where("NOT held_out").select("text")
    counts = settle(count_words(training, settings), "words")
    words = vocabulary(counts, settings)
    settings = grown(settings, words)
    weights = train(training, words, settings)
    shared = docs.sparkSession.sparkContext.broadcast((weights, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, vocab = shared.value
        logs = np.log10(vocab.counts + 0.5) if len(vocab.counts) else np.zeros(1)
        within = np.log10(vocab.class_total + 0.5 * (vocab.class_distinct + 1))
        for batch in batches:
            column = text_column(batch, "text")
            for lo, hi in blocks(column):
                values, endings, starts = tokens(column.slice(lo, hi - lo))
                at, seen = vocab.known(values)
                classes, features = classes_and_features(values, endings, starts, at, seen, vocab, settings)
                chosen = np.concatenate([
                    log_softmax(table, features[:, i : i + settings.batch])[np.arange(min(settings.batch, len(classes) - i)), classes[i : i + settings.batch]]
                    for i in range(0, len(classes), settings.batch)]).astype(float) / np.log(10)
                owner = np.repeat(np.arange(hi - lo), np.diff(starts))
                summed = lambda x: np.bincount(owner, x, minlength=hi - lo)  # noqa: B023, E731
                rare = ~seen
                codes, order = owner[rare], np.argsort(values[rare], kind="stable")
                codes, hashes = codes[order], values[rare][order]
                order = np.argsort(codes, kind="stable")
                codes, hashes = codes[order], hashes[order]
                heads = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (hashes[1:] != hashes[:-1])])) if len(codes) else np.zeros(0, np.int64)
                part = batch.slice(lo, hi - lo)
                ids, ties, held = (part.column(part.schema.get_field_index(c)) for c in ("doc_id", "tie", "held_out"))
                own = pa.array(codes[heads])
                n, none = len(heads), lambda size, kind: pa.nulls(size, kind)
                yield pa.RecordBatch.from_arrays([
                    ids, ties, held, ties, pa.array(np.zeros(hi - lo, np.int64)), pa.array(np.diff(starts)), pa.array(summed(seen).astype(np.int64)),
                    pa.array(summed(np.where(seen, logs[at], 0.0))), pa.array(summed(chosen - within[classes])),
                ], names=_PARTS)
                yield pa.RecordBatch.from_arrays([
                    ids.take(own), ties.take(own), none(n, pa.bool_()), pa.array(hashes[heads].view(np.int64)), pa.array(np.diff(np.append(heads, len(codes)))),
                    none(n, pa.int64()), none(n, pa.int64()), none(n, pa.float64()), none(n, pa.float64()),
                ], names=_PARTS)

    parts = rows.withColumn("tie", F.xxhash64("text")).select("doc_id", "tie", "held_out", "text").mapInArrow(
        run, "doc_id bigint, tie bigint, held_out boolean, word bigint, times bigint, n_tokens bigint, n_known bigint, logs double, fit double")
    # Rows of a document itself carry no word; they find a count only by chance, and it has no weight.
    joined = parts.join(counts.select("word", F.col("n").cast("double").alias("n")), "word", "left")
    seen = F.coalesce("n", F.lit(0.0))
    whole = joined.groupBy("doc_id", "tie").agg(
        F.max("held_out").alias("held_out"), F.count("n_tokens").alias("copies"), F.sum("n_tokens").alias("n_tokens"),
        (F.coalesce(F.sum("n_known"), F.lit(0)) + F.sum(F.when(seen > 0, F.col("times")).otherwise(0))).alias("n_known"),
        (F.sum("logs") + F.sum(F.col("times") * F.log10(seen + 0.5))).alias("logs"), F.sum("fit").alias("fit"))
    each = repeated(whole, "copies")
    of = lambda c: (F.col(c) / F.col("copies"))
    bottom = float(np.log10(words.total + 0.5 * (words.distinct + 1)))
    return each.select(
        "doc_id", "held_out", of("n_tokens").cast("long").alias("n_tokens"), of("n_known").cast("long").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"), (of("logs") - of("n_tokens") * bottom).alias("base_score"), of("logs").__add__(of("fit")).alias("score"))


_PARTS = ["doc_id", "tie", "held_out", "word", "times", "n_tokens", "n_known", "logs", "fit"]
