"""Phrase collocation mining with weighted acyclic automata.

Everything is per language. Phrases are paths (range, language, word, word, ...) of word codes, and
their counts the weights of automata (see ``transducers``). Each task sorts the phrases of a block
of text into an automaton, sums blocks as it goes, and hands its automaton on in pieces, one for
each *prefix range*: a range holds the phrases whose first two words fall into it by a hash, so that a
word that a third of all phrases begin with is spread over all ranges. What arrives for a range
is summed and phrases below ``least`` are dropped.

Counting goes in three steps: words; pairs of words that are both frequent; phrases of three
and four words whose pairs are all frequent. A frequent phrase has only frequent parts, so nothing is
lost. Which words and pairs are frequent is told to the tasks by a bitmap of at most
``filter_bits`` bits: it knows every frequent one, and takes some others for frequent, which costs
work but changes no count.

The counts of a candidate's parts come from composing it with the automata: its parts are sent
to their ranges and walked along the automaton there. Ranges with many requests are split, each part with a
copy of the automaton, whose size is that of the frequent phrases of one range.

Word codes are 64-bit hashes. Should two words of the corpus share one, the whole is done again
with another, slower hash. A null text is empty; a null language is ``und``; rows count as often as they are there; ids and
other columns are not read. Without candidates the result is empty. A text is read block by
block of rows, a longer text as a block of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.text import LOWER, ODD, blocks, hashed, mix, prepare, raw, shuffle_width, text_column
from tarmac.llm.transducers import Builder, Transducer, dump, from_paths, load, summed
from tarmac.session import settle


@dataclass(frozen=True)
class Settings:
    least: int = 30
    words: int = 4
    top: int = 2000
    scale: int = 2_000_000
    covered: int = 80  # per cent of a phrase's occurrences inside a longer one that make it redundant
    filter_bits: int = 1 << 28
    sorted_paths: int = 200_000  # paths that a task sorts at once
    task_nodes: int = 750_000  # nodes held by a task before it hands them on
    asked_rows: int = 200_000  # requests that one copy of a range's automaton answers


# What parts words, and what parts pieces.
KINDS = np.ones(256, dtype=np.uint8)
KINDS[[0x20, 0x09]] = 0
KINDS[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2

Coder = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def fast_codes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    codes = hashed(data, first, last)
    codes[codes == 0] = 1  # 0 is no word
    return codes


def slow_codes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    whole = data.tobytes()
    return np.array([int.from_bytes(blake2b(whole[a:b], digest_size=8).digest(), "little") or 1 for a, b in zip(first.tolist(), last.tolist(), strict=True)], dtype=np.uint64)


@dataclass
class Words:
    """The words of a block: bytes, places, codes, languages, and whether the next word goes on in the same piece."""

    data: np.ndarray
    first: np.ndarray
    last: np.ndarray
    codes: np.ndarray
    lang: np.ndarray
    goes_on: np.ndarray


def words_of(column: pa.Array, langs: np.ndarray, coder: Coder) -> Words:
    data, at = raw(column)
    kinds = KINDS[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:-1])
    edge[at] = True
    cuts = np.flatnonzero(edge)
    kind = kinds[cuts[:-1]]
    solid = kind == 1
    first, last = cuts[:-1][solid], cuts[1:][solid]
    row = np.searchsorted(at, first, side="right") - 1
    piece = np.cumsum(kind == 2)[solid]
    goes_on = np.zeros(len(first), dtype=bool)
    goes_on[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    data = LOWER[data]
    return Words(data, first, last, coder(data, first, last), langs[row], goes_on)


def _blocks(batches: Iterator[pa.RecordBatch], coder: Coder) -> Iterator[Words]:
    for batch in batches:
        column, langs = text_column(batch, "text"), batch.column(0).to_numpy().view(np.uint64)
        for lo, hi in blocks(column):
            yield words_of(column.slice(lo, hi - lo), langs[lo:hi], coder)


def unlike(w: Words, model: np.ndarray) -> np.ndarray:
    """Whether each word differs from the word that stands for it, byte by byte, or in language."""
    size = w.last - w.first
    odd = (size[model] != size) | (w.lang[model] != w.lang)
    same = np.flatnonzero(~odd)
    owner = np.repeat(same, size[same])
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size[same]) - size[same], size[same])
    odd[owner[w.data[w.first[owner] + place] != w.data[w.first[model[owner]] + place]]] = True
    return odd


def path_code(*steps: np.ndarray) -> np.ndarray:
    code = steps[0]
    for s in steps[1:]:
        code = mix(code * ODD + s)
    return code


def count_words(rows: DataFrame, coder: Coder, settings: Settings) -> DataFrame:
    """(lang, word, text, n, clash): frequent words, and for each language the number of all words as word 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

        def merged(parts: list) -> tuple[np.ndarray, ...]:
            langs, codes, counts, texts = (np.concatenate(x) for x in zip(*parts, strict=True))
            _, first, back = np.unique(path_code(langs, codes), return_index=True, return_inverse=True)
            # Rows that agree by chance only stay apart; the grouping by language and word finds them.
            odd = ~((langs[first][back] == langs) & (codes[first][back] == codes) & (texts[first][back] == texts))
            sums = np.zeros(len(first), np.int64)
            np.add.at(sums, back[~odd], counts[~odd])
            pick = np.concatenate([first, np.flatnonzero(odd)])
            return langs[pick], codes[pick], np.concatenate([sums, counts[odd]]), texts[pick]

        def out(parts: list) -> pa.RecordBatch:
            langs, codes, counts, texts = merged(parts)
            each, back = np.unique(langs, return_inverse=True)
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([langs, each]).view(np.int64)), pa.array(np.concatenate([codes, np.zeros(len(each), np.uint64)]).view(np.int64)),
                pa.array([*texts.tolist(), *[b""] * len(each)], pa.binary()), pa.array(np.concatenate([counts, np.bincount(back, counts).astype(np.int64)])),
            ], names=["lang", "word", "text", "n"])

        for w in _blocks(batches, coder):
            _, first, back = np.unique(path_code(w.lang, w.codes), return_index=True, return_inverse=True)
            odd = unlike(w, first[back])
            counts = np.bincount(back[~odd], minlength=len(first)).astype(np.int64)
            pick = np.concatenate([first, np.flatnonzero(odd)])
            whole = w.data.tobytes()
            texts = np.empty(len(pick), dtype=object)
            texts[:] = [whole[a:b] for a, b in zip(w.first[pick].tolist(), w.last[pick].tolist(), strict=True)]
            held.append((w.lang[pick], w.codes[pick], np.concatenate([counts, np.ones(int(odd.sum()), np.int64)]), texts))
            if len(held) >= 16:
                held = [merged(held)]
                if len(held[0][0]) > 300_000:
                    yield out(held)
                    held = []
        if held:
            yield out(held)

    counted = rows.mapInArrow(run, "lang bigint, word bigint, text binary, n bigint").groupBy("lang", "word").agg(
        F.min("text").alias("text"), F.sum("n").alias("n"), (F.min("text") != F.max("text")).alias("clash"))
    return counted.where((F.col("n") >= settings.least) | (F.col("word") == 0) | F.col("clash"))


def bitmap(codes: DataFrame, settings: Settings) -> np.ndarray:
    """A bitmap in which the two places of every code (a column of 64-bit numbers) are set."""
    many = codes.count()
    size = 1 << min(int(settings.filter_bits).bit_length() - 1, max(10, (32 * many).bit_length()))
    own = F.col("code")
    place = F.explode(F.array(own.bitwiseAND(size - 1), F.shiftrightunsigned(own, 32).bitwiseAND(size - 1)))
    found = codes.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits")).toArrow()  # at most filter_bits / 64 rows
    out = np.zeros(size // 64, dtype=np.uint64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _listed(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    size = np.uint64(64 * len(bits) - 1)
    known = np.ones(len(codes), dtype=bool)
    for place in (codes & size, (codes >> np.uint64(32)) & size):
        known &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return known


def ranges_of(lang: np.ndarray, one: np.ndarray, two: np.ndarray | None, ranges: int) -> np.ndarray:
    """The prefix range of phrases: by their first two words, or the only one."""
    code = path_code(lang, one) if two is None else path_code(lang, one, two)
    return mix(code) % np.uint64(ranges)


def _pieces(t: Transducer) -> pa.RecordBatch:
    each = t.sliced() if t.label else []
    return pa.RecordBatch.from_arrays(
        [pa.array([r for r, _ in each], pa.int64()), pa.array([dump(x) for _, x in each], pa.binary())], names=["range", "automaton"])


def count_phrases(rows: DataFrame, coder: Coder, known: list[np.ndarray], ranges: int, settings: Settings) -> DataFrame:
    """(range, automaton) of frequent phrases: pairs where ``known`` has the bitmap of words only, longer ones where it has that of pairs too."""
    shared, first = rows.sparkSession.sparkContext.broadcast(known), 3 if len(known) == 1 else 4

    def paths(w: Words) -> tuple[list[np.ndarray], np.ndarray]:
        bits = shared.value
        word = _listed(bits[0], path_code(w.lang, w.codes))
        pair = w.goes_on & word & np.append(word[1:], False)
        if len(bits) == 1:
            at = np.flatnonzero(pair)
            lengths = np.full(len(at), 4)
        else:
            at = np.flatnonzero(pair)
            pair[at] = _listed(bits[1], path_code(w.lang[at], w.codes[at], w.codes[at + 1]))
            run = [pair]
            for _ in range(settings.words - 2):
                run.append(run[-1] & np.append(pair[len(run) :], np.zeros(len(run), bool))[: len(pair)])
            at = np.flatnonzero(run[1])
            lengths = 4 + sum(r[at].astype(np.int64) for r in run[1:])
        steps = [ranges_of(w.lang[at], w.codes[at], w.codes[at + 1], ranges), w.lang[at]]
        last = len(w.codes) - 1
        steps += [w.codes[np.minimum(at + k, last)] for k in range(2 if len(bits) == 1 else settings.words)]
        return steps, lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built, waiting = Builder(), []

        def sort() -> None:
            if waiting:
                steps = [np.concatenate(x) for x in zip(*(s for s, _ in waiting), strict=True)]
                built.add(from_paths(steps, np.concatenate([n for _, n in waiting]), first))
                waiting.clear()

        for w in _blocks(batches, coder):
            if len(w.codes):
                waiting.append(paths(w))
            if sum(len(n) for _, n in waiting) > settings.sorted_paths:
                sort()
            if len(built) > settings.task_nodes:
                yield _pieces(built.take())
        sort()
        yield _pieces(built.take())

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, built in _by_range(batches):
            t = built.take().pruned(settings.least)
            if any(len(x) for x in t.label):
                yield _pieces(t)

    dealt = rows.mapInArrow(run, "range bigint, automaton binary").repartition(shuffle_width(rows.sparkSession), "range").sortWithinPartitions("range")
    return dealt.mapInArrow(total, "range bigint, automaton binary")


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Builder]]:
    """The automata of rows sorted by range, a range at a time."""
    key, built = None, Builder()
    for batch in batches:
        for own, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if own != key and key is not None:
                yield key, built
                built = Builder()
            key = own
            built.add(load(data.as_py()))
    if key is not None:
        yield key, built


def word_automata(words: DataFrame, ranges: int) -> DataFrame:
    """(range, automaton) of frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, word = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            t = from_paths([ranges_of(lang, word, None, ranges), lang, word], np.full(len(word), 3), 3)
            # Each path is one row, so a row's count belongs to the path's only node.
            order = np.lexsort((word, lang, ranges_of(lang, word, None, ranges)))
            t.weight[2] = batch.column(2).to_numpy()[order]
            yield _pieces(t)

    return words.select("lang", "word", "n").mapInArrow(run, "range bigint, automaton binary")


STEPS = ["w1", "w2", "w3", "w4"]


def phrases(automata: DataFrame) -> DataFrame:
    """(lang, w1, w2, w3, w4, a) of all accepted phrases; steps that a phrase lacks are 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(1):
                t = load(data.as_py())
                for d in range(3, len(t.label)):
                    keep = t.weight[d] > 0
                    steps = [x[keep].view(np.int64) for x in t.paths(d)[1:]]
                    steps += [np.zeros(int(keep.sum()), np.int64)] * (5 - len(steps))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*steps, t.weight[d][keep])], names=["lang", *STEPS, "a"])

    return automata.select("range", "automaton").mapInArrow(run, "lang bigint, w1 bigint, w2 bigint, w3 bigint, w4 bigint, a bigint")


def part_counts(candidates: DataFrame, automata: DataFrame, ranges: int, settings: Settings) -> DataFrame:
    """(lang, w1..w4, a, k, l, r) for every cut of every candidate, by composition with the automata."""
    spark = candidates.sparkSession
    kind = "range bigint, side int, k int, lang bigint, w1 bigint, w2 bigint, w3 bigint, w4 bigint, a bigint"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            lang, steps = columns[0].view(np.uint64), [c.view(np.uint64) for c in columns[1:5]]
            size = sum((s != 0).astype(np.int64) for s in steps)
            for k in range(1, len(steps)):
                rows = np.flatnonzero(size > k)
                for side, start, stop in ((0, 0, np.full(len(rows), k)), (1, k, size[rows])):
                    one = steps[start][rows]
                    two = steps[min(start + 1, 3)][rows]
                    single = stop - start == 1
                    own = np.where(single, ranges_of(lang[rows], one, None, ranges), ranges_of(lang[rows], one, two, ranges))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(own.view(np.int64)), pa.array(np.full(len(rows), side, np.int32)), pa.array(np.full(len(rows), k, np.int32)),
                        *[pa.array(c[rows]) for c in columns],
                    ], names=["range", "side", "k", "lang", *STEPS, "a"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, automaton = None, [], None
        for batch in batches:
            asked = np.flatnonzero(np.asarray(batch.column("side")) >= 0)
            own = list(zip(batch.column("range").to_pylist(), batch.column("part").to_pylist(), strict=True))
            cuts = [0, *[i for i in range(1, len(own)) if own[i] != own[i - 1]], len(own)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if own[lo] != key:
                    key, held, automaton = own[lo], [], None
                rows = asked[np.searchsorted(asked, lo) : np.searchsorted(asked, hi)]
                # A range's automata come before its requests.
                held += [load(x.as_py()) for x in batch.column("automaton").slice(lo, hi - lo - len(rows))]
                if not len(rows):
                    continue
                if automaton is None:
                    automaton = summed(held) if held else Transducer()
                part = batch.slice(lo + (hi - lo - len(rows)), len(rows))
                column = lambda c, p=part: np.asarray(p.column(c))
                steps, side, k = [column(c).view(np.uint64) for c in STEPS], column("side"), column("k")
                size = sum((s != 0).astype(np.int64) for s in steps)
                start, length = np.where(side == 0, 0, k), np.where(side == 0, k, size - k)
                table = np.stack(steps)
                labels = [np.where(j < length, table[np.minimum(start + j, 3), np.arange(len(k))], 0) for j in range(3)]
                path = [column("range").view(np.uint64), column("lang").view(np.uint64), *labels]
                f = automaton.weights_of(path, length + 2)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("side", "k", "lang", *STEPS, "a")], pa.array(f)], names=["side", "k", "lang", *STEPS, "a", "f"])

    requests = settle(candidates.select("lang", *STEPS, "a").mapInArrow(ask, kind), "requests")
    # One row for each range.
    split = F.broadcast(requests.groupBy("range").agg(F.ceil(F.count("*") / settings.asked_rows).cast("int").alias("parts")))
    dealt = automata.join(split, "range").select(
        "range", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(-1).alias("side"), F.lit(0).alias("k"),
        *[F.lit(0).cast("long").alias(c) for c in ("lang", *STEPS, "a")], "automaton",
    ).unionByName(requests.join(split, "range").select(
        "range", F.pmod(F.xxhash64("lang", *STEPS), F.col("parts")).cast("int").alias("part"), "side", "k", "lang", *STEPS, "a", F.lit(None).cast("binary").alias("automaton")))
    found = dealt.repartition(shuffle_width(spark), "range", "part").sortWithinPartitions("range", "part", "side").mapInArrow(
        answer, "side int, k int, lang bigint, w1 bigint, w2 bigint, w3 bigint, w4 bigint, a bigint, f bigint")
    return found.groupBy("lang", *STEPS, "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))


def maximal(candidates: DataFrame, settings: Settings) -> DataFrame:
    """Candidates but for those that lie inside a longer one with ``covered`` per cent of their occurrences or more."""
    none = F.lit(0).cast("long")
    inner = [F.struct(*[(F.col(STEPS[i + j]) if j < size else none).alias(STEPS[j]) for j in range(settings.words)])
             for size in range(2, settings.words) for i in range(settings.words - size + 1)]
    # Of a shorter phrase the places beyond its end are 0: such parts are left out, and so is the phrase itself.
    lists = F.filter(F.array(*inner), lambda p: (p["w2"] != 0) & ~((p["w1"] == F.col("w1")) & (p["w2"] == F.col("w2")) & (p["w3"] == F.col("w3")) & (F.col("w4") == 0)))
    longer = candidates.where("w3 <> 0").select("lang", "a", F.explode(lists).alias("p"))
    # A part that reaches over the end of a three-word phrase ends in 0 and has the length of a shorter part: it is that part.
    most = longer.groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2"), F.col("p.w3").alias("w3"), F.col("p.w4").alias("w4")).agg(F.max("a").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(25,0)")
    kept = candidates.join(most, ["lang", *STEPS], "left")
    return kept.where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * settings.covered)).drop("longer")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    prepare(spark)
    width = shuffle_width(spark)
    ranges = 2 * width
    language = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    rows = docs.select(F.xxhash64(language).alias("lang"), F.col(text).alias("text"))
    names = docs.select(language.alias("name")).distinct().select(F.xxhash64("name").alias("lang"), "name")
    for coder in (fast_codes, slow_codes):
        counted = settle(count_words(rows, coder, settings), "words")
        if counted.where("clash").isEmpty():
            break
    words = counted.where(f"word <> 0 AND n >= {settings.least}")
    bits = [bitmap(_codes(words, 1), settings)]
    pairs = settle(count_phrases(rows, coder, bits, ranges, settings), "pairs")
    bits.append(bitmap(_codes(phrases(pairs), 2), settings))
    longer = settle(count_phrases(rows, coder, bits, ranges, settings), "longer")
    automata = word_automata(words, ranges).unionByName(pairs).unionByName(longer)

    candidates = settle(phrases(pairs.unionByName(longer)), "candidates")
    cuts = part_counts(maximal(candidates, settings), automata, ranges, settings)
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    value = F.expr(f"CAST(a AS DECIMAL(20,0)) * {settings.scale}BD div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = cuts.where((wide("l") + wide("r")) > 0).withColumn("score", value)
    best = scored.groupBy("lang", *STEPS, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", *STEPS, "a", "cut.*")
    # Equal scores are told apart by text, which is looked up only for rows that can be in the result.
    front = settle(
        best.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).where(F.col("place") <= settings.top).drop("place"), "front")
    spelled = words.select("lang", F.col("word"), F.col("text").alias("spelling"))
    for step in STEPS:
        front = front.join(spelled.withColumnsRenamed({"word": step, "spelling": f"{step}_text"}), ["lang", step], "left")
    phrase = F.concat_ws(" ", *[F.col(f"{s}_text").cast("string") for s in STEPS])
    total = counted.where("word = 0").select("lang", "n")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = front.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.top)
    return ranked.join(total, "lang").join(names, "lang").select(
        F.col("name").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def _codes(frame: DataFrame, words: int) -> DataFrame:
    """``path_code`` of words, or of phrases of two words, as a column of 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = path_code(*[c.to_numpy().view(np.uint64) for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64))], names=["code"])

    own = frame.select("lang", "word") if words == 1 else frame.where("w3 = 0").select("lang", "w1", "w2")
    return own.mapInArrow(run, "code bigint")


#: What SQL says of the query, with its production parameters.
SQL = r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
      w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
      g AS (SELECT lang, list_slice(words, i, i + k - 1) AS words FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) ks WHERE len(words) >= k) s),
      f AS (SELECT lang, words, count(*) AS f FROM g GROUP BY ALL),
      totals AS (SELECT lang, sum(f) AS n FROM f WHERE len(words) = 1 GROUP BY lang),
      c AS (SELECT lang, words, f AS a FROM f WHERE len(words) > 1 AND f >= 30),
      inner_parts AS (SELECT lang, list_slice(words, i, i + k - 1) AS words, max(a) AS longer FROM
        (SELECT lang, words, a, k, unnest(range(1, len(words) - k + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS k) ks WHERE len(words) > k) s GROUP BY ALL),
      kept AS (SELECT c.* FROM c LEFT JOIN inner_parts i USING (lang, words) WHERE i.longer IS NULL OR 100 * i.longer < 80 * c.a),
      cuts AS (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM kept),
      scored AS (SELECT u.lang, u.words, u.a, u.k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * u.a) // (x.f + y.f) AS BIGINT) AS score
        FROM cuts u JOIN f x ON x.lang = u.lang AND x.words = list_slice(u.words, 1, u.k) JOIN f y ON y.lang = u.lang AND y.words = list_slice(u.words, u.k + 1, len(u.words))),
      best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
      ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank, array_to_string(words, ' ') AS phrase, a, l, r, score FROM best)
    SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, CAST(t.n AS BIGINT) AS n, r.score FROM ranked r JOIN totals t USING (lang) WHERE r.rank <= 2000"""
