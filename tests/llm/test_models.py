"""The language model and the nearest neighbours against plain Python."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from tarmac.llm import langmodel, neighbours
from tarmac.llm import text as text_helpers


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode())) + [None]


def two_languages(n=400):
    random.seed(6)
    a, b = [f"{i}al" for i in range(80)], [f"{i}bo" for i in range(80)]
    return [(i, " ".join(random.choices(a if i % 2 else b, k=random.randint(20, 60))), "en", "s", 1) for i in range(n)]


@pytest.mark.parametrize("data", [odd.rows(), two_languages(), [], [(i, "x", "en", "s", 1) for i in range(2000) if zlib.crc32(str(i).encode()) % 5 == 1][:3]])
def test_scores(spark, data):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in data}
    counts = Counter()
    for i, text, *_ in data:
        if not held[i]:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted(((i, held[i], len(t), sum(counts[w] > 0 for w in t), total, round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t), 5))
                   for i, text, *_ in data for t in [tokens(text)]), key=str)
    # A small bound on frequent words sends most of them through the join.
    got = langmodel.score(odd.clashing(odd.frame(spark, data), "word", "tie"), settings=langmodel.Settings(frequent=20)).collect()
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got), key=str) == want
    assert all(r["score"] < 0 or r["n_tokens"] == r["n_known"] for r in got)


def test_the_model_beats_counts_on_texts_held_out(spark):
    got = [r for r in langmodel.score(odd.frame(spark, two_languages(3000)), settings=langmodel.Settings(batch=1024)).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) + 0.1 * sum(r["n_tokens"] for r in got)


def plain_scores(data, words, weights, s):
    """The score of each text, token by token, from the trained table."""
    place = {int(h): i for i, h in enumerate(words.hashes)}
    size, out = 1 << s.contexts_log2, []

    def mixed(x):
        return int(langmodel.mix(np.array([x & (2**64 - 1)], np.uint64))[0])

    for _, text, *_ in data:
        total, before = 0.0, (size - 1, size - 1)
        for w in tokens(text):
            code = int(langmodel.END) if w is None else int(langmodel.hashed(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
            ending = 0 if w is None else int.from_bytes(w[:-4:-1], "little")
            at = place.get(code)
            n, rank = (0, 1 << 40) if at is None else (int(words.counts[at]), int(words.rank[at]))
            y = rank if rank < s.own_classes else s.own_classes + mixed(ending & 0xFFFF) % s.ending_classes
            context = rank if rank < s.own_contexts else s.own_contexts + mixed(ending) % (size - s.own_contexts - 1)
            pair = mixed(before[0] * int(langmodel.ODD) + before[1]) >> (64 - s.contexts_log2)
            z = [sum(float(weights[f, c]) for f in (before[0], size + pair, 2 * size + before[1], -1)) for c in range(s.classes)]
            total += (z[y] - math.log(sum(map(math.exp, z)))) / math.log(10)
            total += math.log10(n + 0.5) - math.log10(words.class_total[y] + 0.5 * (words.class_distinct[y] + 1))
            before = (context, before[0])
        out.append(round(total, 3))
    return out


def test_scores_are_those_of_the_model(spark, tmp_path):
    data = two_languages(60) + [(900, "", "en", "s", 0), (901, "never seen wörds é", "en", "s", 0)]
    s = langmodel.Settings(batch=256)
    spark.createDataFrame(data, odd.SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")  # one file, so one task reads it in order and training can be repeated
    got = {r["doc_id"]: round(r["score"], 3) for r in langmodel.score(docs, settings=s).collect()}
    texts = docs.where("crc32(CAST(doc_id AS STRING)) % 5 <> 1").select("text")
    words = langmodel.vocabulary(langmodel.count_words(texts, s), s)
    want = plain_scores(data, words, langmodel.train(texts, words, s), s)
    assert [got[r[0]] for r in data] == pytest.approx(want, abs=2e-2)


def test_frequent_words_are_found_and_no_others():
    rng = np.random.default_rng(8)
    for n in (0, 1, 5, 3000):
        hashes = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        crowd = np.uint64(1 << 63) + np.arange(min(n, 40), dtype=np.uint64)  # all in one slot
        hashes = np.unique(np.concatenate([hashes, crowd]))
        words = langmodel.Vocabulary(hashes, np.ones(len(hashes)), np.arange(len(hashes)), 0, 0, np.zeros(0), np.zeros(0))
        asked = np.concatenate([hashes, hashes + np.uint64(1), rng.integers(0, 2**64, 500, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        at, seen = words.known(asked)
        assert seen.tolist() == np.isin(asked, hashes).tolist() and (not len(hashes) or (hashes[at[seen]] == asked[seen]).all())


def test_rows_are_repeated_by_small_steps(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2500), ("c", 1024)], "k string, n bigint")
    assert {r["k"]: r["count"] for r in text_helpers.repeated(df, "n").groupBy("k").count().collect()} == {"a": 1, "b": 2500, "c": 1024}


def test_classes_share_out_all_probability():
    settings = langmodel.Settings()
    rng = np.random.default_rng(0)
    weights = rng.normal(0, 1, (settings.rows, settings.classes)).astype(np.float32)
    features = np.stack([rng.integers(0, 1 << settings.contexts_log2, 50) + (k << settings.contexts_log2) for k in range(3)])
    assert np.allclose(np.exp(langmodel.log_softmax(weights, features).astype(float)).sum(axis=1), 1, atol=1e-4)


def test_contexts_grow_with_the_counts_and_a_second_round_starts_from_the_first(spark):
    settings = langmodel.Settings()
    none = np.zeros(0)
    sized = [langmodel.grown(settings, langmodel.Vocabulary(none, np.full(v, n), none, v * n, v, none, none)) for v, n in ((0, 0), (5_000, 4_000), (50_000, 4_000))]
    assert [s.contexts_log2 for s in sized] == [12, 14, 17] and [s.own_contexts for s in sized] == [2048, 5000, 50_000]
    assert all(s.own_contexts < (1 << s.contexts_log2) - 1 for s in sized) and settings.rounds >= 2
    texts = odd.frame(spark, two_languages(300)).select("text")
    words = langmodel.vocabulary(langmodel.count_words(texts, settings), settings)
    one = langmodel.train(texts, words, replace(settings, rounds=1))
    assert np.allclose(langmodel._round(texts, one, words, settings), langmodel.train(texts, words, settings), atol=1e-4)


def vectors(n=300, d=20):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (n, d))
    x[50:150] = x[min(50, n - 1)]  # a third are copies
    return [(i, x[i].astype(np.float32).tolist()) for i in range(n)]


def nearest(data, k=20):
    ids = np.array([i for i, _ in data])
    x = np.array([v for _, v in data], dtype=np.float64)
    out = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:k]
        out += [(int(ids[q]), n + 1, int(ids[i]), round(float(scores[i]), 9)) for n, i in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("settings", [neighbours.Settings(), neighbours.Settings(bucket_rows=16, query_rows=2)])
def test_small_tables_are_searched_whole(spark, settings):
    data = vectors()
    strange = [(1000, None), (1020, []), (1040, [0.0] * 20), (1060, [float("nan")] * 20), (1080, [1.0, None] * 10), (None, [1.0] * 20), (1100, [1.0] * 3), (0, data[0][1])]
    frame = spark.createDataFrame(data + strange, "vec_id bigint, embedding array<float>").withColumn("slot", F.lit("other"))
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0, settings=settings).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got) == nearest(data)


def test_few_or_no_vectors(spark):
    for data in ([], vectors(5), vectors(1), [(20, [0.0] * 4)]):
        frame = spark.createDataFrame(data, "vec_id bigint, embedding array<float>")
        got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect()
        assert len(got) == max(0, len(data) - 1) or data[0][0] == 20


def test_recall_with_few_probes(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 1, (30, 32))
    data = [(i, (centres[i % 30] + 0.4 * rng.normal(0, 1, 32)).tolist()) for i in range(3000)]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0, settings=neighbours.Settings(candidates=1)).collect()
    want = {(q, i) for q, _, i, _ in nearest(data)}
    assert len(want & {(r["query_id"], r["vec_id"]) for r in got}) / len(want) >= 0.9


def test_hadamard_is_orthogonal():
    turned = neighbours.hadamard(np.eye(16))
    assert np.allclose(turned @ turned.T, np.eye(16))


def test_a_query_in_sparse_surroundings_looks_further(spark):
    rng = np.random.default_rng(12)
    crowd = rng.normal(0, 1, 64)
    data = [(20 * i + 1, (crowd + 0.05 * rng.normal(0, 1, 64)).tolist()) for i in range(10_000)]
    data += [(20 * i, (-crowd + 3 * rng.normal(0, 1, 64)).tolist()) for i in range(30)]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    want = {(q, i) for q, _, i, _ in nearest(data)}
    assert len(got) == len(want) and len(want & {(r["query_id"], r["vec_id"]) for r in got}) / len(want) >= 0.9
