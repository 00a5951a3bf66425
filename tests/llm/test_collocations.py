"""Collocations against a plain count of all phrases; automata against dictionaries."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

import odd
from tarmac.llm import collocations, transducers


def expected(rows, s=collocations.Settings()):
    """Rows by their definition: (lang, rank, phrase, a, l, r, n, score)."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            f.update(tuple(words[i : i + k]) for k in range(1, s.words + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= s.least}
        longer = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        kept = []
        for p, a in candidates.items():
            if 100 * longer[p] >= s.covered * a:
                continue
            score, k = min((s.scale * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[: s.top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def mined(spark, rows, **settings):
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id bigint, text string, lang string").repartition(5)
    s = replace(collocations.Settings(), **settings)
    return sorted(tuple(r) for r in collocations.mine(df, settings=s).collect()), s


def prose(n, seed=0):
    rng = np.random.default_rng(seed)
    words = ["Of", "the", "cat", "sat", "on", "mat", "ünï", "日本", "a-b", "x\x1cy", "\u0085", "É"]
    marks = [" ", "  ", "\t", ". ", ",", "\n", "!?", " ; "]
    out = []
    for i in range(n):
        m = int(rng.integers(0, 40))
        text = "".join(words[int(j)] + marks[int(k)] for j, k in zip(rng.zipf(1.5, m) % len(words), np.minimum(rng.geometric(0.5, m) - 1, 7)))
        out.append((text if i % 11 else None, [None, "en", "de", "und"][i % 4]))
    return [*out, ("the cat sat on the mat " * 200, "en"), ("", "fr"), ("one two", "fr")]


def test_as_counted_plainly(spark):
    rows = prose(400)
    got, s = mined(spark, rows, least=5)
    assert got == expected(rows, s) and len(got) > 60


def test_top_rows_and_ties(spark):
    rows = prose(300, seed=1) + [(f"left{i} right{i}. " * 6, "tie") for i in range(40)]
    got, s = mined(spark, rows, least=4, top=7)
    assert got == expected(rows, s)
    assert [r[2] for r in got if r[0] == "tie"] == [f"left{i} right{i}" for i in sorted(range(40), key=lambda i: f"left{i}")][:7]


def test_small_tasks_small_filters_and_split_ranges(spark):
    rows = prose(300, seed=2)
    got, s = mined(spark, rows, least=3, task_nodes=50, filter_bits=1 << 10, asked_rows=7)
    assert got == expected(rows, s)


def test_words_that_share_a_code_are_found(spark, monkeypatch):
    def worse(data, first, last):
        codes = last - first  # every word of a length has one code
        return codes.astype(np.uint64)

    monkeypatch.setattr(collocations, "fast_codes", worse)
    rows = prose(120, seed=3)
    got, s = mined(spark, rows, least=3)
    assert got == expected(rows, s)


def test_odd_rows_and_no_rows(spark):
    rows = [(r[1], r[2]) for r in odd.rows()]
    df = odd.clashing(odd.frame(spark), "w1", "word", "n", "range", "phrase")
    few = replace(collocations.Settings(), least=2)
    got = sorted(tuple(r) for r in collocations.mine(df, settings=few).collect())
    assert got == expected(rows, few) and got
    empty = collocations.mine(odd.frame(spark, []))
    assert empty.count() == 0 and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocations.mine(odd.frame(spark, [(1, None, None, None, None)])).count() == 0


def as_dict(t):
    return {tuple(int(c[i]) for c in t.paths(d)): int(w) for d in range(len(t.label)) for i, w in enumerate(t.weight[d]) if w}


@pytest.mark.parametrize("seed", range(4))
def test_automata_hold_the_counts(seed):
    rng, counts, built = np.random.default_rng(seed), Counter(), transducers.Builder()
    for _ in range(6):
        n = int(rng.integers(0, 300))
        steps, length = [rng.integers(1, 5, n).astype(np.uint64) for _ in range(4)], rng.integers(1, 5, n)
        built.add(transducers.load(transducers.dump(transducers.from_paths(steps, length, 1))))
        for i in range(n):
            counts.update(tuple(int(c[i]) for c in steps[: d + 1]) for d in range(1, length[i]))
    t = built.take()
    assert as_dict(t) == counts and as_dict(transducers.load(transducers.dump(t))) == counts
    few = t.pruned(9)
    assert as_dict(few) == {p: n for p, n in counts.items() if n >= 9}
    assert {p: n for _, part in few.sliced() for p, n in as_dict(part).items()} == as_dict(few)


def test_states_are_shared():
    n = 1000
    steps = [np.arange(1, n + 1).astype(np.uint64), np.full(n, 7, np.uint64), np.full(n, 8, np.uint64)]
    t = transducers.from_paths(steps, np.full(n, 3), 0)
    # One state for all that follows the first label: its arcs are written once.
    assert len(transducers.dump(t)) < 5 * n
    assert as_dict(transducers.load(transducers.dump(t))) == as_dict(t)
