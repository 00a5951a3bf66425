"""The n-gram join against all pairs; components; the stage that keeps one of each class."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import odd
import pytest

from tarmac.llm import components, ngramjoin


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def expected(data):
    sets = [shingles(r[1]) for r in data]
    top, links = list(range(len(data))), [0] * len(data)

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in combinations(range(len(data)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
            links[a] += 1
            links[b] += 1
            top[find(b)] = find(a)
    classes = {}
    for i in range(len(data)):
        classes.setdefault(find(i), []).append(i)
    named = {g: min((data[i][0] for i in own if data[i][0] is not None), default=None) for g, own in classes.items()}
    return sorted(((data[i][0], named[find(i)], links[i]) for i in range(len(data))), key=str), len(classes)


def copies():
    random.seed(8)
    base = [f"v{random.randint(0, 400)}" for _ in range(150)]
    data = []
    for i in range(120):
        words = list(base)
        for _ in range(i % 6):
            words[random.randrange(150)] = f"n{i}"
        data.append((i, " ".join(words), "en", "s", 1))
    other = [(200 + i, " ".join(random.choices("abcdefghij", k=8)), "en", "s", 1) for i in range(60)]
    return data + other + [(300 + i, "the very same words again and again", "en", "s", 1) for i in range(40)]


@pytest.mark.parametrize("data", [odd.rows(), copies(), [], [(None, None, None, None, None)]])
def test_against_all_pairs(spark, data, monkeypatch):
    got = ngramjoin.near_duplicates(odd.clashing(odd.frame(spark, data), "node", "tie", "component"))
    rows, n_classes = expected(data)
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in got.collect()), key=str) == rows
    kept = ngramjoin.keep_one(odd.clashing(odd.frame(spark, data), "node"))
    # Texts without words are each a class of their own, but rows equal in id and text count as one.
    assert kept.count() == n_classes and "node" in kept.columns


def test_blocks_find_the_same_links():
    random.seed(1)
    members = []
    for i in range(60):
        own = np.unique(np.array([random.randint(0, 60) for _ in range(150)], dtype=np.uint64))
        members.append((f"{i:02d}".encode(), i % 2, 1 + i % 3, own))
    whole = {n: c for n, _, c in ngramjoin._linked(members, 0.8, False)}
    parts: dict = {}
    for chosen, apart in (([m for m in members if m[1] == 0], False), ([m for m in members if m[1] == 1], False), (members, True)):
        for n, _, c in ngramjoin._linked(chosen, 0.8, apart):
            parts[n] = parts.get(n, 0) + c
    assert whole == parts and whole


def test_bands_reach_the_recall():
    bands, rows = ngramjoin.Settings().bands()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999999 and bands * rows <= 128


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "node bigint, other bigint")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 130)}
    assert components.connected_components(spark.createDataFrame([], "node bigint, other bigint")).count() == 0
