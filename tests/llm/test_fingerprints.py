"""Order MinHash against a plain version, and its behaviour under edits."""

from __future__ import annotations

import hashlib

import numpy as np
import odd
import pytest

from tarmac.llm import fingerprints as fp


def test_selection_is_that_of_a_full_sort():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 96, 97, 1000, 5001):
        low = rng.integers(0, 2**32, n, dtype=np.uint32)
        factors = fp._factors(8)
        picks = min(2, n)
        got = fp._smallest(low, picks, factors)
        for j, f in enumerate(factors):
            values = (low * f).astype(np.uint32)
            assert sorted(values[got[j]]) == sorted(values)[:picks]


def test_occurrences_are_told_apart():
    sketch = fp.Sketch(k=2)
    values = fp._numbered(np.frombuffer("ababab".encode("utf-32-le"), np.uint32), sketch)
    assert len(set(values.tolist())) == 5  # ab, ba, ab again, ba again, ab again


def test_order_counts_and_equal_texts_agree():
    words = [f"w{i}xyz" for i in range(400)]
    text, turned = " ".join(words), " ".join(words[::-1])
    a, b = fp.components(text.encode()), fp.components(turned.encode())
    assert fp.likeness(a, fp.components(text.encode())) == 1.0
    assert fp.likeness(a, b) < 0.75
    near = " ".join(words[:-20] + ["changed"] * 20)
    assert fp.likeness(a, fp.components(near.encode())) > fp.likeness(a, b)


def expected(data):
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, r in enumerate(order):
        text, following = r[1] or "", order[(i + 1) % len(order)][1] or ""
        q = len(text) // 4
        changed = text[: len(text) - q] + following[:q]
        a, b, c = (fp.components(t.encode()) for t in (text, changed, following))
        out.append((r[0], len(text), hashlib.sha256(changed.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("data", [odd.rows(), odd.rows()[5:6], [], [(None, None, None, None, None)]])
def test_neighbours_against_plain_python(spark, data):
    got = fp.compare_neighbours(odd.clashing(odd.frame(spark, data), "fingerprint", "spot", "after")).collect()
    assert sorted(map(tuple, got), key=str) == expected(data)


def test_column_is_replaced(spark):
    got = fp.with_fingerprint(odd.clashing(odd.frame(spark), "fingerprint"))
    assert got.columns == [*odd.frame(spark).columns, "fingerprint"] and got.where("fingerprint = 'other'").count() == 0
