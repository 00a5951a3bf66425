"""Line deduplication against plain Python, and its runs."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import odd
import pytest

from tarmac.llm import linededup

LOWER = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip(" \t\n\v\f\r").translate(LOWER)


def expected(data):
    held = defaultdict(list)
    for i, text, *_ in data:
        if i is not None:
            for k in {key(x) for x in (text or "").split("\n")}:
                if len(k) >= 20:
                    held[k].append(i)
    gone = {k: max(v) for k, v in held.items() if len(v) >= 3}
    out = []
    for i, text, *_ in data:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or gone.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("data", [odd.rows(), [], [(None, odd.LINE, None, None, 0)] * 4, [(i, f"{i}\n{odd.LINE}", "en", "s", 1) for i in range(200)]])
def test_against_plain_python(spark, data):
    got = linededup.digest(odd.clashing(odd.frame(spark, data), "n_lines", "lost", "line_key")).collect()
    assert sorted(map(tuple, got), key=str) == expected(data)


def test_runs_know_what_they_have_seen(spark):
    runs = linededup.Runs(spark, fanout=2)
    seen = {}
    for n in range(5):
        batch = [(f"k{j}".encode(), 100 - 10 * n - j % 3) for j in range(n, n + 4)]
        fresh = {bytes(r["line_key"]): r["keeper"] for r in runs.admit(spark.createDataFrame(batch, "line_key binary, doc_id bigint")).collect()}
        assert set(fresh) == {k for k, _ in batch} - set(seen)
        seen.update({k: v for k, v in batch if k in fresh})
    assert runs.totals().count() == len(seen)
    totals = {bytes(r["line_key"]): (r["n_docs"], r["keeper"]) for r in runs.totals().collect()}
    assert {k: v for k, (_, v) in totals.items()} == seen and sum(n for n, _ in totals.values()) == 20
    assert sum(map(len, runs.levels)) < 5 and len(runs.levels) > 1


def test_keys_count_code_points():
    assert linededup.line_key("é".encode() * 19) is None and linededup.line_key("é".encode() * 20) is not None
