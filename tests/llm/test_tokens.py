"""Packing, BPE and token counts against the tokenizers library."""

from __future__ import annotations

import random
import time
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import odd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarmac.llm import bpe, packing, tokencounts, wordpieces
from tarmac.llm.wordpieces import WordEncoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def library(path):
    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


def strange():
    random.seed(3)
    letters = [chr(c) for c in range(32, 1200)] + list("\n\t '’") + [c for c in map(chr, random.sample(range(0x3000, 0x1F9FF), 300)) if not 0xD800 <= ord(c) < 0xE000]
    out = ["".join(random.choice(letters) for _ in range(random.randint(1, 40))) for _ in range(1500)]
    out += ["".join(random.choice("ethanoisr 'SLt,.1") for _ in range(random.randint(1, 60))) for _ in range(1500)]
    return [*out, "", "<|endoftext|>", "x<|endoftext|>y <|startoftext|>", "  \n\n \t x", "é́ é İSTANBUL ΣΑΣ", "日本語 テキスト😀👩‍👩‍👧", "a" * 5000, "ab" * 3000, " " * 999 + "x", "\x1c\x1d\x85 ᠎ x", "١٢٣ ²³ Ⅷ", "0" * 400]


def test_words_are_encoded_as_by_the_library():
    own, texts = WordEncoder(WORD), strange()
    expected = library(WORD).encode_batch(texts, add_special_tokens=False)
    for text, got, want in zip(texts, own.encode([t.encode() for t in texts]), expected, strict=True):
        assert np.frombuffer(got, "<u4").tolist() == want.ids, text[:60]


def test_long_unbroken_text_is_encoded_in_time_and_not_kept():
    own, rng = WordEncoder(WORD), np.random.default_rng(5)
    letters = "".join(rng.choice(list("abcdefghij"), 1 << 20))
    signs = "".join(chr(c) for c in rng.integers(0x4E00, 0x4E80, 1 << 18))
    began = time.monotonic()
    got = own.encode([letters.encode(), signs.encode(), letters.encode()])
    assert time.monotonic() - began < 60
    want = library(WORD).encode_batch([letters, signs], add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [want[0].ids, want[1].ids, want[0].ids]
    assert not len(own.words) and not len(own.runs)


def test_words_come_back_from_the_generation_before(monkeypatch):
    monkeypatch.setattr(wordpieces, "MOST_WORDS", 40)
    monkeypatch.setattr(wordpieces, "MOST_RUNS", 20)
    own, other = WordEncoder(WORD), library(WORD)
    for i in range(60):
        text = " ".join(f"{'abcdefghij'[j % 10]}q{'klmnopqrst'[j // 10]} été{j}'s 日{j}" for j in range(i, i + 25)) + "x" * 70
        assert np.frombuffer(own.encode([text.encode()])[0], "<u4").tolist() == other.encode(text, add_special_tokens=False).ids
        assert len(own.words) <= 40 + 50 and len(own.runs) <= 20 + 50


def test_latin_letters_are_read_by_their_bytes():
    own, other = WordEncoder(WORD), library(WORD)
    latin = [chr(c) for c in range(0x21, 0x180) if not chr(c).isspace()]
    texts = [a + b + c for a in latin for b in ("", "a", "É", "1") for c in ("", "ß", ".")] + ["ÀÉÎÕÜ", "×÷", "a×b", "Ã", "naïve CAFÉ.", "x²", "«Où»"]
    for text, want in zip(texts, other.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(own.encode([text.encode()])[0], "<u4").tolist() == want.ids, text
    broken = [b"\xc3", b"a\xc3", b"\xc3\xc3\xa9", b"\xa9b", b"\xff\xfe ok"]
    for text in broken:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == other.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, text


def test_bpe_is_that_of_the_library_and_goes_back():
    own, other, texts = bpe.Bpe(BYTE), library(BYTE), strange()
    for text, got, want in zip(texts, own.encode(texts), other.encode_batch(texts, add_special_tokens=False), strict=True):
        assert got.tolist() == want.ids, text[:60]
        assert own.decode(got) == other.decode(want.ids, skip_special_tokens=False) == text
    partial = np.array(other.encode("日本", add_special_tokens=False).ids[:-1])
    assert own.decode(partial) == other.decode(partial.tolist(), skip_special_tokens=False)


def test_both_ways_of_merging_agree():
    own = bpe.Bpe(BYTE)
    for word in (b"theinternationalisation" * 2, b"aaaaaaaaaaaaaaaa", "éàüöß".encode() * 4):
        assert own.merged(word) == own._merged_long([own.single[b] for b in word])


def test_bpe_rows(spark):
    other, data = library(BYTE), odd.rows()
    got = sorted((tuple(r) for r in bpe.digest(odd.clashing(odd.frame(spark), "tokens"), BYTE).collect()), key=str)
    want = []
    for i, text, *_ in data:
        ids = other.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = bpe.with_text(bpe.with_tokens(odd.clashing(odd.frame(spark), "tokens"), BYTE), BYTE).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)


@pytest.mark.parametrize("data", [odd.rows(), [], [(i, "same length", "en", "s", 1) for i in range(300)]])
def test_packing(spark, data):
    own = library(WORD)
    rows = packing.packed(odd.clashing(odd.frame(spark, data), "rank", "salt", "length"), WORD).collect()
    want = Counter()
    for i, text, *_ in data:
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            want[(i, k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places: dict = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own_places in places.values():
        own_places.sort()
        ends = np.cumsum([n for _, n in own_places])
        assert [o for o, _ in own_places] == [0, *ends[:-1]] and ends[-1] <= 4096
    total = sum(r["length"] for r in rows)
    assert len(places) <= -(-total // 4096) + 1 if rows else not places


def first_fit_decreasing(lengths, capacity=4096):
    rooms: list = []
    for n in sorted(lengths, reverse=True):
        at = next((i for i, r in enumerate(rooms) if r >= n), None)
        if at is None:
            rooms.append(capacity - n)
        else:
            rooms[at] -= n
    return len(rooms)


def test_plans_place_every_piece_and_are_tight():
    rng = np.random.default_rng(0)
    for lengths in (np.clip(rng.lognormal(6, 1, 3000), 1, 4096).astype(int), rng.integers(1500, 4000, 1000), np.array([2500] * 10 + [1500] * 7 + [1] * 3), np.full(50, 4096)):
        rows = packing.plan(np.bincount(lengths, minlength=4097))
        used = Counter()
        for n in np.unique(lengths):
            own = rows[rows[:, 0] == n]
            for rank in range(int((lengths == n).sum())):
                r = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
                used[int(r[2] + (rank - r[1]) // r[4])] += int(n)
        assert max(used.values()) <= 4096 and len(used) <= 1.01 * first_fit_decreasing(lengths.tolist()) + 1


def test_nonnegative_least_squares():
    rng = np.random.default_rng(3)
    a, x = rng.random((20, 60)), np.maximum(rng.normal(0, 1, 60), 0)
    found = packing.nonnegative_least_squares(a, a @ x)
    assert (found >= 0).all() and np.allclose(a @ found, a @ x, atol=1e-6)
    b = rng.normal(0, 1, 20)
    found = packing.nonnegative_least_squares(a, b)
    slope = a.T @ (b - a @ found)
    assert (slope <= 1e-6).all() and np.abs(slope[found > 0]).max(initial=0) < 1e-6


def test_token_rollups(spark, tmp_path):
    other, data, want, seen = library(WORD), odd.rows(), Counter(), set()
    for i, text, lang, source, _ in sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[3] is not None, r[3] or "", r[2] is not None, r[2] or "")):
        for version in ("words", "word_bpe_49k"):
            want[(source, lang, version, "docs")] += 0
        if (text or "") not in seen:
            seen.add(text or "")
            for version, n in (("words", len((text or "").encode().split())), ("word_bpe_49k", len(other.encode(text or "", add_special_tokens=False).ids) + 1)):
                want[(source, lang, version, "docs")] += 1
                want[(source, lang, version, "tokens")] += n
    rows = tokencounts.maintained(odd.clashing(odd.frame(spark), "n_words", "sign"), WORD).collect()
    assert len(rows) == len([k for k in want if k[3] == "docs"])
    for r in rows:
        key = (r["source"], r["lang"], r["tokenizer"])
        assert (want[(*key, "docs")], want[(*key, "tokens")]) == (r["n_docs"], r["n_tokens"]), key
    assert tokencounts.maintained(odd.frame(spark, []), WORD).count() == 0


def test_batches_count_once(spark, tmp_path):
    held = tokencounts.Rollup(spark, str(tmp_path))
    assert held.totals().count() == 0
    rows = spark.createDataFrame([("a", "en", "v", 1, 10), ("a", "en", "v", 1, 5), (None, None, "v", 1, 1)], "source string, lang string, tokenizer string, sign bigint, n_tokens bigint")
    back = spark.createDataFrame([("a", "en", "v", -1, 5)], rows.schema)
    assert held.commit("one", rows) and not held.commit("one", rows)
    held.compact()
    assert held.commit("two", back) and not held.commit("one", rows)
    (tmp_path / "deltas" / "broken").mkdir()  # a writer that did not finish
    want = {("a", 1, 10), (None, 1, 1)}
    assert {(r["source"], r["n_docs"], r["n_tokens"]) for r in held.totals().collect()} == want
    held.compact()
    assert not held.commit("two", back) and {(r["source"], r["n_docs"], r["n_tokens"]) for r in held.totals().collect()} == want


def test_many_batches_fold(spark, tmp_path):
    held = tokencounts.Rollup(spark, str(tmp_path / "rollup"))
    rows = spark.createDataFrame([("a", "en", "v", 1, 10)], "source string, lang string, tokenizer string, sign bigint, n_tokens bigint").coalesce(1)
    names = ["a+b", "2026/08/07", "ü %", "a b", "x" * 150, *[f"2026-08-{i:02d}T00:00:00" for i in range(1, 25)]]
    for n in names:
        assert held.commit(n, rows)
    held.compact()
    held.compact()
    assert held.batches() == set(names) and not any(held.commit(n, rows) for n in names[:4])
    assert [tuple(r) for r in held.totals().collect()] == [("a", "en", "v", len(names), 10 * len(names))]
    assert held.commit("one more", rows) and held.totals().first()["n_docs"] == len(names) + 1
    # A fold that was cut off before its totals does not count.
    (tmp_path / "rollup/folded/99999999-cut/names").mkdir(parents=True)
    assert held.totals().first()["n_docs"] == len(names) + 1
    # Names far beyond what a file may be called are kept inside the fold.
    spark.createDataFrame([(f"day-{i}-" + "n" * 60,) for i in range(1000)], "batch string").coalesce(1).write.parquet(str(tmp_path / "other/folded/00001000-f/names"))
    rows.groupBy("source", "lang", "tokenizer").agg(F.lit(1000).cast("long").alias("n_docs"), F.lit(5).cast("long").alias("n_tokens")).write.parquet(str(tmp_path / "other/folded/00001000-f/totals"))
    big = tokencounts.Rollup(spark, str(tmp_path / "other"))
    assert not big.commit("day-999-" + "n" * 60, rows) and big.commit("new", rows)
    big.compact()
    assert len(big.batches()) == 1001 and big.totals().first()["n_docs"] == 1001
    with pytest.raises(ValueError, match="name for a batch"):
        held.commit("n" * 300, rows)
