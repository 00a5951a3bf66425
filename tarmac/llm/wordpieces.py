"""Token ids of a word-wise tokenizer, by remembering words and runs.

The tokenizer drops white space and encodes runs of letters, digits and marks each for itself,
and most words of a corpus are met again and again. A block of texts is split and its words are numbered
in Arrow; the distinct words are lowered and cut into runs by their bytes, and the runs numbered
again; ids are looked up for the distinct runs and gathered for all words. So no Python object
is made for a word, but for those with rarer letters or signs, whose ids are remembered by
word. New runs are encoded by the ``tokenizers`` library, many in one call. A run's last token is
marked as the end of a word, which parts the result.

What is kept is bounded in bytes: words and runs beyond ``LONGEST`` bytes are encoded where they
occur and not kept, the others are held in two generations of bounded number.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from tarmac.llm.bpe import UNSURE
from tarmac.llm.text import LOWER, raw

# Fixed value: how the tokenizer parts a normalised text.
RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words, and runs, in each of two generations that a process remembers; runs encoded in one call.
MOST_WORDS, MOST_RUNS, TOGETHER = 120_000, 120_000, 512
#: Bytes of the longest word or run that is remembered.
LONGEST = 64

#: Kinds of bytes: 0 for what needs the careful way, letters, digits, marks. An apostrophe may begin a suffix, and < a special token.
LETTER, DIGIT, MARK = 1, 2, 3
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[0x21:0x7F] = MARK
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KINDS[0x30:0x3A] = DIGIT
KINDS[[ord("'"), ord("<")]] = 0
#: The first byte of the letters from U+00C0 to U+00FF; two of their second bytes are signs, times and divided by.
ACCENTED, SIGNS = 0xC3, (0x97, 0xB7)


class Memory:
    """Ids by key, in two generations: keys still in use come back from the older one, the rest are forgotten with the next."""

    def __init__(self, most: int):
        self.most, self.held, self.older = most, {}, {}

    def __len__(self) -> int:
        return len(self.held)

    def look_up(self, keys: list, learn: Callable[[list], list[bytes]]) -> list[bytes]:
        """The ids of distinct keys; those not held are learned, and kept if they are short."""
        held = self.held
        new = [k for k in keys if k not in held]
        if len(held) + len(new) > self.most:
            self.held, self.older = {}, held
            held, new = self.held, keys
        if not new:
            return list(map(held.__getitem__, keys))
        older = self.older
        lacking = [k for k in new if k not in older]
        held.update((k, older[k]) for k in new if k in older)
        long: dict = {}
        for k, ids in zip(lacking, learn(lacking), strict=True):
            (held if len(k) <= LONGEST else long)[k] = ids
        return list(map(held.__getitem__, keys)) if not long else [held[k] if k in held else long[k] for k in keys]


def gathered_ids(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of entries ``codes`` one after the other, each a range of ``ids``, and where each begins (one more than codes)."""
    many = sizes[codes]
    at = np.concatenate([[0], np.cumsum(many)])
    return ids[np.arange(at[-1]) + np.repeat(starts[codes] - at[:-1], many)], at


def _arena(found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    return np.frombuffer(b"".join(found), dtype="<u4"), np.cumsum(sizes) - sizes, sizes


class WordEncoder:
    """Ids as little-endian 32-bit bytes, or as arrays."""

    def __init__(self, path: str):
        self.own = Tokenizer.from_file(path)
        self.own.no_truncation()
        self.own.no_padding()
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]
        ids = self.own.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(ids.values()) + 1, dtype=bool)
        self.ends[[i for token, i in ids.items() if token.endswith("</w>")]] = True
        self.words, self.runs = Memory(MOST_WORDS), Memory(MOST_RUNS)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        ids, at = self.encode_column(pa.array(texts, pa.large_binary()))
        flat, ends = ids.tobytes(), (4 * at).tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a ``large_binary`` column without nulls, and where each text's ids begin (one more than texts)."""
        parted = pc.ascii_split_whitespace(column.view(pa.large_string()))
        at = parted.offsets.to_numpy().astype(np.int64)
        words = parted.flatten().dictionary_encode()
        ids, begins = gathered_ids(*self._distinct(words.dictionary.cast(pa.large_binary())), words.indices.to_numpy())
        return ids, begins[at - at[0]]

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words: one array, and where each word's ids begin in it and how many they are."""
        data, at = raw(words)
        odd = np.zeros(len(words), dtype=bool)
        odd[np.searchsorted(at, np.flatnonzero(_kinds(data)[0] == 0), side="right") - 1] = True
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        ids, starts[~odd], sizes[~odd] = self._by_runs(words.filter(pa.array(~odd)))
        if odd.any():
            rare, first, sizes[odd] = _arena(self.words.look_up(words.filter(pa.array(odd)).to_pylist(), self._learn_words))
            starts[odd] = first + len(ids)
            ids = np.concatenate([ids, rare])
        return ids, starts, sizes

    def _by_runs(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, at = raw(words)
        kinds, lowered = _kinds(data)
        cut = np.ones(len(data) + 1, dtype=bool)
        cut[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
        cut[at] = True
        bounds = np.flatnonzero(cut)
        runs = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(lowered)]).dictionary_encode()
        ids, begins = gathered_ids(*_arena(self.runs.look_up(runs.dictionary.to_pylist(), lambda new: self._learn_runs([r.decode() for r in new]))), runs.indices.to_numpy())
        place = begins[np.searchsorted(bounds, at)]
        return ids, place[:-1], np.diff(place)

    def _learn_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words with letters or signs that bytes alone don't tell."""
        whole: dict[int, bytes] = {}
        runs_of: list[list[str]] = []
        for i, w in enumerate(words):
            text = w.decode("utf-8", "replace")
            if not text.isascii():
                if UNSURE.search(text):
                    whole[i] = self._whole(text)
                text = normalize("NFC", text)
            if "<|" in text and any(s in text for s in self.special):
                whole[i] = self._whole(text)
            # The library lowers each letter for itself, also a sigma at the end of a word.
            runs_of.append([] if i in whole else RUNS.findall(text.replace("Σ", "σ").lower()))
        distinct = list(set().union(*runs_of))
        look = dict(zip(distinct, self._learn_runs(distinct), strict=True)).__getitem__
        return [whole[i] if i in whole else b"".join(map(look, runs)) for i, runs in enumerate(runs_of)]

    def _learn_runs(self, runs: list[str]) -> list[bytes]:
        """Ids of distinct runs."""
        out: list[bytes] = []
        groups = [runs[i : i + TOGETHER] for i in range(0, len(runs), TOGETHER)]
        for group, found in zip(groups, self.own.encode_batch_fast(["\n".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(group):  # the library parts a run otherwise: one by one
                out += map(self._whole, group)
                continue
            flat, ends = ids.tobytes(), (4 * cuts).tolist()
            out += [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return out

    def _whole(self, text: str) -> bytes:
        return np.array(self.own.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def _kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte, and the bytes in lower case (right for words without a byte of kind 0)."""
    kinds, lowered = KINDS[data], LOWER[data]
    lead = np.flatnonzero(data[:-1] == ACCENTED)
    second = data[lead + 1]
    letter = (second >= 0x80) & (second < 0xC0) & (second != SIGNS[0]) & (second != SIGNS[1])
    lead = lead[letter]
    kinds[lead] = kinds[lead + 1] = LETTER
    capital = lead[data[lead + 1] <= 0x9E] + 1
    lowered[capital] = data[capital] + 0x20
    return kinds, lowered


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
