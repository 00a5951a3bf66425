"""Byte-level BPE, encoded by speculation and verification.

A word's tokens are proposed by greedy longest match: many words walk the vocabulary's trie
together. A proposal is the true encoding if every token in it is one that merging its own bytes
yields, and every pair of neighbours stays apart when the bytes of the two are merged; so one
vectorised look-up of all pairs of a block settles most words. Verdicts on tokens and pairs are
remembered. Only words with a failing pair are merged step by step.

Null or empty texts have no tokens. Special tokens in a text count as such. Texts of any length
are encoded whole; repeated rows each for themselves.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from tarmac.llm.text import blocks, prepare, text_column

# Fixed value: how the byte-level scheme parts a text.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Code points whose kind depends on the version of Unicode: texts with one are parted by the library.
UNSURE = regex.compile("[\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7ff\uab6c-\uab6f\U00010000-\U0001efff\U0001fb00-\U0010ffff]")
#: Words remembered by one process; words up to this many bytes are merged by scanning.
MOST_WORDS, SHORT = 250_000, 48


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.bytes: list[bytes] = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.single = [vocabulary[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self._build_trie({t: i for i, t in enumerate(self.bytes) if t})
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.parter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.known: dict[str, bytes] = {}
        self.sound = np.zeros(len(self.bytes), dtype=np.int8)  # of a token by itself: 1 yes, -1 no, 0 not yet known
        self.apart = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)  # pairs judged so far, sorted, and the verdicts
        sizes = np.array([len(t) for t in self.bytes])
        self.spelled = np.frombuffer(b"".join(self.bytes), np.uint8), np.concatenate([[0], np.cumsum(sizes)])
        decimals = [b"%d," % i for i in range(len(self.bytes))]
        self.decimal = np.frombuffer(b"".join(decimals), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in decimals])])

    def _build_trie(self, tokens: dict[bytes, int]) -> None:
        """Edges as sorted codes (node * 256 + byte) with the node that each leads to; the token that ends at a node."""
        nodes, edges, ends = 1, {}, [-1]
        for token, i in tokens.items():
            at = 0
            for b in token:
                if (at << 8 | b) not in edges:
                    edges[at << 8 | b] = nodes
                    ends.append(-1)
                    nodes += 1
                at = edges[at << 8 | b]
            ends[at] = i
        codes = np.fromiter(edges, np.int64, len(edges))
        order = np.argsort(codes)
        self.edges, self.ahead = codes[order], np.fromiter(edges.values(), np.int64, len(edges))[order]
        self.ends = np.array(ends)

    def merged(self, data: bytes) -> list[int]:
        """The exact encoding of one word: the earliest merge of the lowest rank, again and again."""
        ids = [self.single[b] for b in data]
        if len(ids) > SHORT:
            return self._merged_long(ids)
        ranks = [self.merges.get(pair, _NONE) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best is _NONE:
                break
            at = ranks.index(best)
            ids[at : at + 2] = [best[1]]
            del ranks[at]
            if at:
                ranks[at - 1] = self.merges.get((ids[at - 1], ids[at]), _NONE)
            if at < len(ranks):
                ranks[at] = self.merges.get((ids[at], ids[at + 1]), _NONE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a queue of possible merges, for words of any length."""
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, a, b, into = heapq.heappop(queue)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = into, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (m := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(queue, (m[0], left, ids[left], ids[right], m[1]))
        return [i for i in ids if i >= 0]

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words: (word, token), in order within a word."""
        sizes = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        stop = at + sizes
        lane = np.flatnonzero(sizes)
        at, stop = at[lane], stop[lane]
        node = np.zeros(len(lane), dtype=np.int64)
        token, resume = np.full(len(lane), -1), at.copy()
        out: list[tuple[np.ndarray, np.ndarray]] = []
        while len(lane):
            code = (node << 8) | data[at]
            spot = np.minimum(np.searchsorted(self.edges, code), len(self.edges) - 1)
            moved = (self.edges[spot] == code) & (at < stop)
            node = np.where(moved, self.ahead[spot], node)
            at = at + moved
            ended = np.where(moved, self.ends[node], -1)
            hit = ended >= 0
            token, resume = np.where(hit, ended, token), np.where(hit, at, resume)
            # Where the walk is stuck the longest match so far is a token, and the next begins behind it.
            stuck = ~moved
            if stuck.any():
                out.append((lane[stuck], token[stuck]))
                node[stuck], at[stuck] = 0, resume[stuck]
                going = ~stuck | (resume < stop)
                lane, at, stop, node, token, resume = (x[going] for x in (lane, at, stop, node, token, resume))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, tokens = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.argsort(owner, kind="stable")
        return owner[order], tokens[order]

    def _judge(self, tokens: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Which pairs (left << 20 | right) are of sound tokens that stay apart."""
        for t in np.unique(tokens[self.sound[tokens] == 0]).tolist():
            self.sound[t] = 1 if self.merged(self.bytes[t]) == [t] else -1
        codes, verdicts = self.apart
        wanted = np.unique(pairs)
        spot = np.searchsorted(codes, wanted)
        fresh = wanted[(spot == len(codes)) | (codes[np.minimum(spot, len(codes) - 1)] != wanted)] if len(codes) else wanted
        if len(fresh):
            found = np.array([self.merged(self.bytes[p >> 20] + self.bytes[p & 0xFFFFF]) == [p >> 20, p & 0xFFFFF] for p in fresh.tolist()])
            codes, verdicts = np.concatenate([codes, fresh]), np.concatenate([verdicts, found])
            order = np.argsort(codes)
            self.apart = codes, verdicts = codes[order], verdicts[order]
        return verdicts[np.searchsorted(codes, pairs)] if len(pairs) else np.zeros(0, dtype=bool)

    def learn(self, words: list[str]) -> None:
        """Encode new words and remember them."""
        data = [w.encode() for w in words]
        owner, tokens = self.propose(data)
        same = owner[1:] == owner[:-1]
        pairs = ((tokens[:-1] << 20) | tokens[1:])[same]
        apart = self._judge(tokens, pairs)
        wrong = np.zeros(len(words), dtype=bool)
        wrong[owner[:-1][same][~apart]] = True
        wrong[owner[self.sound[tokens] < 0]] = True
        flat = tokens.astype("<u4").tobytes()
        cuts = (4 * np.searchsorted(owner, np.arange(len(words) + 1))).tolist()
        for i, (word, bad) in enumerate(zip(words, wrong.tolist(), strict=True)):
            self.known[word] = np.array(self.merged(data[i]), dtype="<u4").tobytes() if bad else flat[cuts[i] : cuts[i + 1]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        parted = [self._split(t) for t in texts]
        new = set().union(*parted).difference(self.known) if parted else set()
        if len(self.known) + len(new) > MOST_WORDS:
            self.known.clear()
            new = set().union(*parted)
        if new:
            marks = new & self.special.keys()
            self.known.update((m, np.array([self.special[m]], dtype="<u4").tobytes()) for m in marks)
            self.learn(list(new - marks))
        look = self.known.__getitem__
        return [np.frombuffer(b"".join(map(look, words)), dtype="<u4") for words in parted]

    def _split(self, text: str) -> list[str]:
        if self.parts is None or not any(mark in text for mark in self.special):
            return self._words(text)
        out: list[str] = []
        for part in self.parts.split(text):
            out += [part] if part in self.special else self._words(part)
        return out

    def _words(self, text: str) -> list[str]:
        if text.isascii() or not UNSURE.search(text):
            return WORDS.findall(text)
        return [text[a:b] for _, (a, b) in self.parter.pre_tokenize_str(text)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        return gathered(*self.spelled, ids).decode("utf-8", "replace")

    def listed(self, ids: np.ndarray) -> bytes:
        """Decimal ids, joined by commas."""
        return gathered(*self.decimal, ids)[:-1]


_NONE = (1 << 40, -1)


def gathered(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> bytes:
    """The pieces ``data[offsets[i]:offsets[i + 1]]`` of all ids, end to end."""
    sizes = offsets[ids + 1] - offsets[ids]
    ends = np.cumsum(sizes)
    if not len(ends):
        return b""
    return data[np.repeat(offsets[ids] - (ends - sizes), sizes) + np.arange(ends[-1])].tobytes()


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def with_tokens(docs: DataFrame, tokenizer: str, text: str = "text", into: str = "tokens") -> DataFrame:
    """The rows with their ids as an array of int; a column of that name is replaced."""
    prepare(docs.sparkSession)
    docs = docs.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(tokenizer)
        for batch in batches:
            column = text_column(batch, text)
            for lo, hi in blocks(column):
                ids = own.encode([t.decode("utf-8", "replace") for t in column.slice(lo, hi - lo).to_pylist()])
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))], names=[*part.schema.names, into])

    return docs.mapInArrow(run, docs.withColumn(into, F.array().cast("array<int>")).schema)


def with_text(docs: DataFrame, tokenizer: str, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """The rows with the text that their ids spell; null ids spell the empty text."""
    prepare(docs.sparkSession)
    docs = docs.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(tokenizer)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(tokens))
            spelled = [own.decode(np.asarray(x.values, dtype=np.int64)) if x.is_valid else "" for x in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spelled, pa.string())], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, docs.withColumn(into, F.lit("")).schema)


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens and digests of each text's ids and of what they decode to, in one pass."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(tokenizer)
        for batch in batches:
            column = text_column(batch, "text")
            for lo, hi in blocks(column):
                ids = own.encode([t.decode("utf-8", "replace") for t in column.slice(lo, hi - lo).to_pylist()])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([sha256(own.listed(i)).hexdigest() for i in ids], pa.string()),
                    pa.array([sha256(own.decode(i).encode()).hexdigest() for i in ids], pa.string()),
                ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
