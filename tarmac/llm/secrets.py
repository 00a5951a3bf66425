"""Secret scans: all rules in one deterministic automaton, run over many texts at once.

The texts of a block are laid end to end and cut into lanes of equal length. All lanes step
through the transition array together, one byte at a time; each lane warms up on the bytes
before it, and a lane whose state at its start then differs from the state its predecessor
ended in is run again from there, until all agree. Lanes that reach an accepting state name
the regions that may hold secrets. There, one automaton for all rules reads backward and marks
the bytes at which a match of a rule begins, and from those that no earlier match covers one automaton for each
rule reads the match to its end, the leftmost and longest first. So a byte is read once by all rules
together, and again only inside matches, on lines of any length.
The shared automaton accepts a rule after at most ``SEEN`` bytes of its measured part: full
counters of all rules at once would multiply its states, and the exact step counts them all.

A private key's span goes on to the end of its block: to its END line, or without one over the lines of
base64 that follow.

Null or empty texts have no spans. Spans count code points; the end is exclusive. Repeated
rows are scanned each for itself; columns other than the text are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tarmac.llm.automaton import Automaton, compile_rules
from tarmac.llm.text import blocks, prepare, text_column

LANE, WARM_UP = 256, 32
SEEN = 12


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; one counts if its measured part has ``least`` bytes.

    ``head`` is what precedes the measured part, ``unit`` one byte of that part.
    """

    kind: str
    unit: str
    least: int
    head: str = ""
    fold: bool = False

    @property
    def pattern(self) -> str:
        return f"{self.head}{self.unit}+"

    @property
    def counted(self) -> str:
        return f"{self.head}{self.unit}{{{self.least},}}"

    @property
    def sought(self) -> str:
        """What the shared automaton looks for: every match long enough has one."""
        least = min(self.least, SEEN if not self.head else 2)
        return f"{self.head}{self.unit}{{{least}}}"


# The base rules, in the order in which kinds are listed.
BASE = (
    Rule("assign", "[A-Za-z0-9+/_.=-]", 8, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", True),
    Rule("access", "[A-Z0-9]", 12, "AKIA"),
    Rule("hex", "[0-9a-f]", 32),
)
#: Further kinds: signed web tokens, private key headers, prefixed service tokens.
ADDED = (
    Rule("jwt", "[A-Za-z0-9_-]", 10, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\."),
    Rule("private_key", "-", 5, "-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY"),
    Rule("service", "[A-Za-z0-9_-]", 20, "(gh[pousr]_|github_pat_|glpat-|xox[abeoprs]-|sk_live_)"),
)
RULES = BASE + ADDED

#: What follows the header of a private key: all up to the end of its block, or lines of base64. Neither goes past the next header.
BLOCK = re.compile(rb"[^-]*(?:-(?!----)[^-]*)*-----END [A-Z0-9 ]*PRIVATE KEY-----")
BODY = re.compile(rb"(?:[\x20\t]*(?:\r?\n|\\n)[A-Za-z0-9+/=]++(?=[\x20\t]*(?:\r?\n|\\n|['\"]|$)))+")

SPAN = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))


class Scanner:
    """The compiled rules. Built once per Python process."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.search: Automaton = compile_rules([(r.sought, r.fold) for r in rules], search=True)
        self.resets = self.search.resets()
        self.flat = self.search.table.astype(np.int32).ravel()
        self.single = [compile_rules([(r.pattern, r.fold)], search=False) for r in rules]
        self.counted = [compile_rules([(r.counted, r.fold)], search=False) for r in rules]
        self.rows = [[a.table.tolist() for a in group] for group in (self.single, self.counted)]
        self.starts = compile_rules([(r.pattern, r.fold) for r in rules], search=True, backward=True)
        self.start_rows, self.start_bits = self.starts.table.tolist(), self.starts.accepts.tolist()
        if not self.resets[0x0A]:
            raise ValueError("a rule spans line ends, which part the texts here")

    def hit_lanes(self, data: np.ndarray) -> np.ndarray:
        """Numbers of the lanes in which a possible match is seen."""
        n = -(-len(data) // LANE)
        padded = np.full(WARM_UP + n * LANE, 0x0A, dtype=np.uint8)
        padded[WARM_UP : WARM_UP + len(data)] = data
        lanes = padded[WARM_UP:].reshape(n, LANE)
        warm = np.lib.stride_tricks.as_strided(padded, (n, WARM_UP), (LANE, 1))
        state, _ = self.walk(np.zeros(n, np.int32), warm)
        begun = state.copy()
        ended, most = self.walk(state, lanes)
        while True:
            owed = np.concatenate([[0], ended[:-1]]).astype(np.int32)
            again = np.flatnonzero(owed != begun)
            if not len(again):
                return np.flatnonzero(most >= self.search.first_accept)
            begun[again] = owed[again]
            ended[again], most[again] = self.walk(owed[again], lanes[again])

    def walk(self, state: np.ndarray, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state of each lane after its bytes, and the highest state on the way."""
        state, most = state.astype(np.int32), np.zeros(len(state), np.int32)
        for column in np.ascontiguousarray(lanes.T):
            state = self.flat[(state << 8) + column]
            np.maximum(most, state, out=most)
        return state, most

    def regions(self, data: np.ndarray) -> list[tuple[int, int]]:
        """Byte ranges between resetting bytes that hold every possible match."""
        hits = self.hit_lanes(data)
        if not len(hits):
            return []
        cuts = np.flatnonzero(self.resets[data])
        low = np.searchsorted(cuts, hits * LANE)
        high = np.searchsorted(cuts, np.minimum(hits * LANE + LANE, len(data)))
        out: list[tuple[int, int]] = []
        for a, b in zip(low, high, strict=True):
            region = (int(cuts[a - 1]) + 1 if a else 0, int(cuts[b]) if b < len(cuts) else len(data))
            if out and region[0] <= out[-1][1]:
                out[-1] = (out[-1][0], max(region[1], out[-1][1]))
            else:
                out.append(region)
        return out

    def begins(self, data: bytes, low: int, high: int) -> list[list[int]]:
        """For each rule the places in a range where a match begins, in order."""
        rows, bits, least, state = self.start_rows, self.start_bits, self.starts.first_accept, 0
        found: list[list[int]] = [[] for _ in self.rules]
        for at in range(high - 1, low - 1, -1):
            state = rows[state][data[at]]
            if state >= least:
                own = bits[state]
                for k, places in enumerate(found):
                    if own >> k & 1:
                        places.append(at)
        for places in found:
            places.reverse()
        return found

    def spans(self, data: bytes, low: int, high: int) -> list[tuple[int, int, int]]:
        """(start, rule, end) of all matches long enough in a range, in bytes."""
        found = []
        for k, places in enumerate(self.begins(data, low, high)):
            done = low
            for at in places:
                if at < done:
                    continue
                done = self.single[k].longest(data, at, high, self.rows[0][k])
                if self.counted[k].longest(data, at, done, self.rows[1][k]) == done:
                    found.append((at, k, done))
        return found

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its spans (start, rule, end) in code points, by start and rule."""
        joined = b"\n".join(texts)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        data = np.frombuffer(joined, dtype=np.uint8)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        for low, high in self.regions(data):
            for a, k, b in self.spans(joined, low, high):
                owner = int(np.searchsorted(starts, a, side="right")) - 1
                a, b = a - int(starts[owner]), b - int(starts[owner])
                if self.rules[k].kind == "private_key":
                    rest = BLOCK.match(texts[owner], b) or BODY.match(texts[owner], b)
                    b = rest.end() if rest else b
                out[owner].append((a, k, b))
        for text, own in zip(texts, out, strict=True):
            if own:
                own.sort()
                # Code points before each byte; a private key's block may hold any.
                lead = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                own[:] = [(int(lead[a]), k, int(lead[b])) for a, k, b in own]
        return out


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def find_secrets(docs: DataFrame, text: str = "text", into: str = "secrets", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with an array of (kind, start, end) spans; an existing column of that name is replaced."""
    prepare(docs.sparkSession)
    docs = docs.drop(into)
    schema = StructType([*docs.schema.fields, StructField(into, SPAN)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner(rules)
        for batch in batches:
            column = text_column(batch, text)
            for lo, hi in blocks(column):
                found = own.scan(column.slice(lo, hi - lo).to_pylist())
                spans = pa.array([[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in f] for f in found], arrow)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, spans], names=[*part.schema.names, into])

    return docs.mapInArrow(run, schema)


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the number of spans of each base kind, a digest of the base spans, and all spans as text."""
    kinds = [r.kind for r in BASE]
    found = find_secrets(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "secrets")
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    of = lambda kind: F.filter("secrets", lambda s: s["kind"] == F.lit(kind))
    counts = [F.size(of(k)).cast(LongType()).alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows with every span of their texts replaced by ``mark``; null texts stay null.

    Overlapping spans (a kind inside another) become one mark. Text without spans is not changed.
    """
    prepare(docs.sparkSession)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner()
        for batch in batches:
            column = text_column(batch, text)
            at = batch.schema.get_field_index(text)
            for lo, hi in blocks(column):
                part = batch.slice(lo, hi - lo)
                values = part.column(at).to_pylist()
                for i, spans in enumerate(own.scan(column.slice(lo, hi - lo).to_pylist())):
                    if spans:
                        values[i] = _marked(values[i], spans, mark)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, part.schema.types[k]) if k == at else part.column(k) for k in range(len(columns))],
                    schema=part.schema,
                )

    return docs.mapInArrow(run, docs.schema)


def _marked(value: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, done = [], 0
    for a, _, b in spans:
        if a >= done:
            out += [value[done:a], mark]
        done = max(done, b)
    return "".join([*out, value[done:]])
