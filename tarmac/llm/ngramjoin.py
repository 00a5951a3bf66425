"""N-gram Jaccard join by MinHash banding.

Texts are sets of hashed five-word shingles (lower-cased, parted by white space; a text of fewer
words is one shingle). Rows of one set are collapsed into a *node* with a number of copies
before anything is compared. Each node's MinHash signature is cut into bands whose number and
rows follow from the threshold and the wanted recall; nodes that share a band hash are
candidates. Candidates are not paired bucket by bucket: buckets give hub edges, their connected
components hold every candidate pair once, and a component is verified on the full sets in
blocks. A large component becomes many pairs of blocks of bounded size, spread over the tasks;
a task counts the links of its members with matrix products and gives out one row for each
member (its links and a spanning edge), never the pairs.

The result has one row for each row of the input: the class of its near duplicates (connected by
links; named by the smallest id), and the number of other rows linked to it. Null and empty
texts, and texts of white space only, have no shingles: no links, each a class of its own. Rows
without an id take part; a class is named by an id if any member has one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.components import connected_components
from tarmac.llm.text import ODD, blocks, mix, shuffle_width, prepare, text_column, words
from tarmac.session import settle

#: Members of a block, and shingles of a block, at which a component is split.
BLOCK_MEMBERS, BLOCK_GRAMS = 1024, 1 << 18
#: Shared shingles laid out at once as the columns of a matrix.
COLUMNS = 2048


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.8
    recall: float = 0.999999
    most_functions: int = 128
    n: int = 5

    def bands(self) -> tuple[int, int]:
        """(bands, rows): the most rows with which the wanted recall at the threshold fits the signature."""
        for rows in range(16, 0, -1):
            bands = math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold**rows))
            if bands * rows <= self.most_functions:
                return bands, rows
        return self.most_functions, 1


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each row, as 64-bit hashes."""
    hashes, at = words(column)
    grams = hashes[: max(0, len(hashes) - n + 1)].copy()
    for j in range(1, n):
        grams *= ODD
        grams += hashes[j : j + len(grams)]
    grams = mix(grams)
    out = []
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        if hi - lo >= n:
            own = np.sort(grams[lo : hi - n + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif hi > lo:
            # Fewer than n words: the number of words goes in, so that this is no shingle of a longer text.
            weights = ODD ** np.arange(1, hi - lo + 1, dtype=np.uint64)
            out.append(mix((hashes[lo:hi] * weights).sum(keepdims=True) + (hi - lo).astype(np.uint64)))
        else:
            out.append(hashes[:0])
    return out


def band_hashes(grams: np.ndarray, bands: int, rows: int, factors: np.ndarray) -> np.ndarray:
    low, least = (grams >> np.uint64(32)).astype(np.uint32), None
    for lo in range(0, len(low), 4096):
        part = (low[lo : lo + 4096] * factors[:, None]).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    least = least.astype(np.uint64).reshape(bands, rows)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        out = mix(out * ODD + least[:, j])
    return out.view(np.int64)


def _sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, tie, node, n_grams and the band hashes; node is null without shingles."""
    bands, rows = settings.bands()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = np.random.default_rng(11).integers(0, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1)
        for batch in batches:
            column = text_column(batch, "text")
            for lo, hi in blocks(column):
                sets = shingle_sets(column.slice(lo, hi - lo), settings.n)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                    pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([band_hashes(s, bands, rows, factors) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ], names=["doc_id", "tie", "node", "n_grams", "bands"])

    return docs.select("doc_id", "tie", "text").mapInArrow(run, "doc_id bigint, tie bigint, node binary, n_grams bigint, bands array<bigint>")


def _linked(members: list[tuple], threshold: float, apart: bool) -> list[tuple[bytes, bytes, int]]:
    """(node, smallest node reached, links) of the members that have links.

    A member is (node, block, copies, shingles). With ``apart`` only pairs across blocks count.
    """
    sizes = np.array([len(m[3]) for m in members])
    grams = np.concatenate([m[3] for m in members])
    owner = np.repeat(np.arange(len(members)), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    count = np.diff(np.append(start, len(grams)))
    column = np.repeat(np.cumsum(count > 1) - 1, count)
    shared = np.repeat(count > 1, count)
    owner, column = owner[shared], column[shared]
    common = np.zeros((len(members), len(members)), dtype=np.float32)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + COLUMNS, COLUMNS))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        present, local = np.unique(owner[lo:hi], return_inverse=True)
        table = np.zeros((len(present), COLUMNS), dtype=np.float32)
        table[local, column[lo:hi] % COLUMNS] = 1
        common[np.ix_(present, present)] += table @ table.T
    union = sizes[:, None] + sizes[None, :] - common.astype(np.float64)
    near = common / union >= threshold
    np.fill_diagonal(near, False)
    block = np.array([m[1] for m in members])
    if apart:
        near &= block[:, None] != block[None, :]
    links = near @ np.array([m[2] for m in members], dtype=np.int64)
    nodes = np.array([m[0] for m in members], dtype=object)
    rank = np.empty(len(members), dtype=np.int64)
    rank[np.argsort(nodes)] = np.arange(len(members))
    label = rank.copy()
    while True:
        lower = np.minimum(label, np.where(near, label[None, :], len(members)).min(axis=1))
        if (lower == label).all():
            break
        label = lower
    by_rank = nodes[np.argsort(rank)]
    return [(nodes[i], by_rank[label[i]], int(links[i])) for i in np.flatnonzero(links)]


def _verified(docs: DataFrame, members: DataFrame, settings: Settings) -> DataFrame:
    """Links of the candidates, checked on full shingle sets: node, hub, n_links."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = text_column(batch, "text")
            for lo, hi in blocks(column):
                grams = [s.tobytes() for s in shingle_sets(column.slice(lo, hi - lo), settings.n)]
                part = batch.slice(lo, hi - lo).drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(grams, pa.binary())], names=[*part.schema.names, "grams"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}

        def out() -> pa.RecordBatch:
            found = _linked(list(held.values()), settings.threshold, key[1] != key[2]) if len(held) > 1 else []
            return pa.RecordBatch.from_pylist([dict(zip(("node", "hub", "n_links"), x, strict=True)) for x in found], schema=result)

        result = pa.schema([("node", pa.binary()), ("hub", pa.binary()), ("n_links", pa.int64())])
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("component", "low", "high", "node", "block", "copies", "grams")]
            for component, low, high, node, block, copies, grams in zip(*columns, strict=True):
                if key != (component, low, high):
                    if key is not None:
                        yield out()
                    key, held = (component, low, high), {}
                held[node] = (node, block, copies, np.frombuffer(grams, dtype=np.uint64))
        if key is not None:
            yield out()

    wanted = members.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), "node", "component", "copies", "block", "n_blocks")
    found = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tie") == F.col("__tie")))
    with_sets = found.select("node", "component", "copies", "block", "n_blocks", "text").mapInArrow(
        sets, "node binary, component binary, copies bigint, block bigint, n_blocks bigint, grams binary")
    dealt = with_sets.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))).select(
        "component", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "node", "block", "copies", "grams")
    width = 2 * shuffle_width(docs.sparkSession)
    return dealt.repartition(width, "component", "low", "high").sortWithinPartitions("component", "low", "high").mapInArrow(
        verify, "node binary, hub binary, n_links bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row for each row: doc_id, tie, class_id, n_links, n_copies, chosen.

    ``tie`` is a hash of the text, which tells rows of one id apart. ``n_copies`` counts the rows
    with the same shingles, itself included; they are links of each other. ``chosen`` marks one
    (doc_id, tie) of each class, the smallest id.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    sketches = settle(_sketches(rows, settings), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "tie"))
    nodes = settle(
        sketches.where("node IS NOT NULL").groupBy("node").agg(first.alias("first"), F.count("*").alias("copies"), F.max("n_grams").alias("n_grams")), "nodes")
    banded = sketches.where("node IS NOT NULL").select("node", F.explode("bands").alias("band")).distinct()
    banded = settle(banded, "bands")
    hubs = banded.groupBy("band").agg(F.min("node").alias("other"), F.count("*").alias("n")).where("n > 1")
    # A node has at most one hub for each band. It keeps an edge to the smallest; that one stands in for it at the others,
    # so a group with many bands in common has few edges besides one for each node.
    own = banded.join(hubs, "band").groupBy("node").agg(F.collect_set("other").alias("hubs")).withColumn("least", F.array_min("hubs"))
    edges = own.select("node", F.col("least").alias("other")).unionByName(
        own.select(F.col("least").alias("node"), F.explode("hubs").alias("other"))).where("node <> other").distinct()
    candidates = connected_components(edges)
    sized = candidates.join(nodes, "node").groupBy("component").agg(F.count("*").alias("n"), F.sum("n_grams").alias("grams"))
    parted = sized.select("component", F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("long").alias("n_blocks"))
    members = candidates.join(parted, "component").join(nodes, "node").select(
        "node", "component", "copies", "n_blocks", F.pmod(F.xxhash64("node"), F.col("n_blocks")).alias("block"), "first.doc_id", "first.tie")
    links = settle(_verified(rows, members, settings), "links")
    classes = connected_components(links.select("node", F.col("hub").alias("other")).where("node <> hub"))
    counted = links.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    grouped = nodes.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = grouped.groupBy("component").agg(F.min("first").alias("named"))
    facts = grouped.join(named, "component").join(counted, "node", "left").select(
        F.col("node").alias("__node"), "named", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n_copies"))
    own = sketches.select("doc_id", "tie", "node").join(facts, F.col("node") == F.col("__node"), "left")
    return own.select(
        "doc_id", "tie", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("named.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        (F.col("node").isNull() | (F.col("doc_id").eqNullSafe(F.col("named.doc_id")) & (F.col("tie") == F.col("named.tie")))).alias("chosen"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row of each class of near duplicates, unchanged; rows equal in id and text count as one."""
    chosen = near_duplicates(docs, doc_id, text, settings).where("chosen").select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie")).distinct()
    own = docs.withColumn("__own", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    kept = own.join(chosen, F.col(doc_id).cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__tie")), "left_semi")
    return kept.dropDuplicates([doc_id, "__own"]).select(*docs.columns)
