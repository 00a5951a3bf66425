"""Weighted acyclic automata over words: phrases with whole-number weights, as numpy arrays.

An automaton is kept as layers. A node of layer d is a path of d + 1 labels: it has the node above
it, a label, and a weight, 0 where its path is not accepted. Nodes are sorted by (node above,
label). Building from paths and summing several automata are one operation: name the nodes of a
layer by their place in the layer above, sort, and add up the weights of equal ones.

For transport and storage an automaton is minimised: nodes with the same arcs below (labels,
weights and targets) share one state, from the last layer upwards. ``load`` unfolds it again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

from tarmac.llm.text import ODD, mix


def _ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the rank of each value among them; few distinct ones need no sort."""
    few = np.unique(values[:: 1 + len(values) // 256])
    if len(few) < 64:
        rank = np.minimum(np.searchsorted(few, values), len(few) - 1)
        if np.array_equal(few[rank], values):
            return few, rank
    return np.unique(values, return_inverse=True)


def _ranked_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for whole numbers from 0 on; those of a small range are marked in a table."""
    top = int(keys.max()) + 1
    if top > 4 * len(keys):
        return np.unique(keys, return_inverse=True)
    there = np.zeros(top, dtype=bool)
    there[keys] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[keys]


def _folded(up: np.ndarray, label: np.ndarray, weight: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (up, label) in order with their summed weights (without weights: 1 each), and the place of each row among them."""
    if not len(label):
        return up, label, np.zeros(0, np.int64), np.zeros(0, np.int64)
    labels, rank = _ranked(label)
    keys, back = _ranked_keys(up * len(labels) + rank)
    if weight is None:
        sums = np.bincount(back, minlength=len(keys))
    else:
        sums = np.zeros(len(keys), dtype=np.int64)
        np.add.at(sums, back, weight)
    return keys // len(labels), labels[keys % len(labels)], sums, back


@dataclass
class Transducer:
    up: list[np.ndarray] = field(default_factory=list)
    label: list[np.ndarray] = field(default_factory=list)
    weight: list[np.ndarray] = field(default_factory=list)
    indexes: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict, repr=False)

    def __len__(self) -> int:
        return sum(map(len, self.label))

    def paths(self, layer: int) -> list[np.ndarray]:
        """The labels of every node of a layer, one array for each step of the path."""
        at, out = np.arange(len(self.label[layer])), []
        for d in range(layer, -1, -1):
            out.append(self.label[d][at])
            at = self.up[d][at]
        return out[::-1]

    def pruned(self, least: int) -> Transducer:
        """Without the weights below ``least``, and without nodes that then lead to no weight."""
        out, below = Transducer(), None
        kept = []
        for d in range(len(self.label) - 1, -1, -1):
            keep = self.weight[d] >= least
            if below is not None:
                keep[below] = True
            kept.append(keep)
            below = self.up[d][keep]
        places = None
        for d, keep in enumerate(kept[::-1]):
            up = self.up[d][keep]
            out.up.append(up if places is None else places[up])
            out.label.append(self.label[d][keep])
            out.weight.append(np.where(self.weight[d] >= least, self.weight[d], 0)[keep])
            places = np.cumsum(keep) - 1
        return out

    def _index(self, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """The layer's distinct labels, and its nodes' sorted keys by node above and rank of label."""
        if layer not in self.indexes:
            labels, rank = np.unique(self.label[layer], return_inverse=True)
            self.indexes[layer] = labels, self.up[layer] * len(labels) + rank
        return self.indexes[layer]

    def weights_of(self, steps: Sequence[np.ndarray], length: np.ndarray) -> np.ndarray:
        """The weight of each path given as columns of labels, of which the first ``length`` count; 0 if it is not there."""
        at, found = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        alive = np.arange(len(length))
        for d, column in enumerate(steps):
            alive = alive[length[alive] > d]
            if not len(alive) or d >= len(self.label) or not len(self.label[d]):
                break
            labels, keys = self._index(d)
            own = column[alive]
            near = np.minimum(np.searchsorted(labels, own), len(labels) - 1)
            wanted = at[alive] * len(labels) + near
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            good = (labels[near] == own) & (keys[place] == wanted)
            alive = alive[good]
            at[alive] = place[good]
            ends = alive[length[alive] == d + 1]
            found[ends] = self.weight[d][at[ends]]
        return found

    def sliced(self) -> list[tuple[int, Transducer]]:
        """(label, automaton) for every label of the first layer."""
        out, bounds = [], np.arange(len(self.label[0]) + 1)
        cuts = [bounds]
        for d in range(1, len(self.label)):
            cuts.append(np.searchsorted(self.up[d], cuts[-1]))
        for i, label in enumerate(self.label[0]):
            t = Transducer()
            for d, cut in enumerate(cuts):
                lo, hi = cut[i], cut[i + 1]
                t.up.append(self.up[d][lo:hi] - (cuts[d - 1][i] if d else 0))
                t.label.append(self.label[d][lo:hi])
                t.weight.append(self.weight[d][lo:hi])
            out.append((int(label), t))
        return out


def from_paths(steps: Sequence[np.ndarray], length: np.ndarray, counted: int) -> Transducer:
    """Every path adds 1 to each of its nodes from the layer ``counted`` on."""
    out, node = Transducer(), np.zeros(len(length), np.int64)
    alive = np.arange(len(length))
    for d, column in enumerate(steps):
        alive = alive[length[alive] > d]
        up, label, many, back = _folded(node[alive], column[alive], None)
        out.up.append(up)
        out.label.append(label)
        out.weight.append(many if d >= counted else np.zeros(len(many), np.int64))
        node[alive] = back
    return out


def summed(parts: Sequence[Transducer]) -> Transducer:
    """The union of the paths; weights of equal paths add up."""
    if len(parts) == 1:
        return parts[0]
    out, places = Transducer(), [np.zeros(1, np.int64)] * len(parts)
    for d in range(max((len(p.label) for p in parts), default=0)):
        have = [p if d < len(p.label) else None for p in parts]
        ups = [np.zeros(0, np.int64) if p is None else places[i][p.up[d]] for i, p in enumerate(have)]
        labels = [np.zeros(0, np.uint64) if p is None else p.label[d] for p in have]
        weights = [np.zeros(0, np.int64) if p is None else p.weight[d] for p in have]
        up, label, weight, back = _folded(np.concatenate(ups), np.concatenate(labels), np.concatenate(weights))
        out.up.append(up)
        out.label.append(label)
        out.weight.append(weight)
        places = np.split(back, np.cumsum([len(x) for x in labels])[:-1])
    return out


def _small(values: np.ndarray) -> np.ndarray:
    top = int(values.max(initial=0))
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


def _states(t: Transducer, layer: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States of the nodes above a layer: which state each node is in, the first arc of every state, its arcs' number.

    ``state`` holds the states of the layer's own nodes. Nodes are taken together by a hash of
    their arcs, and arc by arc compared with the state's first node; those that differ stay apart.
    """
    above = len(t.label[layer - 1]) if layer else 1
    up, label, weight = t.up[layer], t.label[layer], t.weight[layer]
    many = np.bincount(up, minlength=above)
    start = np.concatenate([[0], np.cumsum(many)])[:-1]
    arc = mix(label * ODD + mix(weight.astype(np.uint64) * ODD + state.astype(np.uint64)))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(arc, dtype=np.uint64)])
    mark = mix((total[start + many] - total[start]) + many.astype(np.uint64))
    _, first, back = np.unique(mark, return_index=True, return_inverse=True)
    model = first[back]  # the node that stands for this one
    same = many == many[model]
    rows = np.flatnonzero(same[up])
    twin = np.minimum(start[model[up[rows]]] + (rows - start[up[rows]]), max(0, len(up) - 1))
    equal = (label[rows] == label[twin]) & (weight[rows] == weight[twin]) & (state[rows] == state[twin])
    same[up[rows[~equal]]] = False
    model = np.where(same, model, np.arange(above))
    kept, back = np.unique(model, return_inverse=True)
    return back, start[kept], many[kept]


def dump(t: Transducer) -> bytes:
    """The minimal automaton as bytes."""
    state, arrays = np.zeros(len(t.label[-1]) if t.label else 0, np.int64), []
    for d in range(len(t.label) - 1, -1, -1):
        own, start, many = _states(t, d, state)
        arcs = np.repeat(start - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
        arrays += [many, t.label[d][arcs], t.weight[d][arcs], state[arcs]]
        state = own
    small = [_small(a) for a in arrays]
    head = np.array([len(t.label), *[x for a in small for x in (a.itemsize, len(a))]], dtype="<i8")
    return head.tobytes() + b"".join(a.astype(a.dtype.newbyteorder("<")).tobytes() for a in small)


def load(data: bytes) -> Transducer:
    depth = int(np.frombuffer(data, "<i8", 1)[0])
    head = np.frombuffer(data, "<i8", 8 * depth, 8).reshape(-1, 2)
    at, arrays = 8 + 64 * depth, []
    for size, n in head.tolist():
        arrays.append(np.frombuffer(data, f"<u{size}", n, at))
        at += size * n
    out, state = Transducer(), np.zeros(1, np.int64)
    for d in range(depth):
        many, label, weight, target = arrays[4 * (depth - 1 - d) : 4 * (depth - d)]
        many = many.astype(np.int64)
        start = np.concatenate([[0], np.cumsum(many)])[:-1]
        own = many[state]
        up = np.repeat(np.arange(len(state)), own)
        arcs = np.repeat(start[state], own) + np.arange(len(up)) - np.repeat(np.cumsum(own) - own, own)
        out.up.append(up)
        out.label.append(label[arcs].astype(np.uint64))
        out.weight.append(weight[arcs].astype(np.int64))
        state = target[arcs].astype(np.int64)
    return out


class Builder:
    """Sums automata as they come: two of like size are summed, so each path is sorted again few times."""

    def __init__(self) -> None:
        self.held: list[Transducer] = []

    def add(self, t: Transducer) -> None:
        self.held.append(t)
        while len(self.held) > 1 and len(self.held[-2]) < 2 * len(self.held[-1]):
            last = self.held.pop()
            self.held[-1] = summed([self.held[-1], last])

    def __len__(self) -> int:
        return sum(map(len, self.held))

    def take(self) -> Transducer:
        held, self.held = self.held, []
        return summed(held) if held else Transducer()
