"""Weighted acyclic automata over n-grams: build from sorted n-grams, share equal states, cut by prefix, add, look up.

An automaton reads a sequence of symbols (unsigned 64-bit numbers, never 0) and gives the count of that sequence, which is
the weight of its last transition. ``Grams`` is the unshared form that sums are made in: one sorted level of nodes for
each length. ``pack`` goes through the levels from the longest n-grams back and gives states with equal transitions (symbol, weight and target)
the same number, which is the smallest automaton of these weights; ``unpack`` follows all its paths again.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tideshift.llm.common import mix64

LONGEST = 4


@dataclass(frozen=True)
class Level:
    """The n-grams of one length in order: the node of all but the last symbol, the last symbol, the count."""

    parent: np.ndarray
    symbol: np.ndarray  # index into the sorted symbols
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.symbol)


@dataclass(frozen=True)
class Grams:
    symbols: np.ndarray  # sorted, unsigned
    levels: list[Level]

    def __len__(self) -> int:
        return sum(len(x) for x in self.levels)

    def sequences(self, length: int, nodes: np.ndarray) -> np.ndarray:
        """The symbols of some nodes of a level, one row each, filled up with zeros."""
        out = np.zeros((len(nodes), LONGEST), np.uint64)
        for at in range(length - 1, -1, -1):
            level = self.levels[at]
            out[:, at] = self.symbols[level.symbol[nodes]]
            nodes = level.parent[nodes]
        return out

    def hashes(self) -> list[np.ndarray]:
        """A number for each node, from its symbols alone."""
        out: list[np.ndarray] = []
        for level in self.levels:
            own = mix64(self.symbols[level.symbol])
            out.append(own if not out else mix64(out[-1][level.parent] + own))
        return out


EMPTY = Grams(np.zeros(0, np.uint64), [Level(*(np.zeros(0, np.int64) for _ in range(3))) for _ in range(LONGEST)])


def from_runs(symbols: np.ndarray, word: np.ndarray, run: np.ndarray) -> Grams:
    """Count the n-grams of all lengths in runs of words; ``word`` holds indices into the sorted ``symbols``."""
    size = max(len(symbols), 1)
    count = np.bincount(word, minlength=len(symbols))
    levels = [Level(np.zeros(len(symbols), np.int64), np.arange(len(symbols)), count)]
    node, start = word.astype(np.int64), np.arange(len(word))
    for length in range(2, LONGEST + 1):
        inside = np.flatnonzero(start + length <= len(word))
        inside = inside[run[start[inside]] == run[start[inside] + length - 1]]
        start = start[inside]
        keys, node, count = np.unique(node[inside] * size + word[start + length - 1], return_inverse=True, return_counts=True)
        node = node.reshape(-1)
        levels.append(Level(keys // size, keys % size, count))
    return Grams(symbols, levels)


def union(parts: Sequence[Grams]) -> Grams:
    """Add the counts of several automata."""
    parts = [p for p in parts if len(p)]
    if len(parts) <= 1:
        return parts[0] if parts else EMPTY
    symbols = np.unique(np.concatenate([p.symbols for p in parts]))
    index = [np.searchsorted(symbols, p.symbols) for p in parts]
    nodes = [np.zeros(1, np.int64) for _ in parts]
    levels = []
    for at in range(LONGEST):
        keys = np.concatenate([n[p.levels[at].parent] * len(symbols) + i[p.levels[at].symbol] for p, i, n in zip(parts, index, nodes)])
        weight = np.concatenate([p.levels[at].weight for p in parts])
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        fresh = np.append(True, ordered[1:] != ordered[:-1])[: len(keys)]
        first = np.flatnonzero(fresh)
        place = np.empty(len(keys), np.int64)
        place[order] = np.cumsum(fresh) - 1
        ends = np.cumsum([len(p.levels[at]) for p in parts])[:-1]
        nodes = np.split(place, ends)
        kept = ordered[first]
        levels.append(Level(kept // len(symbols), kept % len(symbols), np.add.reduceat(weight[order], first) if len(first) else weight))
    return Grams(symbols, levels)


def pruned(grams: Grams, least: int) -> Grams:
    """Only n-grams with at least that count, and what leads to them."""
    keep = [level.weight >= least for level in grams.levels]
    for at in range(LONGEST - 1, 0, -1):
        keep[at - 1] = keep[at - 1].copy()
        keep[at - 1][grams.levels[at].parent[keep[at]]] = True
    return _compact(grams.symbols, [Level(x.parent[k], x.symbol[k], np.where(x.weight >= least, x.weight, 0)[k]) for x, k in zip(grams.levels, keep)], keep)


def _compact(symbols: np.ndarray, levels: list[Level], keep: list[np.ndarray]) -> Grams:
    """Number nodes and symbols anew after some have gone."""
    held = np.zeros(len(symbols), bool)
    for level in levels:
        held[level.symbol] = True
    number = np.cumsum(held) - 1
    out = []
    for at, level in enumerate(levels):
        parent = level.parent if at == 0 else (np.cumsum(keep[at - 1]) - 1)[level.parent]
        out.append(Level(parent, number[level.symbol], level.weight))
    return Grams(symbols[held], out)


def below(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the sequences of ``a`` come before those of ``b``, row by row."""
    out = np.zeros(len(a), bool)
    equal = np.ones(len(a), bool)
    for c in range(LONGEST):
        out |= equal & (a[:, c] < b[:, c])
        equal &= a[:, c] == b[:, c]
    return out


def first_from(grams: Grams, length: int, bounds: np.ndarray) -> np.ndarray:
    """For each bound, the first node of a level whose sequence does not come before it."""
    low, high = np.zeros(len(bounds), np.int64), np.full(len(bounds), len(grams.levels[length - 1]), np.int64)
    while (open_ := low < high).any():
        at = np.flatnonzero(open_)
        mid = (low[at] + high[at]) >> 1
        less = below(grams.sequences(length, mid), bounds[at])
        low[at[less]] = mid[less] + 1
        high[at[~less]] = mid[~less]
    return low


def cut(grams: Grams, bounds: np.ndarray) -> list[tuple[int, Grams]]:
    """The automata of the prefix ranges between sorted bounds, without empty ones.

    Nodes that only lead into a range from the left keep no weight there: their counts belong to the range before.
    """
    if not len(grams):
        return []
    edges = [np.concatenate([[0], first_from(grams, k, bounds), [len(grams.levels[k - 1])]]) for k in range(1, LONGEST + 1)]
    out = []
    for r in np.flatnonzero(sum(np.diff(e) for e in edges)).tolist():
        starts = [int(e[r]) for e in edges]
        for at in range(LONGEST - 1, 0, -1):
            if starts[at] < edges[at][r + 1]:
                starts[at - 1] = min(starts[at - 1], int(grams.levels[at].parent[starts[at]]))
        levels, before = [], 0
        for at, (level, a, e) in enumerate(zip(grams.levels, starts, edges)):
            z = max(int(e[r + 1]), a + (a < e[r]))  # a leading node may stand alone
            weight = level.weight[a:z].copy()
            weight[: max(int(e[r]) - a, 0)] = 0
            levels.append(Level(level.parent[a:z] - before if at else level.parent[a:z], level.symbol[a:z], weight))
            before = a
        out.append((r, _compact(grams.symbols, levels, [np.ones(len(x), bool) for x in levels])))
    return out


def range_of(sequences: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The prefix range of each sequence."""
    low, high = np.zeros(len(sequences), np.int64), np.full(len(sequences), len(bounds), np.int64)
    while (open_ := low < high).any():
        at = np.flatnonzero(open_)
        mid = (low[at] + high[at]) >> 1
        above = below(sequences[at], bounds[mid])
        high[at[above]] = mid[above]
        low[at[~above]] = mid[~above] + 1
    return low


def look_up(grams: Grams, sequences: np.ndarray) -> np.ndarray:
    """The counts of some sequences (0 where there is none): compose them with the automaton, symbol by symbol."""
    count = np.zeros(len(sequences), np.int64)
    lengths = (sequences != 0).sum(axis=1)
    alive, node = np.flatnonzero(lengths), np.zeros(len(sequences), np.int64)
    for at, level in enumerate(grams.levels):
        if not len(level) or not len(alive):
            break
        wanted = sequences[alive, at]
        place = np.minimum(np.searchsorted(grams.symbols, wanted), len(grams.symbols) - 1)
        keys = level.parent * len(grams.symbols) + level.symbol
        key = node[alive] * len(grams.symbols) + place
        found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        known = (grams.symbols[place] == wanted) & (keys[found] == key)
        alive, found = alive[known], found[known]
        node[alive] = found
        ended = lengths[alive] == at + 1
        count[alive[ended]] = level.weight[found[ended]]
        alive = alive[~ended]
    return count


@dataclass(frozen=True)
class Automaton:
    """States with their transitions one after another; state 0 has none, the last one reads the first symbol."""

    symbols: np.ndarray
    first: np.ndarray
    symbol: np.ndarray
    weight: np.ndarray
    target: np.ndarray


def shared(grams: Grams) -> Automaton:
    """Give nodes with equal transitions one state, from the longest n-grams back."""
    first, edges = [0, 0], [[np.zeros(0, np.int64)] for _ in range(3)]
    state = np.zeros(len(grams.levels[-1]), np.int64)  # nothing follows the longest
    for at in range(LONGEST - 1, -1, -1):
        level, above = grams.levels[at], len(grams.levels[at - 1]) if at else 1
        parts = (level.symbol, level.weight, state)
        size = np.bincount(level.parent, minlength=above) if len(level) else np.zeros(above, np.int64)
        start = np.cumsum(size) - size
        own = np.zeros(len(level), np.uint64)
        for x in parts:
            own = mix64(own + x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        mark = np.zeros(above, np.uint64)
        filled = np.flatnonzero(size)
        if len(filled):
            mark[filled] = np.add.reduceat(own, start[filled])
        # Equal marks stand for equal transitions once these have been compared.
        _, chosen, group = np.unique(mix64(mark + size.astype(np.uint64)), return_index=True, return_inverse=True)
        model = chosen[group.reshape(-1)]
        model = np.where(size[model] == size, model, np.arange(above))
        inside = np.arange(len(level)) - np.repeat(start, size)
        same = np.repeat(start[model], size) + inside
        wrong = np.zeros(len(level), bool)
        for x in parts:
            wrong |= x != x[same] if len(level) else wrong
        differs = np.zeros(above, bool)
        differs[level.parent[wrong]] = True
        model = np.where(differs, np.arange(above), model)
        made = np.flatnonzero((model == np.arange(above)) & (size > 0))
        number = np.zeros(above, np.int64)
        number[made] = len(first) - 1 + np.arange(len(made))
        taken = np.repeat(start[made] - (np.cumsum(size[made]) - size[made]), size[made]) + np.arange(size[made].sum())
        for k, x in enumerate(parts):
            edges[k].append(x[taken])
        first += (first[-1] + np.cumsum(size[made])).tolist()
        state = number[model]
    return Automaton(grams.symbols, np.array(first), *(np.concatenate(e) for e in edges))


def followed(made: Automaton) -> Grams:
    """All paths of an automaton, in order."""
    if len(made.first) <= 2:
        return EMPTY
    levels, state = [], np.array([len(made.first) - 2])
    for _ in range(LONGEST):
        size = made.first[state + 1] - made.first[state]
        parent = np.repeat(np.arange(len(state)), size)
        taken = np.repeat(made.first[state] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        levels.append(Level(parent, made.symbol[taken], made.weight[taken]))
        state = made.target[taken]
    return Grams(made.symbols, levels)


def pack(grams: Grams) -> bytes:
    """An automaton as bytes: byte planes of its arrays, compressed."""
    made = shared(grams)
    parts = [made.symbols, np.diff(made.first), made.symbol, made.weight, made.target]
    raw = b"".join(x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in parts)
    head = struct.pack("<6q", len(raw), *(len(x) for x in parts))
    return head + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes) -> Grams:
    size, *counts = struct.unpack_from("<6q", data)
    raw = np.frombuffer(pa.decompress(data[48:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    parts, at = [], 0
    for n in counts:
        parts.append(raw[at : at + 8 * n].reshape(8, n).T.copy().view("<u8").reshape(-1))
        at += 8 * n
    symbols, sizes, *edges = parts
    return followed(Automaton(symbols, np.concatenate([[0], np.cumsum(sizes.astype(np.int64))]), *(e.astype(np.int64) for e in edges)))
