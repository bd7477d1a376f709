"""Count automata against plain dictionaries."""

from __future__ import annotations

from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tideshift.llm import count_automata as ca

RUNS = st.lists(st.lists(st.integers(1, 5), max_size=9), max_size=8)
SEQUENCE = st.lists(st.integers(1, 6), min_size=1, max_size=4)


def counted(runs):
    out = Counter()
    for run in runs:
        for n in range(1, 5):
            out.update(tuple(run[i : i + n]) for i in range(len(run) - n + 1))
    return dict(out)


def built(runs):
    words = np.array([w for r in runs for w in r], np.uint64)
    symbols, index = np.unique(words, return_inverse=True)
    return ca.from_runs(symbols, index.reshape(-1), np.repeat(np.arange(len(runs)), [len(r) for r in runs]) if runs else np.zeros(0, int))


def listed(grams, with_zeros=False):
    out = {}
    for n, level in enumerate(grams.levels, 1):
        for row, weight in zip(grams.sequences(n, np.arange(len(level))), level.weight):
            assert tuple(row[:n].tolist()) not in out
            if weight or with_zeros:
                out[tuple(row[:n].tolist())] = int(weight)
    return out


def padded(sequences):
    out = np.zeros((len(sequences), 4), np.uint64)
    for i, s in enumerate(sequences):
        out[i, : len(s)] = s
    return out


@settings(max_examples=150, deadline=None)
@given(RUNS, RUNS, RUNS)
def test_counts_union_and_packing(a, b, c):
    assert listed(built(a)) == counted(a)
    total = ca.union([built(a), built(b), built(c)])
    assert listed(total) == counted([*a, *b, *c])
    again = ca.unpack(ca.pack(total))
    assert listed(again) == listed(total)
    for level in again.levels:  # in order, so that they can be searched
        keys = level.parent * max(len(again.symbols), 1) + level.symbol
        assert (np.diff(keys) > 0).all()
    assert listed(ca.pruned(total, 2)) == {s: n for s, n in counted([*a, *b, *c]).items() if n >= 2}


@settings(max_examples=150, deadline=None)
@given(RUNS, st.lists(SEQUENCE, max_size=6), st.lists(SEQUENCE, max_size=12))
def test_cut_range_and_lookup(runs, bounds, wanted):
    grams, bounds = built(runs), padded(sorted(set(map(tuple, bounds))))
    pieces = ca.cut(grams, bounds)
    assert [r for r, _ in pieces] == sorted({r for r, _ in pieces})
    together = {}
    for r, piece in pieces:
        mine = listed(piece)
        assert mine and set(ca.range_of(padded(list(mine)), bounds).tolist()) == {r}
        together |= mine
        assert listed(ca.unpack(ca.pack(piece)), True) == listed(piece, True)
    assert together == counted(runs)
    assert listed(ca.union([p for _, p in pieces])) == counted(runs)
    expected = counted(runs)
    found = ca.look_up(grams, padded(wanted)).tolist()
    assert found == [expected.get(tuple(w), 0) for w in wanted]


def test_equal_tails_share_states():
    grams = built([[x, 1, 2, 3] for x in (7, 8, 9)])
    made = ca.shared(grams)
    # one state without transitions, "3", "2 3" after one word and after two, "1 2 3", and the start; words stand alone too
    assert len(made.first) - 1 < len(grams) / 2 and listed(ca.followed(made)) == listed(grams)
