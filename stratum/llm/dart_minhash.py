"""DartMinHash: weighted MinHash signatures by darts thrown into the regions of weighted elements.

Every element owns a column of unit cells along the weight axis, and every cell a fixed
random sequence of darts, ordered by rank: a Poisson process with K darts
per unit of rank, each dart with a coordinate out of K and a height inside its
cell.  A set of weighted elements sees the darts below each element's weight;
the signature holds, per coordinate, the earliest dart seen.  Two sets agree at a
coordinate with the probability of their weighted Jaccard similarity.  Only about K ln K
darts of low rank need be looked at for a whole set, however many
elements it has, which is what makes it fast for sparse weighted sets.
"""

from __future__ import annotations

import numpy as np

from stratum.llm.common import mix64, uniform

_STEP = np.uint64(0x9E3779B97F4A7C15)


def unit_cells(sets: np.ndarray, elements: np.ndarray, weights: np.ndarray):
    """(set, cell hash, filled part) of every unit cell that the weights reach; elements are distinct in a set."""
    n = np.ceil(weights).astype(np.int64)
    level = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    cell = mix64(np.repeat(elements, n) + level.astype(np.uint64) * _STEP)
    return np.repeat(sets, n), cell, np.minimum(np.repeat(weights, n) - level, 1.0)


def signatures(sets: np.ndarray, cells: np.ndarray, filled: np.ndarray, count: int, k: int) -> np.ndarray:
    """(count, k) signatures from unit cells; a set without cells has zeros."""
    out = np.zeros((count, k), np.uint64)
    total = np.bincount(sets, filled, minlength=count)
    todo, reach = total > 0, (np.log(k) + 3) / np.maximum(total, 1e-300)
    while todo.any():
        own = todo[sets]
        number = np.cumsum(todo) - 1
        s, c, f = number[sets[own]], cells[own], filled[own]
        limit = reach[todo][s]
        best = np.full(int(todo.sum()) * k, np.inf)
        slot, rank_of, dart_of = [], [], []
        rank, turn = np.zeros(len(s)), 0
        while len(s):
            turn += 1
            dart = mix64(c + np.uint64(turn * int(_STEP) % (1 << 64)))
            rank = rank - np.log(uniform(dart)) / k  # next dart of the cell
            more = mix64(dart ^ _STEP)
            live = rank < limit
            # low bits choose the coordinate, high bits the height
            hit = live & ((more >> np.uint64(32)).astype(np.float64) * 2.0 ** -32 < f)
            at = s[hit] * k + (more[hit] & np.uint64(0xFFFFFFFF)).astype(np.int64) % k
            np.minimum.at(best, at, rank[hit])
            slot.append(at)
            rank_of.append(rank[hit])
            dart_of.append(dart[hit])
            s, c, f, limit, rank = s[live], c[live], f[live], limit[live], rank[live]
        slot, rank_of, dart_of = map(np.concatenate, (slot, rank_of, dart_of))
        found = np.zeros(len(best), np.uint64)
        won = rank_of == best[slot]
        found[slot[won]] = dart_of[won]
        full = np.isfinite(best).reshape(-1, k).all(1)
        rows = np.flatnonzero(todo)
        out[rows[full]] = found.reshape(-1, k)[full]
        todo[rows[full]] = False
        reach = reach * 2  # a coordinate without a dart: look at darts of twice the rank
    return out
