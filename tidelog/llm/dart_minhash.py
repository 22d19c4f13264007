"""DartMinHash: weighted signatures from hashed darts, for many sets at once.

Each element's (weight, rank) half-plane is cut into cells of unit area: for level v the weights [2^v - 1, 2^(v+1) - 1)
and ranks [c / 2^v, (c+1) / 2^v). A hash of element and cell says how many darts fall there (Poisson, mean 1) and where.
A dart counts if its weight lies below the element's. Each dart has a coordinate, by hash; a coordinate keeps the dart of
the least rank. Two sets agree in a coordinate with the probability of their weighted Jaccard similarity. Ranks are
searched up to `(k ln k + 2k) / total weight`, doubled for the sets that still have an empty coordinate.
"""

from __future__ import annotations

import math

import numpy as np

from tidelog.llm.buffers import U64, mix

_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])
_LIMITS = (_POISSON * 2.0**53).astype(np.uint64)


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> U64(11)).astype(np.float64) * 2.0**-53


def _darts(elements: np.ndarray, weights: np.ndarray, most: np.ndarray):
    """Darts below each element's weight and rank `most`: index of the element, rank, id."""
    out = []
    level = 0
    chosen = np.arange(len(elements))
    while len(chosen):
        height = 2.0**-level
        cells = np.ceil(most[chosen] / height).astype(np.int64)
        each = np.repeat(chosen, cells)
        cell = np.arange(len(each)) - np.repeat(np.cumsum(cells) - cells, cells)
        seed = mix(elements[each] ^ mix(cell.astype(U64) * U64(64) + U64(level + 1)))
        fallen = seed >> U64(11)
        number = 0
        live = np.flatnonzero(fallen >= _LIMITS[0])
        while len(live):
            dart = mix(seed[live] + U64((number + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            rank = (cell[live] + _unit(mix(dart ^ U64(0x5851F42D4C957F2D)))) * height
            inside = rank < most[each[live]]
            weight = weights[each[live]]
            partial = weight < 2.0 ** (level + 1) - 1
            if partial.any():
                at = 2.0**level - 1 + _unit(mix(dart ^ U64(0x14057B7EF767814F))) * 2.0**level
                inside &= at < weight
            out.append((each[live[inside]], rank[inside], dart[inside]))
            number += 1
            live = live[fallen[live] >= _LIMITS[number]] if number < len(_LIMITS) else live[:0]
        level += 1
        chosen = chosen[weights[chosen] > 2.0**level - 1]
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, U64)]


def signatures(rows: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """An n x k matrix: the ids of the kept darts of each row's set. A row without elements has zeros.

    `rows`, `elements` and `weights` say which element belongs to which row; an element occurs once in a row.
    """
    out, best = np.zeros(n * k, U64), np.full(n * k, np.inf)
    total = np.bincount(rows, weights, n)
    most = np.divide(k * math.log(k) + 2 * k, total, out=np.zeros(n), where=total > 0)
    todo = total > 0
    while todo.any():
        use = np.flatnonzero(todo[rows])
        each, rank, dart = _darts(elements[use], weights[use], most[rows[use]])
        slot = rows[use][each] * k + ((dart >> U64(32)) * U64(k) >> U64(32)).astype(np.int64)
        np.minimum.at(best, slot, rank)
        kept = rank == best[slot]
        out[slot[kept]] = dart[kept]
        todo &= np.isinf(best.reshape(n, k)).any(1)
        most *= 2
    return out.reshape(n, k)
