"""Burrows-Wheeler transforms of many short strings over integer alphabets, and their merge by interleave refinement.

A shard is a collection of strings; each ends in a terminator of its own, smaller than any symbol and ordered by string.
The transforms of several shards are merged without sorting their suffixes again: starting from an arbitrary interleave
of the shards, each step reads the transforms in the present order and deals the shard numbers out by symbol, stably;
after k steps the interleave is that of all suffixes by their first k symbols. Where neighbours part at step k + 1, their
common prefix is k symbols long, so the repeated intervals of any depth come with the merge.
"""

from __future__ import annotations

import numpy as np


def _by_symbol(symbols: np.ndarray) -> np.ndarray:
    """Stable order of non-negative symbols, by two radix passes."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    high = symbols >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


class Shard:
    """`order`: all suffixes, sorted, as places in `text` (terminators included); `before`: the symbol before each, 0 at a string's start."""

    def __init__(self, text: np.ndarray, starts: np.ndarray):
        """`text` holds the strings one after the other, each followed by 0; symbols are positive, `starts` says where each begins."""
        n = len(text)
        ends = text == 0
        rank = np.where(ends, np.cumsum(ends), text.astype(np.int64) + ends.sum())  # terminators first, by string
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        step, most = 1, int(np.diff(np.append(starts, n)).max(initial=1))
        while step < most:
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1  # beyond the own terminator it never matters: that has decided already
            key = rank * (n + 1) + after
            order = np.argsort(key)
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.concatenate([[0], key[order[1:]] != key[order[:-1]]]))
            rank, step = new, step * 2
        self.order = np.argsort(rank)
        preceding = np.concatenate([[0], text[:-1]])
        preceding[starts] = 0
        self.before, self.strings = preceding[self.order], len(starts)


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of the shards' suffixes by their first `depth` symbols (the shard at each place), and the number of
    the interval at each place: equal where all `depth` symbols are."""
    source = np.repeat(np.arange(len(shards)), [len(s.order) for s in shards])
    interval = np.zeros(len(source), np.int64)
    strings = np.repeat(np.arange(len(shards)), [s.strings for s in shards])
    symbols = np.empty(len(source), np.int64)
    for _ in range(depth):
        by_shard = np.argsort(source.astype(np.uint16), kind="stable")  # places of shard 0 in order, then of shard 1 ...
        symbols[by_shard] = np.concatenate([s.before for s in shards])
        dealt = _by_symbol(symbols)
        symbol, former, source = symbols[dealt], interval[dealt], source[dealt]
        parts = np.ones(len(dealt), bool)
        parts[1:] = (symbol[1:] != symbol[:-1]) | (former[1:] != former[:-1])
        parts[: len(strings)] = True  # the suffixes that are a terminator come first, each alone, in the order of strings
        source[: len(strings)] = strings
        interval = np.cumsum(parts) - 1
    return source, interval


def repeated(shards: list[Shard], depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each shard: places in its text of suffixes whose first `depth` symbols occur again in any shard, and their intervals."""
    source, interval = merge(shards, depth)
    size = np.bincount(interval)
    out = []
    for i, shard in enumerate(shards):
        own = interval[source == i]
        again = size[own] > 1
        out.append((shard.order[again], own[again]))
    return out
