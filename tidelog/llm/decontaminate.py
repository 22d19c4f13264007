"""Benchmark decontamination: rare n-gram seeds lead to passages, a Smith-Waterman alignment scores them.

Words are compared in lower case (A-Z) and without ASCII punctuation. A first pass counts in how many documents each word
n-gram of the benchmark occurs; each item drops its commonest quarter and keeps the rest as seeds, and the rarest of each
few in a row, so a leak in a third of all documents still has seeds, and each stretch of `excerpt` words has one. A second pass finds the seeds in the documents, forms a window of words around each
group of them, and aligns item and window: 2 for an equal word, -1 for another one or a gap. The score is the share of
the item's own alignment that is reached; edited and paraphrased copies keep most of it. An item is found if that share
reaches `threshold`, or if a stretch of at least `excerpt` of its words, from one equal word to another, reaches that share
of the stretch's own score: an excerpt counts however long the item is.

The benchmark goes to the tasks in slices of at most `slice_words` words, each with its own passes, so what is broadcast
is bounded whatever the benchmark's size. Documents are not shuffled.

Defined results: null texts are empty; items of fewer words than an n-gram match nothing; rows with equal or null ids
are judged one by one, equal items each for itself; the item's best passage in a document counts. Only ids and texts are
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.buffers import U64, blocks, flat, in_row, spans, sums, windows, words
from tidelog.llm.scratch import ship
from tidelog.llm.vocab import Table

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_DROP = np.zeros(256, bool)
_DROP[[*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True
_BITS = 20


def folded_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word, lower-case and without punctuation."""
    stays = ~_DROP[data]
    before = np.concatenate([[0], np.cumsum(stays)])
    small = _FOLD[data[stays]]
    starts = before[starts]
    begin, end, row = words(small, starts)
    return spans(sums(small), begin, end), row


class Seeds:
    """n-grams of a slice of the benchmark, and the words of its items."""

    def __init__(self, column: pa.Array, n: int):
        self.n = n
        self.words, row = folded_words(*flat(column))
        self.first = np.searchsorted(row, np.arange(len(column) + 1))
        at = np.flatnonzero(in_row(row, n))
        gram = windows(self.words, n)[at]
        self._index(gram, row[at], at - self.first[row[at]])

    def _index(self, gram: np.ndarray, item: np.ndarray, offset: np.ndarray) -> None:
        order = np.argsort(gram, kind="stable")
        self.gram, self.item, self.offset = gram[order], item[order], offset[order]
        self.keys, self.start = np.unique(self.gram, return_index=True)
        self.stop = np.append(self.start[1:], len(order))
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[self.keys & U64((1 << _BITS) - 1)] = True
        self.table = Table(max(4, (2 * len(self.keys) + 1).bit_length()))
        self.table.put(self.keys, np.arange(len(self.keys)))

    def rare(self, documents: np.ndarray, excerpt: int) -> None:
        """Drops the commonest quarter of each item's n-grams, but none that is the rarest of its block, of which each
        stretch of `excerpt` words holds a whole one; `documents` counts them for each key."""
        count = documents[np.repeat(np.arange(len(self.keys)), self.stop - self.start)]
        order = np.lexsort((self.offset, count, self.item))
        sizes = np.bincount(self.item)
        place = np.arange(len(order)) - (np.cumsum(sizes) - sizes)[self.item[order]]
        stays = place < np.ceil(0.75 * sizes)[self.item[order]]
        block = self.offset[order] // max(1, (excerpt - self.n + 2) // 2)
        stays[np.unique(np.stack([self.item[order], block]), axis=1, return_index=True)[1]] = True
        kept = np.sort(order[stays])
        self._index(self.gram[kept], self.item[kept], self.offset[kept])

    def find(self, hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each n-gram that is a key, and the key's number."""
        gram = windows(hashes, self.n)
        at = np.flatnonzero(self.filter[gram & U64((1 << _BITS) - 1)] & in_row(row, self.n))
        key = self.table.get(gram[at])
        return at[key >= 0], key[key >= 0]


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Best local score of each item in its passage: 2 for equal words, -1 for different ones and for gaps."""
    height, width = max(map(len, items)), max(map(len, passages))
    rows, columns = np.zeros((len(items), height), U64), np.ones((len(items), width), U64)
    for i, (item, passage) in enumerate(zip(items, passages)):
        rows[i, : len(item)], columns[i, : len(passage)] = item, passage
    filled = np.arange(height) < np.array([len(i) for i in items])[:, None]
    place = np.arange(width + 1, dtype=np.int32)
    before, best = np.zeros((len(items), width + 1), np.int32), np.zeros(len(items), np.int32)
    for i in range(height):
        equal = (columns == rows[:, i : i + 1]) & filled[:, i : i + 1]
        now = np.zeros_like(before)
        now[:, 1:] = np.maximum(before[:, :-1] + np.where(equal, 2, -1), before[:, 1:] - 1)
        now = np.maximum.accumulate(np.maximum(now, 0) + place, axis=1) - place  # a gap costs 1 a word
        best = np.maximum(best, now.max(1))
        before = now
    return best


def holds_excerpt(items: list[np.ndarray], passages: list[np.ndarray], threshold: float, least: int) -> np.ndarray:
    """Whether a stretch of at least `least` words of each item reaches `threshold` of its own score in the passage.

    A local alignment as in `align`, less the score that each word of the stretch has to bring: what stays at or above
    zero reaches the threshold. Each value holds, below the score, where in the item its stretch begins.
    """
    height, width = max(map(len, items)), max(map(len, passages))
    rows, columns = np.zeros((len(items), height), U64), np.ones((len(items), width), U64)
    for i, (item, passage) in enumerate(zip(items, passages)):
        rows[i, : len(item)], columns[i, : len(passage)] = item, passage
    filled = np.arange(height) < np.array([len(i) for i in items])[:, None]
    begin = 1 << (height + 1).bit_length()  # more than any place in an item
    cost = lambda score: round(64 * score) * begin
    same, other, gap = cost(2 - 2 * threshold), cost(-1 - 2 * threshold), cost(-1)
    place = -gap * np.arange(width + 1, dtype=np.int64)
    before, found = np.full((len(items), width + 1), -1, np.int64), np.zeros(len(items), bool)
    for i in range(height):
        equal = (columns == rows[:, i : i + 1]) & filled[:, i : i + 1]
        now = np.full_like(before, -1)
        onward = np.maximum(before[:, :-1], begin - 1 - i) + np.where(equal, same, other)
        found |= (equal & (begin - 1 - onward % begin <= i + 1 - least)).any(1)
        now[:, 1:] = np.maximum(onward, before[:, 1:] + other)
        before = np.maximum.accumulate(now + place, axis=1) - place
    return found


def passages(seeds: Seeds, hashes: np.ndarray, row: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(row, item, first word, word after the last) of each window around seeds of one item."""
    at, key = seeds.find(hashes, row)
    each = seeds.stop[key] - seeds.start[key]
    at = np.repeat(at, each)
    entry = np.repeat(seeds.start[key] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    if not len(at):
        return []
    item, start = seeds.item[entry], at - seeds.offset[entry]
    order = np.lexsort((start, item, row[at]))
    at, item, start = at[order], item[order], start[order]
    length = (seeds.first[1:] - seeds.first[:-1])[item]
    joined = np.zeros(len(at), bool)
    joined[1:] = (row[at][1:] == row[at][:-1]) & (item[1:] == item[:-1]) & (start[1:] - start[:-1] <= length[1:])
    group = np.flatnonzero(~joined)
    low, high = np.minimum.reduceat(start, group), np.maximum.reduceat(start + length, group)
    slack = length[group] // 2 + 2
    rows = row[at][group]
    low = np.maximum(low - slack, np.searchsorted(row, rows))
    high = np.minimum(high + slack, np.searchsorted(row, rows, "right"))
    return list(zip(rows.tolist(), item[group].tolist(), low.tolist(), high.tolist()))


def best_scores(known: Seeds, data: np.ndarray, starts: np.ndarray, threshold: float, excerpt: int) -> dict[tuple[int, int], tuple[float, int, int]]:
    """Of each (row, item) that reaches the threshold or holds an excerpt: score, first word and word after the last of the best window."""
    hashes, row = folded_words(data, starts)
    found = passages(known, hashes, row)
    found.sort(key=lambda p: p[3] - p[2])  # like sizes are aligned together
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for i in range(0, len(found), 256):
        part = found[i : i + 256]
        own = [known.words[known.first[p[1]] : known.first[p[1] + 1]] for p in part]
        texts = [hashes[p[2] : p[3]] for p in part]
        reached = align(own, texts)
        whole = 2 * np.array([len(w) for w in own])
        leaks_ = reached >= np.maximum(threshold * whole, np.minimum(12, whole))
        open_ = np.flatnonzero(~leaks_ & (whole >= 2 * excerpt) & (reached >= 2 * threshold * excerpt))
        if len(open_):
            leaks_[open_] = holds_excerpt([own[k] for k in open_], [texts[k] for k in open_], threshold, excerpt)
        for k in np.flatnonzero(leaks_).tolist():
            r, item, low, high = part[k]
            begin = int(np.searchsorted(row, r))
            best[r, item] = max(best.get((r, item), (0.0, 0, 0)), (float(reached[k] / whole[k]), low - begin, high - begin))
    return best


def _slice(docs: DataFrame, bench: pa.Table, *, key: str, text: str, item_key: str, n: int, threshold: float, excerpt: int, found_rows: bool = True) -> DataFrame:
    """The leaks of a slice of the benchmark, or else the documents without any."""
    spark = docs.sparkSession
    seeds = Seeds(bench.column(1).combine_chunks() if bench.num_rows else pa.array([], pa.string()), n)
    all_grams = spark.sparkContext.broadcast(seeds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(all_grams.value.keys), np.int64)
        for batch in batches:
            for _, _, data, starts in blocks(batch.column(0)):
                hashes, row = folded_words(data, starts)
                at, found = all_grams.value.find(hashes, row)
                pairs = np.unique(found * len(starts) + row[at]) if len(at) else found
                total += np.bincount(pairs // len(starts), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    counts = docs.select(text).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    documents = np.zeros(len(seeds.keys), np.int64)  # as many as the slice has n-grams
    documents[counts["gram"].to_numpy()] = counts["n"].to_numpy()
    seeds.rare(documents, excerpt)
    rare, items = spark.sparkContext.broadcast(seeds), bench.column(0).combine_chunks() if bench.num_rows else pa.array([], bench.schema.field(0).type)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in blocks(batch.column(1)):
                best = best_scores(rare.value, data, starts, threshold, excerpt)
                if best:
                    rows, found = zip(*best)
                    values = list(zip(*best.values()))
                    columns = [batch.column(0).slice(first, last - first).take(pa.array(rows)), items.take(pa.array(found)), *(pa.array(v) for v in values)]
                    yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in blocks(batch.column(1)):
                stays = np.ones(last - first, bool)
                stays[[row for row, _ in best_scores(rare.value, data, starts, threshold, excerpt)]] = False
                part = batch.slice(first, last - first).filter(pa.array(stays))
                if part.num_rows:
                    yield part

    if not found_rows:
        return docs.select(F.struct("*").alias("doc"), F.col(text).alias("own_text")).mapInArrow(drop, T.StructType([T.StructField("doc", docs.schema), T.StructField("own_text", T.StringType())])).select("doc.*")
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType), T.StructField(item_key, _types[str(items.type)]),
            T.StructField("score", T.DoubleType()), T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType()),
        ]
    )
    return docs.select(key, text).mapInArrow(score, schema)


_types = {"int64": T.LongType(), "int32": T.IntegerType(), "string": T.StringType(), "large_string": T.StringType()}


def _slices(benchmark: DataFrame, item_key: str, item_text: str, slice_words: int) -> Iterator[pa.Table]:
    items = benchmark.select(F.col(item_key), F.col(item_text))
    size = F.size(F.split(F.coalesce(F.col(item_text), F.lit("")), r"[ \t-\r]+"))
    total = items.agg(F.sum(size.cast("long"))).first()[0] or 0
    slices = max(1, -(-total // slice_words))
    for i in range(slices):
        yield items.filter(F.pmod(F.xxhash64(*items.columns), F.lit(slices)) == i).orderBy(*items.columns).toArrow()


def leaks(
    docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    n: int = 3, threshold: float = 0.5, excerpt: int = 13, slice_words: int = 1_000_000,
) -> DataFrame:
    """One row per document and item that it holds: key, item_key, score, first_word, end_word (the window in the document)."""
    ship(docs.sparkSession)
    options = {"key": key, "text": text, "item_key": item_key, "n": n, "threshold": threshold, "excerpt": excerpt}
    return reduce(DataFrame.unionByName, [_slice(docs, part, **options) for part in _slices(benchmark, item_key, item_text, slice_words)])


def clean(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_key: str = "item_id", item_text: str = "text", n: int = 3, threshold: float = 0.5, excerpt: int = 13, slice_words: int = 1_000_000
) -> DataFrame:
    """`docs`, all columns, without the documents that hold an item. Judged where they lie, without a join."""
    ship(docs.sparkSession)
    for part in _slices(benchmark, item_key, item_text, slice_words):
        docs = _slice(docs, part, key="", text=text, item_key=item_key, n=n, threshold=threshold, excerpt=excerpt, found_rows=False)
    return docs
