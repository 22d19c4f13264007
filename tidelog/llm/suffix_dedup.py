"""Removal of repeated byte strings: every byte that lies in a string of `length` bytes that also starts elsewhere.

1. Equal texts are one node with its number of copies; with copies, all of it is repeated.
2. Each window of `length` bytes has an anchor: the least hash of its k-grams, the first of equal ones. Equal windows have
   equal anchors at equal places, so only runs of windows whose anchor occurs twice can be repeated; the rest, most
   text, goes no further.
3. The contexts of an anchor (the bytes under a run of windows) meet in one task. Cut into blocks of 16 bytes in step with
   the anchor they are strings over block numbers. Shards of them get Burrows-Wheeler transforms, which are merged by
   iterative interleave refinement (`bwt`); its intervals of 24 common blocks hold all windows that may be equal, and the
   bytes beside the blocks decide.
4. An anchor with many contexts is dealt to several tasks. What such a task leaves open, and one window of each class that it
   found, is compared across them by hash.
5. The intervals of each node are united, and cut from the texts.

Defined results: a null text is empty; matches never cross documents; rows with equal ids, or null ids, are documents of
their own, and equal texts are copies of each other; texts shorter than `length` keep all bytes; the kept bytes may end
inside a character. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.buffers import _BASE, U64, blocks, flat, mix, powers, spans, sums
from tidelog.llm.bwt import Shard, repeated
from tidelog.llm.near_dup import content
from tidelog.llm.scratch import keep, ship

GRAM, BLOCK = 64, 16
#: Window starts that are searched at once, and bits of a place among them.
_CHUNK, _PLACE = 1 << 22, 24
#: Bytes of contexts that are merged at once, symbols of a shard, and contexts of an anchor in one task.
TOGETHER, SHARD, MOST = 2 << 20, 1 << 15, 2048


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(-1, width)
    before, after = np.minimum.accumulate(table, 1).ravel(), np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def runs_of_windows(data: np.ndarray, starts: np.ndarray, length: int) -> list[np.ndarray]:
    """Maximal runs of windows with one anchor: row, first window (from the row's start), number, anchor's place in the context, anchor."""
    parts = []
    for low in range(0, max(1, len(data) - length + 1), _CHUNK):
        piece = data[low : low + _CHUNK + length - 1]
        count = len(piece) - length + 1
        if count <= 0:
            continue
        running = sums(piece)
        grams = len(piece) - GRAM + 1
        hashes = mix((running[GRAM:] - running[:grams]) * powers(_BASE, grams)[:grams])
        ordered = (hashes & ~U64((1 << _PLACE) - 1)) | np.arange(grams, dtype=U64)
        place = (_least(ordered, length - GRAM + 1) & U64((1 << _PLACE) - 1)).astype(np.int64)
        window = np.arange(count)
        row = np.searchsorted(starts, window + low, "right") - 1
        whole = window + low + length <= starts[row + 1]
        new = whole.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~whole[:-1] | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        total = np.concatenate([[0], np.cumsum(whole)])
        number = total[np.append(first[1:], count)] - total[first] if len(first) else first
        parts.append([row[first], first + low - starts[row[first]], number, place[first] - first, hashes[place[first]]])
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, U64)]


def _tables(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """Of each document: h1, h2, least (its id), n_bytes, and its runs as arrays."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in blocks(batch.column(3)):
                row, low, number, place, anchor = runs_of_windows(data, starts, length)
                at = pa.array(np.searchsorted(row, np.arange(last - first + 1)).astype(np.int32))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(v, k)) for v, k in zip((anchor.view(np.int64), low, number, place), kinds)]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(np.diff(starts)), *lists], [f.name for f in schema])

    long, int_ = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    fields = [("least", docs.schema[key].dataType), ("h1", T.LongType()), ("h2", T.LongType()), ("n_bytes", T.LongType()), ("anchor", long), ("low", long), ("number", int_), ("place", int_)]
    schema = T.StructType([T.StructField(*f) for f in fields])
    return docs.select(F.col(key), *(c.alias(n) for n, c in content(text).items()), F.col(text)).mapInArrow(find, schema)


def _contexts(rows: DataFrame, length: int) -> DataFrame:
    """anchor, salt, salts, h1, h2, low, place, context: the bytes under each run of `rows` (h1, h2, text, runs)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                data, starts = flat(part.column(2))
                raw = data.tobytes()
                runs = part.column(3)
                begin = runs.offsets.to_numpy()
                row = np.repeat(np.arange(part.num_rows), np.diff(begin))
                fields = runs.values.slice(begin[0], begin[-1] - begin[0]).flatten()
                low, number = (fields[i].to_numpy() for i in (1, 2))
                first = (starts[row] + low).tolist()
                text = pa.array([raw[a : a + n + length - 1] for a, n in zip(first, number.tolist())], pa.binary())
                columns = [fields[0], fields[4], fields[5], part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), fields[1], fields[3], text]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "salt", "salts", "h1", "h2", "low", "place", "context"])

    return rows.select("h1", "h2", "text", "runs").mapInArrow(cut, "anchor long, salt int, salts int, h1 long, h2 long, low long, place int, context binary")


def repeated_windows(contexts: pa.Array, anchor: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context, start, class and hash of each window that may be repeated; windows are equal if their classes are.

    `anchor` and `place` are the contexts' anchor and where it stands in them.
    """
    data, starts = flat(contexts)
    size = np.diff(starts)
    lead = place % BLOCK
    count = np.maximum(size - lead, 0) // BLOCK
    string = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(string)) - np.repeat(np.cumsum(count) - count, count)
    begin = starts[string] + lead[string] + number * BLOCK
    running = sums(data)
    symbol = mix(spans(running, begin, begin + BLOCK) ^ mix(anchor.view(U64))[string])  # blocks of other anchors are others
    symbol = np.unique(symbol, return_inverse=True)[1] + 1
    ends = np.cumsum(count)
    text = np.insert(symbol, ends, 0)  # a terminator after each string
    first = np.concatenate([[0], ends[:-1]]) + np.arange(len(size))
    # Shards of whole strings.
    cuts = np.unique(np.searchsorted(first, np.arange(0, len(text), SHARD)))
    shards, offsets = [], []
    for a, b in zip(cuts, np.append(cuts[1:], len(size))):
        if a < b:
            end = first[b] if b < len(size) else len(text)
            shards.append(Shard(text[first[a] : end], first[a:b] - first[a]))
            offsets.append(first[a])
    found = [(at + offset, interval) for (at, interval), offset in zip(repeated(shards, (length - BLOCK) // BLOCK), offsets)]
    at, interval = (np.concatenate(x) for x in zip(*found))
    own = np.searchsorted(first, at, "right") - 1
    start = (lead[own] + (at - first[own]) * BLOCK)[:, None] - np.arange(BLOCK)[None, :]
    own, interval = (np.repeat(v, BLOCK).reshape(start.shape) for v in (own, interval))
    inside = (start >= 0) & (start <= (size - length)[own])
    own, start, interval = own[inside], start[inside], interval[inside]
    hashes = spans(running, starts[own] + start, starts[own] + start + length)
    return own, start, mix(hashes ^ mix(interval.astype(U64))), mix(hashes ^ mix(anchor.view(U64)[own]))


def _judged(length: int):
    """kind 0: h1, h2, low, high of repeated bytes; kind 1: windows that tasks of one anchor have to compare, by key."""

    def judge(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        anchor, salts, h1, h2, low, place = (table[c].to_numpy() for c in ("anchor", "salts", "h1", "h2", "low", "place"))
        context = table["context"].combine_chunks()
        own, start, classes, key = repeated_windows(context, anchor, place.astype(np.int64), length)
        order = np.argsort(classes)
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = classes[order[1:]] == classes[order[:-1]]
        twice = np.zeros(len(order), bool)
        twice[order] = same[1:] | same[:-1]
        hit_own, hit_start = own[twice], start[twice]
        order_ = np.lexsort((hit_start, hit_own))
        hit_own, hit_start = hit_own[order_], hit_start[order_]
        new = np.concatenate([[True], (hit_own[1:] != hit_own[:-1]) | (hit_start[1:] != hit_start[:-1] + 1)]) if len(hit_own) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hit_own)) - 1 if len(first) else first
        rows = [(0, hit_own[first], hit_start[first], hit_start[last] + length, np.zeros(len(first), np.int64))]
        if (salts > 1).any():
            rows.append(_open(salts, context, anchor, own, start, key, twice, order, same, length))
        for kind, o, begin, end, k in rows:
            for i in range(0, len(o), 100_000):
                s = slice(i, i + 100_000)
                columns = [np.full(len(o[s]), kind, np.int32), h1[o[s]], h2[o[s]], low[o[s]] + begin[s], low[o[s]] + end[s], k[s]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "h1", "h2", "low", "high", "key"])

    return judge


def _open(salts, context, anchor, own, start, key, twice, order, same, length):
    """Windows of dealt-out anchors that are not repeated in this task, and one of each class that is."""
    data, starts = flat(context)
    count = np.where(salts > 1, np.diff(starts) - length + 1, 0)
    each = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
    place = np.cumsum(count) - count
    resolved = np.zeros(len(each), bool)
    dealt = salts[own] > 1
    resolved[(place[own] + start)[twice & dealt]] = True
    lead = order[same[1:] & ~same[:-1]]  # the first of each class of several
    lead = lead[dealt[lead]]
    resolved[place[own[lead]] + start[lead]] = False
    each, at = each[~resolved], at[~resolved]
    begin = starts[each] + at
    hashes = mix(spans(sums(data), begin, begin + length) ^ mix(anchor.view(U64)[each]))
    return 1, each, at, at + length, hashes.view(np.int64)


def _united(rows: DataFrame) -> DataFrame:
    """h1, h2, n_removed, n_spans, kept (start, length) of the intervals of each node."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans_, kept = [], [], []
            for size, each in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                gone, number, stays, at = 0, 0, [], 0
                for span in sorted((s["low"], s["high"]) for s in each):
                    if span[0] > at or not number:
                        if span[0] > at:
                            stays.append({"start": at, "length": span[0] - at})
                        number += 1
                        gone += span[1] - span[0]
                        at = span[1]
                    elif span[1] > at:
                        gone += span[1] - at
                        at = span[1]
                if size > at:
                    stays.append({"start": at, "length": size - at})
                removed.append(gone), spans_.append(number), kept.append(stays)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(removed, pa.int64()), pa.array(spans_, pa.int64()), pa.array(kept, kind)], ["h1", "h2", "n_removed", "n_spans", "kept"])

    return rows.select("h1", "h2", "n_bytes", "spans").mapInArrow(unite, "h1 long, h2 long, n_removed long, n_spans long, kept array<struct<start:long,length:long>>")


def repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 400) -> tuple[DataFrame, DataFrame]:
    """Nodes (h1, h2, least, n_bytes, copies) and what is repeated in those without copies (h1, h2, n_removed, n_spans, kept)."""
    if (length - BLOCK) % BLOCK or length < 2 * GRAM:
        raise ValueError(f"length must be a multiple of {BLOCK}, {2 * GRAM} at least")
    ship(docs.sparkSession)
    found = _tables(docs, key, text, length)
    arrays = ["anchor", "low", "number", "place"]
    runs = F.arrays_zip(*arrays).alias("runs")
    nodes = keep(found.groupBy("h1", "h2").agg(F.min("least").alias("least"), F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes"), F.first(runs).alias("runs")), "nodes")
    each = nodes.select("h1", "h2", F.explode("runs").alias("run")).select("h1", "h2", "run.*")
    shared = keep(each.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "shared")
    salts = F.ceil(F.col("n") / F.lit(MOST)).cast("int")
    met = each.join(shared, "anchor").withColumn("salts", salts).withColumn("salt", F.pmod(F.xxhash64("h1", "low"), F.col("salts")).cast("int"))
    wanted = met.groupBy("h1", "h2").agg(F.collect_list(F.struct("anchor", "low", "number", "place", "salt", "salts")).alias("runs"))
    wanted = keep(wanted.join(nodes.select("h1", "h2", "least"), ["h1", "h2"]), "wanted")
    held = docs.select(F.col(key).alias("own"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumns(content("text"))
    rows = held.join(wanted, ["h1", "h2"]).filter(F.col("own").eqNullSafe(F.col("least"))).select("h1", "h2", "text", "runs").dropDuplicates(["h1", "h2"])
    judge = _judged(length)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:  # sorted by anchor and salt: cut where one changes
            anchor, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])) + 1).tolist()] if len(anchor) else []
            if held and cuts and (anchor[0], salt[0]) == tuple(held[-1].column(i)[-1].as_py() for i in (0, 1)):
                cuts = cuts[1:]
                head = batch.slice(0, cuts[0] if cuts else batch.num_rows)
                held.append(head)
                size += head.column(7).nbytes
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                if size > TOGETHER:
                    yield from judge(pa.Table.from_batches(held))
                    held, size = [], 0
                part = batch.slice(a, b - a)
                held.append(part)
                size += part.column(7).nbytes
        if held:
            yield from judge(pa.Table.from_batches(held))

    dealt = _contexts(rows, length).repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
    told = keep(dealt.mapInArrow(together, "kind int, h1 long, h2 long, low long, high long, key long"), "intervals")
    across = told.filter("kind = 1").groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    second = told.filter("kind = 1").join(across, "key").select("h1", "h2", "low", "high")
    spans_ = told.filter("kind = 0").select("h1", "h2", "low", "high").unionByName(second)
    lists = spans_.groupBy("h1", "h2").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    alone = nodes.filter((F.col("copies") == 1) | (F.col("n_bytes") < length)).select("h1", "h2", "n_bytes")
    return nodes, _united(lists.join(alone, ["h1", "h2"]))


def remove(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, kept (the bytes that stay)."""
    nodes, found = repeats(docs, key=key, text=text, length=length)
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    whole = nodes.filter(copied).select("h1", "h2", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), none.alias("kept"))
    changed = keep(found.unionByName(whole).withColumnRenamed("kept", "stays"), "changed")
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    held = docs.select(F.col(key), raw.alias("raw"), *(c.alias(n) for n, c in content(text).items())).join(changed, ["h1", "h2"], "left")
    kept = F.aggregate("stays", F.encode(F.lit(""), "utf-8"), lambda b, s: F.concat(b, F.substring("raw", s["start"].cast("int") + 1, s["length"].cast("int"))))
    zero = F.lit(0).cast("long")
    return held.select(
        key, F.octet_length("raw").cast("long").alias("n_bytes"), F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.when(F.col("stays").isNull(), F.col("raw")).otherwise(kept).alias("kept"),
    )
