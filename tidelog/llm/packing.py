"""Best-fit packing of documents into sequences of at most `capacity` tokens, by the sum-of-squares rule.

Only documents longer than a sequence are cut. The other pieces are dealt by a hash to parts of about `part_size`, each
packed on its own with the longest first: a piece goes to the open bin for which the sum, over residual gaps, of the
squared numbers of open bins becomes smallest; a bin is opened only where none fits. A part wastes at most about one
sequence, so the result is within 1 in `part_size / pieces per sequence` of the fewest possible, at any input size.

Defined results: a null text is empty, so its only token is the end id; rows with equal or null ids are packed one by
one; an empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.buffers import blocks
from tidelog.llm.scratch import keep, ship
from tidelog.llm.vocab import Ids

_workers: dict[str, Ids] = {}


def pieces(docs: DataFrame, path: str, *, key: str, text: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, and its ids if asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _workers:
            _workers.clear()
            _workers[path] = Ids(path)
        for batch in batches:
            for first, last, data, starts in blocks(batch.column(1)):
                flat, at = _workers[path].of(data, starts)
                count = np.diff(at) + 1
                each = -(-count // capacity)
                doc = np.repeat(np.arange(last - first), each)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
                start = piece * capacity
                length = np.minimum(capacity, count[doc] - start)
                ids = np.insert(flat, at[1:], end_id)
                begin = at[doc] + doc + start
                parts = [ids[b : b + n] for b, n in zip(begin.tolist(), length.tolist())]
                crc = np.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], np.int64)
                columns = [batch.column(0).slice(first, last - first).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    fields = [(key, docs.schema[key].dataType), ("piece", T.IntegerType()), *((c, T.LongType()) for c in ("start", "length", "ids_crc32"))]
    fields += [("ids", T.ArrayType(T.IntegerType()))] * with_ids
    names = [name for name, _ in fields]
    ship(docs.sparkSession)
    return docs.select(key, text).mapInArrow(cut, T.StructType([T.StructField(*f) for f in fields]))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; the longest are placed first."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins = np.zeros(capacity + 1, np.int64)  # by residual gap; a full bin is closed
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    opened = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        here = open_bins[n:]
        if n == capacity or not here.any():
            bin_, gap, opened = opened, capacity, opened + 1
        else:
            # Moving a bin from gap g to g - n changes the sum by 2 (N[g - n] - N[g]) + 2, or by 1 - 2 N[g] if it is full then.
            change = 2 * (open_bins[: capacity + 1 - n] - here) + 2
            change[0] = 1 - 2 * here[0]
            gap = n + int(np.where(here > 0, change, np.iinfo(np.int64).max).argmin())
            open_bins[gap] -= 1
            bin_ = waiting[gap].pop()
        bins[i], offsets[i] = bin_, capacity - gap
        if gap > n:
            open_bins[gap - n] += 1
            waiting[gap - n].append(bin_)
    return bins, offsets


def pack(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0, part_size: int = 8192) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = pieces(docs, path, key=key, text=text, capacity=capacity, end_id=end_id)
    cut = keep(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    short = F.col("length") < capacity
    parts = max(1, -(-cut.filter(short).count() // part_size))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)  # the same result if the task runs again
        bins, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=rows["part"] * (1 << 32) + bins, offset=offset)[names]

    packed = T.StructType([*(f for f in cut.schema if f.name != "row"), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = packed.names
    placed = cut.filter(short).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts))).groupBy("part").applyInPandas(place, packed)
    full = cut.filter(~short).withColumns({"sequence_id": -F.col("row") - 1, "offset": F.lit(0).cast("long")}).select(names)
    return placed.unionByName(full)


def sequences(docs: DataFrame, placed: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The sequences themselves: sequence_id, ids. Needs ids of documents that are unique and not null."""
    cut = pieces(docs, path, key=key, text=text, capacity=capacity, end_id=end_id, with_ids=True)
    rows = cut.select(key, "piece", "ids").join(placed.select(key, "piece", "sequence_id", "offset"), [key, "piece"])
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
