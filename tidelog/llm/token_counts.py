"""Token counts of whole texts: a broadcast table of frequent pieces, and a cache in each worker for the rest.

Nothing about pieces is shuffled. The table holds at most `table_size` hashes and lengths (16 bytes each); it is filled
from `table_documents` documents, and what it lacks is encoded by the worker that meets it, so it never changes a count.

Defined results: a null text counts as empty (no bytes, no tokens); rows with equal or null ids are counted one by one;
an empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidelog.llm.buffers import blocks
from tidelog.llm.scratch import ship
from tidelog.llm.vocab import Lengths

_workers: dict[str, Lengths] = {}


def frequent_pieces(docs: DataFrame, path: str, text: str, table_size: int, table_documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and lengths of the commonest pieces of some documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, seen = Lengths(path, (np.zeros(0, np.uint64), np.zeros(0, np.int64))), {}
        for batch in batches:
            for _, _, data, starts in blocks(batch.column(0)):
                keys, n = learner.keys_of(data, starts)
                for k, c in zip(keys.tolist(), n.tolist()):
                    seen[k] = seen.get(k, 0) + c
        top = np.array(sorted(seen, key=lambda k: (-seen[k], k))[:table_size], np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(top.view(np.int64)), pa.array(learner.table.get(top))], ["key", "length"])

    rows = docs.select(text).limit(table_documents).coalesce(1).mapInArrow(count, "key long, length long").toArrow()
    return rows["key"].to_numpy().view(np.uint64), rows["length"].to_numpy()


def count_tokens(
    docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", limit: int = 1024, table_size: int = 65_536, table_documents: int = 1_000
) -> DataFrame:
    """One row per document: key, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit)."""
    spark = docs.sparkSession
    ship(spark)
    table = spark.sparkContext.broadcast(frequent_pieces(docs, path, text, table_size, table_documents))

    use = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if use not in _workers:
            _workers.clear()
            _workers[use] = Lengths(path, table.value)
        for batch in batches:
            n_bytes, n_tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, data, starts in blocks(batch.column(1)):
                n_bytes.append(np.diff(starts))
                n_tokens.append(_workers[use].of(data, starts))
            n_tokens = np.concatenate(n_tokens)
            columns = [batch.column(0), pa.array(np.concatenate(n_bytes)), pa.array(n_tokens), pa.array(n_tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_bytes", "n_tokens", "over_limit"])

    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_tokens")), T.StructField("over_limit", T.BooleanType())]
    )
    return docs.select(key, text).mapInArrow(count, schema)
