"""Language-model scores of whole texts: a word-unigram base and a causal self-attention model on subword ids.

Both learn from the training documents (crc32 of the id as text, modulo 10, is not 0), the base and all counts from every
word and id of them. One pass tallies each partition: counts of words (by 64-bit hash), counts of ids by the group of the
id before (a bounded table), and every `train_every`-th window of ids (all of them, unless told otherwise). The attention
model is trained on those windows in rounds, each window in one of them: each partition takes its share from the round's
parameters by its own steps, and the results are averaged, weighted by windows, an id's input vector by its occurrences. What is tallied, trained on and gathered grows with the corpus; what is broadcast does not: the model, the
table of ids, and the counts of at most `table_words` frequent words. Rarer words meet their counts in a join.

Words are lower-cased (A-Z) runs of bytes other than space and 0x09-0x0D, then one end token. The model's text is the
subword ids of the lower-case text and one end id.

Defined results: a null text is empty (only the end token); a null id counts as the empty text for the split; rows with
equal or null ids are scored one by one; with no training document the base is uniform and the model untrained. Only the
id and the text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import attention
from tidelog.llm.attention import SIZE, WIDTH, Adam, Vocabulary
from tidelog.llm.buffers import U64, blocks, flat as buffer, spans, sums, words
from tidelog.llm.scratch import keep, ship
from tidelog.llm.vocab import Ids, Table, tokenizer

#: Key of the end token among the hashes of words.
END = U64(0x5BF03635DEE4C8A7)
_WORDS, _PAIRS, _WINDOWS = range(3)
#: Ids that one row of counts of ids covers.
_SLICE = 1 << 12
_ids: dict[str, Ids] = {}
_scorers: dict[str, tuple] = {}


def _encoder(path: str) -> Ids:
    if path not in _ids:
        _ids.clear()
        _ids[path] = Ids(path)
    return _ids[path]


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word."""
    small = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    begin, end, row = words(small, starts)
    return spans(sums(small), begin, end), row


def _with_end(ids: Ids, data: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    flat, at = ids.of(data, starts)
    return np.insert(flat.astype(np.int64), at[1:], end_id), at + np.arange(len(at))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _stored(size: int) -> str:
    """How ids are written: in two bytes if they fit, -1 as the largest number."""
    return "<u2" if size < 1 << 16 else "<u4"


def _filled(column: pa.Array, size: int) -> np.ndarray:
    kind = np.dtype(_stored(size))
    ids = buffer(column)[0].view(kind).reshape(-1, WIDTH + 1).astype(np.int64)
    ids[ids == np.iinfo(kind).max] = -1
    return ids


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a table of numbers as one binary value."""
    starts = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.itemsize * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(rows))])


def _counts(pairs: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Of a table of counts of ids by group: slices of a group's row, each as its ids above 0 and their counts."""
    slices = -(-pairs.shape[1] // _SLICE)
    for key in range(len(pairs) * slices):
        part = pairs[key // slices, key % slices * _SLICE :][:_SLICE]
        if len(some := np.flatnonzero(part)):
            yield key, np.stack([some, part[some]]).astype("<u4").tobytes()


def _pairs(told: DataFrame, size: int) -> np.ndarray:
    """Counts of ids by group over all partitions; at most GROUPS x size numbers reach the driver."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, key = np.zeros(_SLICE, np.int64), None
        for batch in batches:
            key = batch.column(0)[:1]
            for raw in batch.column(1):
                at, n = np.frombuffer(raw.as_buffer(), "<u4").reshape(2, -1)
                total[at] += n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([key, _binary(some.astype("<u4")[None]), _binary(total[some].astype("<i8")[None])], ["key", "at", "n"])

    counted = told.filter(F.col("kind") == _PAIRS).select("key", "ids").groupBy("key").applyInArrow(added, "key long, at binary, n binary").toArrow()
    slices = -(-size // _SLICE)
    pairs = np.zeros((attention.GROUPS, size))
    for key, at, n in zip(*(column.to_pylist() for column in counted.columns)):
        pairs[key // slices, key % slices * _SLICE + np.frombuffer(at, "<u4").astype(np.int64)] = np.frombuffer(n, "<i8")
    return pairs


def tally(docs: DataFrame, path: str, size: int, end_id: int, train_every: int) -> DataFrame:
    """kind, key, n, ids: what the training documents (`text` of `docs`) hold, one row per partition and key."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, pairs, counted, held, passed = _encoder(path), np.zeros((attention.GROUPS, size), np.int32), [], 0, 0

        def rows(kind: int, keys: np.ndarray, n: np.ndarray, binary: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(keys), 100_000):
                part = slice(i, i + 100_000)
                held = pa.nulls(len(keys[part]), pa.binary()) if binary is None else binary[part]
                columns = [pa.array(np.full(len(keys[part]), kind, np.int32)), pa.array(keys[part].astype(np.uint64).view(np.int64)), pa.array(n[part].astype(np.int64)), held]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "key", "n", "ids"])

        for batch in batches:
            for _, _, data, starts in blocks(batch.column(0)):
                keys, n = np.unique(word_hashes(data, starts)[0], return_counts=True)
                counted += [(keys, n), (np.array([END]), np.array([len(starts) - 1]))]
                held += len(keys)
                if held > 2_000_000:
                    counted = [_merged(counted)]
                    held = len(counted[0][0])
                    if held > 1_000_000:
                        yield from rows(_WORDS, *counted[0])
                        counted, held = [], 0
                flat, at = _with_end(ids, data, starts, end_id)
                before = np.concatenate([[end_id], flat[:-1]])
                before[at[:-1]] = end_id
                np.add.at(pairs.reshape(-1), attention.group_of(before) * size + flat, np.int32(1))  # of the same type: else several times slower
                first, text = attention.windows_of(at)
                chosen = np.arange(-passed % train_every, len(first), train_every)
                passed += len(first)
                filled, _ = attention.fill(flat, at, first[chosen], text[chosen])
                yield from rows(_WINDOWS, np.arange(len(chosen)) + passed, np.ones(len(chosen)), _binary(filled.astype(_stored(size))))
        if counted:
            yield from rows(_WORDS, *_merged(counted))
        if found := list(_counts(pairs)):
            keys, binary = zip(*found)
            yield from rows(_PAIRS, np.array(keys), np.ones(len(keys)), pa.array(binary, pa.binary()))

    ship(docs.sparkSession)
    return docs.select("text").mapInArrow(count, "kind int, key long, n long, ids binary")


def _packed(p: dict[str, np.ndarray]) -> np.ndarray:
    """All parameters in rows of SIZE, "embed" first."""
    rest = np.concatenate([v.ravel() for k, v in p.items() if k != "embed"])
    return np.concatenate([p["embed"], np.pad(rest, (0, -len(rest) % SIZE)).reshape(-1, SIZE)])


def _unpacked(like: dict[str, np.ndarray], packed: np.ndarray) -> dict[str, np.ndarray]:
    out, at, rest = {}, 0, packed[len(like["embed"]) :].ravel()
    for name, v in like.items():
        if name == "embed":
            out[name] = packed[: len(v)].astype(np.float32)
        else:
            out[name] = rest[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
    return out


def train(windows: DataFrame, vocabulary: Vocabulary, *, rounds: int, rate: float, batch_size: int = 64) -> dict[str, np.ndarray]:
    """Parameters after `rounds` rounds; round r uses the windows whose key is r modulo `rounds`."""
    spark = windows.sparkSession
    p = attention.fresh(vocabulary)
    vocab = spark.sparkContext.broadcast((vocabulary.symbol, vocabulary.classes))
    for r in range(rounds):
        begin = spark.sparkContext.broadcast(p)

        def steps(batches: Iterator[pa.RecordBatch], r: int = r, begin=begin) -> Iterator[pa.RecordBatch]:
            own, seen = {k: v.copy() for k, v in begin.value.items()}, 0
            symbol, classes = vocab.value
            optimizer, met = Adam(rate * 0.5**r), np.zeros(len(own["embed"]), np.int64)
            for batch in batches:
                ids = _filled(batch.column(0), len(symbol))
                ids = ids[np.random.default_rng(seen).permutation(len(ids))]
                inputs = attention.model_inputs(symbol, classes, ids)
                for i in range(0, len(ids), batch_size):
                    g, rows, found, n = attention.sparse_gradient(own, *(x[i : i + batch_size] for x in inputs))
                    optimizer.update(own, g, rows, found)
                    met[rows] += n
                seen += len(ids)
            if seen:
                packed = _packed(own).astype(np.float64)
                n = np.concatenate([met, np.full(len(packed) - len(met), seen)])
                for at in np.split(np.flatnonzero(n), range(10_000, np.count_nonzero(n), 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), *(pa.array(packed[at, i] * n[at]) for i in range(SIZE))], ["pos", "n", *values])

        values = [f"v{i}" for i in range(SIZE)]
        done = windows.filter(F.pmod("key", F.lit(rounds)) == r).select("ids").mapInArrow(steps, ", ".join(["pos long", "n long", *(f"{v} double" for v in values)]))
        each = done.groupBy("pos").agg(F.sum("n").alias("n"), *(F.sum(v).alias(v) for v in values)).toArrow()  # as many rows as the model has
        if each.num_rows:
            packed = _packed(p).astype(np.float64)
            packed[each["pos"].to_numpy()] = np.stack([each[v].to_numpy() for v in values], 1) / each["n"].to_numpy()[:, None]
            p = _unpacked(p, packed)
    return p


def _scored(docs: DataFrame, key: str, path: str, end_id: int, model, frequent, end_count: int) -> DataFrame:
    """Of each document: n_tokens, known and base sum over frequent words, the rare ones, and the model's score."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _encoder(path)
        if use not in _scorers:
            _scorers.clear()
            keys, counts = frequent.value
            table = Table(max(4, (2 * len(keys)).bit_length()))
            table.put(keys.view(U64), counts)
            _scorers[use] = (table, *model.value)
        table, vocabulary, p = _scorers[use]
        for batch in batches:
            for first, last, data, starts in blocks(batch.column(2)):
                rows = last - first
                keys, row = word_hashes(data, starts)
                count = table.get(keys)
                common = count >= 0
                n = np.bincount(row, minlength=rows) + 1
                known = np.bincount(row[common], minlength=rows) + (end_count > 0)
                base = np.bincount(row[common], np.log10(count[common] + 0.1), rows) + np.log10(end_count + 0.1)
                rare_row, rare_key = row[~common], keys[~common]
                at = np.searchsorted(rare_row, np.arange(rows + 1)).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(at), pa.array(rare_key.view(np.int64)))
                model_score = attention.score(p, vocabulary, *_with_end(ids, data, starts, end_id))
                part = batch.slice(first, rows)
                columns = [part.column(0), part.column(1), *(pa.array(v.astype(np.int64)) for v in (n, known)), pa.array(base), rare, pa.array(model_score)]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    use = uuid.uuid4().hex
    kinds = {"n_tokens": T.LongType(), "known": T.LongType(), "base": T.DoubleType(), "rare": T.ArrayType(T.LongType()), "score": T.DoubleType()}
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("held_out", T.BooleanType()), *(T.StructField(k, v) for k, v in kinds.items())])
    return docs.select(key, "held_out", "text").mapInArrow(score, schema)


def score_texts(
    docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", end_id: int | None = None,
    train_every: int = 1, rounds: int = 4, rate: float = 0.01, table_words: int = 1 << 20,
) -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    size = tokenizer(path).get_vocab_size()
    end_id = size - 1 if end_id is None else end_id
    held_out = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 10 == 0
    docs = docs.select(F.col(key), held_out.alias("held_out"), F.col(text).alias("text"))
    told = keep(tally(docs.filter(~F.col("held_out")), path, size, end_id, train_every), "tally")

    words_ = keep(told.filter(F.col("kind") == _WORDS).groupBy("key").agg(F.sum("n").alias("n")), "words")
    end = F.sum(F.when(F.col("key") == int(END.view(np.int64)), F.col("n")))
    tokens, distinct, end_count = (v or 0 for v in words_.agg(F.sum("n"), F.count("*"), end).first())
    # The least count of which no more than `table_words` words have as many.
    sizes = words_.groupBy(F.least("n", F.lit(1000)).alias("n")).agg(F.count("*").alias("words")).toArrow().sort_by([("n", "descending")])
    reached = np.cumsum(sizes["words"].to_numpy()) if sizes.num_rows else np.zeros(0)
    fit = int(np.searchsorted(reached, table_words, "right"))
    least = sizes["n"].to_numpy()[fit - 1] if fit else np.iinfo(np.int64).max
    common = words_.filter(F.col("n") >= int(least)).toArrow()
    frequent = spark.sparkContext.broadcast((common["key"].to_numpy(), common["n"].to_numpy()))

    vocabulary = Vocabulary(_pairs(told, size))
    p = train(told.filter(F.col("kind") == _WINDOWS), vocabulary, rounds=rounds, rate=rate)
    model = spark.sparkContext.broadcast((vocabulary, p))

    found = _scored(docs, key, path, end_id, model, frequent, int(end_count))
    found = keep(found.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = found.select("row", F.explode("rare").alias("key"))
    met = rare.join(words_.filter(F.col("n") < int(least)), "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    met = met.groupBy("row").agg(F.sum(F.log10(F.col("n") + 0.1)).alias("rare_base"), F.count_if(F.col("n") > 0).alias("rare_known"))
    whole = float(np.log10(tokens + 0.1 * (distinct + 1)))
    joined = found.drop("rare").join(met, "row", "left")
    return joined.select(
        key, "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(whole)).alias("base_score"), "score",
    )
