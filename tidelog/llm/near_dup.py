"""Near-duplicate documents: weighted Jaccard similarity of word shingles, found by DartMinHash and banded joins.

1. Equal texts are one node (128-bit content hash), whatever their number.
2. Each node's shingles, weighted by their counts, give a DartMinHash signature; its coordinates are cut into bands.
3. Nodes that share a band are linked to two hubs of that bucket, not to each other, and each link is verified on the
   texts by the exact similarity. A pair of similarity 0.8 shares no band with probability 2e-5.
4. Connected components of the verified links are the classes so far. Buckets whose members fall into several classes are
   then searched exhaustively, block by block: members of different classes whose signatures may reach the threshold are
   compared exactly, and links that join classes come back, fewer than a block has members. So a member that resembles
   no hub is not lost, and a bucket whose members are of one class, however large, is not searched.

Defined results. Words are runs of bytes other than space and 0x09-0x0D; a text of fewer words than a shingle is one
shingle; a null text or one without words is alone in its class, unless it is equal to others; a null text counts as
empty. Rows with equal ids, or null ids, are documents of their own: their class depends on their text. The class id is
the least id in the class (null if all are null). Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.buffers import U64, blocks, flat, in_row, mix, spans, sums, windows, words
from tidelog.llm.components import components
from tidelog.llm.dart_minhash import signatures
from tidelog.llm.scratch import keep, ship

BANDS, ROWS = 28, 5
#: Members of a bucket that are compared at once.
BLOCK = 512
#: Buckets of so few members are joined with themselves instead.
FEW = 8


def shingles(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row: row, hash, count."""
    begin, end, row = words(data, starts)
    each = spans(sums(data), begin, end)
    found = windows(each, size)
    at = np.flatnonzero(in_row(row, size))
    count = np.bincount(row, minlength=len(starts) - 1)
    short = np.flatnonzero((count > 0) & (count < size))
    first = np.searchsorted(row, short)
    alone = [mix(np.array([hash_of(each[f : f + c])], U64))[0] for f, c in zip(first.tolist(), count[short].tolist())]
    rows, hashes = np.concatenate([row[at], short]), np.concatenate([found[at], np.array(alone, U64)])
    key = (rows.astype(U64) << U64(44)) | (hashes >> U64(20))  # 44 bits tell apart the shingles of one text
    key, counts = np.unique(key, return_counts=True)
    return (key >> U64(44)).astype(np.int64), key & U64((1 << 44) - 1), counts


def hash_of(parts: np.ndarray) -> int:
    total = len(parts)
    for p in parts.tolist():
        total = (total * 0xA0761D6478BD642F + p) % (1 << 64)
    return total


def content(text: str) -> dict[str, Column]:
    """128 bits of a text's content, as two numbers."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return {"h1": F.xxhash64(F.lit(1), whole), "h2": F.xxhash64(F.lit(2), whole)}


def signed(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """key, h1, h2, signature (32 bits of each coordinate; null without words), of each document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in blocks(batch.column(3)):
                part = batch.slice(first, last - first)
                row, element, count = shingles(data, starts, size)
                found = signatures(row, mix(element), count.astype(np.float64), last - first, BANDS * ROWS)
                raw = (found >> U64(32)).astype("<u4").tobytes()
                some = np.bincount(row, minlength=last - first) > 0
                step = 4 * BANDS * ROWS
                column = pa.array([raw[i * step : (i + 1) * step] if s else None for i, s in enumerate(some.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], column], names)

    names = [key, "h1", "h2", "signature"]
    kinds = [docs.schema[key].dataType, T.LongType(), T.LongType(), T.BinaryType()]
    return docs.select(key, *(c.alias(n) for n, c in content(text).items()), text).mapInArrow(sign, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))


def band_keys(nodes: DataFrame) -> DataFrame:
    """node, band key of each node and band."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(1).is_valid())
            if batch.num_rows:
                data, _ = flat(batch.column(1))
                found = np.ascontiguousarray(data).view("<u4").reshape(-1, BANDS, ROWS).astype(U64)
                keys = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=U64)), found.shape[:2]).copy()
                for i in range(ROWS):
                    keys = mix(keys * U64(0xA0761D6478BD642F) + found[:, :, i])
                node = np.repeat(batch.column(0).to_numpy(), BANDS)
                band = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(keys.ravel().view(np.int64)), pa.array(band)], ["node", "bucket", "band"])

    return nodes.select("node", "signature").mapInArrow(cut, "node long, bucket long, band int")


def similarities(pairs: DataFrame, size: int) -> DataFrame:
    """Adds the weighted Jaccard similarity of text_a and text_b; drops the texts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                n = part.num_rows
                sides = [shingles(*flat(part.column(i)), size) for i in (2, 3)]
                keys = [(row.astype(U64) << U64(44)) | element for row, element, _ in sides]
                _, left, right = np.intersect1d(*keys, assume_unique=True, return_indices=True)
                common = np.bincount(sides[0][0][left], np.minimum(sides[0][2][left], sides[1][2][right]), n)
                total = sum(np.bincount(row, count, n) for row, _, count in sides)
                out[at : at + n] = np.divide(common, total - common, out=np.zeros(n), where=total > common)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], ["a", "b", "similarity"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long, similarity double")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Those pairs of nodes (a, b) that reach the threshold."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return similarities(pairs.join(one, "a").join(two, "b"), size).filter(F.col("similarity") >= threshold).select("a", "b")


def _buckets(bands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Buckets of several nodes: (bucket, first, second, n), and (bucket, node). The hubs are the least node, and the one of the least hash."""
    other = F.xxhash64("node")
    hubs = bands.groupBy("bucket").agg(F.min("node").alias("first"), F.min(other).alias("second"), F.count("*").alias("n")).filter("n > 1")
    hubs = keep(hubs, "hubs")
    return hubs, keep(bands.join(hubs, "bucket").select("bucket", "band", "node", "first", (other == F.col("second")).alias("is_second")), "members")


def _hub_pairs(members: DataFrame) -> DataFrame:
    second = members.filter("is_second").select("bucket", F.col("node").alias("b"))
    to_second = members.join(keep(second, "second"), "bucket").select(F.col("node").alias("a"), "b")
    return _ordered(members.select(F.col("node").alias("a"), F.col("first").alias("b")).unionByName(to_second))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _links_across(size: int, threshold: float, least_agreement: int):
    """Links that join different classes, among the members of a block or between two blocks.

    A pair is looked at in the first bucket that it shares. Those whose signatures may reach the threshold are compared
    exactly, unless links found before already join their classes; so a group returns fewer links than it has members.
    """

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        side, band = rows["side"].to_numpy(), int(rows["band"][0].as_py())
        node, root = rows["node"].to_numpy(), rows["root"].to_numpy()
        raw, _ = flat(rows["signature"].combine_chunks())
        signature = np.ascontiguousarray(raw).view("<u4").reshape(len(node), -1)
        row, element, count = shingles(*flat(rows["text"].combine_chunks()), size)
        _, element = np.unique(element, return_inverse=True)
        at, total = np.searchsorted(row, np.arange(len(node) + 1)), np.bincount(row, count, len(node))
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        held, found = np.zeros(element.max(initial=-1) + 1, np.int64), []
        ones, twos = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        for i in ones.tolist():
            others = twos[(root[twos] != root[i]) & ((side[twos] == 1) | (twos > i))]
            agree = signature[others] == signature[i]
            others = others[(agree.sum(1) >= least_agreement) & (agree.reshape(len(others), BANDS, ROWS).all(2).argmax(1) == band)]
            if not len(others):
                continue
            own = slice(at[i], at[i + 1])
            held[element[own]] = count[own]
            for j in others.tolist():
                one, two = top(int(root[i])), top(int(root[j]))
                theirs = slice(at[j], at[j + 1])
                if one != two:
                    common = int(np.minimum(held[element[theirs]], count[theirs]).sum())
                    if common >= threshold * (total[i] + total[j] - common):
                        parent[max(one, two)] = min(one, two)
                        found.append((node[i], node[j]))
            held[element[own]] = 0
        one, two = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(one, pa.int64()), "b": pa.array(two, pa.int64())})

    return compare


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """bucket, band, node, root, n, blocks of the members of buckets in which several classes meet."""
    placed = members.select("bucket", "band", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = keep(placed, "placed")
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).filter("low < high")
    mixed = keep(mixed.select("bucket", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks"), "n"), "mixed")
    return keep(placed.join(mixed, "bucket"), "mixed_members")


def _missed_in_small(rows: DataFrame) -> DataFrame:
    """Pairs of different classes in buckets of few members."""
    few = rows.filter(F.col("n") <= FEW).select("bucket", "node", "root")
    other = few.select("bucket", F.col("node").alias("b"), F.col("root").alias("root_b"))
    return _ordered(few.join(other, "bucket").filter("root < root_b").select(F.col("node").alias("a"), "b"))


def _missed_in_large(rows: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Links between different classes in the other buckets."""
    # A block meets itself and every other block of its bucket; the pair of blocks is the group.
    many = rows.filter(F.col("n") > FEW).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    wanted = keep(nodes.select("node", "signature").join(many.select("node").distinct(), "node").join(texts, "node"), "wanted")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = many.join(wanted, "node").withColumn("other", each).select(
        "bucket", "band", "node", "root", "signature", "text",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    # Four standard deviations below the threshold, in agreeing coordinates.
    k = BANDS * ROWS
    least_agreement = int(k * threshold - 4 * (k * threshold * (1 - threshold)) ** 0.5)
    return dealt.groupBy("bucket", "low", "high").applyInArrow(_links_across(size, threshold, least_agreement), "a long, b long")


def classes(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per document: key, h1, h2 (its content), class_id, class_size (documents), representative.

    `representative` is true for the documents with the content and id that stand for their class.
    """
    ship(docs.sparkSession)
    found = keep(signed(docs, key, text, size), "signed")
    copies = found.groupBy("h1", "h2").agg(F.min(key).alias("least"), F.count("*").alias("copies"), F.first("signature").alias("signature"))
    nodes = keep(copies.withColumn("node", F.col("h1")), "nodes")
    hubs, members = _buckets(keep(band_keys(nodes), "bands"))
    candidates = keep(_hub_pairs(members), "candidates")
    # Texts of the nodes that occur in a bucket, once each.
    wanted = nodes.select("node", "least", "h1", "h2").join(members.select("node").distinct(), "node")
    held = docs.select(F.col(key).alias("least"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumns(content("text"))
    same = [held[c].eqNullSafe(wanted[c]) for c in ("least", "h1", "h2")]
    texts = keep(held.join(wanted, (held["h1"] == wanted["h1"]) & same[0] & same[2]).select("node", "text").dropDuplicates(["node"]), "texts")
    links = keep(_verified(candidates, texts, size, threshold), "links")
    rows = _placed(members, components(links))
    small = keep(_missed_in_small(rows).join(candidates, ["a", "b"], "left_anti"), "small")
    more = _verified(small, texts, size, threshold).unionByName(_missed_in_large(rows, nodes, texts, size, threshold))
    roots = components(links.unionByName(keep(more, "more")))
    return _result(found, nodes, roots, key)


def _result(found: DataFrame, nodes: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    whole = placed.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"), F.min(F.when(F.col("least").isNotNull(), F.col("least"))).alias("lead"))
    lead = placed.join(whole, "root").filter(F.col("least").eqNullSafe(F.col("lead"))).groupBy("root").agg(F.min("node").alias("lead_node"))
    named = keep(placed.join(whole, "root").join(lead, "root").select("h1", "h2", "class_id", "class_size", (F.col("node") == F.col("lead_node")).alias("lead")), "classes")
    return found.select(key, "h1", "h2").join(named, ["h1", "h2"]).select(
        key, "h1", "h2", "class_id", "class_size", (F.col("lead") & F.col(key).eqNullSafe(F.col("class_id"))).alias("representative")
    )


def thin(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8) -> DataFrame:
    """`docs`, all columns, with one document of each class: the one of the least id (of equal rows, one)."""
    kept = classes(docs, key=key, text=text, size=size, threshold=threshold).filter("representative")
    kept = keep(kept.groupBy(F.col(key).alias("kept_key"), F.col("h1").alias("k1"), F.col("h2").alias("k2")).agg(F.count("*").alias("same_rows")), "kept")
    names = [f"own_{i}" for i in range(len(docs.columns))]  # whatever the columns are called
    own = dict(zip(docs.columns, names))
    held = docs.toDF(*names).withColumns(content(own[text]))
    held = held.join(kept, (held["h1"] == kept["k1"]) & (held["h2"] == kept["k2"]) & held[own[key]].eqNullSafe(kept["kept_key"]))
    if not kept.filter("same_rows > 1").isEmpty():
        again = held.filter("same_rows > 1").dropDuplicates([own[key], "h1", "h2"])
        held = held.filter("same_rows = 1").unionByName(again)
    return held.select(*names).toDF(*docs.columns)
