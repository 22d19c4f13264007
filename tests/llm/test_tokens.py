import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from brute import documents, odd_texts, rows, with_clashes
from tidelog.llm import packing, token_counts, vocab
from tidelog.llm.queries import BYTE_BPE, WORD_BPE

TEXTS = odd_texts() + list(
    enumerate(
        ["a  b", " a", "a ", "\n", "a\n b", "a \nb", "it's he'll o!'s 'a", "x<|endoftext|>y <|endoftext|> z", "x<|end oftext|>", "İstanbul ΣΑΣ", "a\xa0b", "a \xa0b", "a\xa0 b c", "a   b\n\n\nc", "a,b,.c!d \"e\" f.g", "A\n", "a \r\n b  ", "3.14 a1b2 1,000", "x" * 3000, "\xa0", "。、a …—b", "word### other***", "### word !"],
        100,
    )
)


def test_counts_are_those_of_the_library(spark):
    encode = Tokenizer.from_file(BYTE_BPE).encode
    docs = with_clashes(documents(spark, TEXTS), "n_tokens", "n_bytes")
    counted = token_counts.count_tokens(docs, BYTE_BPE, table_size=50)
    want = [(i, len((t or "").encode()), n := len(encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in TEXTS]
    assert rows(counted, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def test_the_table_changes_no_count(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    few, many = (token_counts.count_tokens(docs, BYTE_BPE, table_size=n, table_documents=d) for n, d in ((1, 1), (60_000, 100)))
    encode = Tokenizer.from_file(BYTE_BPE).encode
    want = sorted(((r["doc_id"], len(encode(r["text"], add_special_tokens=False).ids)) for r in docs.collect()), key=repr)
    assert rows(few, "doc_id", "n_tokens") == rows(many, "doc_id", "n_tokens") == want


@pytest.mark.parametrize("operator", [lambda d: token_counts.count_tokens(d, BYTE_BPE), lambda d: packing.pack(d, WORD_BPE)])
def test_empty_table(spark, operator):
    assert operator(documents(spark, [])).count() == 0


def pieces(texts, capacity):
    encode = Tokenizer.from_file(WORD_BPE).encode
    for i, t in texts:
        ids = np.array([*encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            yield i, k // capacity, k, len(part), zlib.crc32(part.tobytes())


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(spark, capacity):
    packed = packing.pack(with_clashes(documents(spark, TEXTS), "row", "part", "piece"), WORD_BPE, capacity=capacity).toPandas()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    have = [tuple(None if v != v else int(v) for v in r) for r in packed[names].itertuples(index=False)]
    assert sorted(have, key=repr) == sorted(pieces(TEXTS, capacity), key=repr)
    for _, each in packed.sort_values("offset").groupby("sequence_id"):
        ends = each["length"].cumsum()
        assert each["offset"].tolist() == [0, *ends[:-1]] and ends.iloc[-1] <= capacity
    assert packed["sequence_id"].nunique() <= 1.02 * packed["length"].sum() / capacity + 2


def test_sequences_hold_the_ids(spark):
    texts = [(i, t) for i, (_, t) in enumerate(TEXTS)]
    docs = documents(spark, texts)
    placed = packing.pack(docs, WORD_BPE, capacity=64)
    made = {r["sequence_id"]: r["ids"] for r in packing.sequences(docs, placed, WORD_BPE, capacity=64).collect()}
    for r in placed.collect():
        part = made[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]


def test_sum_of_squares_comes_close_to_the_fewest():
    lengths = np.random.default_rng(3).integers(1, 1500, 3000)
    bins, offsets = packing.sum_of_squares(lengths, 2048)
    filled = np.bincount(bins, lengths)
    assert filled.max() <= 2048 and len(filled) <= 1.01 * lengths.sum() / 2048 + 1
    assert all(np.diff(np.sort(offsets[bins == b])).min(initial=1) > 0 for b in range(50))


def test_words_of_letters_have_the_library_s_ids():
    draw = random.Random(5)
    letters = [*"etaoinshrz", *(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)]
    texts = ["".join(draw.choices(letters, k=draw.randrange(1, 70))) for _ in range(3000)]
    pieces = [t.encode() for t in texts] + [b"it's", b"'s", "÷".encode(), b"a1b", "é".encode(), b"***"]
    assert vocab.takes_words(WORD_BPE) and vocab.Ids(WORD_BPE).encode(pieces) == vocab.encode(WORD_BPE, pieces)
