import hashlib
import random

import numpy as np
import pytest

from brute import documents, odd_texts, rows, with_clashes
from tidelog.llm import suffix_dedup
from tidelog.llm.bwt import Shard, merge


def expected(texts, length):
    raw = [(t or "").encode() for _, t in texts]
    places = {}
    for d, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            places.setdefault(b[i : i + length], []).append((d, i))
    gone = [np.zeros(len(b), bool) for b in raw]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                gone[d][i : i + length] = True
    for (i, _), b, g in zip(texts, raw, gone):
        kept = bytes(np.frombuffer(b, np.uint8)[~g]) if b else b""
        yield i, len(b), int(g.sum()), int((g & ~np.concatenate([[False], g[:-1]])).sum()) if len(g) else 0, hashlib.sha256(kept).hexdigest()


def planted(seed, length):
    draw = random.Random(seed)
    noise = lambda n: "".join(draw.choices("abcdeé \n", k=n))
    parts = [noise(n) for n in (length - 40, length - 1, length, length + 1, 3 * length)]
    texts = [(i, "".join(draw.choice([noise(draw.randrange(2 * length)), draw.choice(parts)]) for _ in range(4))) for i in range(60)]
    texts += [(100, "ab" * 2 * length), (101, "x" * 5 * length), (102, parts[2] * 3), (103, texts[0][1]), (104, parts[4]), (105, parts[4][7:-9])]
    return texts + [t for t in odd_texts() if len(t[1] or "") < 2000]


@pytest.mark.parametrize("salted", [False, True])
def test_against_all_windows(spark, monkeypatch, salted):
    # 144 bytes: the same code on shorter strings, so that brute force stays small
    if salted:
        monkeypatch.setattr(suffix_dedup, "MOST", 3)
        monkeypatch.setattr(suffix_dedup, "SHARD", 100)
        monkeypatch.setattr(suffix_dedup, "TOGETHER", 3000)
    for seed in (1, 2):
        texts = planted(seed, 144)
        docs = with_clashes(documents(spark, texts), "h1", "low", "stays", "n_bytes")
        kept = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in suffix_dedup.remove(docs, length=144).collect()]
        assert sorted(kept, key=repr) == sorted(expected(texts, 144), key=repr)


def test_query(spark, sf_dir):
    from tidelog.llm import queries

    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = rows(queries.op6_suffix_dedup(spark, sf_dir), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == sorted(expected(texts, 400), key=repr)


def test_empty_table(spark):
    assert suffix_dedup.remove(documents(spark, [])).count() == 0


def test_merged_transforms_are_in_suffix_order():
    draw = np.random.default_rng(4)
    for depth in (1, 3, 8):
        groups = [[draw.integers(1, 4, draw.integers(0, 9)) for _ in range(draw.integers(1, 6))] for _ in range(4)]
        shards, suffixes = [], []
        for g, strings in enumerate(groups):
            text = np.concatenate([np.append(s, 0) for s in strings]).astype(np.int64)
            starts = np.cumsum([0] + [len(s) + 1 for s in strings[:-1]])
            shards.append(Shard(text, starts))
            suffixes.append([tuple(s[i:].tolist()) for s in strings for i in range(len(s) + 1)])
        source, interval = merge(shards, depth)
        orders = [iter(s.order.tolist()) for s in shards]
        merged = [suffixes[g][next(orders[g])] for g in source.tolist()]
        assert [m[:depth] for m in merged] == sorted(m[:depth] for m in merged)
        for i in range(1, len(merged)):
            same = len(merged[i]) >= depth and merged[i][:depth] == merged[i - 1][:depth]
            assert same == (interval[i] == interval[i - 1])
