import random

import numpy as np

from brute import documents, near_classes, odd_texts, rows, with_clashes
from tidelog.llm import near_dup
from tidelog.llm.buffers import mix
from tidelog.llm.components import components
from tidelog.llm.dart_minhash import signatures


def family(seed, n, size=120):
    """An original and copies with ever more edits."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefgh", k=4)) for _ in range(500)]
    base = [draw.choice(vocabulary) for _ in range(size)]
    for k in range(n):
        copy = base[:]
        for _ in range(k % 12):
            copy[draw.randrange(size)] = draw.choice(vocabulary)
        yield " ".join(copy)


def test_classes_are_those_of_all_pairs(spark):
    texts = odd_texts() + list(enumerate((t for seed in range(6) for t in family(seed, 25)), 100))
    found = near_dup.classes(with_clashes(documents(spark, texts), "class_id", "node", "h1"))
    want = sorted(((i, c) for (i, _), c in zip(texts, near_classes(texts))), key=repr)
    assert rows(found, "doc_id", "class_id") == want
    lead = [(r["class_id"], r["doc_id"]) for r in found.filter("representative").select("class_id", "doc_id").distinct().collect()]
    assert all(a == b for a, b in lead) and len(lead) == len({c for c in near_classes(texts)})


def test_thin_keeps_one_row_of_each_class(spark):
    texts = odd_texts() + list(enumerate(family(1, 12), 100))
    docs = with_clashes(documents(spark, texts), "h1", "same_rows", "kept_key")
    kept = near_dup.thin(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in rows(kept, "doc_id") if r[0] is not None} == {c for c in near_classes(texts) if c is not None}
    assert kept.count() == len(set(near_classes(texts))) + 1  # two classes are led by documents of id 9


def test_large_buckets_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "FEW", 1)
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    texts = list(enumerate(family(9, 60)))
    assert rows(near_dup.classes(documents(spark, texts)), "doc_id", "class_id") == sorted(((i, c) for (i, _), c in zip(texts, near_classes(texts))), key=repr)


def test_empty_table(spark):
    assert near_dup.classes(documents(spark, [])).count() == 0
    assert near_dup.thin(documents(spark, [])).count() == 0


def test_signatures_estimate_the_weighted_similarity():
    draw = np.random.default_rng(5)
    one = draw.integers(0, 6, 400).astype(float)
    two = np.where(draw.random(400) < 0.8, one, draw.integers(0, 6, 400) + 0.5)
    element = mix(np.arange(1, 401, dtype=np.uint64))
    row = np.repeat([0, 1], [(one > 0).sum(), (two > 0).sum()])
    found = signatures(row, np.concatenate([element[one > 0], element[two > 0]]), np.concatenate([one[one > 0], two[two > 0]]), 3, 6000)
    assert abs((found[0] == found[1]).mean() - np.minimum(one, two).sum() / np.maximum(one, two).sum()) < 0.025
    assert not found[2].any() and found[:2].all()


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}
    for a, b in edges:
        if a == b:
            continue
        one, two = a, b
        while parent.get(one, one) != one:
            one = parent[one]
        while parent.get(two, two) != two:
            two = parent[two]
        parent.setdefault(a, a), parent.setdefault(b, b)
        parent[max(one, two)] = min(one, two)

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert rows(found, "node", "root") == sorted(((x, top(x)) for x in parent), key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
