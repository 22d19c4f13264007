"""Plain restatements of what the operators compute, and odd tables to run them on."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENT = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


def words(text):
    return WORD.findall(text or "")


def documents(spark, texts, lang="en", source="s"):
    """(id, text) pairs as a table of documents."""
    return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in texts], DOCUMENT)


def odd_texts():
    long = "alpha beta gamma delta epsilon zeta eta theta. " * 3000
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one two"), (6, long), (7, long), (8, "é́ 日本\xa0語 \x1c x"), (9, "a  b \n\n c"), (9, "another text")]


def with_clashes(docs, *names):
    """`docs` with further columns of the given names."""
    return docs.withColumns({n: F.lit("clash") for n in names})


def rows(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.select(*names).collect()), key=repr)


def shingles(text, size=5):
    w = words(text)
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def jaccard(a, b):
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 0.0


def near_classes(texts, threshold=0.8):
    """Class of each row by all pairs of distinct texts: the least id, nulls last."""
    distinct = sorted({t or "" for _, t in texts})
    parent = {t: t for t in distinct}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {t: shingles(t) for t in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if jaccard(sets[a], sets[b]) >= threshold:
                parent[top(a)] = top(b)
    ids = {}
    for i, t in texts:
        if i is not None:
            ids[top(t or "")] = min(i, ids.get(top(t or ""), i))
    return [ids.get(top(t or "")) for _, t in texts]
