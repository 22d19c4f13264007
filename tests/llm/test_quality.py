import random
import re
from collections import Counter

import numpy as np

from brute import WORD, documents, odd_texts, rows, with_clashes, words
from tidelog.llm import quality


def base(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = [False] * len(w)
    for i in range(len(w) - 7):
        if count[tuple(w[i : i + 8])] > 1:
            cover[i : i + 8] = [True] * 8
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(cover)


def prose(seed, n=120):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("etaoinshr", k=draw.randrange(2, 9))) for _ in range(n))


def test_base_statistics(spark):
    texts = odd_texts() + [(50, "a\nb\na\n\n \nb\na"), (51, "# * $ %&|<> #"), (52, "w " * 30), (53, "x\ny z " * 12)] + [(60 + i, prose(i)) for i in range(20)]
    judged = quality.judge(with_clashes(documents(spark, texts), "n_words", "x0", "bin"))
    want = []
    for i, t in texts:
        b = base(t)
        want.append((i, *b, b[0] < 20 or 100 * b[4] > 30 * b[0]))
    assert rows(judged, "doc_id", *quality.BASE, "base_failed") == sorted(want, key=repr)
    assert judged.filter("base_failed and kept").count() == 0


def test_outliers_go_and_clean_texts_stay(spark):
    clean = [(i, prose(i, 60 + i % 300)) for i in range(400)]
    junk = [(1000 + i, " ".join(w + "###" for w in words(prose(i)))) for i in range(60)] + [(2000 + i, " ".join(w * 3 for w in words(prose(i)))) for i in range(60)]
    docs = documents(spark, clean + junk).unionByName(documents(spark, [(5000 + i, t) for i, t in clean[:5]], lang=None, source=None))
    kept = {r[0] for r in rows(quality.judge(docs).filter("kept"), "doc_id")}
    assert {i for i, _ in clean} <= kept and not kept & {i for i, _ in junk} and {5000 + i for i in range(5)} <= kept
    clashing = with_clashes(docs, "n_words", "doc", "h")
    whole = quality.judge(clashing, whole=True)
    assert whole.columns == clashing.columns and {r[0] for r in rows(whole, "doc_id")} == kept


def test_short_junk_and_repeats_alone_go(spark):
    clean = [(i, prose(i, 60 + i % 300)) for i in range(400)]
    short = [(1000 + i, " ".join(w + "#" * (k % 5 < 2) for k, w in enumerate(words(prose(i, 80))))) for i in range(20)]
    repeats = []
    for i in range(10):
        passage = prose(3000 + i, 100)  # read twice in a text of 700 words: 0.29 of it, below the base rule
        repeats.append((2000 + i, f"{prose(i, 250)} {passage} {prose(4000 + i, 250)} {passage}"))
    kept = {r[0] for r in rows(quality.judge(documents(spark, clean + short + repeats)).filter("kept"), "doc_id")}
    assert kept == {i for i, _ in clean}


def test_distance_is_that_of_numpy(spark):
    """The estimate of a large, clean group is close to the plain one of its core, and distances follow from it."""
    docs = documents(spark, [(i, prose(i, 150)) for i in range(300)])
    found = quality.vectors(quality.statistics(docs), (5.0, 0.0), 60)
    known = quality.estimates(found, core=0.75, prior_docs=0.0, steps=12).first()
    x = np.array([[r[c] for c in quality.VECTOR] for r in found.collect()])
    centre = np.array([known[f"m{i}"] for i in range(4)])
    inverse = np.zeros((4, 4))
    for i in range(4):
        for j in range(i, 4):
            inverse[i, j] = inverse[j, i] = known[f"v{i}{j}"]
    d2 = np.einsum("ni,ij,nj->n", x - centre, inverse, x - centre)
    core = x[np.argsort(d2)[: int(known["h"])]]
    assert known["h"] >= 225 and np.allclose(core.mean(0), centre, atol=2e-3)


def test_empty_table(spark):
    assert quality.judge(documents(spark, [])).count() == 0
    assert quality.judge(documents(spark, []), whole=True).count() == 0


def test_all_fail(spark):
    assert rows(quality.judge(documents(spark, [(1, "a b"), (2, None)])), "doc_id", "kept") == [(1, False), (2, False)]
