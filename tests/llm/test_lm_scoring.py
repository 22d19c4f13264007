import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from brute import documents, odd_texts, with_clashes, words
from tidelog.llm import attention, lm_scoring
from tidelog.llm.queries import WORD_BPE
from tidelog.llm.vocab import Ids


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def held(key):
    return zlib.crc32(str(key if key is not None else "").encode()) % 10 == 0


def base_scores(texts):
    tokens = [[*words(lower(t)), None] for _, t in texts]
    count = Counter(w for (i, _), ts in zip(texts, tokens) if not held(i) for w in ts)
    total, distinct = sum(count.values()), len(count)
    for (i, _), ts in zip(texts, tokens):
        score = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ts)
        yield i, held(i), len(ts), sum(count[w] > 0 for w in ts), total, score


def corpus():
    draw = random.Random(3)
    parts = ["th", "ing", "er", "on", "re", "tion", "and", "ed"]
    word = lambda: draw.choice(["the", "of", "and", "to"]) if draw.random() < 0.5 else "".join(draw.choices(parts, k=draw.randrange(1, 4)))
    return [(i, " ".join(word() for _ in range(150))) for i in range(200)] + odd_texts()


@pytest.mark.parametrize("table_words", [1 << 20, 40, 0])
def test_base_scores(spark, table_words):
    texts = corpus()
    found = lm_scoring.score_texts(with_clashes(documents(spark, texts), "held_out", "row", "n", "kind"), WORD_BPE, table_words=table_words, rounds=1).collect()
    have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found), key=repr)
    for a, b in zip(have, sorted(base_scores(texts), key=repr), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r["score"] < 0 for r in found)


def test_attention_learns(spark):
    texts = corpus()[:200]
    docs = documents(spark, texts)
    trained = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(docs, WORD_BPE, train_every=1).collect()}
    untrained = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(docs, WORD_BPE, rounds=0).collect()}
    out = [i for i, _ in texts if held(i)]
    assert out and sum(trained[i] for i in out) > sum(untrained[i] for i in out)


def test_empty_table(spark):
    assert lm_scoring.score_texts(documents(spark, []), WORD_BPE).count() == 0


def small_vocabulary():
    draw = np.random.default_rng(0)
    pairs = draw.poisson(draw.gamma(0.1, 20, size=(attention.GROUPS, 300)))
    return attention.Vocabulary(pairs.astype(float))


def test_probabilities_sum_to_one():
    v = small_vocabulary()
    p = attention.fresh(v)
    symbols = np.random.default_rng(1).integers(0, 300, (2, attention.WIDTH))
    log_p, _ = attention.forward(p, symbols)
    for group in (0, 77):
        whole = np.exp(log_p[:, v.classes] + v.log_share[group]).sum(1)
        assert np.allclose(whole, 1, atol=1e-4)


def test_a_state_sees_only_what_is_before_it():
    v = small_vocabulary()
    p = attention.fresh(v)
    one = np.random.default_rng(1).integers(0, 300, (1, attention.WIDTH))
    two = one.copy()
    two[0, attention.CONTEXT + 10 :] = 5
    a, b = (attention.forward(p, s)[0] for s in (one, two))
    assert np.allclose(a[:10], b[:10], atol=1e-5) and not np.allclose(a[10:], b[10:], atol=1e-5)


def test_gradient_against_differences():
    v = small_vocabulary()
    p = {k: x.astype(np.float64) for k, x in attention.fresh(v).items()}
    ids = np.random.default_rng(2).integers(0, 300, (4, attention.WIDTH + 1))
    inputs = attention.model_inputs(v.symbol, v.classes, ids)
    g, _ = attention.gradient(p, *inputs)
    for name, d in g.items():
        at = np.unravel_index(np.abs(d).argmax(), d.shape)
        losses = []
        for step in (1e-4, -1e-4):
            q = {k: x.copy() for k, x in p.items()}
            q[name][at] += step
            losses.append(attention.gradient(q, *inputs)[1])
        assert (losses[0] - losses[1]) / 2e-4 == pytest.approx(d[at], rel=1e-3)


def test_each_id_is_scored_once_with_its_context():
    v = small_vocabulary()
    p = attention.fresh(v)
    draw = np.random.default_rng(3)
    sizes = [1, 2, 23, 24, 25, 100]
    starts = np.cumsum([0, *sizes])
    flat = draw.integers(0, 300, starts[-1])
    scores = attention.score(p, v, flat, starts, batch=3)
    for k, size in enumerate(sizes):
        ids, total = flat[starts[k] : starts[k + 1]], 0.0
        for i in range(size):
            window = i // attention.SCORED * attention.SCORED
            before = np.full(attention.WIDTH + 1, -1)
            for j in range(attention.WIDTH + 1):
                at = window - attention.CONTEXT - 1 + j
                if 0 <= at <= i:
                    before[j] = ids[at]
            symbols, classes, _ = attention.model_inputs(v.symbol, v.classes, before[None])
            log_p, _ = attention.forward(p, symbols)
            previous = attention.group_of(before[attention.CONTEXT + i - window : attention.CONTEXT + i - window + 1])[0]
            total += log_p[i - window, v.classes[ids[i]]] + v.log_share[previous, ids[i]]
        assert scores[k] == pytest.approx(total / math.log(10), rel=1e-4)


def test_all_windows_of_all_training_texts_are_trained_on(spark, monkeypatch):
    texts = corpus()[:60]
    ids, seen = Ids(WORD_BPE), []
    monkeypatch.setattr(lm_scoring, "train", lambda windows, vocabulary, **_: seen.append(windows.count()) or attention.fresh(vocabulary))
    lm_scoring.score_texts(documents(spark, texts), WORD_BPE).count()
    sizes = [len(ids.of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0]) + 1 for i, t in texts if not held(i)]
    assert seen == [sum(-(-n // attention.SCORED) for n in sizes)]


def test_rare_ids_stay_distinct():
    v = attention.Vocabulary(np.tile(1.0 + np.arange(3000.0, 0, -1), (attention.GROUPS, 1)))
    p = attention.fresh(v)
    filled = np.full((2, attention.WIDTH + 1), 5)
    filled[:, attention.CONTEXT] = 2500, 2900
    one, two = (attention.forward(p, attention.model_inputs(v.symbol, v.classes, filled[k : k + 1])[0])[0] for k in (0, 1))
    assert not np.allclose(one, two, atol=1e-5)


def test_wide_ids_and_gaps_survive_storage():
    for size in (49_408, 70_000):
        filled = np.array([[-1, 0, size - 1] + [7] * (attention.WIDTH - 2)])
        column = pa.array([w.tobytes() for w in filled.astype(lm_scoring._stored(size))], pa.binary())
        assert (lm_scoring._filled(column, size) == filled).all()


def test_counts_of_ids_are_a_few_rows_of_each_partition(spark):
    texts = corpus()[:60]
    ids = Ids(WORD_BPE)
    size = lm_scoring.tokenizer(WORD_BPE).get_vocab_size()
    told = lm_scoring.tally(documents(spark, texts).repartition(3).select("text"), WORD_BPE, size, size - 1, 1).persist()
    want = np.zeros((attention.GROUPS, size))
    for _, t in texts:
        flat = np.append(ids.of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0].astype(np.int64), size - 1)
        np.add.at(want, (attention.group_of(np.append(size - 1, flat[:-1])), flat), 1)
    assert (lm_scoring._pairs(told, size) == want).all()
    rows = told.filter(told.kind == lm_scoring._PAIRS).count()
    assert 0 < rows <= 3 * attention.GROUPS * -(-size // lm_scoring._SLICE) and rows < (want > 0).sum() / 2


def test_a_step_moves_only_symbols_that_occur_and_counts_them():
    v = small_vocabulary()
    p = attention.fresh(v)
    before = p["embed"].copy()
    ids = np.random.default_rng(2).integers(0, 300, (4, attention.WIDTH + 1)) // 9
    inputs = attention.model_inputs(v.symbol, v.classes, ids)
    g, rows, values, n = attention.sparse_gradient(p, *inputs)
    attention.Adam(0.01).update(p, g, rows, values)
    assert (n == np.bincount(inputs[0].ravel())[rows]).all() and n.sum() == inputs[0].size
    assert set(np.flatnonzero((p["embed"] != before).any(1))) == set(rows)
