import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import documents, odd_texts, rows, with_clashes, words
from tidelog.llm import preference_quality as quality
from tidelog.llm.queries import op13_quality_classifier

LABELS = "doc_id long, quality int"


def prose(seed, n=120):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("etaoinshr", k=draw.randrange(2, 9))) for _ in range(n)) + "."


def junk(seed, n=120):
    return " ".join(w + "!!" for w in prose(seed, n).upper().split())


def auc(good, bad):
    good, bad = np.array(good), np.array(bad)
    return ((good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2).item()


def test_held_out_documents_are_told_apart(spark):
    """The query on a real table: labels of a fifth of the documents were never seen."""
    sf_dir = "/root/testdata/sf0.01"
    judged = op13_quality_classifier(spark, sf_dir)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = judged.collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert auc([s for s, _, q in held if q == 1], [s for s, _, q in held if q == 0]) > 0.95
    assert sum(p == q for _, p, q in held) > 0.93 * len(held)


def test_held_out_labels_change_nothing(spark, tmp_path):
    docs = documents(spark, [(i, prose(i) if i % 3 else junk(i)) for i in range(120)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    truth = docs.select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    scores = []
    for name, quality_of_held in (("a", F.col("quality")), ("b", 1 - F.col("quality"))):
        sf_dir = tmp_path / name
        sf_dir.mkdir()
        (sf_dir / "documents.parquet").symlink_to(tmp_path / "documents.parquet")
        truth.withColumn("quality", F.when(held, quality_of_held).otherwise(F.col("quality"))).write.parquet(str(sf_dir / "labels.parquet"))
        scores.append(rows(op13_quality_classifier(spark, str(sf_dir)), "doc_id", "held_out", "score", "predicted"))
    assert scores[0] == scores[1] and all((s[0] % 3 > 0) == s[3] for s in scores[0])


def test_odd_tables(spark):
    texts = odd_texts() + [(100 + i, prose(i)) for i in range(40)] + [(200 + i, junk(i)) for i in range(40)]
    labels = [(i, 1) for i in range(100, 140)] + [(i, 0) for i in range(200, 240)]
    labels += [(100, 1), (200, 0), (100, 0), (None, 1), (4, None), (99_999, 1)]  # repeated, contrary, null, without document
    docs = with_clashes(documents(spark, texts), "key", "label", "log_words", "score")
    judged = quality.judge(docs, with_clashes(spark.createDataFrame(labels, LABELS), "lower", "text"))
    got = judged.collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted((i for i, _ in texts), key=repr)
    score = {r["doc_id"]: r["score"] for r in got}
    assert all(0 <= s <= 1 for s in score.values())
    assert all(score[i] >= 0.3 for i in range(101, 140)) and all(score[i] < 0.3 for i in range(201, 240))
    assert score[1] == score[2]  # null and empty


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, None)]])
def test_without_pairs_nothing_is_known(spark, labels):
    judged = quality.judge(documents(spark, [(1, prose(1)), (2, "")]), spark.createDataFrame(labels, LABELS))
    assert rows(judged, "doc_id", "score", "predicted") == [(1, 0.5, 1), (2, 0.5, 1)]


def test_empty_table(spark):
    assert quality.judge(documents(spark, []), spark.createDataFrame([(1, 1), (2, 0)], LABELS)).count() == 0


def test_the_sample_is_bounded_by_label(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "learn", lambda d, ridge: seen.append(d.shape) or np.zeros(d.shape[1]))
    texts = [(i, prose(i, 20)) for i in range(100)] + [(200 + i, junk(i, 20)) for i in range(7)]
    labels = [(i, int(i < 200)) for i, _ in texts]
    quality.judge(documents(spark, texts), spark.createDataFrame(labels, LABELS), sample=10, pairs=3)
    assert seen == [(30, len(quality.FEATURES))]


def test_learning_is_a_minimum():
    random_ = np.random.default_rng(1)
    d = random_.normal(size=(500, 4)) + [0.5, -0.2, 0, 1]
    w = quality.learn(d, 0.01)
    miss = 1 / (1 + np.exp(d @ w))
    assert np.abs(0.01 * w - d.T @ miss / len(d)).max() < 1e-5


def test_threshold_parts_the_labels():
    assert 2 < quality.threshold(np.array([3.0, 4, 5, 6]), np.array([0.0, 1, 2]), 0.1) < 3
    assert np.isfinite(quality.threshold(np.array([1.0]), np.array([1.0]), 0.5))


def test_features_by_hand():
    text = "One one two, ONE one two, one\n\nsame line\nsame line #9 é!"
    data = np.frombuffer(text.encode(), np.uint8)
    got = dict(zip(quality.FEATURES, quality.count_features(data, np.array([0, len(data)]))[0].tolist()))
    w = words(text)
    n = len(text.encode())
    want = {
        "log_words": np.log1p(len(w)), "capital_words": 2 / len(w), "marked_words": sum(not x[-1].isalpha() for x in w) / len(w),
        "distinct_words": len(set(w)) / len(w), "top_word": 3 / len(w), "doubled_words": 0.0, "repeated_lines": 0.0,
        "digit": np.sqrt(1 / n), "sign": np.sqrt(1 / n), "call": np.sqrt(1 / n), "lead": np.sqrt(1 / n), "newline": np.sqrt(3 / n),
    }
    for name, value in want.items():
        assert got[name] == pytest.approx(value, abs=1e-6), name


def test_all_labelled_rows_are_learned_from(spark):
    """Beyond 20,000 of a label, where the fit once took a sample."""
    n = 50_000
    one = ((F.col("id") * 37 % 1001) / 1001 + F.when(F.col("id") % 10 > 0, 0.3).otherwise(0)).cast("float")
    found = spark.range(n).select(F.col("id").alias("key"), *((one if i == 0 else F.lit(0.5).cast("float")).alias(c) for i, c in enumerate(quality.FEATURES)))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 10 > 0).cast("int").alias("quality"))
    model = quality.fit(found, labels)
    values = np.array(found.select(quality.FEATURES[0]).collect(), float)[:, 0]
    assert model.centre[0] == pytest.approx(values.mean(), abs=1e-8) and model.scale[0] == pytest.approx(values.std(), abs=1e-8)
    assert model.weights[0] > 0 and model == quality.fit(found, labels)


def test_every_labelled_document_is_paired(spark):
    rows = spark.range(107).select(F.col("id").alias("key"), (F.col("id") < 100).cast("int").alias("label"), *(F.lit(0.0).alias(c) for c in quality.FEATURES))
    for label in (1, 0):
        own = F.array(F.when(F.col("label") == label, F.col("key") + 1).otherwise(0).cast("double"))
        got = [abs(r[0][0]) for r in quality.pair(rows, {0: 7, 1: 100}, own, 3, 1).collect()]
        times = {n: got.count(n) for n in set(got)}
        assert len(got) == 300 and len(times) == (100 if label else 7)
        assert set(times.values()) <= ({3} if label else {42, 43, 44})
