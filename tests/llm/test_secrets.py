import random
import re

from pyspark.sql import functions as F

from brute import documents, odd_texts, rows, with_clashes
from tidelog.llm import queries, secrets_scan


def texts():
    draw = random.Random(1)
    hexa = lambda n: "".join(draw.choices("0123456789abcdef", k=n))
    prose = lambda n: " ".join("".join(draw.choices("etaoinshr", k=5)) for _ in range(n))
    real = [(i, f'{prose(30)} {draw.choice(["token", "API_KEY", "password", "secret"])} = "{hexa(40)}" {prose(20)}') for i in range(80)]
    numbers = [(200 + i, f"{prose(30)} {draw.randrange(10**15, 10**16)} {prose(20)}") for i in range(80)]
    paths = [(400 + i, f"{prose(10)} https://example.com/{hexa(8)}/{prose(1)}/{hexa(20)} {prose(10)}") for i in range(80)]
    return real, numbers, paths


def test_secrets_are_kept_and_other_numbers_are_not(spark):
    real, numbers, paths = texts()
    docs = with_clashes(documents(spark, real + numbers + paths + odd_texts()), "candidate", "start", "label", "features")
    found = secrets_scan.scan(docs)
    assert {r[0] for r in rows(found.filter("is_secret"), "doc_id")} == {i for i, _ in real}
    assert {r[0] for r in rows(found, "doc_id")} >= {i for i, _ in numbers}
    by_id = dict(real)
    for r in found.filter("is_secret").collect():
        assert by_id[r["doc_id"]][r["start"] :].startswith(r["candidate"])


def test_candidates_are_those_of_a_plain_search(spark):
    real, numbers, paths = texts()
    extra = [(900, "a1" * 8), (901, "x" * 40), (902, "ab12" * 500 + " " + "9" * 16 + "." + "8" * 15), (903, "1234567890123456" * 3 + "é" + "abcdefgh12345678")]
    every = real + numbers + paths + extra + odd_texts()
    want = []
    for i, t in every:
        want += [(i, m.start(), m[0]) for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", t or "") if re.search("[0-9]", m[0])]
    assert rows(secrets_scan.candidates(documents(spark, every)), "doc_id", "start", "candidate") == sorted(want, key=repr)


def test_many_candidates_in_one_text(spark):
    """Time and memory follow the candidates: rows hold their own surroundings, not those of the whole text."""
    n = 200_000
    text = " ".join(f"{i:016d}" for i in range(n))
    found = secrets_scan.candidates(documents(spark, [(1, text), (2, "x"), (None, text[:4000])]))
    long = found.filter("doc_id = 1")
    assert found.filter("doc_id IS NULL").count() == 235  # the last one is cut short
    got = long.agg(F.count("*"), F.sum("start"), F.max("start"), F.sum(F.length("before")), F.count_if(F.col("start") != 17 * F.col("candidate").cast("long"))).first()
    assert tuple(got) == (n, 17 * n * (n - 1) // 2, 17 * (n - 1), n - 1, 0)


def test_given_labels_decide(spark):
    real, numbers, _ = texts()
    docs = documents(spark, real + numbers)
    features = secrets_scan.features(secrets_scan.candidates(docs))
    labelled = features.withColumn("label", features["digits_only"])
    found = secrets_scan.scan(docs, labelled=labelled)
    assert {r[0] for r in rows(found.filter("is_secret"), "doc_id")} == {i for i, _ in numbers}


def test_rare_secrets_are_learned_from(spark):
    real, numbers, paths = texts()
    found = secrets_scan.scan(documents(spark, real[:4] + numbers + paths), labelled_rows=8)
    assert {r[0] for r in rows(found.filter("is_secret"), "doc_id")} >= {i for i, _ in real[:4]}


def test_copies_do_not_fill_the_sample(spark):
    real, numbers, _ = texts()
    features = secrets_scan.weak_labels(secrets_scan.features(secrets_scan.candidates(documents(spark, real + numbers)))).persist()
    one = features.filter("label = 0").orderBy(F.xxhash64("label", *secrets_scan.FEATURES)).limit(1)
    copied = features.unionByName(one.crossJoin(spark.range(500)).drop("id"))
    judged = secrets_scan.judge(features, copied, labelled_rows=200)
    assert {r[0] for r in rows(judged.filter("is_secret"), "doc_id")} == {i for i, _ in real}


def test_masking(spark):
    real, numbers, _ = texts()
    docs = with_clashes(documents(spark, real + numbers + odd_texts()), "secrets", "secret_key")
    masked = secrets_scan.redact(docs, secrets_scan.scan(docs))
    assert masked.columns == docs.columns and masked.count() == docs.count()
    after = dict(rows(masked.filter("doc_id < 300 and doc_id >= 0"), "doc_id", "text"))
    assert all("[SECRET]" in after[i] and not re.search("[0-9a-f]{40}", after[i]) for i, _ in real[20:])
    assert all(after[i] == t for i, t in numbers)


def test_empty_and_one_sided(spark):
    assert secrets_scan.scan(documents(spark, [])).count() == 0
    only = secrets_scan.scan(documents(spark, [(1, "x 1234567890123456 y")]))
    assert rows(only, "doc_id", "is_secret") == [(1, False)]


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.op7_secret_scans(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("PythonUDF", "Arrow", "Pandas", "Cartesian"))
