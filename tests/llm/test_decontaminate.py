import random

import numpy as np

from brute import documents, odd_texts, rows, with_clashes
from tidelog.llm import decontaminate


def prose(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choices("etaoinshrdlu", k=draw.randrange(1, 8))) for _ in range(n)]


def local_score(item, passage):
    best, before = 0, [0] * (len(passage) + 1)
    for a in item:
        now = [0]
        for j, b in enumerate(passage):
            now.append(max(0, before[j] + (2 if a == b else -1), before[j + 1] - 1, now[j] - 1))
        best, before = max(best, *now), now
    return best


def test_alignment():
    draw = np.random.default_rng(1)
    items = [draw.integers(0, 5, draw.integers(1, 12)).astype(np.uint64) + np.uint64(7) for _ in range(40)]
    texts = [draw.integers(0, 5, draw.integers(1, 30)).astype(np.uint64) + np.uint64(7) for _ in range(40)]
    assert decontaminate.align(items, texts).tolist() == [local_score(a.tolist(), b.tolist()) for a, b in zip(items, texts)]


def cases():
    items = [(i, " ".join(prose(i, 20 + i))) for i in range(12)] + [(50, None), (51, ""), (52, "two words"), (53, items_text := " ".join(prose(3, 23))), (54, "the the the")]
    assert items_text == items[3][1]
    texts, want = [], set()
    for i in range(12):
        words, draw = items[i][1].split(), random.Random(i)
        around = [" ".join(prose(100 + i, 60)), " ".join(prose(200 + i, 60))]
        edited = [f"other{draw.randrange(99)}" if k % 5 == 4 else w for k, w in enumerate(words)]
        dropped = [w for k, w in enumerate(words) if k % 7]
        variants = [words, edited, dropped, [w.upper() + "###" for w in words], words[: len(words) // 4]]
        for k, variant in enumerate(variants):
            key = 1000 + 10 * i + k
            texts.append((key, f"{around[0]} {' '.join(variant)}\n{around[1]}"))
            if k < 4:
                want |= {(key, i)} | ({(key, 53)} if i == 3 else set())
    texts += odd_texts() + [(900, "the the the " * 50), (901, items[0][1]), (901, items[0][1]), (902, items[0][1] + " x " + items[0][1])]
    return texts, items, want | {(901, 0), (902, 0)}


def test_copies_are_found_and_others_are_not(spark):
    texts, items, want = cases()
    docs = with_clashes(documents(spark, texts), "item_id", "score")
    bench = with_clashes(spark.createDataFrame(items, "item_id long, text string"), "doc_id", "score")
    found = decontaminate.leaks(docs, bench)
    assert {r for r in rows(found, "doc_id", "item_id")} == want | {(900, 54)}
    assert found.filter("score > 1").count() == 0
    sliced = decontaminate.leaks(docs, bench, slice_words=60)
    assert {r for r in rows(sliced, "doc_id", "item_id")} == want | {(900, 54)}
    kept = decontaminate.clean(docs, bench, slice_words=150)
    leaked = {i for i, _ in want} | {900}
    assert kept.columns == docs.columns and rows(kept, "doc_id") == sorted(((i,) for i, _ in texts if i not in leaked), key=repr)


def test_a_leak_in_most_documents_keeps_its_seeds(spark):
    item = " ".join(prose(5, 30))
    texts = [(i, " ".join(prose(300 + i, 40)) + (" " + item if i % 3 else "")) for i in range(120)]
    found = decontaminate.leaks(documents(spark, texts), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r[0] for r in rows(found, "doc_id")} == {i for i, _ in texts if i % 3}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    docs = documents(spark, [(1, "a b c d e f g h")])
    assert decontaminate.leaks(docs, none).count() == 0 and decontaminate.clean(docs, none).count() == 1
    assert decontaminate.leaks(docs.limit(0), some).count() == 0 and decontaminate.leaks(docs, some).count() == 1


def test_long_excerpts_are_leaks_whatever_the_item_holds_besides(spark):
    item, long = prose(7, 59), prose(8, 500)
    around = [" ".join(prose(400, 60)), " ".join(prose(401, 60))]
    parts = [item[20:48], long[100:340], long[400:413], [w if k != 6 else "other" for k, w in enumerate(long[50:64])]]
    none = [item[20:30], [w if k % 2 else "other" for k, w in enumerate(item[:28])]]
    texts = [(i, f"{around[0]} {' '.join(part)} {around[1]}") for i, part in enumerate(parts + none)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(long))], "item_id long, text string")
    docs = documents(spark, texts)
    assert rows(decontaminate.leaks(docs, bench), "doc_id", "item_id") == [(0, 1), (1, 2), (2, 2), (3, 2)]
    assert rows(decontaminate.clean(docs, bench), "doc_id") == [(4,), (5,)]


def test_a_common_excerpt_keeps_its_seeds(spark):
    item = prose(9, 60)
    texts = [(i, " ".join(prose(500 + i, 30) + item[20:33] + prose(700 + i, 30))) for i in range(40)]
    found = decontaminate.leaks(documents(spark, texts), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert found.count() == 40
