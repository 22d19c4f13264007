import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidelog.llm import conversation_trie
from tidelog.llm.queries import op12_conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(turns):
    """A plain trie of tuples."""
    own = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, children = defaultdict(list), defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, d == len(path)))
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out, leaves, saved = [], {}, {}
    for p in sorted(members, key=len, reverse=True):
        n = len(members[p])
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = (n - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in children[p])
        above = min(c for c, _ in members[p[:-1]]) if p else None
        ends = ",".join(map(str, sorted(c for c, last in members[p] if last)))
        out.append((min(c for c, _ in members[p]), len(p), above, n, len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def found(frame, **options):
    return Counter(map(tuple, conversation_trie.nodes(frame, **options).select(*COLUMNS).collect()))


def talk(seed, ids=150, texts=("a", "b", "é", None, ""), longest=20):
    draw = random.Random(seed)
    turns = []
    for c in draw.sample(range(-20, 2 * ids), ids):
        for t in range(draw.choice([1, 1, 2, 3, 6, 12, longest])):
            turns.append((c, draw.choice([t, t, t, None, 3]), draw.choice(["u", "a", None]), draw.choice(texts)))
    return turns


@pytest.mark.parametrize("batches", [1, 4])
def test_nodes_equal_a_plain_trie(spark, batches):
    """Ties and nulls of turns, repeated rows, copies, turnless conversations, columns that clash."""
    turns = talk(batches) + [(5000 + 5 * i + j, t, "u", "same") for i in range(20) for j in range(2) for t in range(9)]
    turns += [(None, 1, "u", "no id"), (7000, None, None, None), (7000, None, None, None)]
    frame = spark.createDataFrame(turns, SCHEMA).withColumns({c: F.lit("clash") for c in ("depth", "span", "len", "at", "owner")})
    assert found(frame, batches=batches) == brute(turns)


def test_long_conversations_run_over_spans(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "SPAN", 3)
    monkeypatch.setattr(conversation_trie, "PIECE", 2)
    turns = talk(9, ids=60, longest=60) + [(900 + 5 * i, t, "u", "x") for i in range(7) for t in range(30 - i // 2)]
    assert found(spark.createDataFrame(turns, SCHEMA)) == brute(turns)


def test_query_equals_a_plain_trie(spark, sf_dir):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert Counter(map(tuple, op12_conversation_trie(spark, sf_dir).select(*COLUMNS).collect())) == brute(turns)


def test_one_conversation_and_none(spark):
    assert found(spark.createDataFrame([(3, 1, "u", "hello")], SCHEMA)) == brute([(3, 1, "u", "hello")])
    assert not found(spark.createDataFrame([], SCHEMA))
    assert not found(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA))


def test_two_fattest(spark):
    got = spark.sql("SELECT a, b FROM VALUES (0L, 1L), (0L, 7L), (8L, 9L), (5L, 8L), (9L, 11L), (0L, 4096L) AS t(a, b)")
    pairs = got.select("a", "b", F.expr(conversation_trie._two_fattest("a", "b")).alias("f")).collect()
    assert [r["f"] for r in pairs] == [max(range(r["a"] + 1, r["b"] + 1), key=lambda x: x & -x) for r in pairs]


def test_list_hashes_of_many_ids(spark):
    ids = list(range(0, 30_000, 3))
    frame = spark.createDataFrame([(1, 2, i) for i in reversed(ids)] + [(1, 3, 5), (2, 2, 7), (2, 2, 70)], "a long, b long, id long")
    got = {tuple(r)[:2]: r[2] for r in conversation_trie.list_hashes(frame, ["a", "b"], "id").collect()}
    want = {(1, 2): ids, (1, 3): [5], (2, 2): [7, 70]}
    assert got == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in want.items()}
