"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Words are arranged by their length and then, level by level, by how often each group of letters occurs in them. One
inserted, deleted or replaced letter changes these counts by a surplus of at most one and a deficit of at most one. So the
words near a given one lie in leaves that a depth-first search reaches with a budget of one surplus and one deficit;
the words of those leaves are verified. Nearness is mutual, so each word looks only for words one longer (surplus alone) and
words of its length whose first differing count is larger (surplus before deficit).

The trie spans the cluster: its top levels are walked level by level as joins of the searching words with the nodes,
until a subtree holds at most `limit` words; such a subtree is searched in one task, with numpy over all words that reach
it at once. Words reaching a subtree are dealt over tasks of `block` words each, and a leaf of more than `limit` words with
equal counts is split into blocks that each searching word visits; nothing is left out.

Defined results: a null text has no words; a null id counts as the empty text in the hash; words that occur once, or are
shorter than `least`, do not exist; ties of the commonest near word go to the smallest in code-point order; repeated rows
count each time; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.scratch import keep, ship

#: Lower-cased letters: a-z and U+00C0 to U+00FF, all of which Latin-1 holds in one byte.
LETTERS = "a-zÀ-ÿ"
#: Letters from the commonest on, as dealt to groups: one of the common and one of the rare half in each.
_BY_USE = "etaoinshrdlcumwfgypbvkjxqz"
LEVELS = 13
GROUPS = [
    "".join([_BY_USE[i], _BY_USE[25 - i], *(chr(c) for c in range(0xC0, 0x100) if c % LEVELS == i)]) for i in range(LEVELS)
]
_GROUP = np.zeros(256, np.int64)
for _n, _letters in enumerate(GROUPS):
    _GROUP[[*_letters.encode("latin-1")]] = _n
#: Words in a node below which the search compares them all, and bytes handled at once.
_LEAF, _BYTES = 24, 1 << 22
_MOST = 250
_OTHER = re.compile(f"[^{LETTERS}]")


def pieces(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in pieces of about `size`, cut where no word is."""
    at = 0
    while at < len(text):
        end = _OTHER.search(text, at + size) if at + size < len(text) else None
        stop = end.end() if end else len(text)
        yield text[at:stop]
        at = stop


def count_words(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = 7, every: int = 31) -> DataFrame:
    """word, n: the words of all texts, one letter deleted where `every` divides the hash of id and word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(f"[{LETTERS}]{{{least},}}").findall
        total: dict[str, int] = {}
        size = 0

        def table() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for own, whole in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(f"{own or ''}:".encode())
                # Lower-casing bytes touches A-Z alone.
                for piece in pieces((whole.as_py() or "").encode().lower().decode()):
                    for word, n in Counter(find(piece)).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        if word not in total:
                            size += len(word)
                            total[word] = 0
                        total[word] += n
                    if len(total) > 200_000 or size > 1 << 25:
                        size = 0
                        yield table()
        if total:
            yield table()

    ship(docs.sparkSession)
    found = docs.select(F.col(key).cast("string"), F.col(text)).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _count(level: int) -> Column:
    """How many letters of a word are in the group of a level."""
    return F.least(F.lit(_MOST), F.length("word") - F.length(F.translate(F.col("word"), GROUPS[level], "")))


def _child(node: Column, count: Column) -> Column:
    return F.xxhash64(node, count.cast("int"))


def _searchers(words: DataFrame) -> DataFrame:
    """Each word twice: for words of its length (`same`) and for words one longer; `spent` is its budget used."""
    both = F.explode(F.array(F.struct(F.lit(True).alias("same"), F.lit(0).alias("more")), F.struct(F.lit(False).alias("same"), F.lit(1).alias("more"))))
    rows = words.withColumn("_for", both)
    return rows.select("word", "n", "_for.same", F.lit(0).alias("spent"), F.xxhash64(F.length("word") + F.col("_for.more")).alias("cell"))


def _descend(rows: DataFrame, level: int) -> DataFrame:
    """Searching words one level down: along their own count, or at the cost of the surplus, then of the deficit."""

    def way(change: int, spent: int) -> Column:
        return F.struct(F.lit(change).alias("change"), F.lit(spent).alias("spent"))

    ways = (
        F.when(F.col("spent") == 0, F.array(way(0, 0), way(1, 1)))
        .when(F.col("same") & (F.col("spent") == 1), F.array(way(0, 1), way(-1, 2)))
        .otherwise(F.array(F.struct(F.lit(0).alias("change"), F.col("spent").alias("spent"))))
    )
    return rows.withColumn("_way", F.explode(ways)).select(
        "word", "n", "same", F.col("_way.spent").alias("spent"), _child(F.col("cell"), _count(level) + F.col("_way.change")).alias("cell")
    )


def _subtrees(words: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Words by the subtree they live in, and searching words by each subtree they reach: (word, n, cell[, same])."""
    total = words.count()
    # Where to look first; nodes that are still too large are opened further, whatever this guess.
    level = min(LEVELS, max(0, round(math.log(max(1, total / limit / 5)) / math.log(2.5)) - 1))
    homes = words.select("word", "n", F.xxhash64(F.length("word")).alias("cell"))
    searching = _searchers(words)
    for i in range(level):
        homes = homes.withColumn("cell", _child(F.col("cell"), _count(i)))
        searching = _descend(searching, i)
    settled, reaching = [], []
    while True:
        sizes = homes.groupBy("cell").agg(F.count("*").alias("held"))
        nodes = keep(sizes.withColumn("open", (F.col("held") > limit) & F.lit(level < LEVELS)), "nodes")
        homes, searching = keep(homes.join(nodes, "cell"), "homes"), keep(searching.join(nodes, "cell"), "searching")
        settled.append(homes.filter("NOT open").drop("open"))
        reaching.append(searching.filter("NOT open").select("word", "n", "same", "cell", "held"))
        if nodes.filter("open").isEmpty():
            break
        homes = homes.filter("open").select("word", "n", _child(F.col("cell"), _count(level)).alias("cell"))
        searching = _descend(searching.filter("open").drop("open", "held"), level)
        level += 1
    home, reach = settled[0], reaching[0]
    for h, r in zip(settled[1:], reaching[1:]):
        home, reach = home.unionByName(h), reach.unionByName(r)
    return home, reach


def _counts(letters: np.ndarray) -> np.ndarray:
    """Letters of each group in each row of a matrix of letters."""
    rows, width = letters.shape
    if not rows * width:
        return np.zeros((rows, LEVELS), np.int16)
    flat = (np.arange(rows) * LEVELS)[:, None] + _GROUP[letters]
    return np.minimum(np.bincount(flat.ravel(), minlength=rows * LEVELS).reshape(rows, LEVELS), _MOST).astype(np.int16)


def _matrix(words: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer("".join(words.to_pylist()).encode("latin-1"), np.uint8).reshape(len(words), width)


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Row by row: do the letters differ in one place, or is one letter inserted in the longer row?"""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(1) == 1
    width = short.shape[1]
    before, after = short == long[:, :-1], (short == long[:, 1:])[:, ::-1]
    front, back = (np.where(e.all(1), width, e.argmin(1)) if width else np.zeros(len(e), int) for e in (before, after))
    return front + back >= width


def search(held: np.ndarray, seeking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (seeking, held) of all pairs one edit apart; both are matrices of letters, `seeking` as wide or one narrower."""
    same = held.shape[1] == seeking.shape[1]
    trie, wanted = _counts(held), _counts(seeking)
    order = np.lexsort(trie.T[::-1])
    trie = trie[order]
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def verify(who: np.ndarray, what: np.ndarray) -> None:
        step = max(1, _BYTES // max(1, held.shape[1]))
        for i in range(0, len(who), step):
            a, b = who[i : i + step], what[i : i + step]
            near = one_edit(seeking[a], held[b])
            found.append((a[near], b[near]))

    def leaf(low: int, high: int, level: int, who: np.ndarray, spent: np.ndarray) -> None:
        step = max(1, _BYTES // ((high - low) * (LEVELS - level + 1)))
        for i in range(0, len(who), step):
            some, used = who[i : i + step], spent[i : i + step]
            change = trie[None, low:high, level:] - wanted[some, None, level:]
            surplus, deficit = (change > 0) * change, (change < 0) * -change
            fits = (surplus.sum(2) <= (used == 0)[:, None]) & (deficit.sum(2) <= ((used < 2) & same)[:, None])
            a, b = np.nonzero(fits)
            verify(some[a], order[low + b])

    def descend(low: int, high: int, level: int, who: np.ndarray, spent: np.ndarray) -> None:
        if high - low <= _LEAF or level == LEVELS:
            leaf(low, high, level, who, spent)
            return
        column, own = trie[low:high, level], wanted[who, level]
        cuts = [0, *(np.flatnonzero(np.diff(column)) + 1), high - low]
        for start, stop in zip(cuts[:-1], cuts[1:]):
            change = column[start] - own
            on = (change == 0) | ((change == 1) & (spent == 0))
            if same:
                on |= (change == -1) & (spent == 1)
            if on.any():
                descend(low + start, low + stop, level + 1, who[on], spent[on] + (change[on] != 0))

    if len(held) and len(seeking):
        descend(0, len(held), 0, np.arange(len(seeking)), np.zeros(len(seeking), np.int8))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    who, what = (np.concatenate(x) for x in zip(*found))
    if same:
        # With equal counts so far both words of a pair find each other: the pair of the smaller one stays.
        mutual = _mutual(wanted[who], _counts(held[what]), seeking[who], held[what])
        who, what = who[~mutual], what[~mutual]
    return who, what


def _mutual(mine: np.ndarray, theirs: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs that the other word reports: its first larger count comes first, or the counts are equal and it is smaller."""
    change = theirs - mine
    differs = (change != 0).any(1)
    first = change[np.arange(len(change)), (change != 0).argmax(1)]
    letter = (a != b).argmax(1)
    at = np.arange(len(a))
    return np.where(differs, first < 0, a[at, letter] > b[at, letter]) if len(a) else np.zeros(0, bool)


def near_words(words: DataFrame, *, limit: int = 8192, block: int = 65_536) -> DataFrame:
    """word, n, near, near_n: all ordered pairs of words of `words` (word, n) that are one edit apart."""

    def compare(rows: pa.Table) -> pa.Table:
        kinds, texts, n = rows["kind"].to_numpy(), rows["word"].combine_chunks(), rows["n"].combine_chunks()
        home = np.flatnonzero(kinds == 0)
        out = []
        if len(home):
            width = len(texts[home[0]].as_py())
            held = _matrix(texts.take(pa.array(home)), width)
            for kind, wide in ((1, width), (2, width - 1)):
                own = np.flatnonzero(kinds == kind)
                who, what = search(held, _matrix(texts.take(pa.array(own)), wide))
                pair = [pa.array(own[who]), pa.array(home[what])]
                out.append(pa.table([texts.take(pair[0]), n.take(pair[0]), texts.take(pair[1]), n.take(pair[1])], ["word", "n", "near", "near_n"]))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in (pa.string(), pa.int64(), pa.string(), pa.int64())], ["word", "n", "near", "near_n"])

    ship(words.sparkSession)
    home, reach = _subtrees(words, limit)
    visits = reach.groupBy("cell").agg(F.ceil(F.count("*") / block).alias("tasks"))
    visits = keep(visits, "visits")
    parts = F.greatest(F.lit(1), F.ceil(F.col("held") / limit))
    pick = F.xxhash64("word", F.lit("block"))
    own = home.join(visits, "cell").select(
        "cell", F.pmod(pick, parts).alias("part"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("kind"), "word", "n"
    )
    others = reach.join(visits, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("part"), F.pmod(pick, F.col("tasks")).alias("task"),
        F.when(F.col("same"), 1).otherwise(2).alias("kind"), "word", "n",
    )
    pairs = own.unionByName(others).groupBy("cell", "part", "task").applyInArrow(compare, "word string, n long, near string, near_n long")
    pairs = keep(pairs, "pairs")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def follow(forms: DataFrame) -> DataFrame:
    """word, root of (word, form) rows without cycles: each round doubles the steps taken."""
    now = keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = keep(now.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        now = after.drop("_moved")
        if after.filter("_moved").isEmpty():
            return now


def variants(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = 7, times: int = 2, factor: int = 10, every: int = 31, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word that occurs `times` times at least.

    `form` is the commonest near word, if it occurs `factor` times as often; `root` follows forms to the last one.
    """
    words = keep(count_words(docs, key=key, text=text, least=least, every=every).filter(F.col("n") >= times), "words")
    near = near_words(words, **options)
    best = F.min(F.when(F.col("near_n") >= factor * F.col("n"), F.struct((-F.col("near_n")).alias("order"), F.col("near")))).alias("_best")
    grouped = keep(near.groupBy("word").agg(F.count("*").alias("n_near"), best), "near")
    forms = grouped.select("word", F.col("_best.near").alias("form"), (-F.col("_best.order")).alias("form_n"), "n_near")
    roots = follow(forms.filter("form IS NOT NULL"))
    out = words.join(forms, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")
