import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from brute import documents, odd_texts, rows, with_clashes
from tidelog.llm import spelling
from tidelog.llm.queries import op11_spelling_variants

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def counted(texts, every=31):
    total = Counter()
    for i, text in texts:
        for word, n in Counter(re.findall("[A-Za-zÀ-ÿ]+", text or "")).items():
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += n
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def near(words):
    """Near words by what is left when one letter is cut out, with its place."""
    holes, out = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
    for (a, b), found in holes.items():
        for w in found:
            out[w] |= found - {w}
            if a + b in words:
                out[w].add(a + b)
                out[a + b].add(w)
    return out


def brute(texts, every=31):
    words = counted(texts, every)
    links, form = near(words), {}
    for w, n in words.items():
        if links[w]:
            best = min(links[w], key=lambda y: (-words[y], y))
            if words[best] >= 10 * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n, len(links[w]), words.get(form.get(w))) for w, n in words.items()), key=repr)


def typos(seed, stems=60, texts=120):
    """Texts of a few stems and many wrong spellings of them, stems by very different numbers."""
    draw = random.Random(seed)
    letters = "abcdeéÿ"
    words = ["".join(draw.choices(letters, k=draw.randrange(6, 12))) for _ in range(stems)]
    out = []
    for i in range(texts):
        line = []
        for _ in range(150):
            w = words[min(int(draw.expovariate(0.15)), stems - 1)]
            for _ in range(draw.choice([0, 0, 0, 0, 1, 1, 2])):
                at = draw.randrange(len(w) + 1)
                w = w[:at] + draw.choice(["", draw.choice(letters)]) + w[at + draw.choice([0, 1]) :]
            line.append(draw.choice([w, w.upper(), w.capitalize()]))
        out.append((i, draw.choice([" ", "ł", "9"]).join(line)))
    return out


@pytest.mark.parametrize("limit", [40, 3])
def test_all_near_words_are_found(spark, limit):
    """Also where subtrees are opened to the last level, and leaves are cut into blocks."""
    texts = typos(limit) + odd_texts() + [(200 + i, "abcdefg gfedcba abcdegf " * 2) for i in range(3)]
    found = spelling.variants(with_clashes(documents(spark, texts), "word", "n", "cell"), limit=limit, block=2 * limit)
    assert rows(found, *COLUMNS) == brute(texts)


def test_query_equals_brute_force(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(op11_spelling_variants(spark, sf_dir), *COLUMNS) == brute(texts)


def test_very_long_words(spark):
    """Words of hundreds of thousands of letters, beyond the counts that a level tells apart."""
    a, b = "ab" * 100_000, "ba" * 150
    words = {a: 30, a + "x": 2, a[:777] + a[778:]: 2, a[:1000] + "x" + a[1001:]: 2, a + "xy": 2, b: 4, b[:100] + b[101:]: 4, b.replace("b", "c", 1): 4}
    found = spelling.variants(documents(spark, [(1, " ".join(f"{w} " * n for w, n in words.items()))]), every=10**12)
    want = [(w, a if w in list(words)[1:4] else None, a if w in list(words)[1:4] else w, n, {a: 3, a + "x": 2, b: 2}.get(w, 1), 30 if w in list(words)[1:4] else None) for w, n in words.items()]
    assert rows(found, *COLUMNS) == sorted(want, key=repr)


def test_texts_are_cut_between_words():
    text = " ".join("".join(random.Random(i).choices("abé", k=i % 40)) for i in range(500)) + "z" * 5000
    for size in (1, 7, 1000):
        cut = list(spelling.pieces(text, size))
        assert "".join(cut) == text and [w for p in cut for w in re.findall("[a-zé]+", p)] == re.findall("[a-zé]+", text)


def test_one_edit_row_by_row():
    draw = random.Random(3)
    for _ in range(300):
        n = draw.randrange(1, 9)
        short, long = ["".join(draw.choices("ab", k=n)) for _ in range(20)], ["".join(draw.choices("ab", k=n + 1)) for _ in range(20)]
        matrix = lambda words: np.frombuffer("".join(words).encode(), np.uint8).reshape(len(words), -1)
        inserted = [any(b[:i] + b[i + 1 :] == a for i in range(n + 1)) for a, b in zip(short, long)]
        assert spelling.one_edit(matrix(short), matrix(long)).tolist() == inserted
        replaced = [sum(x != y for x, y in zip(a, b)) == 1 for a, b in zip(short, reversed(short))]
        assert spelling.one_edit(matrix(short), matrix(short[::-1])).tolist() == replaced


def test_every_letter_has_one_group():
    letters = "".join(spelling.GROUPS)
    assert sorted(letters) == sorted([*map(chr, range(97, 123)), *map(chr, range(0xC0, 0x100))])


def test_empty_table(spark):
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, [(1, None), (2, "")])).count() == 0
