"""Encoding by a public tokenizer, piece by piece, each distinct piece once in a worker.

Both vocabularies split a text before merging: between white space and what follows it, between a letter and punctuation,
and between punctuation and a letter or digit. Cut there, a text's ids are those of its pieces one after the other, so
most text is a lookup in a hash table over numpy arrays, and only pieces that the worker has not met go to the library.
Pieces are told apart by 64-bit hashes. Texts that hold a special token's string go to the library whole, and so do those
in which other white space than the ASCII kind touches ASCII white space, where spaces matter.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from tidelog.llm.buffers import U64, WHITE, mix, spans, sums

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives each task its core
from tokenizers import Tokenizer, models  # noqa: E402

_WHITE, _LETTER, _DIGIT, _PUNCTUATION, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[WHITE] = _WHITE
_CLASS[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = _LETTER
_CLASS[[*b"0123456789"]] = _DIGIT
_CLASS[[*b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~']] = _PUNCTUATION  # without the apostrophe, which may begin a contraction
_CUT = np.zeros((5, 5), bool)
_CUT[_WHITE, 1:] = True
_CUT[_LETTER, _PUNCTUATION] = _CUT[_PUNCTUATION, _LETTER] = _CUT[_PUNCTUATION, _DIGIT] = True
_CUT = _CUT.ravel()

#: White space of any kind at an end of a piece.
EDGE = re.compile(r"\A\s|\s\Z")
#: Words of lower-case letters of Latin-1 only.
LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]{1,64}")
#: How a byte-level model writes the two bytes of each such letter beyond ASCII: the second is 0x9F to 0xBF.
_WRITTEN = {0xC0 + b - 0x80: "\u00c3" + (chr(0x143) if b == 0xAD else chr(b) if b > 0xA0 else chr(0x122 + b - 0x80)) for b in range(0x9F, 0xC0)}
#: Length of such pieces: more than any text has.
UNSAFE = 1 << 60


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def specials(path: str) -> tuple[bytes, ...]:
    return tuple(t.content.encode() for t in tokenizer(path).get_added_tokens_decoder().values())


def encode(path: str, texts: list[bytes]) -> list[list[int]]:
    return [e.ids for e in tokenizer(path).encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]


class Table:
    """Open-addressing map from 64-bit hashes to numbers; at most half full."""

    def __init__(self, bits: int = 20):
        self.mask = U64((1 << bits) - 1)
        self.keys, self.values, self.size = np.zeros(1 << bits, U64), np.zeros(1 << bits, np.int64), 0

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values; -1 where there is none."""
        out = np.full(len(keys), -1, np.int64)
        slot = keys & self.mask
        held = self.keys[slot]
        hit = held == keys
        out[hit] = self.values[slot[hit]]
        left = np.flatnonzero(~hit & (held != 0))
        while len(left):
            slot[left] = (slot[left] + U64(1)) & self.mask
            held = self.keys[slot[left]]
            hit = held == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (held != 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that are not there yet."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            old = self.keys != 0
            kept = self.keys[old], self.values[old]
            self.__init__(int(self.mask).bit_length() + 1)
            self.put(*kept)
            return self.put(keys, values)
        self.size += len(keys)
        slot, left = keys & self.mask, np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == 0
            at, first = np.unique(slot[left[free]], return_index=True)
            chosen = left[free][first]
            self.keys[at], self.values[at] = keys[chosen], values[chosen]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + U64(1)) & self.mask


class Pieces:
    """Base: finds the pieces of texts and the value of each, encoding what is new. A worker keeps `limit` pieces."""

    def __init__(self, path: str, spaced: bool, lower: bool, limit: int = 1_600_000):
        self.path, self.spaced, self.lower, self.limit = path, spaced, lower, limit
        self.reset()

    def reset(self) -> None:
        self.table = Table()

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        return encode(self.path, pieces)

    def store(self, pieces: list[bytes], ids: list[list[int]]) -> np.ndarray:
        raise NotImplementedError

    def find(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each piece: key, whether a space leads it, row, first byte, byte after the last."""
        kind = _CLASS[data]
        cut = np.zeros(len(data) + 1, bool)
        if len(data):
            cut[1:-1] = _CUT[kind[:-1] * np.uint8(5) + kind[1:]]
            at = starts[:-1][starts[:-1] < len(data)]
            cut[at] = kind[at] != _WHITE
        inside = kind != _WHITE
        stop = np.zeros(len(data) + 1, bool)
        if len(data):
            stop[1:] = inside
            stop[1:-1] &= cut[1:-1] | ~inside[1:]
            ends = starts[1:][starts[1:] > 0]
            stop[ends] |= inside[ends - 1]
        begin, end = np.flatnonzero(cut), np.flatnonzero(stop)
        row = np.searchsorted(starts, begin, "right") - 1
        keys = spans(sums(data), begin, end)
        keys[keys == 0] = U64(1)
        lead = np.zeros(len(begin), bool)
        if self.spaced:
            inner = begin > starts[row]
            lead[inner] = data[begin[inner] - 1] == 0x20
            keys[lead] = mix(keys[lead] ^ U64(0x20)) | U64(1)
        return keys, lead, row, begin, end

    def values(self, data: np.ndarray, keys: np.ndarray, lead: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        values = self.table.get(keys)
        new = np.flatnonzero(values < 0)
        if len(new):
            if self.table.size > self.limit:
                self.reset()
                values = self.table.get(keys)
                new = np.flatnonzero(values < 0)
            fresh, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            raw = data.tobytes()
            at = new[first]
            pieces = [(b" " if space else b"") + raw[a:b] for space, a, b in zip(lead[at].tolist(), begin[at].tolist(), end[at].tolist())]
            stored = self.store(pieces, self.encode(pieces))
            self.table.put(fresh, stored)
            values[new] = stored[back]
        return values

    def lowered(self, data: np.ndarray) -> np.ndarray:
        return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data) if self.lower else data

    def special(self, data: np.ndarray, starts: np.ndarray) -> list[int]:
        """Rows that hold a special token's string."""
        raw = data.tobytes()
        found = set()
        for text in specials(self.path):
            at = raw.find(text)
            while at >= 0:
                row = int(np.searchsorted(starts, at, "right")) - 1
                if at + len(text) <= starts[row + 1]:
                    found.add(row)
                at = raw.find(text, at + 1)
        return sorted(found)


class Lengths(Pieces):
    """Token counts under a vocabulary whose pre-tokens may begin with one space.

    Tier one is the given table of frequent pieces, tier two what this worker has encoded itself.
    """

    def __init__(self, path: str, frequent: tuple[np.ndarray, np.ndarray]):
        self.frequent, self.gaps = frequent, {}
        super().__init__(path, spaced=True, lower=False)

    def reset(self) -> None:
        super().reset()
        self.table.put(*self.frequent)

    def store(self, pieces: list[bytes], ids: list[list[int]]) -> np.ndarray:
        return np.array([UNSAFE if EDGE.search(p[p[:1] == b" " :].decode()) else len(i) for p, i in zip(pieces, ids)], np.int64)

    def keys_of(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' keys and how often each occurs; the table has their lengths then."""
        keys, lead, _, begin, end = self.find(data, starts)
        self.values(data, keys, lead, begin, end)
        return np.unique(keys, return_counts=True)

    def of(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        keys, lead, row, begin, end = self.find(data, starts)
        values = self.values(data, keys, lead, begin, end)
        rows = len(starts) - 1
        total = np.zeros(rows, np.int64)
        np.add.at(total, row, np.minimum(values, UNSAFE >> 20))
        unsafe = {*self.special(data, starts), *np.flatnonzero(total >= UNSAFE >> 20).tolist()}
        # White space that is not just the one space before a piece: between pieces, and after the last of a text.
        before = np.where(np.r_[True, row[1:] != row[:-1]], starts[row], np.r_[0, end[:-1]]) if len(row) else begin
        long = begin - before - ((begin > before) & (data[np.maximum(begin - 1, 0)] == 0x20) if len(begin) else 0)
        at = np.flatnonzero(long > 0)
        raw = data.tobytes()
        for r, a, n in zip(row[at].tolist(), before[at].tolist(), long[at].tolist()):
            total[r] += self._gap(raw[a : a + n], inner=data[a + n] != 0x20)
        last = starts[:-1].copy()
        if len(row):
            tail = np.flatnonzero(np.r_[row[1:] != row[:-1], True])
            last[row[tail]] = end[tail]
        for r in np.flatnonzero(last < starts[1:]).tolist():
            total[r] += self._gap(raw[last[r] : starts[r + 1]], inner=False)
        if unsafe:
            unsafe = sorted(unsafe)
            total[unsafe] = [len(i) for i in encode(self.path, [raw[starts[r] : starts[r + 1]] for r in unsafe])]
        return total

    def _gap(self, white: bytes, inner: bool) -> int:
        """Tokens of white space; `inner`: a character follows at once, so the last one stands apart."""
        key = white, bool(inner)
        if key not in self.gaps:
            parts = [white[:-1], white[-1:]] if inner else [white]
            self.gaps[key] = sum(len(i) for i in encode(self.path, [p for p in parts if p]))
            if len(self.gaps) > 10_000:
                self.gaps = {key: self.gaps[key]}
        return self.gaps[key]


def merged(path: str, word: str) -> list[int]:
    """Ids of a word of LETTERS by the vocabulary's model alone."""
    return [t.id for t in tokenizer(path).model.tokenize(word if word.isascii() else word.translate(_WRITTEN))]


@lru_cache(maxsize=4)
def takes_words(path: str) -> bool:
    """Whether `merged` gives the library's ids: the model's kind and a trial of about 2,000 words tell."""
    if not isinstance(tokenizer(path).model, models.BPE):
        return False
    known = sorted(w for w in (t.removesuffix("</w>") for t in tokenizer(path).get_vocab()) if LETTERS.fullmatch(w))
    some = known[:: max(1, len(known) // 900)]
    some += [a + b for a, b in zip(some, reversed(some))]
    some += [a + chr(c) + a for c in _WRITTEN if chr(c) != "\u00f7" for a in ("", "e", "tion")]
    return [merged(path, w) for w in some] == encode(path, [w.encode() for w in some])


class Ids(Pieces):
    """Ids under a lower-case vocabulary that drops white space."""

    def __init__(self, path: str):
        super().__init__(path, spaced=False, lower=True)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Most pieces are words of letters only, which need none of the library's steps before its model."""
        if not takes_words(self.path):
            return encode(self.path, pieces)
        texts = [p.decode() for p in pieces]
        plain = [LETTERS.fullmatch(t) is not None for t in texts]
        others = iter(encode(self.path, [p for p, easy in zip(pieces, plain) if not easy]))
        return [merged(self.path, t) if easy else next(others) for t, easy in zip(texts, plain)]

    def reset(self) -> None:
        super().reset()
        self.flat, self.start, self.count, self.used = np.zeros(1 << 16, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def store(self, pieces: list[bytes], ids: list[list[int]]) -> np.ndarray:
        new = np.fromiter((i for each in ids for i in each), np.uint32)
        count = np.array([len(i) for i in ids], np.int64)
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used : self.used + len(new)] = new
        index = len(self.start) + np.arange(len(ids))
        self.start = np.concatenate([self.start, self.used + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.used += len(new)
        return index

    def of(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each begins."""
        small = self.lowered(data)
        keys, lead, row, begin, end = self.find(small, starts)
        values = self.values(small, keys, lead, begin, end)
        count = self.count[values]
        ends = np.cumsum(count)
        flat = self.flat[np.repeat(self.start[values] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        each = np.bincount(row, count, len(starts) - 1).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(each)])
        if special := self.special(data, starts):
            raw = data.tobytes()
            ids = dict(zip(special, encode(self.path, [raw[starts[r] : starts[r + 1]] for r in special])))
            parts = [np.array(ids[r], np.uint32) if r in ids else flat[at[r] : at[r + 1]] for r in range(len(each))]
            flat = np.concatenate(parts)
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return flat, at
