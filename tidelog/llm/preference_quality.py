"""Quality scores learned from preferences: a Bradley-Terry model of document pairs.

A document labelled good is preferred to one labelled bad. With s(x) = w.x, the model says that x beats y with probability
1 / (1 + exp(s(y) - s(x))); w minimises the logistic loss on the differences of the features of such pairs. Preferences
fix no origin of s, so a quantile of the labelled documents' scores serves: the one that parts the two labels best. The
score of a document is the probability that it beats a document at that quantile, with the odds shifted such that the
quantile itself gets `at`.

Features are counted over whole texts in one pass, in Arrow batches, and written once; labels are joined to them by a shuffle,
scores are plain column arithmetic. The fit sees all labelled documents: those of the commoner label are each paired with
`pairs` documents of the other, which all take part equally often. Each step of Newton's method is a pass over the pairs that
leaves one row of sums a task. The origin is sought among the borders of at most BINS equal bins of all their scores. `sample`
bounds the fit for a quick trial: it then sees at most so many documents of each label, those with the least hashes.

Defined results: a null or empty text has all counts 0 and gets a score like any other; null labels are left out; a
document with contrary labels counts for both; rows with equal or null ids are scored one by one, null ids match no
label; without a pair of contrary labels all scores are 0.5; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.buffers import U64, WHITE, blocks, in_row, mix, runs, spans, sums, windows, words
from tidelog.llm.scratch import keep, ship

#: Kinds of bytes whose shares are features; what is in none of them (controls) is not counted.
KINDS = {
    "white": b" \t\r\v\f", "newline": b"\n", "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": b"0123456789",
    "stop": b".", "comma": b",", "call": b"!?", "quote": b";:'\"()-", "sign": b"#*$%&@", "bracket": b"|<>{}[]\\/^_=+~`",
    "lead": bytes(range(0xC2, 0xF5)),
}
FEATURES = (
    *KINDS, "log_words", "word_length", "word_spread", "capital_words", "marked_words", "distinct_words", "top_word",
    "doubled_words", "repeated_triples", "repeated_lines", "line_length",
)
_KIND = np.full(256, len(KINDS), np.int64)
for _n, _bytes in enumerate(KINDS.values()):
    _KIND[[*_bytes]] = _n
_LETTER = np.zeros(256, bool)
_LETTER[[*KINDS["lower"], *KINDS["upper"], *range(0x80, 0x100)]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[[*KINDS["upper"]]] = True
_CLIP = 8.0
#: Labelled rows that are numbered in one task, and bins of their scores.
BLOCK, BINS = 50_000, 65_536


def _distinct(hashes: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: how many different hashes it has, and how often its commonest occurs."""
    _, first, n = np.unique(mix(hashes + row.astype(U64) * U64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, row[first], n)
    return np.bincount(row[first], minlength=rows), most


def count_features(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """FEATURES of each row, all finite."""
    rows = len(starts) - 1
    out = np.zeros((rows, len(FEATURES)), np.float32)
    sizes = np.diff(starts)
    kinds = np.bincount(np.repeat(np.arange(rows) * (len(KINDS) + 1), sizes) + _KIND[data], minlength=rows * (len(KINDS) + 1))
    shares = kinds.reshape(rows, -1)[:, : len(KINDS)] / np.maximum(sizes, 1)[:, None]
    out[:, : len(KINDS)] = np.sqrt(shares)

    running = sums(data)
    begin, end, row = words(data, starts)
    n_words = np.bincount(row, minlength=rows)
    per = np.maximum(n_words, 1)
    length = (end - begin).astype(float)
    mean = np.bincount(row, length, rows) / per
    spread = np.sqrt(np.maximum(np.bincount(row, length**2, rows) / per - mean**2, 0))
    capital = np.bincount(row[_CAPITAL[data[begin]]], minlength=rows) / per
    marked = np.bincount(row[~_LETTER[data[end - 1]]], minlength=rows) / per
    hashes = spans(running, begin, end)
    distinct, most = _distinct(hashes, row, rows)
    doubled = np.bincount(row[1:][in_row(row, 2) & (hashes[1:] == hashes[:-1])], minlength=rows) / per
    inside = np.flatnonzero(in_row(row, 3))
    triples, _ = _distinct(windows(hashes, 3)[inside], row[inside], rows)
    n_triples = np.bincount(row[inside], minlength=rows)

    first, last = runs(data != 0x0A, starts)
    full = np.concatenate([[0], np.cumsum(~WHITE[data])])
    some = full[last] > full[first]
    first, last = first[some], last[some]
    line = np.searchsorted(starts, first, "right") - 1
    n_lines = np.bincount(line, minlength=rows)
    different, _ = _distinct(spans(running, first, last), line, rows)
    values = (
        np.log1p(n_words), np.log1p(mean), np.log1p(spread), capital, marked, distinct / per, most / per, doubled,
        1 - triples / np.maximum(n_triples, 1), 1 - different / np.maximum(n_lines, 1), np.log1p(sizes / np.maximum(n_lines, 1)),
    )
    out[:, len(KINDS) :] = np.stack(values, 1)
    out[n_triples == 0, FEATURES.index("repeated_triples")] = 0
    out[n_lines == 0, FEATURES.index("repeated_lines")] = 0
    return out


def features(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and a float column for each of FEATURES."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, starts in blocks(batch.column(1)):
                found = count_features(data, starts)
                columns = [pa.array(np.ascontiguousarray(found[:, i])) for i in range(found.shape[1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *columns], ["key", *FEATURES])

    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(count, f"key {kind}, " + ", ".join(f"{c} float" for c in FEATURES))


@dataclass(frozen=True)
class Model:
    """Weights on features standardised by `centre` and `scale`, and the score `origin` that gets `at`."""

    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    origin: float
    at: float

    def score(self) -> Column:
        """Probability that a row of FEATURES beats the document at the quantile."""
        terms = [
            float(w / s) * F.greatest(F.lit(-_CLIP * s), F.least(F.lit(_CLIP * s), F.col(c).cast("double") - F.lit(m)))
            for c, m, s, w in zip(FEATURES, self.centre, self.scale, self.weights)
        ]
        latent = sum(terms, F.lit(0.0)) - F.lit(self.origin)
        odds = F.lit((1 - self.at) / self.at) * F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), latent)))
        return 1 / (1 + odds)


#: What scores when nothing is known: no weights, every document like any other.
UNKNOWN = Model((0.0,) * len(FEATURES), (1.0,) * len(FEATURES), (0.0,) * len(FEATURES), 0.0, 0.5)


def _terms(differences: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number of pairs, and sums of their losses, slopes and curvatures at `w`, as one flat array."""
    won = differences @ w
    miss = 1 / (1 + np.exp(np.clip(won, -30, 30)))
    bend = (differences * (miss * (1 - miss))[:, None]).T @ differences
    return np.concatenate([[len(won), np.logaddexp(0, -won).sum()], differences.T @ miss, bend.ravel()])


def _newton(terms: Callable[[np.ndarray], np.ndarray], width: int, ridge: float, steps: int) -> np.ndarray:
    """Weights of least mean loss plus ridge by Newton's method with halved steps; `terms` is a pass over the pairs."""

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        sums = terms(w)
        sums = sums[1:] / sums[0]
        slope, bend = ridge * w - sums[1 : width + 1], sums[width + 1 :].reshape(width, width) + ridge * np.eye(width)
        return sums[0] + ridge / 2 * w @ w, slope, bend

    w = np.zeros(width)
    now, slope, bend = at(w)
    for _ in range(steps):
        step, size = np.linalg.solve(bend, slope), 1.0
        # What the order of the sums changes is rounded away, so equal tables give equal weights.
        next_w = np.round(w - step, 9)
        after, slope, bend = at(next_w)
        while after > now and size > 1e-6:
            size /= 2
            next_w = np.round(w - size * step, 9)
            after, slope, bend = at(next_w)
        if after > now:
            break
        w, gain, now = next_w, now - after, after
        if gain < 1e-10:
            break
    return w


def learn(differences: np.ndarray, ridge: float, steps: int = 50) -> np.ndarray:
    """Weights of least mean logistic loss on the differences winner - loser."""
    return _newton(lambda w: _terms(differences, w), differences.shape[1], ridge, steps)


def learn_pairs(pairs: DataFrame, ridge: float, steps: int = 50) -> np.ndarray:
    """The same on a column of differences; a pass brings one row of sums of each task to the driver."""
    width = len(FEATURES)

    def terms(w: np.ndarray) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(2 + width + width**2)
            for batch in batches:
                found += _terms(np.asarray(batch.column(0).flatten(), float).reshape(-1, width), w)
            yield pa.RecordBatch.from_arrays([pa.array([found.tolist()], pa.list_(pa.float64()))], ["sums"])

        return np.sum([r["sums"] for r in pairs.mapInArrow(add, "sums array<double>").collect()], 0)

    ship(pairs.sparkSession)
    return _newton(terms, width, ridge, steps)


def _numbered(rows: DataFrame, totals: dict[int, int]) -> DataFrame:
    """`rows` with their place `at` among those of their label, in the order of a hash; numbered in blocks."""
    place = F.xxhash64("key", *FEATURES)
    blocks = -(-sum(totals.values()) // BLOCK)
    rows = rows.withColumn("place", place).withColumn("block", F.pmod("place", F.lit(blocks)))
    starts, before = [], dict.fromkeys(totals, 0)
    # A row for each label and block.
    for r in sorted(rows.groupBy("label", "block").agg(F.count("*").alias("n")).collect()):
        starts.append((r["label"], r["block"], before[r["label"]]))
        before[r["label"]] += r["n"]
    first = F.broadcast(rows.sparkSession.createDataFrame(starts, "label int, block long, first long"))
    inside = F.row_number().over(Window.partitionBy("label", "block").orderBy("place", "key")) - 1
    return rows.withColumn("inside", inside).join(first, ["label", "block"]).withColumn("at", F.col("first") + F.col("inside"))


def pair(rows: DataFrame, totals: dict[int, int], x: Column, pairs: int, seed: int) -> DataFrame:
    """Differences of `x`, good - bad. Each document of the commoner label meets `pairs` of the other, by shifted places."""
    many = int(totals[1] >= totals[0])
    few = totals[1 - many]
    shifts = np.random.default_rng(seed).integers(few) + np.arange(pairs) * max(1, few // pairs)
    numbered = _numbered(rows, totals).select("label", "at", x.alias("x"))
    shift = F.explode(F.array(*(F.lit(int(n)) for n in shifts)))
    ours = numbered.filter(F.col("label") == many).select("at", F.col("x").alias("ours"), shift.alias("shift"))
    ours = ours.select("ours", F.pmod(F.col("at") + F.col("shift"), F.lit(few)).alias("at"))
    theirs = numbered.filter(F.col("label") != many).select("at", F.col("x").alias("theirs"))
    sign = 1 if many else -1
    return ours.join(theirs, "at").select(F.zip_with("ours", "theirs", lambda a, b: ((a - b) * sign).cast("float")).alias("difference"))


def threshold(good: np.ndarray, bad: np.ndarray, share_bad: float) -> float:
    """The quantile of all labelled scores that parts the labels best.

    Each label counts with its true share, whatever the sample holds. Among all quantiles, the one with the fewest errors
    of both kinds, each as a share of its label, is taken; of a range of equal ones, its middle.
    """
    values = np.concatenate([good, bad])
    order = np.argsort(values, kind="stable")
    values = values[order]
    is_bad = np.concatenate([np.zeros(len(good)), np.ones(len(bad))])[order]
    errors = np.concatenate([[0], np.cumsum((1 - is_bad) / len(good))]) + 1 - np.concatenate([[0], np.cumsum(is_bad / len(bad))])
    below = np.concatenate([[0], np.cumsum(np.where(is_bad == 1, share_bad / len(bad), (1 - share_bad) / len(good)))])
    at = np.flatnonzero(errors <= errors.min() + 1e-12)
    quantile = (below[at[0]] + below[at[-1]]) / 2
    cut = int(np.clip(np.searchsorted(below, quantile), 1, len(values) - 1))
    return float((values[cut - 1] + values[cut]) / 2)


def _origin(scores: DataFrame) -> float:
    """`threshold` over all of `scores` (label, s), at the borders of bins; rows of one bin are not parted."""
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    if low == high:
        return low
    number = F.least(F.floor((F.col("s") - low) / (high - low) * BINS), F.lit(BINS - 1))
    bins = scores.groupBy(number.alias("bin")).agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0), F.min("s"), F.max("s"))
    _, good, bad, lowest, highest = np.array(bins.orderBy("bin").collect(), float).T
    errors = np.concatenate([[0], np.cumsum(good / good.sum())]) + 1 - np.concatenate([[0], np.cumsum(bad / bad.sum())])
    below = np.concatenate([[0], np.cumsum(good + bad)]) / (good + bad).sum()
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    cut = int(np.clip(np.searchsorted(below, (below[best[0]] + below[best[-1]]) / 2), 1, len(good) - 1))
    return float((highest[cut - 1] + lowest[cut]) / 2)


def _fit_all(rows: DataFrame, totals: dict[int, int], pairs: int, ridge: float, at: float, seed: int) -> Model:
    moments = rows.agg(*(f(c) for c in FEATURES for f in (F.avg, F.stddev_pop))).first()
    centre, scale = np.round(moments[::2], 9), np.maximum(np.round(moments[1::2], 9), 1e-6)
    clip = (F.lit(-_CLIP), F.lit(_CLIP))
    x = [F.greatest(clip[0], F.least(clip[1], (F.col(c) - m) / s)) for c, m, s in zip(FEATURES, centre.tolist(), scale.tolist())]
    weights = learn_pairs(keep(pair(rows, totals, F.array(*x), pairs, seed), "pairs"), ridge)
    score = sum((w * column for w, column in zip(weights.tolist(), x)), F.lit(0.0))
    origin = _origin(keep(rows.select("label", score.alias("s")), "scores"))
    return Model(tuple(centre.tolist()), tuple(scale.tolist()), tuple(weights.tolist()), origin, at)


def fit(found: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", sample: int | None = None, pairs: int = 8, ridge: float = 1e-3, at: float = 0.3, seed: int = 1) -> Model:
    """Learns from `found` (of `features`) and the 0/1 column `label` of `labels`: all of them, or `sample` of each class."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("key IS NOT NULL AND label IN (0, 1)").distinct()
    rows = keep(found.join(known, "key"), "labelled")
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return UNKNOWN
    if sample is None:
        return _fit_all(rows, totals, pairs, ridge, at, seed)
    order = [F.xxhash64(F.col("key"), *FEATURES), F.col("key")]
    good, bad = (np.array(rows.filter(F.col("label") == value).orderBy(*order).select(*FEATURES).limit(sample).collect(), float) for value in (1, 0))
    both = np.concatenate([good, bad])
    centre, scale = both.mean(0), np.maximum(both.std(0), 1e-6)
    good, bad = (np.clip((x - centre) / scale, -_CLIP, _CLIP) for x in (good, bad))
    random = np.random.default_rng(seed)
    n = max(len(good), len(bad)) * pairs
    # Every document takes part: each class is dealt round after round, in a random order.
    winners, losers = (np.concatenate([random.permutation(len(x)) for _ in range(-(-n // len(x)))])[:n] for x in (good, bad))
    weights = learn(good[winners] - bad[losers], ridge)
    origin = threshold(good @ weights, bad @ weights, totals[0] / (totals[0] + totals[1]))
    return Model(tuple(map(float, centre)), tuple(map(float, scale)), tuple(map(float, weights)), origin, at)


def judge(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", at: float = 0.3, **options) -> DataFrame:
    """key, score and predicted (1 if score >= `at`) of each row of `docs`. `labels` holds the rows to learn from."""
    found = keep(features(docs, key=key, text=text), "features")
    model = fit(found, labels, key=key, label=label, at=at, **options)
    scored = found.select(F.col("key").alias(key), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= at).cast("int"))
