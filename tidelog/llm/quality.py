"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Each document's statistics become a vector: log of its mean word length, log of symbols per word, share of repeated lines,
share of words in repeated windows. For each (lang, source) the minimum-covariance-determinant estimate is found by concentration steps over all
documents that pass the base rules: distances are binned finely, one aggregation sums the moments of each bin, and the
innermost bins that hold the share `core` give the next centre and covariance. Centre and covariance are drawn towards
the pooled ones by the weight of `prior_docs` documents, which settles small groups, and each variance gets a floor, a
quarter (SHARE squared) of the mean square deviation from the group's median over the documents that are ordinary in the
other statistics, which settles statistics that hardly vary. What a text of its length scatters by chance (NOISE) bounds
each of its variances from below; values are never drawn towards others. A document is rejected if its squared Mahalanobis
distance exceeds the chi-square quantile `quantile`. Groups are joined, never collected: only totals and pooled moments
(one row each) reach the driver.

Defined results: words are runs of bytes other than space and 0x09-0x0D; a null text has none and fails the base rules; a
null language or source is a group of its own; rows with equal or null ids are judged one by one; an empty table gives an
empty result. Only the id, text, language and source are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.buffers import U64, WHITE, blocks, in_row, mix, runs, spans, sums, windows, words
from tidelog.llm.scratch import keep, ship

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VECTOR = ("x0", "x1", "x2", "x3")
NOISE = ("e0", "e1", "e2", "e3")
#: Floor of a standard deviation, as a share of the pooled one.
SHARE = 0.5
_LEAST = 1e-4
WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*b"#*$%&|<>"]] = True
_P = len(VECTOR)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(degrees // 2))


def chi_square_quantile(q: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < q else (low, middle)
    return high


def _per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights, n).astype(np.int64)


def base_statistics(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """BASE and the number of lines with a word, for each row."""
    rows = len(starts) - 1
    running = sums(data)
    begin, end, row = words(data, starts)
    n_words = _per_row(row, rows)
    row_of_byte = np.repeat(np.arange(rows), np.diff(starts))
    chars = ~WHITE[data] & ((data & 0xC0) != 0x80)
    word_chars = _per_row(row_of_byte[chars], rows)
    n_symbols = _per_row(row_of_byte[_SYMBOL[data]], rows)

    first, last = runs(data != 0x0A, starts)
    inside = np.concatenate([[0], np.cumsum(~WHITE[data])])
    full = inside[last] > inside[first]
    first, last = first[full], last[full]
    line_row = np.searchsorted(starts, first, "right") - 1
    n_lines = _per_row(line_row, rows)
    _, once = np.unique(_with_row(spans(running, first, last), line_row), return_index=True)
    n_dup_lines = n_lines - _per_row(line_row[once], rows)

    found = windows(spans(running, begin, end), WINDOW)
    at = np.flatnonzero(in_row(row, WINDOW))
    key = _with_row(found[at], row[at])
    order = np.argsort(key)
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = key[order[1:]] == key[order[:-1]]
    repeated = at[order[same[1:] | same[:-1]]]
    cover = np.zeros(len(begin) + 1, np.int64)
    np.add.at(cover, repeated, 1)
    np.add.at(cover, repeated + WINDOW, -1)
    n_repeat = _per_row(row[np.cumsum(cover)[:-1] > 0], rows)
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat, n_lines]


def _with_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mix(hashes + row.astype(U64) * U64(0x9E3779B97F4A7C15))


def statistics(docs: DataFrame, *, key: str | None = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """key, BASE, n_lines, base_failed, and the group of each document. Without a key, the whole document as `doc`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [base_statistics(data, starts) for _, _, data, starts in blocks(batch.column(1))]
            if parts:
                yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *(pa.array(np.concatenate(c)) for c in zip(*parts))], names)

    names = [key or "doc", "group_lang", "group_source", *BASE, "n_lines"]
    kinds = [docs.schema[key].dataType if key else docs.schema, T.StringType(), T.StringType(), *[T.LongType()] * 6]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    ship(docs.sparkSession)
    own = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (lang, source)]
    found = docs.select(F.col(key) if key else F.struct("*").alias("doc"), F.col(text), *own).mapInArrow(count, schema)
    return found.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def totals(found: DataFrame) -> tuple[float, float]:
    """Characters and symbols per word, over the documents that pass the base rules."""
    passed = found.filter(~F.col("base_failed"))
    n, chars, symbols = (v or 0.0 for v in passed.agg(*(F.sum(c).cast("double") for c in ("n_words", "word_chars", "n_symbols"))).first())
    return (chars / n, symbols / n) if n else (1.0, 0.0)


def vectors(found: DataFrame, total: tuple[float, float], prior_words: int) -> DataFrame:
    """Adds VECTOR and NOISE, the variances by chance: characters and symbols scatter as Poisson counts, and more in texts
    of not many more words than `prior_words`; one line and one window may be there twice."""
    length, symbol = total
    n = F.greatest("n_words", F.lit(1))
    wide = 1 + F.lit(float(prior_words)) / n
    return found.withColumns(
        {
            "x0": F.log(F.greatest("word_chars", F.lit(1)) / n),
            "x1": F.log1p(F.col("n_symbols") / n),
            "x2": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
            "x3": F.col("n_repeat_words") / n,
            "e0": wide / (F.lit(length) * n),
            "e1": wide * (F.lit(symbol) * n + 1) / (n * n),
            "e2": F.pow(F.greatest("n_lines", F.lit(1)), F.lit(-2.0)),
            "e3": F.pow(n / (2.0 * WINDOW), F.lit(-2.0)),
        }
    )


def distance(centre: list[Column], inverse: dict[tuple[int, int], Column], variance: list[Column] | None = None) -> Column:
    """Squared Mahalanobis distance; with the variances given, each is at least the document's NOISE."""
    away = [F.col(x) - m for x, m in zip(VECTOR, centre)]
    if variance:
        away = [a * F.sqrt(F.least(F.lit(1.0), v / F.col(e))) for a, v, e in zip(away, variance, NOISE)]
    return sum((inverse[i, j] * away[i] * away[j] * (1 if i == j else 2) for i, j in _PAIRS), F.lit(0.0))


_GROUP = ["group_lang", "group_source"]
_CENTRE, _MOMENTS = [f"m{i}" for i in range(_P)], [f"s{i}{j}" for i, j in _PAIRS]
_INVERSE = [f"v{i}{j}" for i, j in _PAIRS]
_VARIANCE = [f"c{i}" for i in range(_P)]


def _square(values: np.ndarray) -> np.ndarray:
    out = np.zeros((_P, _P))
    for (i, j), v in zip(_PAIRS, values):
        out[i, j] = out[j, i] = v
    return out


def _core(core: float):
    """Per group: centre and covariance of the innermost bins that hold the share `core`."""

    def concentrate(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bin")
        n = rows["n"].to_numpy()
        take = int(np.searchsorted(np.cumsum(n), core * n.sum() - 1e-9)) + 1
        h = n[:take].sum()
        mean = rows[list(VECTOR)].to_numpy()[:take].sum(0) / h
        moments = _square(rows[_MOMENTS].to_numpy()[:take].sum(0) / h) - np.outer(mean, mean)
        return pd.DataFrame([[*rows[_GROUP].iloc[0], float(h), *mean, *(moments[i, j] for i, j in _PAIRS)]], columns=[*_GROUP, "h", *_CENTRE, *_MOMENTS])

    return concentrate


def _settle(pooled: np.ndarray, factor: float, prior_docs: float, floor: np.ndarray):
    """Adds the inverse and the variances of the drawn and floored covariance, and its log determinant."""

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for values in rows.to_numpy().tolist():
                h, own = values[2], np.array(values[3:])
                drawn = (h * own + prior_docs * pooled) / (h + prior_docs)
                covariance = factor * _square(drawn[_P:]) + np.diag(floor)
                inverse = np.linalg.inv(covariance)
                out.append([*values[:3], *drawn[:_P], *(inverse[i, j] for i, j in _PAIRS), *np.diag(covariance), np.linalg.slogdet(covariance)[1]])
            yield pd.DataFrame(out, columns=[*_GROUP, "h", *_CENTRE, *_INVERSE, *_VARIANCE, "log_det"])

    return settle


def _schema(names: list[str]) -> str:
    return ", ".join(f"{c} string" if c in _GROUP else f"{c} double" for c in names)


def floors(rows: DataFrame, start: DataFrame, limit: float) -> np.ndarray:
    """Least variance of each statistic: SHARE squared of its mean square deviation from the group's median, over the
    documents of all groups whose other statistics lie within `limit` of theirs."""
    away = [F.pow(F.col(x) - F.col(f"q{i}")[1], F.lit(2.0)) for i, x in enumerate(VECTOR)]
    scale = [F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(2.0)) for i in range(_P)]
    ratio = [a / (s + F.col(e)) for a, s, e in zip(away, scale, NOISE)]
    others = [sum((r for j, r in enumerate(ratio) if j != i), F.lit(0.0)) for i in range(_P)]
    means = rows.join(start, _GROUP).agg(*(F.avg(F.when(o <= limit, a)) for o, a in zip(others, away))).first()
    return SHARE**2 * np.array([m or 0.0 for m in means]) + _LEAST**2


def estimates(found: DataFrame, *, core: float, prior_docs: float, steps: int) -> DataFrame:
    """Centre and inverse covariance of each group: _GROUP, h, m*, v*, c* (variances), log_det."""
    spark = found.sparkSession
    rows = found.filter(~F.col("base_failed"))
    q = chi_square_quantile(core, _P)
    factor = core / chi_square(q, _P + 2)  # makes the covariance of the core that of the whole, if it is normal
    # Start: medians, and quartiles for the scales. Rounded values keep each group's count table small.
    quartiles = [F.percentile(F.round(x, 2), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i, x in enumerate(VECTOR)]
    start = keep(rows.groupBy(*_GROUP).agg(*quartiles), "quartiles")
    floor = floors(rows, start, chi_square_quantile(0.999, _P))
    zero = F.lit(0.0)
    now = start.select(
        *_GROUP,
        *(F.col(f"q{i}")[1].alias(m) for i, m in enumerate(_CENTRE)),
        *((1 / (F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(2.0)) + float(floor[i])) if i == j else zero).alias(f"v{i}{j}") for i, j in _PAIRS),
    ).withColumns({c: 1 / F.col(f"v{i}{i}") for i, c in enumerate(_VARIANCE)})
    now, before = keep(now, "start"), math.inf
    for step in range(steps):
        d2 = distance([F.col(m) for m in _CENTRE], {p: F.col(f"v{p[0]}{p[1]}") for p in _PAIRS})
        binned = rows.join(now.select(*_GROUP, *_CENTRE, *_INVERSE), _GROUP).withColumn("bin", F.floor(16 * F.log2(F.greatest(d2, F.lit(2.0**-20)))))
        sums_ = binned.groupBy(*_GROUP, "bin").agg(
            F.count("*").cast("double").alias("n"),
            *(F.sum(x).alias(x) for x in VECTOR),
            *(F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(s) for (i, j), s in zip(_PAIRS, _MOMENTS)),
        )
        # Written before they are grouped: else Spark deals the partial sums by group alone, all of a large one to one task.
        sums_ = keep(sums_, f"bins{step}")
        raw = keep(sums_.groupBy(*_GROUP).applyInPandas(_core(core), _schema([*_GROUP, "h", *_CENTRE, *_MOMENTS])), f"core{step}")
        weight = F.sum("h")
        pooled = raw.agg(*((F.sum(F.col(c) * F.col("h")) / weight).alias(c) for c in [*_CENTRE, *_MOMENTS])).first()
        if pooled[0] is None:
            break
        now = keep(raw.mapInPandas(_settle(np.array(pooled), factor, prior_docs, floor), _schema([*_GROUP, "h", *_CENTRE, *_INVERSE, *_VARIANCE, "log_det"])), f"estimate{step}")
        after = now.agg(F.sum(F.col("log_det") * F.col("h")) / weight).first()[0]
        if after >= before - 1e-4:
            break
        before = after
    return now


def _far() -> Column:
    return F.when(~F.col("base_failed"), distance([F.col(m) for m in _CENTRE], {p: F.col(f"v{p[0]}{p[1]}") for p in _PAIRS}, [F.col(c) for c in _VARIANCE]))


def judge(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    core: float = 0.75, quantile: float = 0.999, prior_words: int = 60, prior_docs: float = 30.0, steps: int = 12, whole: bool = False,
) -> DataFrame:
    """One row per document: key, BASE, base_failed, kept, distance (null where the base rules fail).

    With `whole`, the documents that are kept instead, with all their columns; they are judged where they lie, without a
    join on ids.
    """
    columns = {"text": text, "lang": lang, "source": source}
    found = keep(statistics(docs, key=key, **columns), "statistics")
    total = totals(found)
    found = vectors(found, total, prior_words)
    known = estimates(found, core=core, prior_docs=prior_docs, steps=steps).select(*_GROUP, *_CENTRE, *_INVERSE, *_VARIANCE)
    limit = chi_square_quantile(quantile, _P)
    kept = F.coalesce(_far() <= limit, F.lit(False))
    if whole:
        again = vectors(statistics(docs, key=None, **columns), total, prior_words)
        return again.join(known, _GROUP, "left").filter(kept).select("doc.*")
    return found.join(known, _GROUP, "left").select(key, *BASE, "base_failed", kept.alias("kept"), _far().alias("distance"))
