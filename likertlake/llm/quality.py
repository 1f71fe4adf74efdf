"""Text quality from weak labels.

Overlapping heuristics vote good, bad or nothing on every text. Spark counts the vote
patterns of all texts; expectation-maximisation on the counts estimates how often each
heuristic is right about either class, and with that the probability that a pattern
is a good text. Those posteriors are the labels of a hashed linear scorer, which reads
the text itself and so also judges texts on which the heuristics say little.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likertlake.llm import words as W
from likertlake.llm.share import column_udf, share

BAD, GOOD, NONE = 0, 1, 2
#: Frequent function words of the languages expected.
FUNCTION_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "le la les de des du et en un une que qui est dans pour au par sur pas "
    "el los las del y que en un una es por con para no se al"
)
#: Texts that the scorer is fitted to, and cells of its features.
SAMPLE, CELLS = 6000, 1 << 16
THRESHOLD = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:128] = True
_SYMBOL[48:58] = _SYMBOL[65:91] = _SYMBOL[97:123] = False
_COMMON = np.zeros(256, bool)  # marks of plain prose
_COMMON[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = True
_UPPER, _LOWER, _DIGIT, _BREAK = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91], _LOWER[97:123], _DIGIT[48:58], _BREAK[10] = True, True, True, True


class Measures:
    """What the heuristics look at, for each text of a slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, tables: tuple[W.Powers, W.Powers], function_words: np.ndarray) -> None:
        n = len(offsets) - 1
        share = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][offsets]) / np.maximum(size, 1)
        size = np.diff(offsets)
        self.size = size
        self.symbols, self.marks = share(_SYMBOL[data]), share(_SYMBOL[data] & ~_COMMON[data])
        upper, lower = share(_UPPER[data]), share(_LOWER[data])
        self.letters = (upper + lower) * size
        self.upper = upper / np.maximum(upper + lower, 1e-9)
        self.digits = share(_DIGIT[data])
        low = W.LOWER[data]
        self.words = W.split(low, offsets, W.ALNUM)
        self.hashes = W.word_hashes(self.words, tables[0])
        doc, count = self.words.doc, np.diff(self.words.first)
        self.count = count
        mean = lambda x: np.bincount(doc, x, n) / np.maximum(count, 1)
        length = self.words.ends - self.words.starts
        self.length = mean(length)
        self.function = mean(W.listed(self.hashes, function_words))
        key = W.mix(self.hashes + W.seeds(max(n, 1), 1 << 40)[doc])
        distinct = np.zeros(len(key), bool)
        distinct[np.unique(key, return_index=True)[1]] = True
        self.fresh = distinct  # a word's first occurrence in its text
        self.distinct = mean(distinct)
        self.again = np.r_[False, (self.hashes[1:] == self.hashes[:-1]) & (doc[1:] == doc[:-1])][: len(doc)]
        self.stutter = mean(self.again)
        blank = ~W.NOT_BLANK[data]
        gaps = np.diff(np.r_[0, np.cumsum(blank)][offsets])
        self.per_gap = count / np.maximum(gaps + 1, 1)


def _vote(good: np.ndarray, bad: np.ndarray, knows: np.ndarray | bool = True) -> np.ndarray:
    return np.where(knows & bad, BAD, np.where(knows & good, GOOD, NONE))


#: The heuristics. Each says nothing between its limits, or where it has too little to go by.
HEURISTICS: dict[str, Callable[[Measures], np.ndarray]] = {
    "symbols": lambda m: _vote(m.symbols < 0.06, m.symbols > 0.15, m.size >= 20),
    "marks": lambda m: _vote(m.marks < 0.02, m.marks > 0.06, m.size >= 20),
    "capitals": lambda m: _vote(m.upper < 0.2, m.upper > 0.5, m.letters >= 20),
    "function words": lambda m: _vote(m.function > 0.06, m.function < 0.015, m.count >= 20),
    "distinct words": lambda m: _vote(m.distinct > 0.35, m.distinct < 0.1, m.count >= 20),
    "stutter": lambda m: _vote(m.stutter < 0.1, m.stutter > 0.2, m.count >= 10),
    "word length": lambda m: _vote((m.length > 2.5) & (m.length < 9), (m.length < 2) | (m.length > 14), m.count >= 10),
    "words between blanks": lambda m: _vote(m.per_gap > 0.8, m.per_gap < 0.6, m.count >= 10),
    "digits": lambda m: _vote(m.digits < 0.1, m.digits > 0.3, m.size >= 20),
}


def _measured(batches: Iterator[pa.Array], use: Callable[[Measures], Iterator]) -> Iterator[list]:
    tables = W.powers()
    data, offsets = W.column(pa.array(FUNCTION_WORDS.split()))
    known = np.unique(W.word_hashes(W.split(data, offsets, W.ALNUM), tables[0]))
    for batch in batches:
        data, offsets = W.column(batch)
        yield [x for _, part, at in W.slices(data, offsets) for x in use(Measures(part, at, tables, known))]


def votes(m: Measures) -> list[str]:
    """A digit for each heuristic."""
    table = np.stack([h(m) for h in HEURISTICS.values()], 1)
    return ["".join(map(str, row)) for row in table.tolist()]


class Labels:
    """Prior of the good class, and of each heuristic the chance to be right about each class."""

    def __init__(self, patterns: dict[str, int], rounds: int = 200, tolerance: float = 1e-9) -> None:
        self.names = list(HEURISTICS)
        v = np.array([[int(c) for c in p] for p in patterns], np.int64).reshape(-1, len(self.names))
        n = np.array(list(patterns.values()), float)
        known = v != NONE
        # Bad texts are bad in different ways, so one bad vote says more than many good ones.
        good = 1 / (1 + np.exp(3.0 * (v == BAD).sum(1) - 2.0))
        self.prior, self.right = 0.5, np.full((2, len(self.names)), 0.7)
        for _ in range(rounds):
            # One count each way keeps the chances inside (0, 1).
            right = []
            for y, weight in ((BAD, n * (1 - good)), (GOOD, n * good)):
                hit = (weight[:, None] * (v == y)).sum(0)
                right.append(np.clip((hit + 1) / ((weight[:, None] * known).sum(0) + 2), 0.001, 0.999))
            right = np.array(right)
            # By assumption a bad vote is likelier on a bad text than on a good one.
            right[BAD] = np.maximum(right[BAD], 1 - right[GOOD])
            self.prior = float(np.clip((n * good).sum() + 1, 1e-6, None) / (n.sum() + 2))
            moved = np.abs(right - self.right).max()
            self.right = right
            good = self._posterior(v)
            if moved < tolerance:
                break
        self.posterior = dict(zip(patterns, good.tolist()))

    def _posterior(self, v: np.ndarray) -> np.ndarray:
        bad, good = np.log(self.right[BAD]), np.log(self.right[GOOD])
        not_bad, not_good = np.log1p(-self.right[BAD]), np.log1p(-self.right[GOOD])
        if_good = ((v == GOOD) * good + (v == BAD) * not_good).sum(1) + np.log(self.prior)
        if_bad = ((v == BAD) * bad + (v == GOOD) * not_bad).sum(1) + np.log1p(-self.prior)
        return 1 / (1 + np.exp(np.clip(if_bad - if_good, -500, 500)))


def features(m: Measures) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of each text and how often it has them, relative to its length.

    Three neighbouring bytes; for words their length, whether they repeat the last one,
    whether they occurred before.
    """
    data = m.words.data.astype(np.uint64)
    n = max(0, len(data) - 2)
    grams = W.mix(data[:n] << np.uint64(16) | data[1 : n + 1] << np.uint64(8) | data[2:]) % np.uint64(CELLS) if n else np.zeros(0, np.uint64)
    length = np.minimum(m.words.ends - m.words.starts, 30).astype(np.uint64)
    kinds = W.mix(length + np.uint64(100) * m.again + np.uint64(200) * m.fresh + np.uint64(1 << 50)) % np.uint64(CELLS)
    at = np.r_[0, np.cumsum(m.size)]
    for d in range(len(m.size)):
        own, words = grams[at[d] : max(at[d], at[d + 1] - 2)], kinds[m.words.first[d] : m.words.first[d + 1]]
        cells, count = np.unique(own, return_counts=True)
        kind, times = np.unique(words, return_counts=True)
        yield np.r_[cells, kind].astype(np.int32), np.r_[count / max(1, len(own)), times / max(1, len(words))].astype(np.float32)


class Scorer:
    """Logistic regression on hashed features, with soft labels."""

    def __init__(self) -> None:
        self.weight, self.bias = np.zeros(CELLS), 0.0

    def fit(self, doc: np.ndarray, cell: np.ndarray, value: np.ndarray, label: np.ndarray, rounds: int = 150, rate: float = 0.5, decay: float = 1e-5) -> Scorer:
        """``value`` of ``cell`` in text ``doc``, and the probability ``label`` of each text."""
        first, second = np.zeros(CELLS + 1), np.zeros(CELLS + 1)
        for step in range(1, rounds + 1):
            wrong = (1 / (1 + np.exp(-np.bincount(doc, value * self.weight[cell], len(label)) - self.bias)) - label) / len(label)
            grad = np.r_[np.bincount(cell, value * wrong[doc], CELLS) + decay * self.weight, wrong.sum()]
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
            self.weight -= move[:-1]
            self.bias -= move[-1]
        return self

    def __call__(self, m: Measures) -> list[float]:
        return [float(1 / (1 + np.exp(-np.clip(value @ self.weight[cell] + self.bias, -500, 500)))) for cell, value in features(m)]


def fit(docs: DataFrame, text: str = "text", id: str = "doc_id", sample: int = SAMPLE) -> tuple[Labels, Scorer]:
    """The label model of all texts' votes, and the scorer of at most ``sample`` texts.

    No given label is read. The sample is chosen by a hash of the id; only its features,
    at most the number of cells for each text, reach the driver. Null texts are left out.
    """
    rows = docs.select(F.xxhash64(f"`{id}`").alias("h"), F.col(f"`{text}`").alias("text")).where("text is not null")
    voted = column_udf(lambda batches: (pa.array(x, pa.string()) for x in _measured(batches, votes)), "string")
    counts = rows.select(voted("text").alias("votes")).groupBy("votes").count().collect()  # at most 3 ** heuristics
    labels = Labels({r["votes"]: r["count"] for r in sorted(counts)})
    # Rows up to the last hash of the sample are measured; the limit settles ties.
    last = rows.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for x in _measured(batches, lambda m: zip(votes(m), features(m))):
            yield pa.array([{"votes": v, "cells": c.tolist(), "values": f.tolist()} for v, (c, f) in x], _FEATURES)

    picked = rows.where(F.col("h") <= F.lit(last)).withColumn("f", column_udf(run, "struct<votes string, cells array<int>, values array<float>>")("text"))
    got = picked.orderBy("h", "f.votes", "f.cells").limit(sample).select("f.*").toArrow()
    if not got.num_rows:
        return labels, Scorer()
    cells, values = (got.column(c).combine_chunks() for c in ("cells", "values"))
    doc = np.repeat(np.arange(got.num_rows), cells.value_lengths().to_numpy())
    label = np.array([labels.posterior[v] for v in got.column("votes").to_pylist()])
    return labels, Scorer().fit(doc, cells.flatten().to_numpy(), values.flatten().to_numpy().astype(float), label)


_FEATURES = pa.struct([("votes", pa.string()), ("cells", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])


def score(docs: DataFrame, labels: Labels, scorer: Scorer, text: str = "text", to: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with a struct column ``to``: score, votes, posterior of the votes, and whether to keep.

    The score is the scorer's probability that the whole text is good; a text is kept from
    ``threshold`` on. A null or empty text scores 0 and goes. Votes are a digit for each
    heuristic (0 bad, 1 good, 2 nothing); patterns not met in fitting have a null posterior. A
    column ``to`` of ``docs`` is replaced, others stay as they are.
    """
    get = share(docs.sparkSession, (labels.posterior, scorer))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        posterior, scorer = get()
        for x in _measured(batches, lambda m: zip(scorer(m), votes(m), m.size.tolist())):
            rows = [{"score": s if n else 0.0, "votes": v, "posterior": posterior.get(v), "keep": bool(n and s >= threshold)} for s, v, n in x]
            yield pa.array(rows, _SCORES)

    keep = [f"`{c}`" for c in docs.columns if c != to]
    return docs.select(*keep, column_udf(run, "struct<score double, votes string, posterior double, keep boolean>")(f"`{text}`").alias(to))


_SCORES = pa.struct([("score", pa.float64()), ("votes", pa.string()), ("posterior", pa.float64()), ("keep", pa.bool_())])
