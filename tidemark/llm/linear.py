"""What the classifiers share: a bounded sample of labelled documents, words as features, logistic regression."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .signature_tree import gram_sets

#: ASCII letters, digits and all bytes of other characters stay, the rest parts words.
LETTERS = bytes(b if b >= 128 or chr(b).isalnum() else 0x20 for b in range(256))
#: A word that is in fewer documents of the sample is no feature.
LEAST_DOCUMENTS = 5


def word_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct word hashes of each text."""
    return gram_sets(texts, 1, LETTERS)


def sample(rows: DataFrame, size: int, seed: str) -> DataFrame:
    """The ``size`` rows of ``rows`` (doc_id, ...) that come first by a hash of doc_id, marked for broadcast."""
    return F.broadcast(rows.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(size))


def _documents_with(columns: int):
    """Of rows (text, then 0/1 columns): for each word, in how many documents it is, of all and of those with each column."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(word_sets(batch.column(0).to_pylist()))
            marks = np.column_stack([np.ones(len(batch)), *[batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(columns)]])
            words, where = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_inverse=True)
            weights = np.repeat(marks, [len(s) for s in sets], axis=0)
            counts = [np.bincount(where, weights[:, i], len(words)).astype(np.int64) for i in range(columns + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), *map(pa.array, counts)], ["word", *[f"n{i}" for i in range(columns + 1)]])

    return task


def telling_words(documents: DataFrame, columns: Sequence[str], each: int, significant: bool = False) -> np.ndarray:
    """The ``each`` words that tell most about each of the 0/1 ``columns`` (by the statistic of a fourfold table), sorted.

    ``significant``: only words whose statistic is above what the best of as many words without any meaning reach.
    """
    counts = [f"n{i}" for i in range(len(columns) + 1)]
    rows = documents.select("text", *[F.col(c).cast("int") for c in columns])
    words = rows.mapInArrow(_documents_with(len(columns)), "word bigint, " + ", ".join(f"{c} bigint" for c in counts))
    words = words.groupBy("word").agg(*[F.sum(c).alias(c) for c in counts]).where(F.col("n0") >= LEAST_DOCUMENTS)
    totals = rows.agg(F.count("*").alias("all"), *[F.sum(c).alias(c) for c in columns]).first()
    found: set[int] = set()
    words = words.cache() if len(columns) > 1 or significant else words
    least = math.sqrt(2 * math.log(max(1, words.count()))) if significant else 0.0
    for i, c in enumerate(columns):
        own, rest = totals[c] or 0, totals["all"] - (totals[c] or 0)
        if not own or not rest:
            continue
        expected = F.col("n0") * (own / totals["all"])
        spread = expected * (rest / totals["all"]) * (1 - F.col("n0") / (totals["all"] + 1))
        tells = F.abs(F.col(f"n{i + 1}") - expected) / F.sqrt(spread + 0.5)
        found |= {r.word for r in words.where(tells >= least).orderBy(tells.desc(), "word").limit(each).collect()}
    words.unpersist()
    return np.sort(np.array(sorted(found), np.int64).view(np.uint64))


def word_matrix(texts: list[str | None], words: np.ndarray) -> np.ndarray:
    """A row for each text, a column for each of the sorted ``words``: 1 if the text has it."""
    x = np.zeros((len(texts), len(words)), np.float32)
    if len(words):
        for i, own in enumerate(word_sets(texts)):
            at = np.minimum(np.searchsorted(words, own), len(words) - 1)
            x[i, at[words[at] == own]] = 1
    return x


def probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of rows ``x`` under ``weights``, the last of which is the constant."""
    return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression by Newton's method, squared weights penalised; the constant is not."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)]).astype(np.float64)
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + ridge * weights
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def folds(ids: np.ndarray, n: int) -> np.ndarray:
    """A fold for each id, the same for equal ids."""
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(33)) % np.uint64(n)).astype(int)


def cross_fitted(x: np.ndarray, y: np.ndarray, fold: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """The probability of each row by a model that was fitted without its fold, and the mean weights of these models.

    So the probabilities tell what to expect of the weights, also where a threshold is best.
    """
    p, weights = np.full(len(y), y.mean() if len(y) else 0.0), []
    for f in np.unique(fold):
        own = fold == f
        if (~own).any():
            weights.append(fit(x[~own], y[~own], penalty))
            p[own] = probability(x[own], weights[-1])
    return p, np.mean(weights, axis=0) if weights else fit(x, y, penalty)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def one_label(labels: DataFrame, **columns: Column) -> DataFrame:
    """A row for each doc_id of ``labels``: of repeated labels the largest counts; rows without doc_id or label go."""
    rows = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(c.cast("int")).alias(n) for n, c in columns.items()])
    return rows.dropna()
