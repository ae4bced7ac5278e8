"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other. Each model sees which telling words a document has and the earlier
categories' log odds. Those come from models that were fitted without the document's fold, so that the later models learn
how far the earlier ones can be trusted on documents they don't know. The threshold is chosen on their probabilities too,
and the mean of these models is what scores other documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linear import cross_fitted, folds, logit, one_label, probability, sample, telling_words, word_matrix

#: Labelled documents that the chain is fitted on, at most; words for each category; folds.
TRAIN_ROWS, WORDS, FOLDS = 20_000, 256, 4


def _features(words: np.ndarray, categories: Sequence[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.packbits(word_matrix(batch.column("text").to_pylist(), words).astype(bool), axis=1)
            rows = [pa.array([r.tobytes() for r in x], pa.binary()), batch.column("doc_id"), *[batch.column(c) for c in categories]]
            yield pa.RecordBatch.from_arrays(rows, ["x", "doc_id", *categories])

    return task


class Chain:
    """words: the features; weights: of each category's model; thresholds: from which probability on it is said to hold."""

    def __init__(self, words: np.ndarray, weights: list[np.ndarray], thresholds: list[float]):
        self.words, self.weights, self.thresholds = words, weights, thresholds

    def predict(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities: a row for each text, a column for each category."""
        x = word_matrix(texts, self.words)
        out: list[np.ndarray] = []
        for weights in self.weights:
            out.append(probability(np.column_stack([x, *map(logit, out)]), weights))
        return np.column_stack(out)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on the balance of precision and recall (F1) is best; 0.5 without cases."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    score = 2 * hits / (np.arange(1, len(p) + 1) + y.sum()) if y.sum() else np.zeros(0)
    score[:-1][np.diff(p[order]) == 0] = -1
    if not len(score) or score.max() <= 0:
        return 0.5
    at = int(score.argmax())
    after = p[order[at + 1]] if at + 1 < len(p) else 0.0
    return float((p[order[at]] + after) / 2)


def learn(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], rows: int = TRAIN_ROWS) -> Chain:
    """``categories``: in the order of the chain, each a condition on the columns of ``labels``."""
    names = list(categories)
    some = sample(one_label(labels, **categories), rows, "chain")
    known = docs.where("text IS NOT NULL").select("doc_id", "text").join(some, "doc_id")
    words = telling_words(known, names, WORDS, significant=True)
    table = known.mapInArrow(_features(words, names), "x binary, doc_id bigint, " + ", ".join(f"{c} int" for c in names))
    table = table.groupBy("doc_id").agg(*[F.min(c).alias(c) for c in ("x", *names)]).toPandas()  # a row for each label
    table = table.sort_values("doc_id")
    x = np.unpackbits(np.frombuffer(b"".join(table["x"]), np.uint8).reshape(len(table), -(-len(words) // 8)), axis=1, count=len(words)).astype(np.float32)
    fold = folds(table["doc_id"].to_numpy(), FOLDS)
    weights, thresholds, before = [], [], []
    for name in names:
        y = table[name].to_numpy(float)
        seen = np.column_stack([x, *map(logit, before)])
        p, w = cross_fitted(seen, y, fold)
        before.append(p)
        weights.append(w)
        thresholds.append(best_threshold(before[-1], y))
    return Chain(words, weights, thresholds)


def default_categories() -> dict[str, Column]:
    """The given labels name two things; poor text is no toxicity of its own, but tells about what follows."""
    return {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def score(docs: DataFrame, labels: DataFrame, categories: dict[str, Column] | None = None, rows: int = TRAIN_ROWS) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): doc_id, p_<category> for each of the chain, and ``toxic``.

    toxic: whether the last category's probability reaches the threshold that was best for it out of fold. ``labels``
    (doc_id and what the categories ask for): documents without a label, or with a null one, teach nothing; of repeated
    labels the largest counts. The chain is fitted on ``rows`` labelled documents at most, drawn by a hash of doc_id; all
    documents are scored. A null text is an empty one; both have no words. Without labels all probabilities are one half
    and nothing is toxic; if all labels agree, so do the predictions. Repeated rows have a row each; other columns aren't
    read; an empty table gives an empty result.
    """
    categories = categories or default_categories()
    chain = learn(docs, labels, categories, rows)
    names = [f"p_{c}" for c in categories]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 1000):
                part = batch.slice(i, 1000)
                p = chain.predict(part.column(1).to_pylist())
                toxic = p[:, -1] >= max(chain.thresholds[-1], 1e-9)
                toxic &= (chain.weights[-1] != 0).any()
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, p.T), pa.array(toxic)], ["doc_id", *names, "toxic"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id bigint, " + ", ".join(f"{n} double" for n in names) + ", toxic boolean")
