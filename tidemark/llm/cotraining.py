"""Quality by co-training: what the text is like, and what is known about the page, teach each other.

Two linear classifiers look at a document separately: one at its text (telling words, kinds of characters, repetition),
one at its metadata (source, language, length). In each round both judge all documents without labels, and those that one
is surest about become labels for the other. At the end both are calibrated on labelled documents that neither has
learned from, and a logistic combination of the two calibrated log odds scores every document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import fit, folds, logit, one_label, probability, sample, telling_words, word_matrix
from .shared import forget, stored

#: Labelled documents to learn from, at most; words; rounds; how sure is sure.
TRAIN_ROWS, WORDS, ROUNDS, SURE = 20_000, 256, 3, 0.97
#: Documents that a view gives the other in a round, of the labels of each class.
GIVEN_SHARE = 0.1
#: Sources and languages share so many columns, by hash.
NAMED = 128
#: Of FOLDS parts of the labelled documents one is left for the calibration.
FOLDS = 5

KIND = np.zeros(256, np.int64)
for _b in range(256):
    KIND[_b] = 6 if _b >= 128 else 0 if chr(_b).islower() else 1 if chr(_b).isupper() else 2 if chr(_b).isdigit() else 3 if _b == 10 else 4 if chr(_b).isspace() else 5


def _shape(text: str | None) -> list[float]:
    """Shares of the kinds of characters; how much words and lines repeat; mean lengths of words and lines."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return [0.0] * 12
    kinds = np.bincount(KIND[np.frombuffer(data, np.uint8)], minlength=7) / len(data)
    words, lines = data.split(), data.split(b"\n")
    ends = sum(w[-1:] in b"*$%&#!|" and len(w) > 1 for w in words) / max(1, len(words))
    return [*kinds, len(set(words)) / max(1, len(words)), len(set(lines)) / len(lines), ends, np.log1p(len(data) / max(1, len(words))), np.log1p(len(data) / len(lines))]


def text_view(texts: list[str | None], words: np.ndarray) -> np.ndarray:
    return np.column_stack([word_matrix(texts, words), np.array([_shape(t) for t in texts], np.float32).reshape(len(texts), 12)])


def page_view(sources: list[str | None], langs: list[str | None], lengths: list[int]) -> np.ndarray:
    x = np.zeros((len(sources), NAMED + 2), np.float32)
    for i, (source, lang, length) in enumerate(zip(sources, langs, lengths)):
        x[i, zlib.crc32(f"source {source}".encode()) % NAMED] += 1
        x[i, zlib.crc32(f"lang {lang}".encode()) % NAMED] += 1
        x[i, NAMED:] = np.log1p(length or 0) / 10, (np.log1p(length or 0) / 10) ** 2
    return x


def pack(text: np.ndarray, page: np.ndarray) -> list[bytes]:
    """Both views of each document in some two hundred bytes: words as bits, sources and languages as bytes."""
    parts = [np.packbits(text[:, :-12].astype(bool), axis=1), page[:, :NAMED].astype(np.uint8)]
    parts += [np.ascontiguousarray(x, np.float16).view(np.uint8) for x in (text[:, -12:], page[:, NAMED:])]
    return [x.tobytes() for x in np.concatenate(parts, axis=1)]


def unpack(rows: list[bytes], words: int) -> list[np.ndarray]:
    """(text view, page view) of packed rows."""
    bits = -(-words // 8)
    x = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), bits + NAMED + 28)
    named, shape, length = np.split(x[:, bits:], [NAMED, NAMED + 24], axis=1)
    shape, length = (np.ascontiguousarray(part).view(np.float16) for part in (shape, length))
    views = (np.unpackbits(x[:, :bits], axis=1, count=words), shape), (named, length)
    return [np.concatenate(view, axis=1).astype(np.float32) for view in views]


def _views(words: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 1000):
                part = batch.slice(i, 1000)
                c = {n: part.column(n).to_pylist() for n in ("text", "source", "lang", "length")}
                rows = pack(text_view(c["text"], words), page_view(c["source"], c["lang"], c["length"]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "x"])

    return task


def packed_views(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """(doc_id, x): both views packed, a stored row for each row of ``docs``. Later steps read these and no texts."""
    return stored(docs.mapInArrow(_views(words), "doc_id bigint, x binary"), "views")


def one_each(views: DataFrame) -> DataFrame:
    """A row for each doc_id; of rows that repeat it the smallest by bytes."""
    return views.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("x").alias("x"))


SUREST = "view int, label int, doc_id bigint, q double, x binary"


def _surest(weights: list[np.ndarray], words: int, given: list[np.ndarray], most: dict[int, int], sure: float):
    """Of rows (doc_id, x): the documents of each class that each view of a task is surest about and that aren't given yet."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {(v, label): [] for v in (0, 1) for label in (0, 1)}
        for batch in batches:
            for i in range(0, len(batch), 10_000):
                part = batch.slice(i, 10_000)
                ids, rows = part.column("doc_id").to_numpy(), part.column("x").to_pylist()
                p = [probability(x, w) for x, w in zip(unpack(rows, words), weights)]
                agree = ~(((p[0] >= sure) & (p[1] <= 1 - sure)) | ((p[1] >= sure) & (p[0] <= 1 - sure)))
                for (v, label), best in held.items():
                    q = p[v] if label else 1 - p[v]
                    at = np.flatnonzero((q >= sure) & agree & ~np.isin(ids, given[1 - v]))
                    at = at[np.lexsort((ids[at], -q[at]))][: most[label]]
                    best += [(-q[j], int(ids[j]), rows[j]) for j in at]
                    best.sort()
                    del best[most[label] :]
        for (v, label), best in held.items():
            columns = [[v] * len(best), [label] * len(best), [b[1] for b in best], [-b[0] for b in best], [b[2] for b in best]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in SUREST.split(", ")])

    return task


class Views:
    """weights of both views, of their calibrations and of the combination."""

    def __init__(self, words: np.ndarray, views: list[np.ndarray], calibrations: list[np.ndarray], combination: np.ndarray):
        self.words, self.views, self.calibrations, self.combination = words, views, calibrations, combination

    def score(self, xs: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """(calibrated probability of each view, combined probability)"""
        odds = [logit(probability(x, w)) for x, w in zip(xs, self.views)]
        own = [probability(o[:, None], c) for o, c in zip(odds, self.calibrations)]
        return own, probability(np.column_stack([logit(p) for p in own]), self.combination)


def cotrain(labelled: list[np.ndarray], y: np.ndarray, pool: DataFrame, words: int, rounds: int, sure: float, given_share: float) -> list[np.ndarray]:
    """Weights of each view. Per round both views judge all of ``pool`` (doc_id, x), and each gives the other its surest
    documents of each class, at most ``given_share`` of that class's labels; a document that both are sure of
    but disagree about is given to none. Only the documents that are given come to the driver."""
    given: list[dict[int, tuple[int, bytes]]] = [{}, {}]
    most = {label: max(1, int((y == label).sum() * given_share)) for label in (0, 1)}
    weights = []
    for r in range(rounds + 1):
        weights = []
        for v in (0, 1):
            extra = [given[v][i] for i in sorted(given[v])]
            more = unpack([x for _, x in extra], words)[v]
            weights.append(fit(np.concatenate([labelled[v], more]), np.concatenate([y, [label for label, _ in extra]])))
        if r == rounds:
            break
        known = [np.array(sorted(g), np.int64) for g in given]
        surest = stored(pool.select("doc_id", "x").mapInArrow(_surest(weights, words, known, most, sure), SUREST), "surest")
        for v in (0, 1):
            for label in (0, 1):
                best = surest.where(f"view = {v} AND label = {label}").orderBy(F.desc("q"), "doc_id").limit(most[label])
                for row in best.collect():
                    given[1 - v].setdefault(row.doc_id, (label, bytes(row.x)))
        forget(surest)
    return weights


def learn(
    docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, rounds: int = ROUNDS, sure: float = SURE, given_share: float = GIVEN_SHARE
) -> tuple[Views, DataFrame]:
    """(what was learned, the stored views of all rows of ``docs``)"""
    docs = docs.select("doc_id", "text", "source", "lang", F.length(F.coalesce("text", F.lit(""))).alias("length"))
    known = stored(one_label(labels, good=F.col("quality") == 1), "labels")
    chosen = sample(known, rows, "views")
    words = telling_words(docs.join(chosen, "doc_id"), ["good"], WORDS)
    every = packed_views(docs, words)
    table = one_each(every.join(chosen.select("doc_id"), "doc_id")).join(chosen, "doc_id").toPandas().sort_values("doc_id")
    xs, y = unpack(list(table["x"]), len(words)), table["good"].to_numpy(float)
    if not len(table):
        nothing = np.zeros(2)
        forget(known)
        return Views(words, [np.zeros(x.shape[1] + 1) for x in xs], [nothing, nothing], np.zeros(3)), every
    apart = folds(table["doc_id"].to_numpy(), FOLDS) == 0
    if apart.all() or not apart.any():
        train, apart = np.ones(len(table), bool), np.ones(len(table), bool)
    else:
        train = ~apart
    pool = stored(one_each(every.join(known, "doc_id", "left_anti")), "pool")
    weights = cotrain([x[train] for x in xs], y[train], pool, len(words), rounds, sure, given_share)
    forget(pool, known)
    odds = [logit(probability(x[apart], w)) for x, w in zip(xs, weights)]
    calibrations = [fit(o[:, None], y[apart], 1e-3) for o in odds]
    own = np.column_stack([logit(probability(o[:, None], c)) for o, c in zip(odds, calibrations)])
    return Views(words, weights, calibrations, fit(own, y[apart], 1e-3)), every


RESULT = "doc_id bigint, p_text double, p_page double, score double, keep boolean"


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text, source, lang): what each view thinks, score (that it is good), keep.

    keep: a score of ``threshold`` or more. ``labels`` (doc_id, quality): documents without a label, or with a null one,
    are the pool, all that have a doc_id; of repeated labels the best counts. At most ``rows`` labelled documents, drawn by a
    hash of doc_id, are learned from, and a view is given at most ``given_share`` of them in a round; of rows that repeat a
    doc_id, one teaches. All documents are scored. A null text is an empty one, null source
    and lang are values of their own. Without labels every score is one half, and all is kept. Repeated rows have a row
    each; other columns aren't read; an empty table gives an empty result.
    """
    views, every = learn(docs, labels, **options)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 10_000):
                part = batch.slice(i, 10_000)
                own, both = views.score(unpack(part.column("x").to_pylist(), len(views.words)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, own), pa.array(both), pa.array(both >= threshold)], [x.split()[0] for x in RESULT.split(", ")])

    return every.mapInArrow(task, RESULT)
