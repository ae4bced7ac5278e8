"""Languages of a document as a mixture.

Each language's model is the frequency of its letter trigrams (of lower-cased words, with their ends), in BUCKETS hash
buckets, counted over all learnable documents. A document's words are drawn from a mixture of the languages and of noise,
under which all trigrams are equally likely. Expectation-maximisation estimates the proportions; it is run again on the
one, two, ... strongest components alone, up to all of them, and the set with the highest likelihood less half a log of
the number of words for each further component (BIC) is taken. Larger sets are left out only where a bound of the likelihood
shows that none can be better.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import forget, small_batches, stored

BITS = 15
BUCKETS = 1 << BITS
#: The model has BUCKETS numbers for each language, 128 KB, and is sent to every task in parts of so many languages.
PART_LANGUAGES = 128
#: Characters that a task looks at together; longer texts are taken in slices of this length.
SLICE = 1 << 18
#: Rounds of EM on all components, and on each set.
ROUNDS, ROUNDS_OF_SET = 12, 6
UNDETERMINED = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams around each letter of lower-cased text, and where each word begins among them."""
    code = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    code = np.where(letter, code, np.uint32(0))
    at = np.flatnonzero(letter)
    mixed = code[at - 1] * np.uint32(0x9E3779B1) + code[at] * np.uint32(0x85EBCA77) + code[at + 1] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(32 - BITS)).astype(np.int64), np.flatnonzero(~letter[at - 1])


def slices(texts: list[str | None]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Lower-cased texts put together up to SLICE characters: (text, numbers of the documents, where each begins)."""
    held, numbers, starts, length = [], [], [], 0
    for number, text in enumerate(texts):
        lower = (text or "").lower()
        for i in range(0, len(lower), SLICE):
            part = lower[i : i + SLICE]
            if length + len(part) > SLICE and held:
                yield " ".join(held), np.array(numbers), np.array(starts)
                held, numbers, starts, length = [], [], [], 0
            held.append(part)
            numbers.append(number)
            starts.append(length)
            length += len(part) + 1
    if held:
        yield " ".join(held), np.array(numbers), np.array(starts)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            total = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for text, _, _ in slices([t for t, x in zip(texts, langs) if x == lang]):
                total += np.bincount(trigrams(text)[0], minlength=BUCKETS)
    for lang, total in counts.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at])], ["lang", "bucket", "n"])


def learn(docs: DataFrame) -> tuple[list[str], list]:
    """Languages, and the log probability of each bucket under each, of all documents with text and lang that aren't held out.

    The second is a list of broadcast tables, a column for each language, PART_LANGUAGES in each but the last.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counted = rows.select("text", "lang").mapInArrow(_count, "lang string, bucket int, n bigint")
    counted = stored(counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "trigrams")
    langs = sorted(r.lang for r in counted.select("lang").distinct().collect())
    parts = []
    for i in range(0, len(langs), PART_LANGUAGES):
        own = langs[i : i + PART_LANGUAGES]
        table = counted.where(F.col("lang").isin(own)).toPandas()
        counts = np.full((BUCKETS, len(own)), 0.1)
        counts[table["bucket"], [own.index(x) for x in table["lang"]]] += table["n"]
        parts.append(docs.sparkSession.sparkContext.broadcast(np.log(counts / counts.sum(axis=0)).astype(np.float32)))
    forget(counted)
    return langs, parts


def mixture(words: np.ndarray, starts: np.ndarray, shares: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM for many documents at once: (shares, log likelihood) of each.

    words: relative likelihood of each word under each component; starts: the first word of each document; shares: where
    to begin, components at 0 stay out.
    """
    lengths = np.diff(np.append(starts, len(words)))
    document = np.repeat(np.arange(len(starts)), lengths)
    for i in range(rounds + 1):
        joint = words * shares[document]
        total = np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)
        if i == rounds:
            return shares, np.add.reduceat(np.log(total[:, 0], dtype=np.float64), starts)
        joint /= total
        shares = np.add.reduceat(joint, starts) / lengths[:, None]
    raise AssertionError


def choose(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares under the chosen set, shares under all components) of each document; words: log likelihoods."""
    words = np.exp(words - words.max(axis=1, keepdims=True))
    components = words.shape[1]
    lengths = np.diff(np.append(starts, len(words)))
    full, _ = mixture(words, starts, np.full((len(starts), components), 1 / components, np.float32), ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    # The likelihood is concave: no shares reach more than that of ``full`` and the steepest of its slopes less their mean.
    document = np.repeat(np.arange(len(starts)), lengths)
    total = np.maximum((words * full[document]).sum(axis=1, keepdims=True), 1e-30)
    slopes = np.add.reduceat((words / total).astype(np.float64), starts)
    bound = np.add.reduceat(np.log(total[:, 0], dtype=np.float64), starts) + slopes.max(axis=1) - lengths + 1e-4 * lengths
    best, best_score = np.zeros_like(full), np.full(len(starts), -np.inf)
    left = np.arange(len(starts))
    for size in range(1, components + 1):
        left = left[bound[left] - (size - 1) / 2 * np.log(lengths[left]) > best_score[left]]
        if not len(left):
            break
        begin = np.zeros((len(left), components), np.float32)
        np.put_along_axis(begin, order[left, :size], np.float32(1 / size), axis=1)
        own = np.zeros(len(starts), bool)
        own[left] = True
        first = np.cumsum(lengths[left]) - lengths[left]
        shares, likelihood = mixture(words[own[document]], first, begin, ROUNDS_OF_SET if size > 1 else 0)
        score = likelihood - (size - 1) / 2 * np.log(lengths[left])
        better = score > best_score[left]
        best[left[better]], best_score[left[better]] = shares[better], score[better]
    return best, full


RESULT = "doc_id bigint, held_out boolean, lang_pred string, score double, noise double, languages array<struct<lang:string,share:double>>"


def _predict(langs: list[str], model: list):
    noise = np.float32(-BITS * np.log(2))

    def scored(texts: list[str | None]) -> list[tuple]:
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for text, numbers, starts in slices(texts):
            buckets, begins = trigrams(text)
            if not len(begins) or not langs:
                continue
            words = np.column_stack([np.add.reduceat(part.value[buckets], begins) for part in model])
            lengths = np.diff(np.append(begins, len(buckets))).astype(np.float32)
            words = np.column_stack([words, lengths * noise])
            at = np.flatnonzero(_letters()[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)])
            owner = np.searchsorted(starts, at[begins] - 1, side="right") - 1
            cuts = np.searchsorted(owner, np.arange(len(numbers) + 1))
            for i, number in enumerate(numbers):
                if cuts[i] < cuts[i + 1]:
                    parts[number].append(words[cuts[i] : cuts[i + 1]])
        out = [(UNDETERMINED, 0.0, 0.0, [])] * len(texts)
        known = [i for i, p in enumerate(parts) if p]
        for group in np.array_split(known, max(1, sum(len(x) for i in known for x in parts[i]) * (len(langs) + 1) // 1_000_000)):
            if not len(group):
                continue
            lists = [np.concatenate(parts[i]) for i in group]
            shares, full = choose(np.concatenate(lists), np.cumsum([0] + [len(x) for x in lists[:-1]]))
            for i, own, every in zip(group, shares.astype(float), full):
                first = int(own[:-1].argmax()) if own[:-1].any() else int(every[:-1].argmax())
                order = [k for k in np.argsort(-own[:-1], kind="stable") if own[k] > 0]
                out[i] = (langs[first], min(1.0, own[first]), own[-1], [{"lang": langs[k], "share": own[k]} for k in order])
        return out

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, 5000 // (len(langs) + 5))
            for i in range(0, len(batch), rows):
                part = batch.slice(i, rows)
                lang, score, other, list_ = zip(*scored(part.column(2).to_pylist()))
                kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
                columns = [part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(other, pa.float64()), pa.array(list_, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "noise", "languages"])

    return task


def identify(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text, lang), see RESULT.

    lang_pred: the language with the largest share of the words, the first by name among equals; score: that share;
    noise: the share of words that no language explains; languages: the chosen set, largest share first.
    A null text, or one without letters, is ``und`` with score 0, and so is every text if nothing could be learned. Rows
    without lang or doc_id teach nothing but are predicted (held_out is false without an id). Repeated rows count as
    often as they occur and have a row each. An empty table gives an empty result. Other columns aren't read.
    """
    langs, model = learn(docs)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(_predict(langs, model), RESULT)


def reject(docs: DataFrame, most_noise: float = 0.5) -> DataFrame:
    """``docs`` without those that are ``und`` or more than ``most_noise`` noise.

    A row is judged by its text alone, whatever its other columns: rows with a null or empty text go, rows with a null id
    are judged (but teach nothing), repeated rows stay or go together. An empty table gives an empty result, and so does
    one that nothing can be learned from. Other columns travel along.
    """
    langs, model = learn(docs)
    predict = _predict(langs, model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none, text = pa.nulls(len(batch), pa.int64()), batch.column("text")
            asked = pa.RecordBatch.from_arrays([none, pa.array([False] * len(batch)), text], ["doc_id", "held_out", "text"])
            at = 0
            for x in predict(iter([asked])):  # the rows of the batch in order, some at a time
                keep = [a != UNDETERMINED and b <= most_noise for a, b in zip(x.column("lang_pred").to_pylist(), x.column("noise").to_pylist())]
                yield batch.slice(at, len(x)).filter(pa.array(keep, pa.bool_()))
                at += len(x)

    return docs.mapInArrow(task, docs.schema)
