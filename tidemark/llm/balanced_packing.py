"""Packing documents into sequences of bounded length with balanced attention cost.

A piece of n tokens that attends within itself costs n + QUADRATIC * n * n. Each task packs what it reads in groups of
some thousand sequences: documents of a sequence or more fill whole sequences; what is left of them goes, in descending
order of cost, to the sequence of lowest cost that still has room for it whole, and is cut only if none has. A group has
just as many sequences as its tokens fill; what is over (less than one sequence) goes on to the next group, and at the
end of the task into sequences of powers of two, which need no padding.

One pass over the documents, nothing is shuffled: a sequence needs no document from elsewhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .shared import small_batches
from .tokens import encoder

#: Cost of a pair of tokens beside that of a token: with 1024 tokens the quadratic part is half as large as the linear.
QUADRATIC = 1 / 2048
#: A task packs its documents when it holds so many sequences of tokens.
GROUP_SEQUENCES = 512

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
NAMES = [x.split()[0] for x in PIECES.split(", ")]

#: A part of a document: its number in the group, its first token, its length.
Part = tuple[int, int, int]


def assign(parts: list[Part], capacity: int, sequences: int) -> tuple[list[list[Part]], list[Part]]:
    """Deal out parts, none longer than ``capacity``, to ``sequences`` sequences; (parts of each, what didn't fit)."""
    room, cost = np.full(sequences, capacity), np.zeros(sequences)
    dealt: list[list[Part]] = [[] for _ in range(sequences)]
    over: list[Part] = []

    def put(s: int, part: Part) -> None:
        dealt[s].append(part)
        room[s] -= part[2]
        cost[s] += part[2] + QUADRATIC * part[2] ** 2

    for doc, start, length in sorted(parts, key=lambda p: (-p[2], p[0], p[1])):
        fits = np.flatnonzero(room >= length)
        if len(fits):
            put(int(fits[cost[fits].argmin()]), (doc, start, length))
            continue
        while length:
            open_ = np.flatnonzero(room > 0)
            if not len(open_):
                over.append((doc, start, length))
                break
            s = int(open_[cost[open_].argmin()])
            cut = min(length, int(room[s]))
            put(s, (doc, start, cut))
            start, length = start + cut, length - cut
    return dealt, over


def tail(parts: list[Part], capacity: int) -> list[list[Part]]:
    """Sequences of powers of two that take parts of less than ``capacity`` tokens together, without padding."""
    total, made, rest = sum(p[2] for p in parts), [], list(parts)
    for size in [1 << b for b in reversed(range(capacity.bit_length())) if total >> b & 1]:
        sequence, free = [], size
        while free:
            doc, start, length = rest.pop(0)
            cut = min(length, free)
            sequence.append((doc, start, cut))
            free -= cut
            if cut < length:
                rest.insert(0, (doc, start + cut, length - cut))
        made.append(sequence)
    return made


def _pack(capacity: int, group: int, end_id: int, tokenizer: str | None):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        task_number = TaskContext.get().partitionId()
        docs: dict[int, tuple[int | None, np.ndarray]] = {}
        left: list[Part] = []
        held, number, made = 0, 0, 0

        def rows(sequences: list[list[Part]]) -> pa.RecordBatch:
            nonlocal made
            out = []
            for sequence in sequences:
                offset = 0
                for doc, start, length in sequence:
                    doc_id, ids = docs[doc]
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    out.append((doc_id, start, length, crc, len(ids), (task_number << 36) + made, offset))
                    offset += length
                made += 1
            columns = zip(*out) if out else [()] * len(NAMES)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], NAMES)

        for batch in batches:
            names = batch.column(0)
            for i, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                docs[number] = (names[i].as_py(), ids)
                whole = len(ids) // capacity
                if whole:
                    yield rows([[(number, k * capacity, capacity)] for k in range(whole)])
                if len(ids) % capacity:
                    left.append((number, whole * capacity, len(ids) % capacity))
                    held += len(ids) % capacity
                else:
                    del docs[number]
                number += 1
                if held >= group * capacity:
                    sequences, left = assign(left, capacity, held // capacity)
                    yield rows(sequences)
                    held = sum(p[2] for p in left)
                    docs = {p[0]: docs[p[0]] for p in left}
        sequences, left = assign(left, capacity, held // capacity)
        yield rows(sequences)
        yield rows(tail(left, capacity))

    return task


def pack(
    docs: DataFrame, capacity: int = 1024, group: int = GROUP_SEQUENCES, end_id: int = 0, tokenizer: str | None = None
) -> DataFrame:
    """Pieces of the token sequences of ``docs`` (doc_id, text), see PIECES: each token lies in just one of them.

    A document is its tokens (``tokenizers``, no special tokens added) and ``end_id``. start: its tokens before the piece;
    ids_crc32: of the piece's ids as little-endian 32-bit numbers; offset: the piece's place in its sequence.
    ``capacity`` is a power of two. A null or empty text is ``end_id`` alone. Null ids and rows that repeat a doc_id are
    documents of their own. An empty table gives no pieces; other columns aren't read. Documents of any length are cut.
    ``group``: sequences that a task packs together; it bounds the memory (some 4 bytes for each token of their documents).
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_pack(capacity, group, end_id, tokenizer), PIECES)
