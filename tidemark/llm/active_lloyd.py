"""Vector codes by product quantisation, whose codebooks are found by Lloyd's rounds with active entries.

Vectors become integers, floor(scale * x), and are cut into equal parts. Each part position has a codebook of some entries.
A round assigns every part to its nearest entry and moves each entry to the mean of its parts. Every part keeps its entry and
its exact squared distance. If that entry did not move, the distance still holds and so do those to all entries that did not
move, so that only the moved (active) entries are compared with it. The parts of a moved entry look at all entries. Among
equal distances the lower index wins, in both cases, so the codes are those of complete scans.

The state is a table of blocks in the shared folder, written anew in each round. A block also holds by how much its changed
parts alter the sums and counts of the entries: the driver adds up these few whole numbers, never vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, small_batches, stored
from .vectors import integer_matrix, matrix_bytes, matrix_of, usable_vectors, with_total

#: Vectors of a block.
BLOCK = 4096
#: Scaled components stay below this, so that the squared distances of 64 of them add up in a long.
LIMIT = 1 << 27

BLOCKS = "vec_id array<bigint>, label array<bigint>, x binary, code binary, distance binary, change binary"
NAMES = [c.split()[0] for c in BLOCKS.split(", ")]
RESULT = "vec_id bigint, label bigint, code string, error bigint"


def squared_distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to each entry, whole numbers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * most * most * x.shape[1] < 1 << 53:  # sums of whole numbers that a double holds exactly
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((x - entry) ** 2).sum(axis=1) for entry in book], axis=1)


def reassign(x: np.ndarray, code: np.ndarray, distance: np.ndarray, book: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New (code, distance) of the parts ``x`` at one position; ``moved``: which entries changed since the old ones."""
    code, distance = code.copy(), distance.copy()
    again = moved[code]
    if again.any():
        d = squared_distances(x[again], book)
        code[again] = d.argmin(axis=1)
        distance[again] = d.min(axis=1)
    active, rest = np.flatnonzero(moved), np.flatnonzero(~again)
    if len(active) and len(rest):
        d = squared_distances(x[rest], book[active])
        entry, least = active[d.argmin(axis=1)], d.min(axis=1)
        better = (least < distance[rest]) | ((least == distance[rest]) & (entry < code[rest]))
        code[rest[better]], distance[rest[better]] = entry[better], least[better]
    return code, distance


def _blocks(scale: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), BLOCK):
                part = batch.slice(i, BLOCK)
                x = integer_matrix(part.column("embedding"), scale)
                row = [part.column("vec_id").to_pylist(), part.column("label").to_pylist(), matrix_bytes(x), None, None, None]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _kinds())], NAMES)

    return task


def _kinds() -> list[pa.DataType]:
    return [pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 4]


def _rounds(books: np.ndarray, moved: np.ndarray):
    """Of blocks: blocks with new codes, distances and changes. books: (parts, entries, components of a part)."""
    parts, entries, width = books.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids, label, data, code, distance, _ = (batch.column(c)[i] for c in range(6))
                n = len(ids)
                x = matrix_of(data.as_py(), n, parts * width).reshape(n, parts, width)
                first = not code.is_valid
                old = np.zeros((n, parts), np.uint8) if first else np.frombuffer(code.as_py(), np.uint8).reshape(n, parts)
                held = np.zeros((n, parts), np.int64) if first else matrix_of(distance.as_py(), n, parts)
                new, found = old.copy(), held.astype(np.int64)
                change = np.zeros((parts, entries, width + 1), np.int64)
                for p in range(parts):
                    own = x[:, p].astype(np.int64)
                    new[:, p], found[:, p] = reassign(own, old[:, p], found[:, p], books[p], moved[p] | first)
                    counted = np.column_stack([own, np.ones(n, np.int64)])
                    other = np.ones(n, bool) if first else new[:, p] != old[:, p]
                    np.add.at(change[p], new[other, p], counted[other])
                    if not first:
                        np.subtract.at(change[p], old[other, p], counted[other])
                row = [ids.as_py(), label.as_py(), data.as_py(), new.tobytes(), matrix_bytes(found), change.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _kinds())], NAMES)

    return task


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for data in batch.column(0).to_pylist():
            own = np.frombuffer(data, np.int64)
            total = own.copy() if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "value"])


def _changes(blocks: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The changes of all blocks added up: a number for each component of each entry, and a count."""
    rows = blocks.select("change").mapInArrow(_added, "at bigint, value bigint").groupBy("at").agg(F.sum("value").alias("value"))
    total = np.zeros(int(np.prod(shape)), np.int64)
    for row in rows.collect():
        total[row["at"]] = row["value"]
    return total.reshape(shape)


def first_books(vectors: DataFrame, scale: int, parts: int, entries: int, dimension: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids, null last; of repeated ids the smaller vector comes first."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow()
    x = integer_matrix(rows.column(0).combine_chunks(), scale) if rows.num_rows else np.zeros((0, dimension), np.int64)
    return np.ascontiguousarray(x.astype(np.int64).reshape(len(x), parts, dimension // parts).transpose(1, 0, 2))


def train(vectors: DataFrame, books: np.ndarray, scale: int, rounds: int) -> tuple[DataFrame, np.ndarray]:
    """(stored blocks with final codes and distances, final books) after ``rounds`` rounds and a last assignment."""
    state = stored(vectors.select("vec_id", "label", "embedding").mapInArrow(_blocks(scale), BLOCKS), "lloyd")
    sums = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
    moved = np.ones(books.shape[:2], bool)
    for i in range(rounds + 1):
        after = stored(state.mapInArrow(_rounds(books, moved), BLOCKS), "lloyd")
        forget(state)
        state = after
        if i == rounds:
            break
        sums += _changes(state, sums.shape)
        counts = sums[:, :, -1:]
        mean = np.where(counts > 0, sums[:, :, :-1] // np.maximum(counts, 1), books)
        moved = (mean != books).any(axis=2)
        books = mean
        if not moved.any():  # later rounds would find the same
            break
    return state, books


def _coded(parts: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, label, code, distance in zip(*(batch.column(c).to_pylist() for c in range(4))):
                text = code.hex()
                error = matrix_of(distance, len(ids), parts).astype(np.int64).sum(axis=1)
                codes = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
                columns = [pa.array(ids, pa.int64()), pa.array(label, pa.int64()), pa.array(codes, pa.string()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return task


def encode(df: DataFrame, scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> tuple[DataFrame, np.ndarray]:
    """(codes, books): a row (vec_id, label, code, error) for each vector that takes part; entries by part position.

    code: the entry of each part in two hex digits; error: the squared distances of all parts added up. Vectors that are
    null, empty or hold a null or non-finite component take no part, nor do those with a component of LIMIT / scale or more
    (their errors would not fit a long) or of another length than most of the lengths that ``parts`` divides (of equally
    frequent lengths the larger counts). Rows with a null vec_id take part, but give first entries only where others are too
    few. Repeated rows are vectors of their own. With fewer vectors than ``entries`` there are as many entries; an empty
    table gives no rows and books without entries. Only vec_id, embedding and label are read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has a byte for each part: 1 to 256 entries")
    small_batches(df.sparkSession)
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"))
    vectors, dimension = usable_vectors(rows, LIMIT / scale, parts)
    books = first_books(vectors, scale, parts, entries, dimension)
    if not books.shape[1]:
        return df.sparkSession.createDataFrame([], RESULT), books
    state, books = train(vectors, books, scale, rounds)
    return state.select("vec_id", "label", "code", "distance").mapInArrow(_coded(parts), RESULT), books


def books_digest(books: np.ndarray) -> str:
    """sha256 of all entries' components by part, entry and position, as decimal numbers between commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def codes_and_errors(df: DataFrame, **options) -> DataFrame:
    """A row for each vector that takes part: vec_id, code, error, label_error (of its label, nulls together), codebooks_sha256.

    What takes part and what becomes of odd rows: see ``encode``. label_error is null where it doesn't fit a long.
    """
    codes, books = encode(df, **options)
    codes = stored(codes, "codes")
    return with_total(codes, "label", "error", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
