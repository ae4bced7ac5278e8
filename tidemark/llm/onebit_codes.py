"""Nearest neighbours by randomly rotated one-bit codes.

Every vector is scaled to length one, rotated at random and stored as the signs of its components: a bit each, with two
numbers, its length and its inner product with its own code. A rotated query is rounded to whole numbers of ``PLANES`` bits,
which are cut into a word of bits for each power of two; common bits of those words and the codes are counted, and no code is
unpacked. From the counts and numbers comes an estimate of the inner product and a bound of its error. The best estimates are
computed exactly; every other vector whose estimate plus bound reaches the worst of the best so far is computed as well, the
rest is not looked at.

Codes and vectors are written once, side by side, and are read where they lie: only queries travel, in batches of bounded
size that are sent to all tasks, and the best that a task found for each query. The scan's work grows with queries times
vectors.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.sources.tables import path_exists

from .shared import forget, new_path, stored

SEED = 20
#: Bounds hold for a random rotation with probability 1 - 2 exp(-c EPSILON^2); 1.9 is usual, 3 loses next to nothing.
EPSILON = 3.0
#: Bits that a component of a rotated query is rounded to.
PLANES = 8
#: Vectors of a block of codes, and their bytes; queries that are sent at once, in bytes.
BLOCK_CODES, BLOCK_BYTES, QUERY_BYTES = 8192, 4 << 20, 16 << 20
#: Rows that are turned from lists into vectors at once.
SLICE = 4096

CODES = "dim int, ids binary, vectors binary, codes binary, factors binary"
QUERIES = "dim int, ids binary, vectors binary"
FOUND = "query_id bigint, vec_id bigint, score double"


@functools.lru_cache(4)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signs packed into words, float64 columns: length, inner product with the own code) of nonzero vectors."""
    length = np.sqrt((vectors * vectors).sum(axis=1))
    turned = (vectors / length[:, None]) @ rotation(vectors.shape[1])
    own = np.abs(turned).sum(axis=1) / math.sqrt(vectors.shape[1])
    return words(turned > 0), np.column_stack([length, own])


def words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, filled up with zeros."""
    packed = np.packbits(bits, axis=1)
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


class Query:
    """A rotated query as bit planes."""

    def __init__(self, query: np.ndarray):
        turned = query @ rotation(len(query))
        self.low = float(turned.min())
        self.step = float(turned.max() - turned.min()) / ((1 << PLANES) - 1)
        level = np.rint((turned - self.low) / self.step).astype(np.int64) if self.step else np.zeros(len(query), np.int64)
        self.planes = words((level[None, :] >> np.arange(PLANES)[:, None] & 1).astype(bool))
        self.sum, self.dim = int(level.sum()), len(query)
        #: What rounding can change in an inner product with signs.
        self.rounding = float(np.abs(turned - (self.low + self.step * level)).sum()) + 1e-12 * float(np.abs(turned).sum())

    def with_signs(self, codes: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """Inner products of the rounded query with the signs of each code; ``ones`` are the positive signs of each.

        ``codes`` holds the first words of all codes, then the second ones, and so on.
        """
        total = np.zeros(codes.shape[1], np.int32)  # holds the sum of 2**23 components
        for word, planes in zip(codes, self.planes.T):
            for p, plane in enumerate(planes):
                total += np.left_shift(np.bitwise_count(word & plane), p, dtype=np.int32)
        return self.low * (2.0 * ones - self.dim) + self.step * (2.0 * total - self.sum)


def _usable(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, ids, vectors) of the rows that take part."""
    by_dim: dict[int, tuple[list, list]] = {}
    for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if i is not None and v and None not in v:
            ids, vectors = by_dim.setdefault(len(v), ([], []))
            ids.append(i)
            vectors.append(v)
    for dim, (ids, vectors) in by_dim.items():
        x = np.array(vectors, np.float64)
        ok = np.isfinite(x).all(axis=1) & x.any(axis=1)
        if ok.any():
            yield dim, np.array(ids, np.int64)[ok], x[ok]


def _blocks(most: int, size: int, names: list[str], finish):
    """Packs (id, vector) into rows of at most ``most`` vectors and, unless one vector is larger, ``size`` bytes of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def row(dim: int, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            out = [np.ascontiguousarray(a).tobytes() for a in finish(ids, x)]
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *[pa.array([a], pa.binary()) for a in out]], names)

        for batch in batches:
            for i in range(0, len(batch), SLICE):
                for dim, ids, x in _usable(batch.slice(i, SLICE)):
                    if dim in held:
                        ids, x = np.concatenate([held[dim][0], ids]), np.concatenate([held[dim][1], x])
                    n = max(1, min(most, size // (8 * dim)))
                    while len(ids) >= n:
                        yield row(dim, ids[:n], x[:n])
                        ids, x = ids[n:], x[n:]
                    held[dim] = ids.copy(), x.copy()
        for dim, (ids, x) in held.items():
            if len(ids):
                yield row(dim, ids, x)

    return task


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, each added up from the first component to the last: equal vectors give equal products."""
    return np.cumsum(vectors * query, axis=1)[:, -1]


class Codes:
    """A block of codes with its vectors."""

    def __init__(self, row: dict, epsilon: float):
        self.dim, n = row["dim"], len(row["ids"]) // 8
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, self.dim)
        self.codes = np.ascontiguousarray(np.frombuffer(row["codes"], np.uint64).reshape(n, -1).T)
        self.ones = np.bitwise_count(self.codes).sum(axis=0, dtype=np.int64)
        length, own = np.frombuffer(row["factors"], np.float64).reshape(n, 2).T
        own = np.maximum(own, 1e-12)
        self.scale = length / own / math.sqrt(self.dim)
        self.spread = length * np.sqrt(np.maximum(0, 1 - own * own)) / own * epsilon / math.sqrt(max(1, self.dim - 1))

    def search(self, query_id: int, query: np.ndarray, bits: Query, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k nearest here that reach ``floor``, ties to the smaller id; rows with the query's id are left out."""
        ids, vectors = self.ids, self.vectors
        estimate = bits.with_signs(self.codes, self.ones)
        estimate *= self.scale
        most = estimate + self.spread * math.sqrt(float(query @ query)) + self.scale * bits.rounding
        other = ids != query_id
        first = np.argpartition(-estimate, 4 * k)[: 4 * k] if len(ids) > 4 * k else np.arange(len(ids))
        first = first[other[first]]
        if len(first) >= k:
            floor = max(floor, float(np.partition(exact(vectors[first], query), -k)[-k]))
        reaches = (most >= floor) & other
        reaches[first] = True
        chosen = np.flatnonzero(reaches)
        quick = vectors[chosen] @ query  # may differ from the exact order of sums in the last digits
        if len(quick) > k:
            chosen = chosen[quick >= np.partition(quick, -k)[-k] - 1e-9 * max(1.0, float(np.abs(quick).max()))]
        scores = exact(vectors[chosen], query)
        best = np.lexsort((ids[chosen], -scores))[:k]
        return ids[chosen][best], scores[best]


def _near(shared, k: int, epsilon: float):
    """Blocks of codes to the best k of a task for each of the shared queries."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [(i, q, Query(q)) for ids, x in shared.value for i, q in zip(ids.tolist(), x)]
        best = [(np.empty(0, np.int64), np.empty(0))] * len(queries)
        for batch in batches:
            for i in range(len(batch)):
                block = Codes(batch.slice(i, 1).to_pylist()[0], epsilon)
                for place, (query_id, query, bits) in enumerate(queries):
                    if len(query) != block.dim:
                        continue
                    ids, scores = best[place]
                    floor = float(scores[-1]) if len(scores) == k else -math.inf
                    new_ids, new_scores = block.search(query_id, query, bits, k, floor)
                    ids, scores = np.concatenate([ids, new_ids]), np.concatenate([scores, new_scores])
                    order = np.lexsort((ids, -scores))[:k]
                    best[place] = ids[order], scores[order]
        for i in range(0, len(queries), SLICE):
            part = best[i : i + SLICE]
            asked = [np.full(len(b[0]), q[0], np.int64) for b, q in zip(part, queries[i : i + SLICE])]
            columns = [np.concatenate(asked), np.concatenate([b[0] for b in part]), np.concatenate([b[1] for b in part])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in FOUND.split(", ")])

    return task


def _takes_part(embedding: str) -> Column:
    """What ``_usable`` asks of a vector, as a condition on a column."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite & F.exists(embedding, lambda x: x != 0)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, epsilon: float = EPSILON) -> DataFrame:
    """The k rows of ``vectors`` (vec_id, embedding) nearest to each row whose vec_id is divisible by ``every``.

    Rows (query_id, rank, vec_id, score): score is the inner product in double precision, nearest first, ties to the
    smaller vec_id; rows with the query's own vec_id are no candidates. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows without an id; vectors of different dimension don't meet. Of queries
    that repeat a vec_id the smallest vector that takes part counts; candidates that repeat one count as often as they occur. An empty
    table gives an empty result; other columns aren't read.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    asked = rows.where((F.col("vec_id") % every == 0) & _takes_part("embedding")).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    names = [x.split()[0] for x in CODES.split(", ")]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows.rdd.getNumPartitions() < tasks:  # a table of few files is dealt out once; a large one stays where it lies
        rows = rows.repartition(tasks)
    codes = rows.mapInArrow(_blocks(BLOCK_CODES, BLOCK_BYTES, names, lambda ids, x: (ids, x, *encode(x))), CODES)
    codes = stored(codes, "codes")
    packed = asked.mapInArrow(_blocks(BLOCK_CODES, BLOCK_BYTES, names[:3], lambda ids, x: (ids, x)), QUERIES)
    packed = stored(packed.withColumns({"block": F.monotonically_increasing_id(), "size": F.octet_length("vectors")}), "queries")
    path = new_path(spark, "found")
    for i, blocks in enumerate(_batches(packed)):
        part = packed.where(F.col("block").isin(blocks)).orderBy("block").toArrow().to_pylist()  # QUERY_BYTES at most, or a block
        shared = spark.sparkContext.broadcast([(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["vectors"], np.float64).reshape(-1, r["dim"])) for r in part])
        codes.mapInArrow(_near(shared, k, epsilon), FOUND).write.parquet(f"{path}/batch={i}")
        shared.unpersist()
    forget(packed, codes)
    schema = f"{FOUND}, batch int"
    found = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def _batches(packed: DataFrame) -> Iterator[list[int]]:
    """The blocks of queries in batches of at most QUERY_BYTES; a block has some thousand queries."""
    batch, held = [], 0
    for r in packed.select("block", "size").orderBy("block").toLocalIterator():
        if batch and held + r["size"] > QUERY_BYTES:
            yield batch
            batch, held = [], 0
        batch.append(r["block"])
        held += r["size"]
    if batch:
        yield batch
