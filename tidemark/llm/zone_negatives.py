"""Hard negatives from blocks of vectors along a Hilbert curve, chosen by zone maps.

Vectors become integers, floor(scale * x). They are sorted by their place on a Hilbert curve through all dimensions and stored
as Parquet rows of a block each, with the zone map in columns of its own: least and greatest component per dimension, and how
many rows each label has. An anchor's inner product with any vector of a block lies between the sums of the smaller and of
the larger of the products with the ends of each dimension's interval.

An anchor first looks for its positives, the best rows of its label. Blocks with enough such rows whose lower bounds are high
give a score that the last positive must reach, so only blocks whose upper bound reaches it are read. Each positive opens a
window of scores for negatives, and only blocks whose interval meets a window of an anchor and that hold another label are
read. Inside a task the best rows found so far raise what a block must reach.

Anchors are taken in batches of a fixed size, neighbours on the curve together, and sent to the tasks; vectors are shuffled
once, for the sort.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import few, forget, running_total, small_batches, stored
from .vectors import integer_matrix, matrix_bytes, matrix_of, usable_vectors

#: Vectors of a block; anchors sent to the tasks at once, with their vectors and what is known of them; anchors compared at once.
BLOCK, BATCH, TOGETHER = 1024, 16_384, 1024
#: Zone maps compared with all anchors at once.
ZONES = 128
#: Blocks of a partition along the curve, about, where there are many.
PARTITION_BLOCKS = 256
#: Bits of a dimension on the curve.
CURVE_BITS = 4
#: Scaled components stay below this, so that inner products in doubles are exact up to 512 dimensions.
LIMIT = 1 << 22
#: A null id sorts after all others.
NO_ID = (1 << 63) - 1
NOTHING = -(1 << 62)

PLACED = "vec_id bigint, label bigint, x binary, place binary"
BLOCKS = "block bigint, n int, low binary, high binary, labels array<bigint>, counts array<int>, ids binary, label binary, x binary"
ZONE = ["block", "n", "low", "high", "labels", "counts"]
FOUND = "anchor bigint, slot int, score bigint, id bigint, row bigint"


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole numbers in [0, 2**bits), as rows of bytes that sort by place."""
    x = x.astype(np.uint32).copy()
    dimensions = x.shape[1]
    bit = np.uint32(1 << (bits - 1))
    while bit > 1:  # undo the rotations of the sub-cubes, from the largest
        below = np.uint32(bit - 1)
        for d in range(dimensions):
            far = (x[:, d] & bit) != 0
            swapped = np.where(far, np.uint32(0), (x[:, 0] ^ x[:, d]) & below)
            x[:, 0] ^= np.where(far, below, swapped)
            x[:, d] ^= swapped
        bit >>= np.uint32(1)
    for d in range(1, dimensions):  # reflected binary code over the dimensions
        x[:, d] ^= x[:, d - 1]
    turned = np.zeros(len(x), np.uint32)
    bit = np.uint32(1 << (bits - 1))
    while bit > 1:
        turned ^= np.where((x[:, -1] & bit) != 0, np.uint32(bit - 1), np.uint32(0))
        bit >>= np.uint32(1)
    x ^= turned[:, None]
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


def _placed(scale: int, low: np.ndarray, high: np.ndarray):
    width = np.maximum(high - low, 1e-300)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 4 * BLOCK):
                part = batch.slice(i, 4 * BLOCK)
                x = integer_matrix(part.column("embedding"), scale)
                cell = np.clip(np.floor((x - low) / width * (1 << CURVE_BITS)), 0, (1 << CURVE_BITS) - 1)
                places = [p.tobytes() for p in hilbert(cell, CURVE_BITS)]
                data = [p.tobytes() for p in x.astype("<i4")]
                columns = [part.column("vec_id"), part.column("label"), pa.array(data, pa.binary()), pa.array(places, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PLACED.split(", ")])

    return task


def _cut(dimension: int):
    """Of a partition's rows along the curve: its blocks. A block's number tells the partition and the place in it."""

    def block(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        ids = np.array([NO_ID if i is None else i for i in rows.column("vec_id").to_pylist()], np.int64)
        label = rows.column("label").to_numpy()
        x = np.frombuffer(b"".join(rows.column("x").to_pylist()), "<i4").reshape(-1, dimension)
        order = np.argsort(ids, kind="stable")
        names, counts = np.unique(label, return_counts=True)
        row = [number, len(ids), x.min(axis=0).tobytes(), x.max(axis=0).tobytes(), names.tolist(), counts.tolist(), ids[order].tobytes(), label[order].astype("<i8").tobytes(), matrix_bytes(x[order])]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], [c.split()[0] for c in BLOCKS.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, None
        for batch in batches:
            while len(batch):
                if number is None:
                    number = batch.column("partition")[0].as_py() << 32
                part, batch = batch.slice(0, BLOCK - size), batch.slice(BLOCK - size)
                held.append(part)
                size += len(part)
                if size == BLOCK:
                    yield block(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield block(number, held)

    return task


def curve_blocks(vectors: DataFrame, dimension: int, scale: int) -> DataFrame:
    """The stored blocks of ``vectors`` (vec_id, label, embedding) along the curve.

    Rows at the same place follow their ids, so copies of one vector fill as many blocks and tasks as they need.
    """
    ends = vectors.select(F.posexplode("embedding").alias("at", "x")).groupBy("at").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    ends = {r["at"]: (r["low"], r["high"]) for r in ends.collect()}  # a row for each dimension
    low, high = (np.floor(np.array([ends[d][i] for d in range(dimension)], float) * scale) for i in (0, 1))
    placed = vectors.select("vec_id", "label", "embedding").mapInArrow(_placed(scale, low, high + 1), PLACED)
    order = [F.col("place"), F.col("vec_id").asc_nulls_last(), F.col("label"), F.col("x")]
    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), vectors.count() // (PARTITION_BLOCKS * BLOCK) + 1)
    ranged = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("partition", F.spark_partition_id())
    return stored(ranged.mapInArrow(_cut(dimension), BLOCKS), "blocks")


def _anchors(every: int, dimension: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                number, n, ids, label, data = (batch.column(c)[i].as_py() for c in range(5))
                ids, label = np.frombuffer(ids, "<i8"), np.frombuffer(label, "<i8")
                x = matrix_of(data, n, dimension)
                at = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
                rows = [x[j].astype("<i4").tobytes() for j in at]
                columns = [pa.array(number * BLOCK + at), pa.array(ids[at]), pa.array(label[at]), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "id", "label", "x"])

    return task


class Anchors:
    """A batch of anchors: row (a number of its own), id, label, vector, and the window of scores of each slot."""

    def __init__(self, table: pa.Table, dimension: int, windows: dict[int, list[tuple]] | None = None, slots: int = 0):
        self.row, self.id, self.label = (table.column(c).to_numpy() for c in ("row", "id", "label"))
        self.x = np.frombuffer(b"".join(table.column("x").to_pylist()), "<i4").reshape(-1, dimension)
        #: Scores a row needs at least; per slot: of the window.
        self.least = np.full((len(self.row), max(1, slots)), NOTHING)
        self.most = np.full((len(self.row), max(1, slots)), NOTHING if windows is not None else 1 << 62)
        for i, row in enumerate(self.row.tolist()):
            for slot, low, high in (windows or {}).get(row, []):
                self.least[i, slot], self.most[i, slot] = low, high

    @functools.cached_property
    def _signed(self) -> tuple[np.ndarray, np.ndarray]:
        return np.maximum(self.x, 0).astype(float), np.minimum(self.x, 0).astype(float)

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each anchor with a vector between ``low`` and ``high``, a column for each pair."""
        up, down = self._signed
        return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _zones(batch: pa.RecordBatch, dimension: int):
    low, high = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i4").reshape(-1, dimension).astype(float) for c in ("low", "high"))
    return low, high, batch.column("labels").to_pylist(), batch.column("counts").to_pylist()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most ZONES blocks at a time, so that the bounds of all anchors with them stay small."""
    for batch in batches:
        for i in range(0, len(batch), ZONES):
            yield batch.slice(i, ZONES)


def _same_label(anchors: Anchors, labels: list[int], counts: list[int]) -> np.ndarray:
    """How many rows of a block have each anchor's label."""
    names = np.array(labels, np.int64)
    at = np.minimum(np.searchsorted(names, anchors.label), len(names) - 1)
    return np.where(names[at] == anchors.label, np.array(counts)[at], 0)


def _guarantees(shared, dimension: int, k: int):
    """Of zone maps: (anchor, bound, n), the ``k`` blocks with the highest lower bounds that hold rows of the anchor's label."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = shared.value
        best = np.full((len(anchors.row), k), NOTHING)
        count = np.zeros((len(anchors.row), k), np.int64)
        for batch in _slices(batches):
            low, high, labels, counts = _zones(batch, dimension)
            lower, _ = anchors.bounds(low, high)
            for j, number in enumerate(batch.column("block").to_pylist()):
                own = _same_label(anchors, labels[j], counts[j]) - (anchors.row // BLOCK == number)
                bound = np.where(own > 0, lower[:, j], NOTHING).astype(np.int64)
                better = np.flatnonzero(bound > best[:, -1])
                both = np.column_stack([best[better], bound[better]]), np.column_stack([count[better], own[better]])
                order = np.argsort(-both[0], axis=1, kind="stable")[:, :k]
                best[better], count[better] = (np.take_along_axis(x, order, axis=1) for x in both)
        i, j = np.nonzero(best > NOTHING)
        yield pa.RecordBatch.from_arrays([pa.array(anchors.row[i]), pa.array(best[i, j]), pa.array(count[i, j])], ["anchor", "bound", "n"])

    return task


def _wanted(anchors: Anchors, lower: np.ndarray, upper: np.ndarray, same: np.ndarray, n: int, own: np.ndarray, positives: bool) -> np.ndarray:
    """Which anchors must read a block, by its bounds and labels."""
    if positives:
        return (same - own > 0) & (upper >= anchors.least[:, 0])
    meets = ((lower[:, None] <= anchors.most) & (upper[:, None] >= anchors.least) & (anchors.most > NOTHING)).any(axis=1)
    return meets & (same < n)


def _chosen(shared, dimension: int, positives: bool):
    """Of zone maps: the blocks that some anchor must read, and how many anchors."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = shared.value
        for batch in _slices(batches):
            low, high, labels, counts = _zones(batch, dimension)
            lower, upper = anchors.bounds(low, high)
            numbers, sizes, readers = batch.column("block").to_pylist(), batch.column("n").to_pylist(), []
            for j, number in enumerate(numbers):
                same, own = _same_label(anchors, labels[j], counts[j]), anchors.row // BLOCK == number
                readers.append(int(_wanted(anchors, lower[:, j], upper[:, j], same, sizes[j], own, positives).sum()))
            table = pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(readers)], ["block", "readers"])
            yield table.filter(pa.array([r > 0 for r in readers]))

    return task


class Best:
    """The ``k`` best rows of each anchor in one slot, best first: higher scores, then smaller ids."""

    def __init__(self, anchors: int, k: int):
        self.score, self.id, self.row = (np.full((anchors, k), v, np.int64) for v in (NOTHING, NO_ID, NO_ID))

    def take(self, scores: np.ndarray, usable: np.ndarray, who: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Looks at the ``usable`` of ``scores`` (anchors ``who`` by rows, which are in the order of their ids)."""
        k = self.score.shape[1]
        last = self.score[who, -1][:, None]
        usable &= (scores > last) | ((scores == last) & (ids < self.id[who, -1][:, None]))
        found = usable.sum(axis=1)
        some = np.flatnonzero(found)
        if not len(some):
            return
        at, own = np.nonzero(usable[some])
        value = scores[some][at, own]
        order = np.lexsort((own, -value, at))  # rows of a block are in the order of their ids
        at, own, value = at[order], own[order], value[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        first = place < k
        new = [np.full((len(some), k), v, np.int64) for v in (NOTHING, NO_ID, NO_ID)]
        for x, v in zip(new, (value, ids[own], rows[own])):
            x[at[first], place[first]] = v[first]
        owners = who[some]
        both = [np.concatenate([x[owners], y], axis=1) for x, y in zip((self.score, self.id, self.row), new)]
        order = np.lexsort((both[2], both[1], -both[0]), axis=1)[:, :k]
        self.score[owners], self.id[owners], self.row[owners] = (np.take_along_axis(x, order, axis=1) for x in both)


def _search(shared, dimension: int, positives: bool, k: int):
    """Of blocks: the ``k`` best rows of each anchor's slots in them, as FOUND."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = shared.value
        best = [Best(len(anchors.row), k) for _ in range(anchors.least.shape[1])]
        for batch in _slices(batches):
            low, high, labels, counts = _zones(batch, dimension)
            lower, upper = anchors.bounds(low, high)
            for j in range(len(batch)):
                number, n, ids, label, data = (batch.column(c)[j].as_py() for c in ("block", "n", "ids", "label", "x"))
                ids, label, x = np.frombuffer(ids, "<i8"), np.frombuffer(label, "<i8"), matrix_of(data, n, dimension).astype(float)
                same, own = _same_label(anchors, labels[j], counts[j]), anchors.row // BLOCK == number
                wanted = np.flatnonzero(_wanted(anchors, lower[:, j], upper[:, j], same, n, own, positives))
                rows = number * BLOCK + np.arange(n)
                for i in range(0, len(wanted), TOGETHER):
                    who = wanted[i : i + TOGETHER]
                    scores = (anchors.x[who].astype(float) @ x.T).astype(np.int64)
                    fits = (anchors.label[who][:, None] == label) == positives
                    if positives:
                        fits &= anchors.row[who][:, None] != rows
                    for slot, found in enumerate(best):
                        inside = fits & (scores >= anchors.least[who, slot][:, None])
                        if not positives:
                            inside &= scores <= anchors.most[who, slot][:, None]
                        found.take(scores, inside, who, ids, rows)
        for slot, found in enumerate(best):
            at, place = np.nonzero(found.row != NO_ID)
            columns = [pa.array(anchors.row[at]), pa.array(np.full(len(at), slot, np.int32)), *[pa.array(v[at, place]) for v in (found.score, found.id, found.row)]]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FOUND.split(", ")])

    return task


def _read(blocks: DataFrame, shared, dimension: int, positives: bool, k: int) -> DataFrame:
    """(anchor, slot, place, score, id, row): the ``k`` best rows of each anchor's slots, place from 1."""
    chosen = stored(blocks.select(*ZONE).mapInArrow(_chosen(shared, dimension, positives), "block bigint, readers bigint"), "chosen")
    left, keys = blocks, chosen.select("block")
    if chosen.count() < blocks.count():  # a list of few blocks is sent; else each task leaves out blocks by the same bounds
        sent = few(keys)
        left = blocks if sent is keys else blocks.join(sent, "block", "left_semi")
    found = left.select(*BLOCK_COLUMNS).mapInArrow(_search(shared, dimension, positives, k), FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    result = stored(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k), "found")
    forget(chosen)
    return result


BLOCK_COLUMNS = [c.split()[0] for c in BLOCKS.split(", ")]


def _mine_batch(blocks: DataFrame, table: pa.Table, dimension: int, positives: int, negatives: int, window: tuple[int, int]) -> DataFrame:
    spark = blocks.sparkSession
    anchors = Anchors(table, dimension)
    shared = spark.sparkContext.broadcast(anchors)
    bounds = blocks.select(*ZONE).mapInArrow(_guarantees(shared, dimension, positives), "anchor bigint, bound bigint, n bigint")
    by_bound = Window.partitionBy("anchor").orderBy(F.desc("bound"), "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bounds = bounds.withColumn("sum", F.sum("n").over(by_bound)).where(F.col("sum") >= positives).groupBy("anchor").agg(F.max("bound").alias("bound"))
    known = {r["anchor"]: r["bound"] for r in bounds.collect()}  # a row for each anchor of the batch at most
    shared.unpersist()
    anchors.least[:, 0] = [known.get(row, NOTHING) for row in anchors.row.tolist()]

    shared = spark.sparkContext.broadcast(anchors)
    own = _read(blocks, shared, dimension, True, positives)
    shared.unpersist()
    low, high = window
    windows: dict[int, list[tuple]] = {}
    rows = own.select("anchor", "place", "score").toArrow()
    for anchor, slot, s in zip(*(rows.column(c).to_pylist() for c in range(3))):
        windows.setdefault(anchor, []).append((slot - 1, -(-low * s // 100), high * s // 100))

    shared = spark.sparkContext.broadcast(Anchors(table, dimension, windows, positives))
    found = _read(blocks, shared, dimension, False, negatives)
    shared.unpersist()
    pairs = own.select("anchor", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    hard = found.select("anchor", "slot", F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = spark.createDataFrame(table.select(["row", "id"]).rename_columns(["anchor", "anchor_id"]))
    out = hard.join(pairs, ["anchor", "slot"]).join(F.broadcast(ids), "anchor")
    out = out.select("anchor_id", _id("positive_id"), F.col("rank").cast("int").alias("rank"), _id("negative_id"), "positive_score", "negative_score")
    out = stored(out, "negatives")
    forget(own, found)
    return out


def _id(name: str):
    return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(df: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), scale: int = 256) -> DataFrame:
    """Rows RESULT: for each anchor (vec_id divisible by ``every``) and each of its positives, the best negatives.

    ``df``: vec_id, embedding, label. Scores are inner products of floor(scale * x); higher come first, of equal ones
    the smaller id, null last. Positives: the first other rows of the anchor's label. Negatives of a positive: the first rows
    of another label whose score is between ``window`` percent of the positive's, both included.

    Rows with a null label or a null, empty or not finite vector take no part, nor do those with a component of LIMIT / scale
    or more or of another length than most. A null vec_id is no anchor but may be found. Rows that repeat a vec_id are rows of
    their own: anchors of the same id have their rows each, and another row with the anchor's id may be its positive. Anchors
    without a positive, and positives without a row in their window, give no rows; an empty table gives none.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows = df.where("label IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    vectors, dimension = usable_vectors(rows, LIMIT / scale)
    if not dimension:
        return spark.createDataFrame([], RESULT)
    blocks = curve_blocks(vectors, dimension, scale)
    anchors = blocks.select("block", "n", "ids", "label", "x").mapInArrow(_anchors(every, dimension), "row bigint, id bigint, label bigint, x binary")
    anchors = stored(running_total(anchors.withColumn("one", F.lit(1)), [F.col("row")], "one", "place").drop("one"), "anchors")
    out = None
    for i in range(0, anchors.count(), BATCH):
        table = anchors.where(F.col("place").between(i, i + BATCH - 1)).drop("place").toArrow()
        part = _mine_batch(blocks, table.sort_by("row"), dimension, positives, negatives, window)
        out = part if out is None else out.unionByName(part)
    forget(blocks, anchors)
    return spark.createDataFrame([], RESULT) if out is None else out
