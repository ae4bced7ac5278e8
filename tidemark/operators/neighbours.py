"""Rows that a forest puts into the same leaves as a given row.

The proximity of two rows is the share of trees that put them into the same leaf. The table of all pairs grows with the
square of the rows and is never made: a stated set of rows is asked about, and each gets its k nearest ones.

Rows stay where they lie and are read in blocks. A block has an inverted index, the rows of each leaf of each tree, so only
pairs that meet in a leaf are counted. Of the asked rows only different leaf vectors travel, in batches of bounded size; a
task gives back the best of its blocks, less those that can't be among the k any more. A leaf that holds most rows is spread
over the blocks like all others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage

#: Leaves of the asked vectors that are sent at once; rows of a block; asked vectors that are counted together.
SENT_LEAVES, BLOCK_ROWS, TOGETHER = 2_000_000, 8_192, 256


def _shared_leaves(asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many leaves each asked vector shares with each row, tree by tree over the rows of each leaf."""
    shared = np.zeros((len(asked), len(rows)), np.int32)
    for tree in range(rows.shape[1]):
        order = np.argsort(rows[:, tree], kind="stable")
        leaves, starts = np.unique(rows[order, tree], return_index=True)
        postings = dict(zip(leaves.tolist(), np.split(order, starts[1:])))
        by_leaf = np.argsort(asked[:, tree], kind="stable")
        wanted, first = np.unique(asked[by_leaf, tree], return_index=True)
        for leaf, who in zip(wanted.tolist(), np.split(by_leaf, first[1:])):
            if leaf in postings:
                shared[np.ix_(who, postings[leaf])] += 1
    return shared


def _nearest(sent, keys: int, k: int):
    """Rows (keys, leaves), in the order of the keys, to (number of the asked vector, shared leaves, keys)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, asked = sent.value
        floors = np.zeros(len(asked), np.int32)  # what a later row must exceed; rows without a shared leaf don't count
        best = np.zeros((len(asked), k), np.int32)
        for batch in batches:
            for i in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(i, BLOCK_ROWS)
                rows = part.column(keys).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                for j in range(0, len(asked), TOGETHER):
                    who, at, values = [], [], []
                    shared = _shared_leaves(asked[j : j + TOGETHER], rows)
                    for q in np.flatnonzero((shared > floors[j : j + TOGETHER, None]).any(axis=1)):
                        found = np.flatnonzero(shared[q] > floors[j + q])
                        found = found[np.argsort(-shared[q, found], kind="stable")[:k]]
                        merged = np.sort(np.concatenate([best[j + q], shared[q, found]]))[-k:]
                        best[j + q], floors[j + q] = merged, merged[0]
                        who.append(np.full(len(found), numbers[j + q]))
                        at.append(found)
                        values.append(shared[q, found])
                    if who:
                        chosen = part.take(pa.array(np.concatenate(at)))
                        columns = [pa.array(np.concatenate(who), pa.int64()), pa.array(np.concatenate(values), pa.int32())]
                        columns += [chosen.column(c) for c in range(keys)]
                        yield pa.RecordBatch.from_arrays(columns, ["_number", "_shared", *part.schema.names[:keys]])

    return task


def nearest_by_proximity(leaves: DataFrame, asked: Column, keys: Sequence[str], k: int) -> DataFrame:
    """(keys, rank, near_<key>, proximity): the k other rows that share most leaves with each row for which ``asked`` holds.

    ``leaves`` has the columns ``keys``, which tell its rows apart, and ``leaves``, the leaf of each tree. Equal proximities
    go by the keys. Rows without a common leaf are not near; rows whose leaves are null are left out.
    """
    keys = list(keys)
    spark = leaves.sparkSession
    table = cut_lineage(leaves.where(F.col("leaves").isNotNull()).select(*keys, "leaves", F.coalesce(asked, F.lit(False)).alias("_asked")))
    near = [f"near_{c}" for c in keys]
    kinds = {f.name: f.dataType for f in table.schema.fields}
    found_schema = T.StructType(
        [T.StructField("_number", T.LongType()), T.StructField("_shared", T.IntegerType()), *[T.StructField(c, kinds[c]) for c in keys]]
    )
    vectors = cut_lineage(table.where("_asked").select("leaves").distinct().withColumn("_number", F.monotonically_increasing_id()))
    numbers = _batches(vectors)
    ordered = table.select(*keys, "leaves").sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in keys])
    found = None
    for low, high in numbers:
        part = vectors.where(F.col("_number").between(low, high)).toArrow()  # SENT_LEAVES at most
        matrix = part.column("leaves").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
        sent = spark.sparkContext.broadcast((part.column("_number").to_numpy(), matrix))
        # One more than k, since the asked row itself is among them.
        rows = cut_lineage(ordered.mapInArrow(_nearest(sent, len(keys), k + 1), found_schema))
        sent.unpersist()
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        found = spark.createDataFrame([], found_schema)
    by_vector = Window.partitionBy("_number").orderBy(F.desc("_shared"), *[F.col(c).asc_nulls_last() for c in keys])
    found = found.withColumn("_place", F.row_number().over(by_vector)).where(F.col("_place") <= k + 1).drop("_place")
    found = found.withColumnsRenamed(dict(zip(keys, near)))
    # Rows with the same leaves share a list of k + 1 rows. The join is by the rows that ask, the lists are short.
    lists = found.groupBy("_number").agg(F.collect_list(F.struct("_shared", *near)).alias("_near"))
    lists = vectors.join(lists, "_number").select(F.col("leaves").alias("_leaves"), "_near")
    rows = table.where("_asked").join(lists, F.col("leaves") == F.col("_leaves"))
    rows = rows.select(*keys, F.size("leaves").alias("_trees"), F.inline("_near"))
    itself = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(keys, near)])
    order = Window.partitionBy(*keys).orderBy(F.desc("_shared"), *[F.col(n).asc_nulls_last() for n in near])
    ranked = rows.where(~itself).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(*keys, "rank", *near, (F.col("_shared") / F.col("_trees")).alias("proximity"))


def _batches(vectors: DataFrame) -> list[tuple[int, int]]:
    """Ranges of numbers with at most SENT_LEAVES leaves each, from counts of stretches of numbers."""
    size = vectors.agg(F.max(F.size("leaves"))).first()[0]
    if size is None:
        return []
    step = max(1, SENT_LEAVES // max(1, size))
    # Numbers count up inside each partition, so a stretch of ``step`` numbers has at most so many vectors.
    stretches = vectors.groupBy(F.floor(F.col("_number") / step).alias("s")).count().orderBy("s").collect()
    out: list[list[int]] = []
    held = 0
    for s, n in stretches:
        if out and held + n <= step:
            out[-1][1], held = (s + 1) * step - 1, held + n
        else:
            out.append([s * step, (s + 1) * step - 1])
            held = n
    return [(low, high) for low, high in out]
