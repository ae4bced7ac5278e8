"""Helpers of the operators: tables in the shared folder, global running totals, joins with lists of keys."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import shared_folder

#: Up to so many keys (a long and a digest each, some 20 MB) are broadcast; of more, only hashed bits are.
BROADCAST_KEYS = 200_000
#: Sets of bits for longer lists of keys, of so many longs each: 32 MB in all, however long the list is. Each key sets
#: three bits. With 13 million keys some 2 % of the other rows are taken for possible ones, with 50 million a third.
BIT_SETS, LONGS = 1 << 17, 32
#: Bytes of a batch that Spark hands to Python. A batch is held some times over: by the JVM, on its way, and in Python.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark) -> None:
    """From now on the session hands Python batches of at most BATCH_BYTES, or fewer if it was set to fewer.

    Spark reads the setting when a plan is run, so it stays: results may be computed after the operator has returned.
    """
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", spark.conf.get(BATCH_SETTING).strip().lower()).groups()
    if not 0 < int(number) << 10 * " kmgtp".index(unit or " ") <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def new_path(spark, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps don't compute it again, lost executors don't matter."""
    small_batches(df.sparkSession)
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.path = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing will read any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """Names like ``stems`` that no column of ``df`` has, in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in stems:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def running_total(df: DataFrame, order: Sequence[Column], measure: str, name: str) -> DataFrame:
    """Adds ``name``, the sum of ``measure`` over all rows before this one in ``order``, over the whole table.

    The rows are dealt out by ranges of ``order``; each range is summed, and a row adds what its range has before it.
    ``order`` should tell all rows apart, else rows that tie may change places.
    """
    ranged = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    before = ranged.groupBy("_range").agg(F.sum(measure).alias("_sum"))
    before = before.select("_range", F.coalesce(F.sum("_sum").over(ranges), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(measure).over(inside), F.lit(0))
    return ranged.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + local).drop("_range", "_before")


def few(keys: DataFrame, limit: int | None = None) -> DataFrame:
    """``keys``, a stored table, marked for broadcast if it has at most ``limit`` rows; the join's result is the same."""
    return F.broadcast(keys) if _short(keys, limit) else keys


def _short(keys: DataFrame, limit: int | None = None) -> bool:
    limit = BROADCAST_KEYS if limit is None else limit
    return keys.limit(limit + 1).count() <= limit


def _bits(columns: Sequence[Column]) -> tuple[Column, list[Column]]:
    """(set, bits in it) of a key."""
    h = F.xxhash64(*columns)
    bits = [F.call_function("shiftrightunsigned", h, F.lit(s)).bitwiseAND(F.lit(64 * LONGS - 1)).cast("int") for s in (20, 32, 44)]
    return F.pmod(h, F.lit(BIT_SETS)), bits


def _marked(rows: DataFrame, keys: DataFrame, columns: Sequence[str], mark: str) -> DataFrame:
    """``rows`` with ``mark``: false where no row of ``keys`` can be equal in ``columns``. The rows stay where they lie."""
    own, bits = _bits([F.col(c) for c in columns])
    set_name, words = free_names(rows, "_set", "_words")
    long = keys.select(own.alias("set"), F.explode(F.array(*bits)).alias("bit"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(63))
    longs = long.groupBy("set", F.shiftright("bit", 6).alias("at")).agg(F.bit_or(bit).alias("word"))
    sets = longs.groupBy("set").agg(F.map_from_entries(F.collect_list(F.struct("at", "word"))).alias("at"))  # LONGS entries at most
    whole = F.transform(F.sequence(F.lit(0), F.lit(LONGS - 1)), lambda i: F.coalesce(F.col("at")[i], F.lit(0).cast("long")))
    sets = stored(sets.select(F.col("set").alias(set_name), whole.alias(words)), "bits")
    own, bits = _bits([rows[c] for c in columns])
    joined = rows.join(F.broadcast(sets), own == sets[set_name], "left")  # BIT_SETS rows of 8 * LONGS bytes at most
    found = F.lit(True)
    for b in bits:
        word = F.get(words, F.shiftright(b, 6))
        found = found & (F.call_function("shiftrightunsigned", word, b.bitwiseAND(63)).bitwiseAND(1) == 1)
    return joined.select(*[rows[c] for c in rows.columns], F.coalesce(found, F.lit(False)).alias(mark))


def matching(rows: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """The rows that equal a row of ``keys``, a stored table, in ``columns``, null with null.

    A short list of keys is broadcast. Of a long one, hashed bits are: rows that can't match are left out where they lie, and
    only the others, with what they carry, are shuffled and compared with the keys.
    """
    if _short(keys):
        keys = F.broadcast(keys)
        return rows.join(keys, same(rows, keys, *columns), "left_semi")
    (mark,) = free_names(rows, "_may")
    maybe = _marked(rows, keys, columns, mark).where(mark).drop(mark)
    return maybe.join(keys, same(maybe, keys, *columns), "left_semi")


def without(rows: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """The rows that equal no row of ``keys`` in ``columns``; as in ``matching``, only rows that may equal one are shuffled."""
    if _short(keys):
        keys = F.broadcast(keys)
        return rows.join(keys, same(rows, keys, *columns), "left_anti")
    (mark,) = free_names(rows, "_may")
    marked = _marked(rows, keys, columns, mark)
    maybe = marked.where(mark).drop(mark)
    return marked.where(~F.col(mark)).drop(mark).unionByName(maybe.join(keys, same(maybe, keys, *columns), "left_anti"))


def same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Equality of columns, null with null."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the links (a, b): rows (id, component), component being the smallest id reached.

    Alternates two steps until all links are stars: each node links its larger neighbours to its smallest neighbour, then
    its smaller ones. The number of rounds grows with the logarithm of the largest component.
    Sets of neighbours are never gathered: both steps are a minimum by key and a join.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = stored(small.select("e.*").where("a <> b").distinct(), name)
        forget(edges)
        edges = after
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each node with a smaller neighbour (links: a > b) has one only, and no larger ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("smaller"), F.lit(1).alias("larger")))
    nodes = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.sum("larger").alias("larger"))
    return nodes.where("smaller > 1 or smaller > 0 and larger > 0").isEmpty()
