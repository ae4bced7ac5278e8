"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents twice over, each time in an order drawn by hash. Documents are sent in packets of at most
PACKET words. A packet's virtual finish time is the number of words its source has sent with it, divided by the source's
weight. All queues are served side by side: the packets of all sources are sorted by finish time and cut where their words
reach the budget. A source whose queue ends earlier leaves its service to the others, by weight: so its share stops at twice
its size and the excess is shared again. Each source's words follow from the cut and come within a packet of its target,
which is worked out apart from it.

Running totals are over the whole table by ranges of (source, order) and of finish times, so a source may hold any share of
the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free_names, running_total, stored

#: Words of a packet.
PACKET = 256

#: A word: no blank, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: Sequence[float], budget_share: float, repeats: int) -> tuple[DataFrame, int]:
    """Of rows (source, size): a stored row for each source with weight, queue (where it begins) and target; and all sizes.

    Sources in order of code points, null last, take the weights in turn. A target is the source's weight times the virtual
    time at which all have sent the budget; each round finds the time for those whose queue has not ended, until no more end.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_one", F.lit(1))
    order = [F.col("source").asc_nulls_last()]
    sources = running_total(sources, order, "_one", "_rank").drop("_one")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = running_total(sources.withColumn("weight", weight).drop("_rank"), order, "source_size", "queue")
    sources = stored(sources.withColumn("most", F.col("source_size") * repeats), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, time, ended = budget_share * total, 0.0, -1
    while True:
        done = F.col("most") <= F.lit(time) * F.col("weight") if ended >= 0 else F.lit(False)
        x = sources.agg(F.sum(F.when(done, F.col("most")).otherwise(0)).alias("sent"), F.sum(F.when(done, 0).otherwise(F.col("weight"))).alias("left"), F.count_if(done).alias("ended")).first()
        if x.ended == ended or not x.left:
            break
        time, ended = (budget - x.sent) / x.left, x.ended
    return sources.withColumn("target", F.least(F.col("most").cast("double"), F.lit(time) * F.col("weight"))), total


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), budget_share: float = 1.5, repeats: int = 2, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """(documents, the mix).

    documents: a row for each row of ``docs``: row (its number), doc_id, text_hash, size (words), source_size, target (its
    source's).
    The mix: a row for each packet of a document that is taken: row, turn (0, 1, ...), taken (words, fewer than the
    packet has where the cut falls into it), finish, place (words of the mix before it). A document's packets are taken
    from its beginning, so all but the last document of a source are taken whole.

    A null or empty text has no words and is never taken; a null source is a source. Documents without an id are ordered
    by their hash. Rows that repeat a doc_id are documents of their own. Only doc_id, text and source are read.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    text = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", text, size.alias("size")), "sizes")
    sources, total = source_targets(rows, weights, budget_share, repeats)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    turns = rows.where("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    turns = turns.withColumn("drawn", F.md5(F.concat_ws(":", F.lit(seed), "turn", name)))
    order = [F.col("source").asc_nulls_last(), *map(F.col, ("turn", "drawn", "doc_id", "size", "text_hash", "row"))]
    queued = running_total(turns, order, "size", "before").select("row", "turn", "source", "size", "before")
    own = sources.select(F.col("source").alias("_source"), "weight", "queue")
    queued = queued.join(own, F.col("source").eqNullSafe(F.col("_source")))
    start = F.col("before") - F.col("queue") * repeats
    packets = queued.select("row", "turn", "source", "size", "weight", start.alias("start"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / PACKET))).alias("packet"))
    end = F.least("size", (F.col("packet") + 1) * PACKET)
    packets = packets.select("row", "turn", "source", ((F.col("start") + end) / F.col("weight")).alias("finish"), (end - F.col("packet") * PACKET).alias("words"))
    budget = F.lit(budget_share * total)
    served = running_total(packets, [F.col("finish"), F.col("source").asc_nulls_last()], "words", "place").where(F.col("place") < budget)
    taken = F.floor(F.least(F.col("words").cast("double"), budget - F.col("place"))).cast("long")
    mixed = served.select("row", "turn", taken.alias("taken"), "finish", "place").where("taken > 0")
    about = sources.select(F.col("source").alias("_source"), "source_size", "target")
    documents = rows.join(about, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return documents, mixed


def words_taken(docs: DataFrame, **options) -> DataFrame:
    """A row for each row of ``docs``: doc_id, size, source_size, target, taken (words the mix takes of it)."""
    documents, mixed = mix(docs, **options)
    documents = documents.drop("source")
    parts = documents.withColumn("taken", F.lit(0).cast("long")).unionByName(
        mixed.select("row", "taken"), allowMissingColumns=True
    )
    return (
        parts.groupBy("row")
        .agg(*[F.max(c).alias(c) for c in ("doc_id", "size", "source_size", "target")], F.sum("taken").alias("taken"))
        .drop("row")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: one row for each time that a document is taken.

    Where the cut falls into a document, its first words, parted by single blanks, are what is taken of it. n_chars, if
    there is such a column, is the length of what is taken. Of rows that repeat doc_id, source and text any one's other
    columns are taken, for all of them.
    """
    documents, mixed = mix(docs, **options)
    times = mixed.groupBy("row", "turn").agg(F.sum("taken").alias("taken"))
    times = stored(times.join(documents.select("row", "doc_id", "source", "text_hash", "size"), "row"), "times")
    key = ["doc_id", "source", "text_hash"]
    (hashed,) = free_names(docs, "text_hash")
    named = docs.withColumn(hashed, F.xxhash64(F.coalesce("text", F.lit(""))))
    if not times.where("turn = 0").groupBy(*key).count().where("count > 1").isEmpty():  # rows that repeat each other
        named = named.dropDuplicates(["doc_id", "source", hashed])
    names = free_names(named, *key, "size", "taken")
    times = times.select(*[F.col(c).alias(n) for c, n in zip([*key, "size", "taken"], names)])
    condition = F.lit(True)
    for c, n in zip(["doc_id", "source", hashed], names):
        condition = condition & named[c].eqNullSafe(times[n])
    size, taken = (F.col(n) for n in names[3:])
    out = named.join(times, condition)
    first = F.concat_ws(" ", F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), taken.cast("int")))
    out = out.withColumn("text", F.when(taken < size, first).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(taken < size, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
