"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Each task reads its documents once, takes the SHA-256 of every text and its first 64 bits as the fingerprint. It cuts
   its sorted distinct fingerprints by owner (ranges of the fingerprint) and sends each owner one Golomb-Rice code.
2. An owner decodes what it got, and answers each sender with a bitmap: which of its fingerprints others have as well.
3. The senders' documents with a marked or locally repeated fingerprint are suspects. Only their texts are shuffled, to be
   compared byte by byte; copies are combined before the shuffle, so a text that a third of the documents share is sent
   once by each task.

A document that shares its fingerprint with none never leaves its place but for some bits.

With very many owners a sender would have a row for each of them, and rows would grow with the square of the documents. Then
senders send to regions of owners, and in a region relays put the codes of many senders together before they ask its owners.
"""

from __future__ import annotations

import hashlib
import math
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free_names, matching, stored, without

#: A task sends what it has after so many documents: bounds its memory.
PACKET_ROWS = 500_000
#: Fingerprints of an owner, on average: 32 MB.
OWNER_ROWS = 4_000_000
#: More owners than this are put together to regions, about as many as each has owners.
DIRECT = 1024
#: Fingerprints of a relay, on average.
RELAY_PRINTS = 1_000_000

HEADER = struct.Struct("<IBQI")


def golomb_encode(values: np.ndarray) -> bytes:
    """Code of sorted distinct uint64: a header, the quotients of the gaps in unary, then their remainders."""
    n = len(values)
    if n == 0:
        return HEADER.pack(0, 0, 0, 0)
    gaps = np.diff(values)
    mean = float(gaps.mean()) if n > 1 else 1.0
    k = max(0, min(63, int(np.log2(max(1.0, mean * np.log(2))))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.ones(int(ends[-1]) if n > 1 else 0, np.uint8)
    unary[ends - 1] = 0
    packed = np.packbits(unary).tobytes()
    bits = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return HEADER.pack(n, k, int(values[0]), len(packed)) + packed + np.packbits(bits.ravel()).tobytes()


def golomb_decode(code: bytes) -> np.ndarray:
    n, k, first, length = HEADER.unpack_from(code)
    if n == 0:
        return np.empty(0, np.uint64)
    unary = np.unpackbits(np.frombuffer(code, np.uint8, length, HEADER.size))
    stops = np.flatnonzero(unary == 0)[: n - 1]
    quotients = np.diff(stops, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(code, np.uint8, offset=HEADER.size + length), count=(n - 1) * k).reshape(n - 1, k)
    remainders = (bits.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    gaps = (quotients.astype(np.uint64) << np.uint64(k)) + remainders
    return np.concatenate([[np.uint64(first)], np.uint64(first) + np.cumsum(gaps, dtype=np.uint64)]).astype(np.uint64)


PACKETS = "packet string, owner int, code binary, doc_ids array<bigint>, slots array<int>, digests array<binary>"


def _range_of(owners: int) -> Callable[[np.ndarray], np.ndarray]:
    """Which of that many equal ranges fingerprints are in."""
    return lambda prints: ((prints >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def _send(owners: int, bits: int):
    """Rows of PACKETS, one for each owner and packet; slots: where in the code each document's fingerprint is."""

    def packet(ids: list, digests: list[bytes]) -> pa.RecordBatch:
        prints = np.frombuffer(b"".join(d[:8] for d in digests), ">u8").astype(np.uint64) >> np.uint64(64 - bits)
        prints <<= np.uint64(64 - bits)
        order = np.argsort(prints, kind="stable")
        cuts = np.flatnonzero(np.diff(_range_of(owners)(prints[order]))) + 1
        rows, name = [], uuid.uuid4().hex
        for part in np.split(order, cuts):
            own = prints[part]
            distinct, slots = np.unique(own, return_inverse=True)
            to = int(_range_of(owners)(distinct[:1])[0])
            rows.append((name, to, golomb_encode(distinct), [ids[i] for i in part], slots.tolist(), [digests[i] for i in part]))
        kinds = (pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.binary()))
        names = ("packet", "owner", "code", "doc_ids", "slots", "digests")
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, digests = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            digests += [hashlib.sha256(x or b"").digest() for x in batch.column(1).cast(pa.binary()).to_pylist()]
            if len(ids) >= PACKET_ROWS:
                yield packet(ids, digests)
                ids, digests = [], []
        if ids:
            yield packet(ids, digests)

    return task


def answer(codes: pd.DataFrame) -> pd.DataFrame:
    """Of one owner's codes: to each sender the bitmap of the fingerprints that another sender has too."""
    lists = [golomb_decode(c) for c in codes["code"]]
    seen, times = np.unique(np.concatenate(lists), return_counts=True)
    common = seen[times > 1]
    bitmaps = [np.packbits(np.isin(x, common, assume_unique=True)).tobytes() for x in lists]
    return pd.DataFrame({"packet": codes["packet"], "owner": codes["owner"], "bitmap": bitmaps})


ANSWERS = "packet string, owner int, bitmap binary"
RELAYS = "packet string, owner int, region int, code binary, packets array<string>, codes array<binary>"


def regions_and_owners(owners: int) -> tuple[int, int]:
    """Into how many regions at least ``owners`` owners are put, and how many each has."""
    per = 1 if owners <= DIRECT else math.ceil(math.sqrt(owners))
    return -(-owners // per), per


def _relay(owner_of: Callable[[np.ndarray], np.ndarray]):
    """Of a batch of codes of a region: a row that stays, with the codes, and one for each owner, with what all have."""

    def task(key: tuple, codes: pd.DataFrame) -> pd.DataFrame:
        name, region = f"{key[0]}-{key[1]}", int(key[0])
        distinct = np.unique(np.concatenate([golomb_decode(c) for c in codes["code"]]))
        owners = owner_of(distinct)
        rows = [(name, -1, region, None, list(codes["packet"]), list(codes["code"]))]
        for part in np.split(np.arange(len(distinct)), np.flatnonzero(np.diff(owners)) + 1):
            rows.append((name, int(owners[part[0]]), region, golomb_encode(distinct[part]), None, None))
        return pd.DataFrame(rows, columns=["packet", "owner", "region", "code", "packets", "codes"])

    return task


def _passed_on(owner_of: Callable[[np.ndarray], np.ndarray]):
    """The owners' answers to a relay, and what its senders share among them, as answers to its senders."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                lists = [golomb_decode(c) for c in row["codes"]]
                seen, times = np.unique(np.concatenate(lists), return_counts=True)
                counts = np.unique(owner_of(seen), return_counts=True)[1].tolist()
                maps = sorted(row["bitmaps"], key=lambda m: m["owner"])
                others = [np.unpackbits(np.frombuffer(m["bitmap"], np.uint8), count=n) for m, n in zip(maps, counts, strict=True)]
                common = (np.concatenate(others) == 1) | (times > 1)
                bitmaps = [np.packbits(common[np.searchsorted(seen, x)]).tobytes() for x in lists]
                regions = pa.array([row["region"]] * len(lists), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(row["packets"]), regions, pa.array(bitmaps, pa.binary())], ["packet", "owner", "bitmap"])

    return task


def answers(codes: DataFrame, owner_of: Callable[[np.ndarray], np.ndarray], regions: int, per: int, prints: int) -> DataFrame:
    """To each packet and region the bitmap of the fingerprints that another packet has too: rows of ANSWERS.

    codes: (packet, owner, code), where owner is one of ``regions`` regions. With one owner each (``per``) it gets the codes
    itself. Else a region's packets are dealt to relays, by the number of all fingerprints ``prints``; a relay sends each of
    the region's owners, which ``owner_of`` tells, one code for all its packets. A packet then makes a row for each region
    and a relay one for each owner of its region, so rows grow with the fingerprints times their square root over some
    millions, and not with their square.
    """
    if per == 1:
        return codes.groupBy("owner").applyInPandas(answer, ANSWERS)
    batch = F.pmod(F.xxhash64("packet"), F.lit(-(-prints // (regions * RELAY_PRINTS)) or 1))
    relays = stored(codes.withColumn("batch", batch).groupBy("owner", "batch").applyInPandas(_relay(owner_of), RELAYS), "relays")
    asked = relays.where("owner >= 0").select("packet", "owner", "code").groupBy("owner").applyInPandas(answer, ANSWERS)
    asked = asked.groupBy("packet").agg(F.collect_list(F.struct("owner", "bitmap")).alias("bitmaps"))  # ``per`` at most
    return relays.where("owner = -1").join(asked, "packet").mapInArrow(_passed_on(owner_of), ANSWERS)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            slots = np.array(row["slots"], np.int64)
            marked = np.unpackbits(np.frombuffer(row["bitmap"], np.uint8)).astype(bool)
            suspect = marked[slots] | (np.bincount(slots)[slots] > 1)
            names = [f"{row['packet']}-{row['owner']}-{i}" for i in range(len(slots))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(row["doc_ids"], pa.int64()), pa.array(row["digests"], pa.binary()), pa.array(suspect)],
                ["row", "doc_id", "digest", "suspect"],
            )


def exact_groups(docs: DataFrame, owners: int | None = None, bits: int = 64) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (the same bytes) the row with the largest doc_id stays. A null text counts as empty, so null and empty
    texts are one group. A null doc_id is smaller than all others. Of rows repeated with the same doc_id and text one
    stays; each has its own row here. An empty table gives an empty result; other columns aren't read.
    ``owners``: into how many ranges the fingerprints are cut, by default as many as there are shuffle partitions, or more, so
    that a range has some OWNER_ROWS fingerprints.
    ``bits``: leading bits of the fingerprint in use (fewer only to test that clashes do no harm).
    """
    spark = docs.sparkSession
    prints = docs.count()
    owners = owners or max(int(spark.conf.get("spark.sql.shuffle.partitions")), prints // OWNER_ROWS)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    regions, per = regions_and_owners(owners)
    packets = stored(docs.mapInArrow(_send(regions, bits), PACKETS), "packets")
    bitmaps = answers(packets.select("packet", "owner", "code"), _range_of(regions * per), regions, per, prints)
    rows = packets.select("packet", "owner", "doc_ids", "slots", "digests").join(bitmaps, ["packet", "owner"])
    rows = stored(rows.mapInArrow(_mark, "row string, doc_id bigint, digest binary, suspect boolean"), "marked")

    suspects = rows.where("suspect")
    texts = matching(docs, stored(suspects.select("doc_id").distinct(), "suspects"), "doc_id")
    texts = texts.select(F.unhex(F.sha2("text", 256)).alias("digest"), "text").distinct()
    clash = texts.groupBy("digest").count().where("count > 1").take(1)
    if clash:
        raise ValueError(f"different texts have the SHA-256 {clash[0].digest.hex()}")

    best = suspects.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
    groups = suspects.join(best, "digest").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "digest",
    )
    single = rows.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    return groups.unionByName(single).withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops, all columns as they were.

    Rows repeated with the same doc_id and text leave one of them; if their other columns differ, any one of them.
    """
    groups = stored(exact_groups(docs), "groups")
    repeated = stored(groups.groupBy("doc_id").count().where("count > 1 or doc_id is null").select("doc_id"), "repeated")
    dropped = stored(groups.where("not kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "dropped")
    if repeated.isEmpty():
        return without(docs, dropped, "doc_id")
    once = without(docs, stored(repeated.unionByName(dropped).distinct(), "repeated-or-dropped"), "doc_id")
    sha, kept_id, kept_sha = free_names(docs, "sha", "kept_id", "kept_sha")
    digest = docs.withColumn(sha, F.sha2(F.coalesce("text", F.lit("")), 256))
    kept = groups.where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
    more = matching(digest, repeated, "doc_id")
    more = more.join(kept, more["doc_id"].eqNullSafe(kept[kept_id]) & (more[sha] == kept[kept_sha]), "left_semi")
    return once.unionByName(more.dropDuplicates(["doc_id", sha]).drop(sha))
