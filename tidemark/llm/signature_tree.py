"""Join of documents whose sets of word n-grams have a high Jaccard similarity, by signature trees.

Copies (equal sets) are one class from the start. A set can only link with another if all but few of its n-grams are in
other documents too. That is tested first, on all n-grams whose hash is below a bound: tasks exchange them as Golomb-coded
short fingerprints (which may clash: then a set is kept for nothing), and a set with too many that no other has is done.

Two different sets that link differ in few n-grams, so if the n-grams are dealt by hash into somewhat more parts than that,
some parts are the same in both. The sets that have a part in common form a bucket; all other pairs are never looked at.
Which n-grams are frequent does not matter, as a whole part must agree.

In a bucket the sets, in order of size, are the leaves of a tree. A node holds the union and the intersection of its leaves'
bitmaps and the range of their sizes, from which the largest overlap of any leaf of one node with any leaf of another
follows. Two nodes are compared from the root down and given up if that overlap is too small, or if all their leaves are in
one component already. What remains at the leaves is computed on the n-grams themselves.

A bucket yields links that connect what belongs together, not all its pairs. Buckets that overlap are put together to a
cluster, which a task compares as one tree, so each set is sent once. Clusters that are too large for a task are cut into
blocks, each pair of which meets in a task; still larger ones are compared bucket by bucket. No link between components is
lost.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fingerprint_exchange import answers, golomb_encode, regions_and_owners
from .shared import components, forget, matching, stored, without

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
U = np.uint64
#: Bytes that a task hashes together; longer texts are hashed alone.
CHUNK = 1 << 18
#: Sets, and n-grams of all of them, in a block that is compared in one task.
BLOCK_SETS, BLOCK_GRAMS = 4096, 4_000_000
#: A cluster of up to so many blocks is compared pair of blocks by pair of blocks, a larger one bucket by bucket.
CLUSTER_BLOCKS = 32
FANOUT = 8
#: Ways to deal the n-grams, for sets that leave many parts empty.
DEALS = 12
#: A fingerprint has so many bits more than it takes to number all n-grams: one in 16 clashes with another.
SPARE_BITS = 4
#: A task sends what it has after so many n-grams or documents; an owner has so many to compare.
PACKET_GRAMS, PACKET_DOCS, OWNER_GRAMS = 1_000_000, 60_000, 4_000_000
#: A size class ends at so many times its beginning.
CLASS = 1.3


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    powers, inverse = np.full(n, U(base)), np.full(n, U(pow(base, -1, 1 << 64)))
    powers[0] = inverse[0] = U(1)
    return np.cumprod(powers, dtype=U), np.cumprod(inverse, dtype=U)


BYTES = _mixed(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, where it begins); words are parted by ASCII white space."""
    x = np.frombuffer(b" " + data + b" ", np.uint8)
    space = SPACE[x]
    begin, end = np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1
    powers, inverse = _powers(1 << max(18, int(len(x) - 1).bit_length()))
    total = np.cumsum(BYTES[x] * powers[: len(x)], dtype=U)
    return _mixed((total[end - 1] - total[begin - 1]) * inverse[begin]), begin - 1


def gram_sets(texts: list[str | None], n: int = 3, bytes_as: bytes | None = None) -> Iterator[np.ndarray]:
    """Of each text: the sorted distinct hashes of its n-grams of words, A-Z lower-cased; of fewer words, of all as one.

    ``bytes_as``: a table that bytes are translated by first.
    """

    def chunks() -> Iterator[list[bytes]]:
        held, size = [], 0
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass").lower()
            data = data.translate(bytes_as) if bytes_as else data
            if held and size + len(data) > CHUNK:
                yield held
                held, size = [], 0
            held.append(data)
            size += len(data) + 1
        if held:
            yield held

    factors = _mixed(np.arange(1, n + 1, dtype=U)) | U(1)
    for chunk in chunks():
        words, at = word_hashes(b" ".join(chunk))
        cuts = np.searchsorted(at, np.cumsum([0] + [len(x) + 1 for x in chunk]))
        for i in range(len(chunk)):
            own = words[cuts[i] : cuts[i + 1]]
            width = min(n, len(own))
            grams = np.zeros(max(0, len(own) - width + 1) if width else 0, U) + U(width)
            for k in range(width):
                grams += own[k : len(own) - width + k + 1] * factors[k]
            yield np.unique(_mixed(grams))


class Similarity:
    """J >= percent / 100 in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent

    def linked(self, common, sizes):
        """Of the sum of both sizes: (100 + percent) * common >= percent * sizes is the same as the threshold on Jaccard."""
        return (100 + self.percent) * common >= self.percent * sizes

    def differing(self, larger: int) -> int:
        """Most n-grams that are in just one of two linked sets of at most that size."""
        return 2 * larger * (100 - self.percent) // (100 + self.percent)

    @functools.cached_property
    def classes(self) -> list[int]:
        """Where size classes begin."""
        begins = [1]
        while begins[-1] < 1 << 40:
            begins.append(max(begins[-1] + 1, int(begins[-1] * CLASS)))
        return begins

    def missing(self, size: int) -> int:
        """N-grams of a set of that size that a linked set may lack, at most."""
        return size - -(-self.percent * size // 100)

    @property
    def tested(self) -> int:
        """N-grams with a smaller hash are tested: twice as many as may be missing."""
        return min((1 << 64) - 1, (1 << 64) // 100 * 2 * (100 - self.percent))

    @functools.cache
    def parts(self, own: int) -> tuple[int, int]:
        """Of size class ``own``: into how many parts n-grams are dealt, and how many more that is than can differ."""
        begin, end = self.classes[own], self.classes[own + 1] - 1
        differing, smallest, spare = self.differing(end), -(-self.percent * begin // 100), 1
        for _ in range(20):  # about as many as are empty by chance, and some more
            parts = differing + 1 + spare
            empty = parts * (1 - 1 / parts) ** smallest
            spare = min(max(1, int(np.ceil(empty + np.sqrt(empty)))), max(1, differing))
        return differing and differing + 1 + spare, spare

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """Keys of which linked different sets share one: for every size class of the larger set that the smaller may be in.

        With at most d differing n-grams and d + 1 + spare parts, more than ``spare`` parts agree. Only parts that hold
        something make a key. If the agreeing parts are all empty, then both sets have more than ``spare`` empty parts;
        such sets are dealt again in another way, and after DEALS ways empty parts make keys too.
        """
        n, begins, out = len(grams), self.classes, []
        own = int(np.searchsorted(begins, n, side="right")) - 1
        while 100 * n >= self.percent * begins[own]:
            parts, spare = self.parts(own)
            for deal in range(DEALS if parts else 0):
                dealt = _mixed(grams + U((own * DEALS + deal + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
                part = ((dealt >> U(32)) % U(parts)).astype(np.int64)
                sums = np.zeros(parts, U)
                np.add.at(sums, part, _mixed(dealt))
                counts = np.bincount(part, minlength=parts)
                name = U((own * DEALS + deal) << 32) + np.arange(parts, dtype=U)
                key = _mixed(sums + _mixed(name + U(1)) + counts.astype(U))
                out.append(key if deal == DEALS - 1 else key[counts > 0])
                if (counts == 0).sum() <= spare:
                    break
            own += 1
        return np.concatenate(out) if out else np.empty(0, U)


def _levels(bitmaps: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """From the leaves to the root: (union, intersection, smallest size, largest size) of each node."""
    levels = [(bitmaps, bitmaps, sizes, sizes)]
    while len(levels[-1][2]) > 1:
        union, common, low, high = levels[-1]
        at = np.arange(0, len(low), FANOUT)
        levels.append((np.bitwise_or.reduceat(union, at), np.bitwise_and.reduceat(common, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
    return levels


def _children(x: np.ndarray, y: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    i, j = (a.ravel() for a in np.meshgrid(np.arange(FANOUT), np.arange(FANOUT), indexing="ij"))
    a, b = (x[:, None] * FANOUT + i).ravel(), (y[:, None] * FANOUT + j).ravel()
    keep = (b < count) & (a <= b)
    return a[keep], b[keep]


def _bitmap(grams: np.ndarray, bits: int) -> np.ndarray:
    """2**bits bits, of which one is set for each n-gram, by the first bits of its hash."""
    marks = np.zeros(1 << bits, bool)
    marks[(grams >> U(64 - bits)).astype(np.int64)] = True
    return np.packbits(marks).view(U)


def _halved(bitmap: np.ndarray) -> np.ndarray:
    """The bitmap of the same n-grams with half as many bits."""
    return np.packbits(np.unpackbits(bitmap.view(np.uint8)).reshape(-1, 2).any(axis=1)).view(U)


class Tree:
    """A signature tree over sets that are given by size and bitmap, in order of size; labels: their components."""

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray, labels: np.ndarray, similarity: Similarity):
        self.levels, self.labels, self.similarity = _levels(bitmaps, sizes), labels, similarity

    def hopeful(self, level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of pairs of nodes: whether leaves of both may link, and not all are in one component."""
        union, common, low, high = self.levels[level]
        percent, labels, begin = self.similarity.percent, self.labels, np.arange(0, len(self.labels), FANOUT**level)
        sized = (100 * high[x] >= percent * low[y]) & (100 * high[y] >= percent * low[x])
        apart = [np.bitwise_count(common[p] & ~union[q]).sum(axis=1).astype(np.int64) for p, q in ((x, y), (y, x))]
        overlap = np.minimum(high[x] - apart[0], high[y] - apart[1])
        first, last = np.minimum.reduceat(labels, begin), np.maximum.reduceat(labels, begin)
        settled = (first[x] == last[x]) & (first[y] == last[y]) & (first[x] == first[y])
        return sized & self.similarity.linked(overlap, low[x] + low[y]) & ~settled

    def pairs(self, level: int | None = None, x=None, y=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaves that may link, from the root down, near ones first. Labels may change meanwhile."""
        if level is None:
            level, x, y = len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64)
        for i in range(0, len(x), 128):
            a, b = x[i : i + 128], y[i : i + 128]
            if level:
                keep = self.hopeful(level, a, b)
                a, b = _children(a[keep], b[keep], len(self.levels[level - 1][2]))
                nearest = np.argsort(b - a, kind="stable")
                yield from self.pairs(level - 1, a[nearest], b[nearest])
            else:
                a, b = a[a < b], b[a < b]
                keep = self.hopeful(0, a, b)
                yield a[keep], b[keep]


def tree_links(ids: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], similarity: Similarity) -> list[tuple[int, int]]:
    """Links between leaves of different components (``labels``) that connect all linked leaves, by dual traversal."""
    sizes = np.array([len(s) for s in sets])
    order = np.lexsort((ids, sizes))
    ids, sizes, sets = ids[order], sizes[order], [sets[i] for i in order]
    labels = np.unique(labels[order], return_inverse=True)[1]
    links: list[tuple[int, int]] = []
    if labels.max(initial=0) == 0:
        return links
    bits = min(12, max(6, int(2 * sizes.max()).bit_length()))
    for x, y in Tree(sizes, np.stack([_bitmap(s, bits) for s in sets]), labels, similarity).pairs():
        while len(x):
            for a, b in zip(x[:256].tolist(), y[:256].tolist()):
                if labels[a] != labels[b] and ids[a] != ids[b]:
                    common = len(sets[a]) + len(sets[b]) - len(np.union1d(sets[a], sets[b]))
                    if similarity.linked(common, sizes[a] + sizes[b]):
                        links.append((int(ids[a]), int(ids[b])))
                        labels[labels == labels[b]] = labels[a]
            left = labels[x[256:]] != labels[y[256:]]
            x, y = x[256:][left], y[256:][left]
    return links


def tree_hopes(labels: np.ndarray, sizes: np.ndarray, bitmaps: list[np.ndarray], similarity: Similarity) -> np.ndarray:
    """Which leaves may link with one of another component, as far as the bitmaps tell."""
    hope = np.zeros(len(sizes), bool)
    order = np.argsort(sizes, kind="stable")
    labels = np.unique(labels[order], return_inverse=True)[1]
    if labels.max(initial=0) == 0:
        return hope
    least = min(len(m) for m in bitmaps)
    maps = []
    for i in order:
        m = bitmaps[i]
        while len(m) > least:
            m = _halved(m)
        maps.append(m)
    for x, y in Tree(sizes[order], np.stack(maps), labels, similarity).pairs():
        apart = labels[x] != labels[y]
        hope[order[x[apart]]] = hope[order[y[apart]]] = True
    return hope


def _parts(batch: pa.RecordBatch, rows: int = 500) -> Iterator[tuple[list, list]]:
    """A batch's two columns, some rows at a time."""
    for i in range(0, len(batch), rows):
        part = batch.slice(i, rows)
        yield part.column(0).to_pylist(), part.column(1).to_pylist()


def _digests(n: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _parts(batch):
                sets = list(gram_sets(texts, n))
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary())], ["doc_id", "n", "digest"])

    return task


PACKETS = "packet string, owner int, code binary, ids array<bigint>, missing array<int>, of binary, starts binary, sent array<int>"


def _send(n: int, percent: int, bits: int, owners: int, width: int):
    """Rows for the owners (code: sorted distinct fingerprints), and for each packet one with owner -1 that stays.

    That one has its documents, how many n-grams each may miss, the document of each n-gram in order of fingerprints, which
    of these begin a new fingerprint, and how many fingerprints each owner was sent. ``width``: the range of an owner.
    """
    similarity = Similarity(percent)

    def packet(ids: list[int], missing: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        prints = np.concatenate(sets) >> U(64 - bits)
        order = np.argsort(prints, kind="stable")
        of = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])[order]
        prints = prints[order]
        starts = np.diff(prints, prepend=prints[:1] + U(1)) != 0
        distinct = prints[starts]
        cuts = np.searchsorted(distinct, np.arange(owners + 1, dtype=U) * U(width))
        name, sent = uuid.uuid4().hex, np.diff(cuts).tolist()
        rows = [(name, -1, None, ids, missing, of.tobytes(), np.packbits(starts).tobytes(), sent)]
        rows += [(name, o, golomb_encode(distinct[cuts[o] : cuts[o + 1]]), *[None] * 5) for o in range(owners) if sent[o]]
        kinds = (pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [x.split()[0] for x in PACKETS.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, missing, sets, held = [], [], [], 0
        for batch in batches:
            for names, texts in _parts(batch):
                for name, grams in zip(names, gram_sets(texts, n)):
                    if not len(grams):
                        continue
                    ids.append(name)
                    missing.append(similarity.missing(len(grams)))
                    sets.append(grams[: np.searchsorted(grams, U(similarity.tested))].copy())  # the rest is let go
                    held += len(sets[-1])
                    if held >= PACKET_GRAMS or len(ids) >= PACKET_DOCS:
                        yield packet(ids, missing, sets)
                        ids, missing, sets, held = [], [], [], 0
        if ids:
            yield packet(ids, missing, sets)

    return task


def _accompanied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each packet of which others have enough."""
    for batch in batches:
        for i in range(len(batch)):
            row = {c: batch.column(c)[i].as_py() for c in ("ids", "missing", "of", "starts", "sent", "bitmaps")}
            maps = {x["owner"]: x["bitmap"] for x in row["bitmaps"] or []}
            common = [np.unpackbits(np.frombuffer(maps[o], np.uint8), count=k) for o, k in enumerate(row["sent"]) if k]
            of = np.frombuffer(row["of"], np.uint16)
            starts = np.unpackbits(np.frombuffer(row["starts"], np.uint8), count=len(of))
            slot = np.cumsum(starts, dtype=np.int64) - 1
            alone = (np.concatenate([np.empty(0, np.uint8), *common])[slot] == 0) & (np.bincount(slot)[slot] == 1) if len(of) else np.empty(0, bool)
            lacking = np.bincount(of[alone], minlength=len(row["ids"]))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(row["ids"], np.int64)[lacking <= np.array(row["missing"])])], ["id"])


def _sets(n: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _parts(batch):
                sets = list(gram_sets(texts, n))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "n", "grams"])

    return task


def _keys(percent: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        similarity = Similarity(percent)
        for batch in batches:
            for ids, sets in _parts(batch):
                keys = [similarity.keys(np.frombuffer(s, U)) for s in sets]
                times = [len(k) for k in keys]
                size = np.repeat([len(s) // 8 for s in sets], times)
                key = np.concatenate([np.empty(0, U), *keys]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(np.array(ids, np.int64), times)), pa.array(size, pa.int64())], ["key", "id", "n"])

    return task


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of some eight bits for each n-gram."""
    for batch in batches:
        for ids, sets in _parts(batch):
            grams = [np.frombuffer(s, U) for s in sets]
            maps = [_bitmap(g, min(18, max(6, (8 * len(g)).bit_length()))).tobytes() for g in grams]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(g) for g in grams], pa.int64()), pa.array(maps, pa.binary())], ["id", "n", "bitmap"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Runs of two or more rows with the same key and block."""
    held, at = [], None
    for batch in batches:
        groups = zip(batch.column("key").to_pylist(), batch.column("block").to_pylist())
        for i, group in enumerate(groups):
            if group != at:
                if len(held) > 1:
                    yield held
                held, at = [], group
            held.append({c: batch.column(c)[i].as_py() for c in batch.schema.names})
    if len(held) > 1:
        yield held


def _links(percent: int):
    """Of rows (key, block, id, component, grams) sorted by key and block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        similarity = Similarity(percent)
        for rows in _groups(batches):
            ids, labels = (np.array([r[c] for r in rows], np.int64) for c in ("id", "component"))
            found = tree_links(ids, labels, [np.frombuffer(r["grams"], U) for r in rows], similarity)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return task


def _hopes(percent: int):
    """Of rows (key, block, id, component, n, bitmap) sorted by key and block: those that may link in their bucket."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        similarity = Similarity(percent)
        for rows in _groups(batches):
            labels, sizes = (np.array([r[c] for r in rows], np.int64) for c in ("component", "n"))
            hope = tree_hopes(labels, sizes, [np.frombuffer(r["bitmap"], U) for r in rows], similarity)
            left = [r for r, h in zip(rows, hope) if h]
            kinds = (("key", pa.int64()), ("block", pa.string()), ("id", pa.int64()), ("component", pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in left], t) for c, t in kinds], [c for c, _ in kinds])

    return task


def _linked_by_key(members: DataFrame, compared, hopeful) -> DataFrame:
    """Links among ``members`` (key, id, blocks), bucket by bucket.

    First each set is compared in one of its buckets only, then in another, which settles nearly all groups. Last, every
    bucket that still holds different components is compared in full, each pair of its blocks by a task: first by bitmaps
    alone, which are far smaller than sets; the sets that may link go on to be compared exactly.
    """
    links, open_ = None, members.withColumn("component", F.col("id"))
    for way, pick in (("one", F.min), ("another", F.max), ("all", None)):
        block = F.pmod(F.xxhash64("id", F.lit(way)), F.col("blocks")).cast("int")
        if pick is None:
            other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
            buckets = open_.withColumn("own", block).withColumn("other", other)
            pair = F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other"))
            buckets = stored(hopeful(buckets.select("key", pair.alias("block"), "id", "component")), "hopes")
        else:
            picked = open_.groupBy("id").agg(pick("key").alias("key"))
            buckets = open_.join(picked, ["id", "key"]).select("key", block.cast("string").alias("block"), "id", "component")
        more = compared(buckets)
        links = stored(more if links is None else links.unionByName(more), "links")
        if pick is not None:
            found = stored(components(links), "found")
            named = members.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
            mixed = named.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
            open_ = stored(named.join(mixed.where("least < most").select("key"), "key"), "open")
    return links


def link_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    A document's set: the distinct ``n``-grams of its words (parted by ASCII white space, A-Z lower-cased); with fewer
    words, all of them as one. Two documents link if their sets' Jaccard similarity is at least ``percent`` / 100; null
    and empty texts and those without words have an empty set and link with nothing. component_id: the smallest doc_id
    that links reach, the own included.

    Rows that repeat a doc_id are one document: their components are joined, unless the set is empty. Rows without a
    doc_id have component null and link with nothing. An empty table gives an empty result. Other columns aren't read.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    rows = stored(docs.mapInArrow(_digests(n), "doc_id bigint, n bigint, digest binary"), "digests")
    some = rows.where("doc_id IS NOT NULL AND n > 0")
    classes = some.groupBy("digest").agg(F.min("doc_id").alias("id"))
    known = stored(some.join(classes, "digest").select("doc_id", "id"), "classes")
    # Only a document that is the smallest of none of its texts is left out: the rows of the others may be all a text has.
    copies = stored(known.groupBy("doc_id").agg(F.max("id").alias("id")).where("doc_id <> id").select("doc_id"), "copies")
    first = without(docs.where("doc_id IS NOT NULL"), copies, "doc_id")

    grams = rows.agg(F.sum("n")).first()[0] or 0
    bits = min(63, max(16, int(grams).bit_length() + SPARE_BITS))
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(grams) // OWNER_GRAMS)
    regions, per = regions_and_owners(owners)
    width = (Similarity(percent).tested >> (64 - bits)) // (regions * per) + 1
    packets = stored(first.mapInArrow(_send(n, percent, bits, regions, width * per), PACKETS), "packets")
    codes = packets.where("owner >= 0").select("packet", "owner", "code")
    bitmaps = answers(codes, lambda prints: (prints // U(width)).astype(np.int64), regions, per, int(grams))
    bitmaps = bitmaps.groupBy("packet").agg(F.collect_list(F.struct("owner", "bitmap")).alias("bitmaps"))  # one for each region
    staying = packets.where("owner = -1").drop("owner", "code").join(bitmaps, "packet", "left")
    accompanied = stored(staying.mapInArrow(_accompanied, "id bigint").distinct(), "accompanied")
    forget(packets)
    texts = matching(first, accompanied.withColumnRenamed("id", "doc_id"), "doc_id")
    sets = stored(texts.mapInArrow(_sets(n), "id bigint, n bigint, grams binary"), "sets")

    keys = stored(sets.select("id", "grams").mapInArrow(_keys(percent), "key bigint, id bigint, n bigint"), "keys")
    shared = keys.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    members = stored(keys.join(shared.select("key", "least"), "key").distinct(), "members")
    forget(keys)

    def compared(buckets: DataFrame) -> DataFrame:
        dealt = buckets.join(sets.drop("n"), "id").select("key", "block", "id", "component", "grams")
        dealt = dealt.repartition("key", "block").sortWithinPartitions("key", "block")
        return dealt.mapInArrow(_links(percent), "a bigint, b bigint")

    def hopeful(buckets: DataFrame) -> DataFrame:
        marks = sets.select("id", "grams").mapInArrow(_marks, "id bigint, n bigint, bitmap binary")
        dealt = buckets.join(marks, "id").select("key", "block", "id", "component", "n", "bitmap")
        dealt = dealt.repartition("key", "block").sortWithinPartitions("key", "block")
        return dealt.mapInArrow(_hopes(percent), "key bigint, block string, id bigint, component bigint")

    def blocks(rows: DataFrame, by: str) -> DataFrame:
        """How many blocks each bucket needs."""
        need = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_GRAMS), F.lit(1))
        return rows.groupBy(by).agg(need.cast("int").alias("blocks"))

    alike = known.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")  # repeated doc_ids
    alike = known.join(alike.select("doc_id", "a"), "doc_id").select("a", F.col("id").alias("b")).where("a < b")

    near = components(members.select(F.col("least").alias("a"), F.col("id").alias("b")), "near")
    near = near.withColumnRenamed("component", "cluster").join(members.groupBy("id").agg(F.max("n").alias("n")), "id")
    near = stored(near, "clusters")
    near = stored(near.join(blocks(near, "cluster"), "cluster"), "clusters")
    cut = near.where(F.col("blocks") <= CLUSTER_BLOCKS).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cut = cut.withColumnRenamed("cluster", "key").select("key", "blocks", "own", "id")
    inside = cut.select("key", F.col("own").cast("string").alias("block"), "id", F.col("id").alias("component"))
    links = stored(compared(inside).unionByName(alike), "links")
    found = stored(components(links), "found")
    several = cut.where("blocks > 1")
    if not several.isEmpty():  # then all pairs of blocks of a cluster
        named = several.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = named.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
        pairs = named.join(mixed.select("key"), "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        pair = F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other"))
        pairs = pairs.where("own <> other").select("key", pair.alias("block"), "id", "component")
        links = stored(links.unionByName(compared(pairs)), "links")
        found = stored(components(links), "found")
    large = near.where(F.col("blocks") > CLUSTER_BLOCKS).select("id")
    if not large.isEmpty():
        members = members.join(large, "id")
        members = stored(members.join(blocks(members, "key"), "key"), "large")
        links = stored(links.unionByName(_linked_by_key(members, compared, hopeful)), "links")
        found = stored(components(links), "found")
    forget(sets)
    reached = known.distinct().join(found, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component"))
    reached = reached.groupBy("doc_id").agg(F.min("component").alias("reached"))
    out = rows.join(reached, "doc_id", "left")
    own = F.when(F.col("n") > 0, F.coalesce("reached", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each_component(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with only the smallest doc_id of each component, all columns as they were; rows that repeat it stay.

    Documents without words are no one's copies and stay, as do rows without a doc_id.
    """
    linked = link_components(docs, n, percent).where("n_shingles > 0 AND doc_id <> component_id")
    gone = stored(linked.select("doc_id").distinct(), "gone")
    wordless = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) == 0
    return without(docs.where(~wordless), gone, "doc_id").unionByName(docs.where(wordless))
