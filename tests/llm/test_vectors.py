"""Whole-number vector codes and hard negatives against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import active_lloyd, queries, shared, vectors, zone_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, _key int, _n int, row int"


def made(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3) for i, v, label in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def given():
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(0, 0.3, 16).astype(np.float32).tolist(), i % 4) for i in range(400)]
    hot = rows[8][1]
    rows += [(1000 + i, hot, i % 3) for i in range(150)]  # a third: copies of one vector
    rows += [(2000 + i, np.round(draw.normal(0, 2, 16)).astype(np.float32).tolist(), 1) for i in range(40)]  # many ties
    rows += [(50, rows[3][1], 2), (50, rows[3][1], 2), (None, rows[4][1], 1), (None, rows[5][1], None), (60, rows[6][1], None)]
    bad = [(5000, None, 1), (5001, [], 1), (5002, [float("nan")] * 16, 1), (5003, [float("inf")] + [0.0] * 15, 1), (5004, [None] + [0.0] * 15, 1), (5005, [1.0] * 8, 1), (5006, [1e30] * 16, 1)]
    random.Random(3).shuffle(rows)
    return rows, rows + bad


def lloyd(rows, scale=4096, parts=8, entries=16, rounds=6):
    """Complete scans in every round."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([r[1] for r in rows], np.float64) * scale).astype(np.int64).reshape(len(rows), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2)

    for _ in range(rounds):
        code, _ = assign()
        for p, e in itertools.product(range(parts), range(books.shape[1])):
            own = x[code[:, p] == e, p]
            if len(own):
                books[p, e] = own.sum(axis=0) // len(own)
    code, d = assign()
    return rows, ["".join(f"{c:02x}" for c in own) for own in code], d.sum(axis=1), books


@pytest.mark.parametrize("entries,rounds", [(16, 6), (3, 40)])
@pytest.mark.parametrize("block", [4096, 37])
def test_codes_are_those_of_complete_scans(spark, given, monkeypatch, entries, rounds, block):
    monkeypatch.setattr(active_lloyd, "BLOCK", block)
    got = active_lloyd.codes_and_errors(made(spark, given[1]), entries=entries, rounds=rounds)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    rows, codes, errors, books = lloyd(given[0], entries=entries, rounds=rounds)
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    expected = [(r[0], c, int(e), by_label[r[2]], digest) for r, c, e in zip(rows, codes, errors)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_only_parts_of_moved_entries_look_at_all_entries(monkeypatch):
    seen = []
    real = active_lloyd.squared_distances
    monkeypatch.setattr(active_lloyd, "squared_distances", lambda x, b: seen.append((len(x), len(b))) or real(x, b))
    x = np.array([[0], [10], [20], [21]])
    book, moved = np.array([[0], [10], [20]]), np.array([False, False, True])
    code, distance = active_lloyd.reassign(x, np.array([0, 1, 2, 2], np.uint8), np.array([0, 0, 1, 0]), book, moved)
    assert seen == [(2, 3), (2, 1)]  # two parts of the moved entry with all three, the others with it alone
    assert code.tolist() == [0, 1, 2, 2] and distance.tolist() == [0, 0, 0, 1]


def test_a_moved_entry_of_lower_index_wins_a_tie():
    code, _ = active_lloyd.reassign(np.array([[5]]), np.array([1], np.uint8), np.array([4]), np.array([[3], [7]]), np.array([True, False]))
    assert code.tolist() == [0]


def test_few_vectors_and_none(spark, given):
    none = made(spark, [])
    assert active_lloyd.codes_and_errors(none).count() == 0 and zone_negatives.mine(none).count() == 0
    three = [(i, [float(i)] * 16, None) for i in range(3)]
    got = active_lloyd.codes_and_errors(made(spark, three)).collect()
    assert {(r.vec_id, r.code, r.error, r.label_error) for r in got} == {(i, f"0{i}" * 8, 0, 0) for i in range(3)}


def test_totals_of_hot_and_cold_keys(spark, monkeypatch):
    monkeypatch.setattr(vectors, "HOT_SHARE", 4)
    rows = [(i, None if i % 2 else i % 20, i) for i in range(60)]
    table = shared.stored(spark.createDataFrame(rows, "id long, k int, v long"), "test")
    got = {(r.id, r.total) for r in vectors.with_total(table, "k", "v", "total").collect()}
    assert got == {(i, sum(v for _, k2, v in rows if k2 == k)) for i, k, _ in rows}


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 2), (1, 4)])
def test_neighbours_on_the_curve_are_neighbours(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    places = [p.tobytes() for p in zone_negatives.hilbert(cells, bits)]
    assert len(set(places)) == len(cells)
    along = cells[sorted(range(len(cells)), key=places.__getitem__)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def hard(rows, every=50, positives=5, negatives=3, low=50, high=95, scale=256):
    rows = [r for r in rows if r[2] is not None]
    x = np.floor(np.array([r[1] for r in rows], np.float64) * scale).astype(np.int64)
    out = []
    for a, (anchor, _, label) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        s = x @ x[a]
        order = sorted((j for j in range(len(rows)) if j != a), key=lambda j: (-s[j], rows[j][0] is None, rows[j][0] or 0))
        for p in [j for j in order if rows[j][2] == label][:positives]:
            fits = [j for j in order if rows[j][2] != label and low * s[p] <= 100 * s[j] <= high * s[p]][:negatives]
            out += [(anchor, rows[p][0], i + 1, rows[j][0], int(s[p]), int(s[j])) for i, j in enumerate(fits)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block,batch", [(1024, 16384), (16, 4), (7, 1000)])
def test_hard_negatives(spark, given, monkeypatch, block, batch):
    monkeypatch.setattr(zone_negatives, "BLOCK", block)
    monkeypatch.setattr(zone_negatives, "BATCH", batch)
    monkeypatch.setattr(zone_negatives, "TOGETHER", 3)
    monkeypatch.setattr(zone_negatives, "ZONES", 5)
    got = zone_negatives.mine(made(spark, given[1]))
    assert sorted(map(tuple, got.collect()), key=str) == hard(given[0])


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    """Two far clusters: the blocks of the other cluster meet no window of an anchor and are not read."""
    draw = np.random.default_rng(2)
    rows = [(i, (draw.normal(0, 0.05, 16) + (1 if i % 2 else -1)).astype(np.float32).tolist(), i % 3) for i in range(600)]
    read = []
    monkeypatch.setattr(zone_negatives, "BLOCK", 16)
    table = made(spark, rows)
    real = zone_negatives._read

    def counted(blocks, shared_anchors, dimension, positives, k):
        lower, chosen = blocks.select(*zone_negatives.ZONE), zone_negatives._chosen(shared_anchors, dimension, positives)
        read.append((lower.mapInArrow(chosen, "block bigint, readers bigint").count(), blocks.count()))
        return real(blocks, shared_anchors, dimension, positives, k)

    monkeypatch.setattr(zone_negatives, "_read", counted)
    got = zone_negatives.mine(table.where("vec_id % 2 = 0 OR vec_id % 50 <> 0"), every=50)
    kept = [r for r in rows if r[0] % 2 == 0 or r[0] % 50]
    assert sorted(map(tuple, got.collect()), key=str) == hard(kept)
    assert all(chosen < 0.6 * every for chosen, every in read), read


def test_relabelled_anchors_of_the_query(spark, tmp_path):
    rows = [(i, [float(i % 5), 1.0], i % 10) for i in range(120)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_hard_negatives(spark, str(tmp_path)).where(F.col("anchor_id") == 0)
    expected = hard([(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows])
    assert sorted(map(tuple, got.collect()), key=str) == [r for r in expected if r[0] == 0]
