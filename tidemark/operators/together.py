"""Regression trees over subsets of one table's columns, grown together.

Trees that see all rows differ only in the columns that they may split. As long as they split alike, their nodes hold the
same rows, so a node is known by the range of bins it has in each column: its rows are counted once, for all trees that
reach it and all columns that these may split. A level of all trees takes one pass over the binned rows, in which every
task sends a table of counts for each node; the best splits are found node by node in Spark, and only they come to the
driver. What is shuffled follows nodes and tasks, not rows.

Splits are chosen as Spark's ``DecisionTreeRegressor`` chooses them: by variance, at most ``maxBins`` bins of about equal
numbers of rows in each column, the first column and split of equal gain. Its bins come from a sample of some ten thousand
rows; here they come from all rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import ranked
from tidemark.operators.packed import PackedTrees
from tidemark.operators.sizes import ROWS_PER_TASK, small_side
from tidemark.session import cut_lineage

#: What the trees can be told, with the values that Spark takes.
DEFAULTS = {"maxDepth": 5, "minInstancesPerNode": 1, "maxBins": 32, "minInfoGain": 0.0}
#: A node whose variance is smaller is not split.
EPSILON = 2.0**-52
#: Numbers in the tables of counts that a task holds at once.
CELLS = 8_000_000

Region = tuple[tuple[int, int], ...]


class GrownTree(Model, HasFeaturesCol, HasPredictionCol):
    """One of the trees, as a model: the prediction is the mean label of the leaf."""

    def __init__(self, tree: PackedTrees):
        super().__init__()
        self.tree = tree

    def _transform(self, dataset: DataFrame) -> DataFrame:
        tree = self.tree

        @F.pandas_udf("double")
        def leaf(rows: pd.Series) -> pd.Series:
            return pd.Series(tree.values(np.stack(rows.to_numpy()))[:, 0] if len(rows) else [], dtype=float)

        return dataset.withColumn(self.getOrDefault("predictionCol"), leaf(vector_to_array(F.col(self.getFeaturesCol()))))


# --- bins ----------------------------------------------------------------------------------------------------------


def thresholds(df: DataFrame, columns: Sequence[str], max_bins: int, rows_per_task: int = ROWS_PER_TASK) -> list[np.ndarray]:
    """Where each column may be split: between all its values, if they are few, else where equal shares of the rows end.

    A share ends before the value that would take it further from its number of rows; a value with the rows of several
    shares leaves their ends to the values after it. So only values next to the ends of shares are looked at.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)])
    counts = cut_lineage(df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    if not counts.where("value is null or isnan(value)").isEmpty():
        raise ValueError("fill missing values before training")
    total = counts.where("column = 0").agg(F.sum("n")).first()[0]
    if not total:
        raise ValueError("no rows to train on")
    most = min(max_bins, total) - 1
    stride = total / (most + 1)
    ends = F.ceil((F.col("_upto") - F.col("n") / 2) / F.lit(stride)).alias("_ends")  # of shares before the value's middle
    placed = cut_lineage(ranked(counts, ["column"], ["value"], position="_p", running={"_upto": F.col("n")}, rows_per_task=rows_per_task))
    firsts = placed.groupBy("column", ends).agg(F.min("_p").alias("_first"))
    near = F.explode(F.sequence(F.col("_first") - 2, F.col("_first") + (most + 2)))
    looked_at = small_side(firsts.select("column", near.alias("_p")).distinct())
    rows = placed.join(looked_at, ["column", "_p"]).select("column", "_p", "value", "n", "_upto").collect()
    largest = {r["column"]: r["p"] for r in placed.groupBy("column").agg(F.max("_p").alias("p")).collect()}
    own = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r["column"], r["_p"])):
        own[row["column"]].append(row)
    cuts = []
    for i in range(len(columns)):
        between, target, few = [], stride, largest[i] - 1 <= most
        for before, row in zip(own[i], own[i][1:]):
            upto, last = row["_upto"], row["_upto"] - row["n"]
            if row["_p"] == before["_p"] + 1 and (few or abs(last - target) < abs(upto - target)):
                between.append((before["value"] + row["value"]) / 2.0)
                target += stride
        cuts.append(np.array(between, float))
    return cuts


def binned(df: DataFrame, columns: Sequence[str], label: str, cuts: Sequence[np.ndarray]) -> DataFrame:
    """(x, y), stored: the bins of a row as bytes, and its label, dealt evenly to as many tasks as there are cores."""
    kind = _kind(cuts)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.empty((len(batch), len(cuts)), kind)
            for i, own in enumerate(cuts):
                bins[:, i] = np.searchsorted(own, batch.column(i).to_numpy(zero_copy_only=False), "left")
            x = pa.array([row.tobytes() for row in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([x, batch.column(len(cuts))], ["x", "y"])

    rows = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)], F.col(label).cast("double").alias("y"))
    return cut_lineage(rows.mapInArrow(task, "x binary, y double").repartition(df.sparkSession.sparkContext.defaultParallelism))


def _kind(cuts: Sequence[np.ndarray]) -> type:
    return np.uint8 if max(map(len, cuts), default=0) < 256 else np.uint16


# --- counting ------------------------------------------------------------------------------------------------------


def _walk(paths: Mapping[int, Sequence[tuple[int, int, bool]]]) -> dict:
    """Paths (column, last bin to the left, whether left) to numbered nodes, as a tree: common beginnings are walked once."""
    top: dict = {"end": None, "next": {}}
    for number, path in paths.items():
        at = top
        for column, cut, left in path:
            at = at["next"].setdefault((column, cut), {}).setdefault(left, {"end": None, "next": {}})
        at["end"] = number
    return top


def _counting(shared, width: int, bins: int, kind: type):
    """Rows (x, y) to rows (node, sums): of each node, the number, sum and sum of squares of labels by column and bin."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, columns = shared.value
        held = {n: np.zeros((3, len(c) * bins)) for n, c in columns.items()}

        def visit(at: dict, rows: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
            number = at["end"]
            if number is not None:
                own = columns[number]
                places = np.arange(len(own)) * bins
                size = len(own) * bins
                sums = held[number]
                sums[0] += np.bincount((x[np.ix_(rows, own)] + places).ravel(), minlength=size)
                some = rows[y[rows] != 0]
                if len(some):
                    codes, labels = (x[np.ix_(some, own)] + places).ravel(), np.repeat(y[some], len(own))
                    sums[1] += np.bincount(codes, labels, size)
                    sums[2] += np.bincount(codes, labels * labels, size)
            for (column, cut), sides in at["next"].items():
                left = x[rows, column] <= cut
                for side, child in sides.items():
                    own = rows[left if side else ~left]
                    if len(own):
                        visit(child, own, x, y)

        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind).reshape(len(y), width).astype(np.intp)
            visit(top, np.arange(len(y)), x, y)
        for number, sums in held.items():
            if sums[0].any():
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([sums.ravel()], pa.list_(pa.float64()))], ["node", "sums"])

    return task


def _variance(n, s, q):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, 0.0, (q - s * s / n) / n)


def _best(shared, bins: int, min_rows: int, min_gain: float):
    """The best split of a node by each of its columns; a gain of -inf where there is none."""

    def best(key: tuple, tables: pd.DataFrame) -> pd.DataFrame:
        (number,), out = key, []
        _, columns = shared.value
        own = columns[number]
        sums = np.sum([np.asarray(t) for t in tables["sums"]], axis=0).reshape(3, len(own), bins)
        for i, column in enumerate(own):
            left = np.cumsum(sums[:, i], axis=1)
            total = left[:, -1:]
            right = total - left
            ln, rn = left[0], right[0]
            n = total[0, 0]
            gain = _variance(*total) - ln / n * _variance(*left) - rn / n * _variance(*right)
            valid = (ln >= max(1, min_rows)) & (rn >= max(1, min_rows)) & (gain >= min_gain)
            gain = np.where(valid, gain, -np.inf)
            at = int(np.argmax(gain))
            out.append((int(number), int(column), float(gain[at]), at, *map(float, left[:, at]), *map(float, right[:, at])))
        return pd.DataFrame(out, columns=[c.split()[0] for c in SPLIT.split(", ")])

    return best


SPLIT = "node long, column long, gain double, cut long, ln double, ls double, lq double, rn double, rs double, rq double"


def _splits(table: DataFrame, wanted: Mapping[Region, tuple[Sequence[tuple[int, int, bool]], Sequence[int]]], width: int, bins: int, kind: type, options) -> dict:
    """(region, column): best split, of all regions and columns that are wanted, from one pass for each part of them."""
    spark, found, regions = table.sparkSession, {}, list(wanted)
    start = 0
    while start < len(regions):
        end, cells = start, 0
        while end < len(regions) and (end == start or cells + 3 * bins * len(wanted[regions[end]][1]) <= CELLS):
            cells += 3 * bins * len(wanted[regions[end]][1])
            end += 1
        part = dict(enumerate(regions[start:end]))
        sent = (_walk({i: wanted[r][0] for i, r in part.items()}), {i: np.array(wanted[r][1]) for i, r in part.items()})
        shared = spark.sparkContext.broadcast(sent)
        counted = table.mapInArrow(_counting(shared, width, bins, kind), "node long, sums array<double>")
        best = counted.groupBy("node").applyInPandas(_best(shared, bins, options["minInstancesPerNode"], options["minInfoGain"]), SPLIT)
        for row in best.collect():
            found[part[row["node"]], row["column"]] = row
        start = end
    return found


# --- growing -------------------------------------------------------------------------------------------------------


def _children(region: Region, split) -> list[tuple[Region, tuple[int, int, bool], tuple[float, float, float]]]:
    column, cut = split["column"], split["cut"]
    low, high = region[column]
    out = []
    for left, own, name in ((True, (low, cut), "l"), (False, (cut + 1, high), "r")):
        out.append((region[:column] + (own,) + region[column + 1 :], (column, cut, left), (split[f"{name}n"], split[f"{name}s"], split[f"{name}q"])))
    return out


def grow(df: DataFrame, columns: Sequence[str], subsets: Sequence[Sequence[str]], label: str = "target", **params) -> list[GrownTree]:
    """A tree for each subset of the columns, in order; ``params`` as in ``DEFAULTS``.

    The driver holds the nodes of all trees.
    """
    options = {**DEFAULTS, **params}
    place = {c: i for i, c in enumerate(columns)}
    own = [sorted(place[c] for c in names) for names in subsets]
    cuts = thresholds(df, columns, options["maxBins"])
    bins, kind = max(map(len, cuts)) + 1, _kind(cuts)
    table = binned(df, columns, label, cuts)
    top: Region = tuple((0, len(c)) for c in cuts)
    *sums, known_labels = table.agg(F.count(F.lit(1)).cast("double"), F.sum("y"), F.sum(F.col("y") * F.col("y")), F.count(F.nanvl("y", F.lit(None)))).first()
    if known_labels < sums[0]:
        raise ValueError("leave rows without a label out before training")
    # Of each tree the nodes of the level that may be split, by their place in the tree's list (region, sums, split, children).
    trees: list[list[list]] = [[[top, tuple(sums), None, None]] for _ in own]
    level = [[0] if options["maxDepth"] > 0 else [] for _ in own]
    known: dict = {}
    paths: dict[Region, tuple] = {top: ()}
    for depth in range(options["maxDepth"]):
        columns_of: dict[Region, set[int]] = defaultdict(set)
        for t, places in enumerate(level):
            for at in places:
                columns_of[trees[t][at][0]].update(c for c in own[t] if len(cuts[c]))
        wanted = {r: (paths[r], sorted(c for c in some if (r, c) not in known)) for r, some in columns_of.items()}
        known |= _splits(table, {r: w for r, w in wanted.items() if w[1]}, len(cuts), bins, kind, options)
        for t, places in enumerate(level):
            after = []
            for at in places:
                region = trees[t][at][0]
                tried = [known[region, c] for c in own[t] if len(cuts[c])]
                split = max(tried, key=lambda s: s["gain"], default=None)  # the first of equals
                if split is None or split["gain"] <= 0:
                    continue
                trees[t][at][2:] = [split, len(trees[t])]
                for child, step, of in _children(region, split):
                    paths.setdefault(child, (*paths[region], step))
                    if depth + 1 < options["maxDepth"] and abs(float(_variance(*map(np.float64, of)))) >= EPSILON:
                        after.append(len(trees[t]))
                    trees[t].append([child, of, None, None])
            level[t] = after
    return [GrownTree(_arrays(nodes, [columns[c] for c in mine], mine, cuts)) for nodes, mine in zip(trees, own)]


def _arrays(nodes: Sequence[Sequence], names: Sequence[str], own: Sequence[int], cuts: Sequence[np.ndarray]) -> PackedTrees:
    """A tree over its own columns."""
    place = {c: i for i, c in enumerate(own)}
    splits = [n[2] for n in nodes]
    return PackedTrees(
        tuple(names),
        np.array([-1 if s is None else place[s["column"]] for s in splits], np.int32),
        np.array([0.0 if s is None else cuts[s["column"]][s["cut"]] for s in splits]),
        np.array([-1 if n[3] is None else n[3] for n in nodes], np.int32),
        np.array([-1 if n[3] is None else n[3] + 1 for n in nodes], np.int32),
        np.array([n[1][1] / n[1][0] for n in nodes]),
        np.zeros(1, np.int64),
        np.ones(1),
        np.zeros(1, np.int64),
    )


def joined(trees: Mapping[int, PackedTrees], columns: Sequence[str]) -> PackedTrees:
    """Single trees over some of the columns, by number, as arrays over ``columns``."""
    place = {c: i for i, c in enumerate(columns)}
    base = np.cumsum([0, *[len(t.feature) for t in trees.values()]])
    parts = list(zip(trees.values(), base))

    def every(make) -> np.ndarray:
        return np.concatenate([make(t, b) for t, b in parts])

    def moved(name: str) -> np.ndarray:
        return every(lambda t, b: np.where(getattr(t, name) < 0, -1, getattr(t, name) + b)).astype(np.int32)

    feature = every(lambda t, b: np.where(t.feature < 0, -1, np.array([place[c] for c in t.columns])[t.feature])).astype(np.int32)
    numbers = np.array(list(trees))
    return PackedTrees(
        tuple(columns), feature, every(lambda t, b: t.threshold), moved("left"), moved("right"), every(lambda t, b: t.value),
        base[:-1], np.ones(len(numbers)), numbers,
    )
