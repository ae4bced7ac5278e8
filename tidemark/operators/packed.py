"""Many trees as flat arrays: scored in one pass over the rows, tree by tree, however many there are.

A model of Spark ML adds a step to the plan that scores with it; some hundred of them make a plan that no optimiser
survives. Here the nodes of all trees are read from the saved models into arrays (feature, threshold, children, value), which
are sent to the tasks, and a batch of rows walks down all trees at once, a level at a time.

The arrays grow with the models and not with the rows. Trees are sent in parts of at most ``PART_NODES`` nodes; with several
parts, the rows are scored in as many passes, each of which adds its trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.fits import concurrently
from tidemark.session import shared_folder
from tidemark.sources.tables import path_exists

#: Nodes that are sent at once, 28 bytes each.
PART_NODES = 1_000_000
#: Rows times trees that a task looks at together.
CELLS = 1_000_000


@dataclass(frozen=True)
class PackedTrees:
    """Nodes of trees of one or several models, in the order of the models.

    feature is -1 at a leaf; left and right are places in these arrays; value is the probability of class 1 at a leaf, or
    what a boosted tree adds; roots and weights have an entry for each tree, models the model of each tree. ``boosted``:
    the weighted sum is a margin, whose logistic function is the probability, else it is the probability itself.
    """

    columns: tuple[str, ...]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    models: np.ndarray
    boosted: bool = False

    @property
    def trees(self) -> int:
        return len(self.roots)

    def first(self, trees: int) -> PackedTrees:
        """The model cut to its first trees. A boosted model is as if it had been trained for so many rounds."""
        return replace(self, roots=self.roots[:trees], weights=self.weights[:trees], models=self.models[:trees])

    def parts(self, nodes: int = PART_NODES) -> list[PackedTrees]:
        """The same trees in parts of at most ``nodes`` nodes (a larger tree is a part of its own)."""
        starts = np.unique(self.roots)  # trees may share their nodes
        ends = np.append(starts, len(self.feature))[np.searchsorted(starts, self.roots) + 1] if self.trees else self.roots
        out, start = [], 0
        for i in range(self.trees):
            if i + 1 == self.trees or ends[i + 1] - self.roots[start] > nodes:  # roots are in order
                low, high = self.roots[start], ends[i]
                cut = slice(start, i + 1)
                arrays = {n: getattr(self, n)[low:high] for n in ("feature", "threshold", "value")}
                children = {n: np.maximum(getattr(self, n)[low:high] - low, -1) for n in ("left", "right")}
                out.append(replace(self, **arrays, **children, roots=self.roots[cut] - low, weights=self.weights[cut], models=self.models[cut]))
                start = i + 1
        return out

    def values(self, x: np.ndarray) -> np.ndarray:
        """The value of the leaf that each row of ``x`` reaches in each tree."""
        at = np.broadcast_to(self.roots, (len(x), self.trees)).copy()
        rows = np.arange(len(x))[:, None]
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return self.value[at]
            left = x[rows, np.maximum(feature, 0)] <= self.threshold[at]
            at = np.where(inner, np.where(left, self.left[at], self.right[at]), at)


def node_rows(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """The nodes of saved tree models: (folder's name, tree, id, feature, threshold, children, stats, prediction).

    Single trees and ensembles are stored in two ways, so each kind is read for itself.
    """
    ensembles = [f for f in folders if path_exists(spark, f"{f}/treesMetadata")]
    singles = [f for f in folders if f not in set(ensembles)]
    tables = []
    for own in filter(None, (ensembles, singles)):
        data = spark.read.parquet(*[f"{f}/data" for f in own])
        node = F.col("nodeData") if own is ensembles else F.struct(*data.columns)
        tree = F.col("treeID") if own is ensembles else F.lit(0)
        name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/data/[^/]*$", 1)
        tables.append(data.select(name.alias("name"), tree.alias("tree"), node.alias("n")))
    return reduce(DataFrame.unionByName, tables).select(
        "name",
        "tree",
        F.col("n.id").alias("id"),
        F.col("n.split.featureIndex").alias("feature"),
        F.get(F.col("n.split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
        (F.col("n.split.numCategories") >= 0).alias("categorical"),
        F.col("n.leftChild").alias("left"),
        F.col("n.rightChild").alias("right"),
        F.col("n.impurityStats").alias("stats"),
        F.col("n.prediction").alias("prediction"),
    )


def pack(
    spark: SparkSession,
    models: Mapping[int, Model],
    columns: Sequence[str],
    *,
    own_columns: Mapping[int, Sequence[str]] | None = None,
    folder: str | None = None,
    threads: int = 8,
) -> PackedTrees:
    """Trees, forests, or one boosted model, by number, as arrays over ``columns``.

    The models are saved below ``folder`` (a new folder in the shared one by default) and their nodes read together.
    ``own_columns`` names the features of models that were fitted on other columns than all.
    """
    import uuid

    folder = folder or f"{shared_folder(spark)}/packed-{uuid.uuid4().hex}"
    boosted = any(isinstance(m, GBTClassificationModel) for m in models.values())
    if boosted and len(models) > 1:
        raise ValueError("pack boosted models one by one")
    paths = {n: f"{folder.rstrip('/')}/model-{n}" for n in models}
    concurrently([lambda n=n: models[n].write().overwrite().save(paths[n]) for n in models], threads, spark)
    return read_packed(spark, paths, columns, own_columns=own_columns, weights=list(models[next(iter(models))].treeWeights) if boosted else None)


def read_packed(
    spark: SparkSession,
    paths: Mapping[int, str],
    columns: Sequence[str],
    *,
    own_columns: Mapping[int, Sequence[str]] | None = None,
    weights: Sequence[float] | None = None,
) -> PackedTrees:
    """Saved models, all of them classifiers or none, as arrays; ``weights`` are those of a boosted model's trees."""
    names = {p.rstrip("/").rsplit("/", 1)[1]: n for n, p in paths.items()}
    if len(names) < len(paths):
        raise ValueError("the folders of the models need different names")
    kind = spark.read.text(f"{next(iter(paths.values()))}/metadata").first()[0]  # a line of JSON that names the class
    classes = weights is None and "ClassificationModel" in kind
    table = node_rows(spark, list(paths.values())).toPandas()
    if table["categorical"].any():
        raise ValueError("splits on categories can't be packed")
    table["model"] = table["name"].map(names)
    table = table.sort_values(["model", "tree", "id"], kind="stable").reset_index(drop=True)
    first = (table[["model", "tree"]].ne(table[["model", "tree"]].shift())).any(axis=1).to_numpy()
    roots = np.flatnonzero(first)
    base = roots[np.cumsum(first) - 1]  # ids count the nodes of a tree in order
    model = table["model"].to_numpy()[roots]
    feature = table["feature"].to_numpy(np.int64)
    inner = table["left"].to_numpy() >= 0
    if own_columns is not None:
        place = {c: i for i, c in enumerate(columns)}
        for n, own in own_columns.items():
            rows = inner & (table["model"].to_numpy() == n)
            feature[rows] = np.array([place[c] for c in own])[feature[rows]]
    if classes:
        value = np.array([s[1] / sum(s) if len(s) > 1 and sum(s) else 0.0 for s in table["stats"]])
    else:
        value = table["prediction"].to_numpy(float)
    per_model = dict(zip(*np.unique(model, return_counts=True)))
    share = np.array([1.0 / per_model[m] for m in model]) if weights is None else np.array(weights, float)
    children = {n: np.where(inner, table[n].to_numpy() + base, -1).astype(np.int32) for n in ("left", "right")}
    return PackedTrees(
        tuple(columns),
        np.where(inner, feature, -1).astype(np.int32),
        table["threshold"].fillna(0.0).to_numpy(float),
        children["left"],
        children["right"],
        value,
        roots,
        share,
        model,
        weights is not None,
    )


def _sums(shared, keep: int, models: Sequence[int], staged: bool, carried: bool):
    """Of rows (kept columns, features, perhaps sums so far): adds the trees of a part to each model's sum, or stage by stage."""
    place = {m: i for i, m in enumerate(models)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: PackedTrees = shared.value
        owner = np.array([place[m] for m in part.models])
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        width = len(part.columns)
        step = max(1, CELLS // max(1, part.trees))
        for batch in batches:
            for i in range(0, len(batch), step):
                rows = batch.slice(i, step)
                features = [rows.column(keep + j) for j in range(width)]
                if any(c.null_count for c in features):
                    raise ValueError("fill missing values before scoring")
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in features])
                each = part.values(x) * part.weights
                before = rows.column(keep + width).to_pylist() if carried else None
                if staged:
                    stages = np.cumsum(each, axis=1)
                    if before:
                        stages = np.concatenate([np.array(before), stages + np.array(before)[:, -1:]], axis=1)
                    sums = stages
                else:
                    sums = np.array(before) if before else np.zeros((len(rows), len(models)))
                    sums[:, owner[starts]] += np.add.reduceat(each, starts, axis=1)
                offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * sums.shape[1])
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(sums).ravel()))
                columns = [rows.column(j) for j in range(keep + width)] + [lists]
                yield pa.RecordBatch.from_arrays(columns, [*rows.schema.names[: keep + width], "_sums"])

    return task


def _scored(packed: PackedTrees, df: DataFrame, keep: Sequence[str], staged: bool, nodes: int) -> tuple[DataFrame, list[int]]:
    models = list(dict.fromkeys(packed.models.tolist()))
    features = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(packed.columns)]
    rows = df.select(*keep, *features)
    schema = T.StructType([*rows.schema.fields, T.StructField("_sums", T.ArrayType(T.DoubleType()))])
    spark = df.sparkSession
    for i, part in enumerate(packed.parts(nodes)):
        task = _sums(spark.sparkContext.broadcast(part), len(keep), models, staged, i > 0)
        rows = rows.mapInArrow(task, schema)
    if not packed.trees:
        rows = rows.withColumn("_sums", F.array().cast("array<double>"))
    return rows.select(*keep, "_sums"), models


def _probability(packed: PackedTrees, total):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total)) if packed.boosted else total


def score_rows(packed: PackedTrees, df: DataFrame, keep: Sequence[str], name: str = "probs", nodes: int = PART_NODES) -> DataFrame:
    """The probabilities of all models as an array, in the order of the models; a row for each row."""
    rows, _ = _scored(packed, df, keep, False, nodes)
    return rows.select(*keep, F.transform("_sums", lambda x: _probability(packed, x)).alias(name))


def score_packed(packed: PackedTrees, df: DataFrame, keep: Sequence[str], nodes: int = PART_NODES) -> DataFrame:
    """(keep, model, prob): a row for each row and model, from one pass over the rows for each part of the trees."""
    rows, models = _scored(packed, df, keep, False, nodes)
    long = rows.select(*keep, F.posexplode("_sums").alias("_place", "_sum"))
    model = F.get(F.array(*[F.lit(m) for m in models]), F.col("_place"))
    return long.select(*keep, model.alias("model"), _probability(packed, F.col("_sum")).alias("prob"))


def mean_packed(packed: PackedTrees, df: DataFrame, keep: Sequence[str], name: str = "prob", nodes: int = PART_NODES) -> DataFrame:
    """The mean probability of all models, a row for each row; nothing is shuffled."""
    rows, models = _scored(packed, df, keep, False, nodes)
    total = F.aggregate("_sums", F.lit(0.0), lambda a, x: a + _probability(packed, x))
    return rows.select(*keep, (total / F.lit(float(max(1, len(models))))).alias(name))


def staged_scores(packed: PackedTrees, df: DataFrame, keep: Sequence[str], name: str = "stages", nodes: int = PART_NODES) -> DataFrame:
    """The probability after the first 1, 2, … trees of one model, as an array; a row for each row."""
    if len(set(packed.models.tolist())) > 1:
        raise ValueError("stages are those of one model")
    rows, _ = _scored(packed, df, keep, True, nodes)
    share = 1.0 if packed.boosted or not packed.trees else float(packed.weights[0])
    stages = F.transform("_sums", lambda x, i: _probability(packed, x if packed.boosted else x / (F.lit(share) * (i + 1))))
    return rows.select(*keep, stages.alias(name))
