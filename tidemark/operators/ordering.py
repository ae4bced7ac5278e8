"""Positions, running totals, ranks and quantiles inside ordered groups of any size.

A plain window sends each group to one task. A month of a large panel, or the whole score table, does not fit
there. ``ranked`` therefore works in two levels once the largest group is above ``rows_per_task`` (it is counted):

1. the rows are stored once, and all later steps read the columns that they need from there;
2. the order keys of a repeatable sample give split points over (group, order), so a large group gets many
   buckets and one hot value is cut by the tie-break columns;
3. counts and sums per (group, bucket) are added up over the few buckets, which gives the offset of each bucket;
4. a window inside (group, bucket) gives the local position, and the offset makes it global.

The input is computed twice, for the sizes and for the stored rows, and the rows are shuffled once, by (group, bucket).
The bucket depends only on the row's values, so a lost executor or a second evaluation cannot change it.

The number of split points follows the number of rows, so buckets stay as small however large the input is. The sample is
ranked by the same operator. Up to ``LITERAL_SPLITS`` split points are part of the plan; of more, every n-th is, and the
ones between are joined to the rows by the number of the gap.
"""

from __future__ import annotations

import datetime
import json
import math
from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.sizes import ROWS_PER_TASK, SMALL_ROWS, GroupSizes, group_sizes, small_side
from tidemark.session import cut_lineage

SAMPLE_PER_SPLIT = 30
#: Split points that are written into the plan and searched there; the ones between them are joined.
LITERAL_SPLITS = 4_096
#: So many split points are sent to all tasks at most; the gaps of more are joined by a shuffle, all of like size.
SENT_SPLITS = 500_000
#: A sample with at most so many rows is ranked by one task.
SAMPLE_ROWS = 100_000


def _name(key: str) -> str:
    return key.lstrip("-")


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``["-prob", "cust"]`` as sort columns: minus means descending, NULL is last either way."""
    return [
        F.col(_name(key)).desc_nulls_last() if key.startswith("-") else F.col(key).asc_nulls_last() for key in order
    ]


def _before(left: Column, right: Column, descending: bool) -> Column:
    strict = left > right if descending else left < right
    return F.when(left.isNull(), False).when(right.isNull(), True).otherwise(strict)


def _not_after(split: Column, order: Sequence[str]) -> Column:
    """Whether a split point sorts before the row or equal to it."""
    result: Column = F.lit(True)
    for key in reversed(order):
        left, right = split[_name(key)], F.col(_name(key))
        result = _before(left, right, key.startswith("-")) | (left.eqNullSafe(right) & result)
    return result


def _plain(value: object) -> object:
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return str(value)
    return value


def _split_points(df: DataFrame, order: Sequence[str], total: int, n_splits: int, rows_per_task: int) -> tuple[DataFrame, int]:
    """Stored split points (_place from 1, _cut) and their number. The sample only places the cuts; every row is in the result."""
    names = [_name(key) for key in order]
    every = max(1, total // (SAMPLE_PER_SPLIT * n_splits))
    sample = df.select(*names).where(F.pmod(F.xxhash64(*names), F.lit(every)) == 0)
    sample = cut_lineage(sample.distinct())  # rows with equal keys share a hash, and a cut can't part them anyway
    rows = sample.count()
    step = max(1, rows // (n_splits + 1))
    placed = ranked(sample, [], order, position="_place", sizes=GroupSizes(rows, 1, rows), rows_per_task=max(rows_per_task, SAMPLE_ROWS))
    cuts = placed.where((F.col("_place") - 1) % step == 0).where(F.col("_place") > 1)
    cuts = cuts.select(F.floor((F.col("_place") - 1) / step).alias("_place"), F.struct(*names).alias("_cut"))
    return cut_lineage(cuts), max(0, (rows - 1) // step)


def _literal(cuts: DataFrame) -> tuple[Column, int]:
    """A bounded number of split points, in order, as an array in the plan."""
    kind = cuts.schema["_cut"].dataType
    points = [{n: _plain(row["_cut"][n]) for n in kind.names} for row in cuts.orderBy("_place").collect()]
    schema = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in kind.fields]))
    return F.from_json(F.lit(json.dumps(points)), schema), len(points)


def _cut_by(df: DataFrame, order: Sequence[str], cuts: DataFrame, n_cuts: int) -> DataFrame:
    """Adds ``_b``, the number of split points not after the row, and the split points next to it, ``_below`` and ``_above``."""
    if n_cuts <= LITERAL_SPLITS:
        splits, n = _literal(cuts)
        df = df.withColumn("_b", _bucket(splits, n, order))
        return df.withColumns({"_below": F.when(F.col("_b") > 0, F.get(splits, F.col("_b") - 1)), "_above": F.get(splits, F.col("_b"))})
    gap = -(-n_cuts // LITERAL_SPLITS)
    splits, n = _literal(cuts.where(F.col("_place") % gap == 0))
    place = F.col("_place")
    # A cut at the edge of two gaps belongs to both, so each row finds its neighbours in its own gap.
    gaps = F.when(place % gap == 0, F.array(place / gap - 1, place / gap)).otherwise(F.array(F.floor(place / gap).cast("double")))
    fine = cuts.withColumn("_gap", F.explode(gaps.cast("array<int>")))
    fine = fine.groupBy("_gap").agg(F.sort_array(F.collect_list(F.struct("_place", "_cut"))).alias("_fine"))  # gap + 1 at most
    fine = fine.select(F.col("_gap").alias("_own"), (F.col("_fine")[0]["_place"] - 1).alias("_first"), F.transform("_fine", lambda x: x["_cut"]).alias("_fine"))
    df = df.withColumn("_gap", _bucket(splits, n, order))
    df = df.join(F.broadcast(fine) if n_cuts <= SENT_SPLITS else fine, F.col("_gap") == F.col("_own"))
    df = df.withColumn("_at", _bucket(F.col("_fine"), gap + 1, order, F.size("_fine")))
    df = df.withColumns({"_b": F.col("_first") + F.col("_at"), "_below": F.when(F.col("_at") > 0, F.get("_fine", F.col("_at") - 1)), "_above": F.get("_fine", F.col("_at"))})
    return df.drop("_gap", "_own", "_first", "_fine", "_at")


def _bucket(splits: Column, n_splits: int, order: Sequence[str], size: Column | None = None) -> Column:
    """Number of split points not after the row, found by halving; ``size`` of them, ``n_splits`` at most."""
    if n_splits == 0:
        return F.lit(0)

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        right = (state["lo"] < state["hi"]) & F.coalesce(_not_after(F.get(splits, middle), order), F.lit(False))
        return F.struct(
            F.when(right, middle + 1).otherwise(state["lo"]).alias("lo"),
            F.when(right, state["hi"]).otherwise(middle).alias("hi"),
        )

    steps = math.ceil(math.log2(n_splits + 1))
    start = F.struct(F.lit(0).alias("lo"), (F.lit(n_splits) if size is None else size).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda state: state["lo"])


def _same(columns: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns], F.lit(True))


def ranked(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    *,
    position: str = "position",
    running: Mapping[str, Column] | None = None,
    group_rows: str | None = None,
    ties: tuple[str, str] | None = None,
    sizes: GroupSizes | None = None,
    uniform: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the 1-based position of each row inside its group.

    ``order`` should end in columns that make it total, so the result does not depend on the row order of the input.
    ``running`` maps a new column to the expression summed from the group's start to the row. ``group_rows`` names a
    column for the size of the group. ``ties`` names two columns for the first and last position of the rows that are
    equal in the first order column. ``uniform`` says that the first order column is a uniform draw in [0, 1): its
    buckets are then known without a sample.
    """
    by, running = list(by), dict(running or {})
    sizes = sizes or group_sizes(df, by)
    if sizes.largest <= rows_per_task:
        return _ranked_plain(df, by, order, position, running, group_rows, ties)
    return _ranked_split(df, by, order, position, running, group_rows, ties, sizes, uniform, rows_per_task)


def _ranked_plain(df, by, order, position, running, group_rows, ties):
    ordered = Window.partitionBy(*by).orderBy(*sort_columns(order))
    up_to_row = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = [F.row_number().over(ordered).cast("long").alias(position)]
    new += [F.sum(F.coalesce(expr, F.lit(0))).over(up_to_row).alias(name) for name, expr in running.items()]
    if group_rows:
        new.append(F.count(F.lit(1)).over(Window.partitionBy(*by)).alias(group_rows))
    if ties:
        value = order[0]
        first = F.rank().over(Window.partitionBy(*by).orderBy(*sort_columns([value]))).cast("long")
        equal = F.count(F.lit(1)).over(Window.partitionBy(*by, _name(value)))
        new += [first.alias(ties[0]), (first + equal - 1).alias(ties[1])]
    return df.select("*", *new)


def _ranked_split(df, by, order, position, running, group_rows, ties, sizes, uniform, rows_per_task):
    full_order = [*by, *order]
    value = _name(order[0])
    n_splits = math.ceil(2 * sizes.total / rows_per_task)
    kept = cut_lineage(df.select("*", *[F.coalesce(expr, F.lit(0)).alias(f"_x_{name}") for name, expr in running.items()]))
    if uniform and not ties:
        keyed, n_buckets = kept.withColumn("_b", F.floor(F.col(value) * n_splits).cast("int")), n_splits * sizes.groups
    else:
        cuts, n_splits = _split_points(kept, full_order, sizes.total, n_splits, rows_per_task)
        keyed, n_buckets = _cut_by(kept, full_order, cuts, n_splits), n_splits + sizes.groups
    if ties:
        keyed = keyed.withColumns({"_lo": _equals_cut("_below", by, value), "_hi": _equals_cut("_above", by, value)})

    measures = [F.count(F.lit(1)).alias("_n")]
    measures += [F.sum(f"_x_{name}").alias(f"_s_{name}") for name in running]
    if ties:
        measures += [F.count_if("_lo").alias("_n_lo"), F.count_if("_hi").alias("_n_hi")]
        measures += [F.any_value(F.col(c)[value]).alias(n) for c, n in (("_below", "_v_lo"), ("_above", "_v_hi"))]  # one in a bucket
    parts = keyed.groupBy(*by, "_b").agg(*measures)

    earlier = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *by,
        "_b",
        "_n",
        *(["_n_lo", "_n_hi", "_v_lo", "_v_hi"] if ties else []),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_rows"),
        *[F.coalesce(F.sum(f"_s_{name}").over(earlier), F.lit(0)).alias(f"_o_{name}") for name in running],
    )
    if ties:
        offsets = _with_runs(offsets, by)
    offsets = offsets.drop("_n").withColumnsRenamed({**{c: f"_g_{c}" for c in by}, "_b": "_g__b"})
    side = small_side(offsets) if n_buckets <= SMALL_ROWS else offsets
    joined = keyed.join(side, _same([*by, "_b"], "_g_"))

    local = Window.partitionBy(*by, "_b").orderBy(*sort_columns(order))
    up_to_row = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = [(F.col("_offset") + F.row_number().over(local)).cast("long").alias(position)]
    for name in running:
        new.append((F.col(f"_o_{name}") + F.sum(f"_x_{name}").over(up_to_row)).alias(name))
    if group_rows:
        new.append(F.col("_rows").alias(group_rows))
    if ties:
        first = F.col("_offset") + F.rank().over(Window.partitionBy(*by, "_b").orderBy(*sort_columns([order[0]])))
        equal = F.count(F.lit(1)).over(Window.partitionBy(*by, "_b", value))
        new += [
            F.when(F.col("_lo"), F.col("_lo_first")).when(F.col("_hi"), F.col("_hi_first")).otherwise(first).alias(ties[0]),
            F.when(F.col("_lo"), F.col("_lo_last"))
            .when(F.col("_hi"), F.col("_hi_last"))
            .otherwise(first + equal - 1)
            .alias(ties[1]),
        ]
    return joined.select(*[F.col(c) for c in df.columns], *new)


def _equals_cut(cut: str, by: Sequence[str], value: str) -> Column:
    """Whether the row equals the split point in group and value. Only such rows can have equal rows in another bucket."""
    same = [F.col(cut)[c].eqNullSafe(F.col(c)) for c in [*by, value]]
    return F.col(cut).isNotNull() & reduce(lambda a, b: a & b, same)


def _with_runs(marked: DataFrame, by: Sequence[str]) -> DataFrame:
    """First and last position of each run of equal values that touches a split point."""
    whole_bucket = (F.col("_n_lo") == F.col("_n")) & (F.col("_n_hi") == F.col("_n"))
    pieces = marked.where("_n_lo > 0").select(
        *by, F.col("_v_lo").alias("_v"), (F.col("_offset") + 1).alias("_start"), F.col("_n_lo").alias("_len")
    ).unionByName(
        marked.where((F.col("_n_hi") > 0) & ~whole_bucket).select(
            *by,
            F.col("_v_hi").alias("_v"),
            (F.col("_offset") + F.col("_n") - F.col("_n_hi") + 1).alias("_start"),
            F.col("_n_hi").alias("_len"),
        )
    )
    runs = pieces.groupBy(*by, "_v").agg(F.min("_start").alias("_first"), F.sum("_len").alias("_len"))
    for side in ("lo", "hi"):
        side_runs = runs.select(
            *[F.col(c).alias(f"_r_{c}") for c in by],
            F.col("_v").alias(f"_r__v_{side}"),
            F.col("_first").alias(f"_{side}_first"),
            (F.col("_first") + F.col("_len") - 1).alias(f"_{side}_last"),
        )
        found = _same([*by, f"_v_{side}"], "_r_") & (F.col(f"_n_{side}") > 0)
        marked = marked.join(side_runs, found, "left").drop(*[f"_r_{c}" for c in by], f"_r__v_{side}")
    return marked.drop("_v_lo", "_v_hi", "_n_lo", "_n_hi")


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    *,
    name: str = "quantiles",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Quantiles with linear interpolation per group, as one array column. NULL values are left out.

    The built-in ``percentile`` keeps all distinct values of a group in one task, so it serves only groups that were
    counted to fit. In larger groups equal values are counted first, so a hot value becomes one row; the counts are
    added up in order, and the values at the two places next to each quantile are read off.
    """
    by, probabilities = list(by), [float(p) for p in probabilities]
    known = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    sizes = group_sizes(known, by)
    if sizes.largest <= rows_per_task:
        return known.groupBy(*by).agg(F.percentile("_v", probabilities).alias(name))

    counted = cut_lineage(known.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n")))
    placed = ranked(counted, by, ["_v"], position="_p", running={"_end": F.col("_n")}, rows_per_task=rows_per_task)
    if by:
        totals = counted.groupBy(*by).agg(F.sum("_n").alias("_rows"))
        totals = totals.withColumnsRenamed({c: f"_g_{c}" for c in by})
        placed = placed.join(totals, _same(by, "_g_"))
    else:
        placed = placed.withColumn("_rows", F.lit(sizes.total))

    def spot(p: float) -> Column:
        return (F.col("_rows") - 1) * F.lit(p)

    def holds(place: Column) -> Column:
        return (F.col("_end") - F.col("_n") <= place) & (place < F.col("_end"))

    wanted = reduce(
        lambda a, b: a | b, [holds(F.floor(spot(p))) | holds(F.ceil(spot(p))) for p in probabilities]
    )

    def at(place: Column) -> Column:
        return F.max(F.when(holds(place), F.col("_v")))

    values = [
        at(F.floor(spot(p))) + (at(F.ceil(spot(p))) - at(F.floor(spot(p)))) * F.max(spot(p) - F.floor(spot(p)))
        for p in probabilities
    ]
    return placed.where(wanted).groupBy(*by).agg(F.array(*values).alias(name))


#: Bins of a round of ``top_cuts``; ranges with at most so many rows are not cut further.
TOP_BINS, EDGE_ROWS = 4_096, 100_000


def top_cuts(
    df: DataFrame, by: Sequence[str], score: str, key: Sequence[str], k: int, *, bins: int = TOP_BINS, edge_rows: int = EDGE_ROWS
) -> DataFrame | None:
    """(by, cut): score and key of the k-th row of each group by falling score and rising key, or of its last row.

    Rows are counted in bins between the least and the greatest score; the bin that holds the k-th row is cut into bins
    again, until it has few rows or one score. Only the rows of that bin are sorted, and of those only as many as are still
    to be taken. None where the scores are not all finite numbers: then there are no bins, and the rows must be ranked.
    """
    by = list(by)
    value = F.col(score).cast("double")
    rows = df.select(*dict.fromkeys([*by, *key]), F.col(score).alias("_s"), value.alias("_v"))
    finite = F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < float("inf"))
    edges = rows.groupBy(*by).agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count(F.lit(1)).alias("_n"), F.count_if(~F.coalesce(finite, F.lit(False))).alias("_odd")
    )
    edges = cut_lineage(edges.withColumn("_take", F.least(F.lit(k).cast("long"), F.col("_n"))))
    if not edges.where("_odd > 0").isEmpty():
        return None
    edges = edges.drop("_odd")

    def inside(edges: DataFrame) -> DataFrame:
        """The rows between the ends of their group's range, with what is known of it."""
        named = small_side(edges.select(*[F.col(c).alias(f"_g_{c}") for c in by], "_low", "_high", "_n", "_take"))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by]) if by else F.lit(True)
        return rows.join(named, same).where(F.col("_v").between(F.col("_low"), F.col("_high")))

    open_ = (F.col("_n") > edge_rows) & (F.col("_low") < F.col("_high"))
    while not edges.where(open_).isEmpty():
        wide = edges.where(open_)
        # Halves, since the whole width may be beyond all numbers.
        share = (F.col("_v") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
        placed = inside(wide).withColumn("_bin", F.least(F.floor(share * bins), F.lit(bins - 1)))
        counts = placed.groupBy(*by, "_take", "_bin").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        # At most one row per bin and group.
        above = Window.partitionBy(*by).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_n").over(above), F.lit(0))
        reached = counts.withColumn("_before", before).where((F.col("_before") < F.col("_take")) & (F.col("_before") + F.col("_n") >= F.col("_take")))
        narrow = reached.select(*by, "_low", "_high", "_n", (F.col("_take") - F.col("_before")).alias("_take"))
        edges = cut_lineage(edges.where(~open_).unionByName(narrow))
    order = Window.partitionBy(*by).orderBy(F.desc("_v"), *key)
    last = inside(edges).withColumn("_p", F.row_number().over(order)).where(F.col("_p") <= F.col("_take"))
    cut = F.max_by(F.struct(F.col("_v").alias("score"), *key), F.col("_p")).alias("cut")
    return last.groupBy(*by).agg(cut)
