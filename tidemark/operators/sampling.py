"""Repeatable samples, folds and control columns.

All randomness is a hash of the row's key, so a retried task or another partitioning gives the same sample. ``draw``
may be replaced by another uniform column in [0, 1).

Exact sample sizes do not need a full sort: the draws are uniform, so a histogram of them tells in which narrow bin the
last sampled row lies, and only the rows of that bin are ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import Md5Draw
from tidemark.functions.scalar import draw as hash_draw
from tidemark.operators.ordering import ranked
from tidemark.operators.sizes import ROWS_PER_TASK, SMALL_ROWS, small_side
from tidemark.session import cut_lineage

Draw = Callable[[Sequence[str], int | Column], Column]
BINS = 4_096
EDGE_ROWS = 500_000


def _mark_smallest(
    df: DataFrame,
    by: Sequence[str],
    draw: str,
    keys: Sequence[str],
    take: Column,
    flag: str,
    bins: int = BINS,
    edge_rows: int = EDGE_ROWS,
) -> DataFrame:
    """Flag the ``take`` rows with the smallest draws of each group; ``take`` may use the group's size ``_rows``.

    The bin that holds the last flagged row is cut into finer bins until it has at most ``edge_rows`` rows.
    """
    by = list(by)
    edges, fine = _edges(df, by, draw, take, bins, None), bins
    while (edges.agg(F.max("_edge_n")).first()[0] or 0) > edge_rows and fine * bins < 2**52:
        rest = _with_edge(df, by, draw, edges, fine).where("_bin = _edge_bin")
        fine *= bins
        edges = _edges(rest, by, draw, take, fine, "_left")

    joined = _with_edge(df, by, draw, edges, fine)
    clear = joined.where(F.col("_bin") != F.col("_edge_bin")).withColumn(flag, F.col("_bin") < F.col("_edge_bin"))
    in_edge = joined.where(F.col("_bin") == F.col("_edge_bin"))
    order = Window.partitionBy(*by).orderBy(draw, *keys)
    ranked_edge = in_edge.withColumn(flag, F.row_number().over(order) <= F.col("_left"))
    return clear.unionByName(ranked_edge).select(*df.columns, flag)


def _edges(df: DataFrame, by: Sequence[str], draw: str, take: Column, bins: int, left: str | None) -> DataFrame:
    """Per group the bin of the last flagged row, how many rows it has and how many of them to take."""
    measures = [F.count(F.lit(1)).alias("_n"), *([F.max(left).alias(left)] if left else [])]
    counts = df.groupBy(*by, F.floor(F.col(draw) * bins).alias("_bin")).agg(*measures)
    # At most one row per bin and group.
    before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(
        "*",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_rows"),
    ).withColumn("_take", F.col(left) if left else take)
    reached = placed.where((F.col("_before") < F.col("_take")) | (F.col("_before") == 0))
    edge = reached.groupBy(*by).agg(F.max(F.struct("_bin", "_before", "_take", "_n")).alias("_edge"))
    return small_side(
        edge.select(
            *[F.col(c).alias(f"_g_{c}") for c in by],
            F.col("_edge._bin").alias("_edge_bin"),
            F.col("_edge._n").alias("_edge_n"),
            (F.col("_edge._take") - F.col("_edge._before")).alias("_left"),
        )
    )


def _with_edge(df: DataFrame, by: Sequence[str], draw: str, edges: DataFrame, bins: int) -> DataFrame:
    binned = df.withColumn("_bin", F.floor(F.col(draw) * bins))
    if by:
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by])
        return binned.join(edges.drop("_edge_n"), same)
    edge = edges.first()
    known = {"_edge_bin": edge["_edge_bin"], "_left": edge["_left"]} if edge else {"_edge_bin": 0, "_left": 0}
    return binned.withColumns({name: F.lit(value) for name, value in known.items()})


def undersample(
    df: DataFrame,
    majority: Column,
    fraction: float,
    keys: Sequence[str],
    seed: int = 0,
    draw: Draw = hash_draw,
) -> DataFrame:
    """All other rows and exactly ``floor(fraction * n)`` of the majority rows."""
    take = F.floor(F.col("_rows") * F.lit(float(fraction)))
    return _sampled_majority(df, majority, take, keys, seed, draw)


def sample_majority(
    df: DataFrame, majority: Column, count: int, keys: Sequence[str], seed: int = 0, draw: Draw = hash_draw
) -> DataFrame:
    """All other rows and exactly ``count`` majority rows (all when there are fewer)."""
    return _sampled_majority(df, majority, F.least(F.lit(count), F.col("_rows")), keys, seed, draw)


def _sampled_majority(df, majority, take, keys, seed, draw):
    many = F.coalesce(majority, F.lit(False))
    drawn = df.where(many).withColumn("_draw", draw(keys, seed))
    kept = _mark_smallest(drawn, [], "_draw", keys, take, "_keep").where("_keep").select(*df.columns)
    return kept.unionByName(df.where(~many))


def undersample_by_draw(
    df: DataFrame, keep: Column, fraction: float, keys: Sequence[str], seed: int = 0, draw: Draw = hash_draw
) -> DataFrame:
    """Rows to keep always, and every other row with probability ``fraction``. A filter: nothing is shuffled."""
    return df.where(F.coalesce(keep, F.lit(False)) | (draw(keys, seed) <= fraction))


def stratified_fold(
    df: DataFrame,
    division: Sequence[int],
    by: Sequence[str],
    keys: Sequence[str],
    seed: int = 0,
    name: str = "fold",
    draw: Draw = hash_draw,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Folds 1, 2, … with the proportions of ``division`` inside every group, e.g. (7, 3) or (1, 1, 1, 1, 1)."""
    pattern = [i + 1 for i, size in enumerate(division) for _ in range(size)]
    placed = ranked(
        df.withColumn("_draw", draw(keys, seed)), by, ["_draw", *keys], position="_p", uniform=True, rows_per_task=rows_per_task
    )
    fold = F.get(F.array(*[F.lit(f) for f in pattern]), ((F.col("_p") - 1) % len(pattern)).cast("int"))
    return placed.withColumn(name, fold).drop("_draw", "_p")


def stratified_share(
    df: DataFrame,
    share: float,
    by: Sequence[str],
    keys: Sequence[str],
    seed: int = 0,
    name: str = "in_share",
    draw: Draw = hash_draw,
) -> DataFrame:
    """Flag exactly ``floor(share * n)`` random rows of every group. Only the rows of one bin are shuffled."""
    take = F.floor(F.col("_rows") * F.lit(float(share)))
    drawn = df.withColumn("_draw", draw(keys, seed))
    return _mark_smallest(drawn, by, "_draw", keys, take, name).drop("_draw")


#: Repeats in one number of the bits.
WORD = 62
#: The window that must hold a cut reaches so many standard deviations of its place to both sides.
DEVIATIONS = 8.0
#: Draws for which a task is worth starting.
DRAWS_PER_TASK = 2_000_000
#: Stands for a draw below the window.
BELOW = float("-inf")


def _drawn(
    df: DataFrame, sizes: DataFrame, same: Column, tasks: int, repeats: int, share: float, keys: Sequence[str], seed: int, draw: Draw, deviations: float
) -> DataFrame:
    """``df`` stored with the bits ``_sure`` of draws below a window around the share and the draws inside it, ``_open``.

    The draws are what costs time, so each is taken once, and the rows are dealt to so many tasks as there are draws for. The text
    of an MD5 draw's keys is written once a row, and hashes are compared with the window; only those inside become numbers.
    """
    spread = F.lit(deviations) * (F.sqrt(F.lit(share * (1 - share)) / F.col("_n")) + 2 / F.col("_n"))
    low, high = F.lit(share) - spread, F.lit(share) + spread
    seeds = F.array(*[F.lit(f"{r}|{seed}") for r in range(1, repeats + 1)])
    if isinstance(draw, Md5Draw):
        # Made before the rows are dealt: behind that it would be made again for each draw.
        texts, low, high, number = df.withColumn("_text", draw.text(keys)), draw.bound(low), draw.bound(high), draw.number
        draws = F.transform(seeds, lambda s: draw.hashed(F.col("_text"), s))
    else:
        texts, number = df, lambda x: x
        draws = F.transform(seeds, lambda s: draw(keys, s))
    ends = sizes.withColumns({"_low": low, "_high": high}).drop("_n", "_take")
    rows = texts.repartition(tasks).join(small_side(ends), same, "left")
    # Draws above the window are null.
    placed = F.transform(draws, lambda x: F.when(x < F.col("_low"), BELOW).when(x < F.col("_high"), number(x)))
    rows = rows.withColumn("_draws", placed)

    def word(first: int) -> Column:
        drawn = F.reverse(F.slice("_draws", first, min(WORD, repeats - first + 1)))
        return F.aggregate(drawn, F.lit(0).cast("long"), lambda a, x: a * 2 + F.when(x == BELOW, 1).otherwise(0))

    sure = F.array(*[word(first) for first in range(1, repeats + 1, WORD)])
    numbered = F.transform("_draws", lambda x, i: F.when(x > BELOW, F.struct((i + 1).alias("_repeat"), x.alias("_draw"))))
    return cut_lineage(rows.select(*df.columns, sure.alias("_sure"), F.filter(numbered, lambda x: x.isNotNull()).alias("_open")))


def _split_cuts(drawn: DataFrame, sizes: DataFrame, same: Column, repeats: int, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(by, _repeat, cut), stored: draw and key of the last row to take, where the window holds it. Only its rows are shuffled."""
    below = drawn.groupBy(*by).agg(*[F.sum(in_split("_sure", r).cast("long")).alias(f"_r{r}") for r in range(1, repeats + 1)])
    below = below.join(small_side(sizes), same)
    per_repeat = F.array(*[F.struct(F.lit(r).alias("_at"), (F.col("_take") - F.col(f"_r{r}")).alias("_left")) for r in range(1, repeats + 1)])
    left = below.select(*[F.col(c).alias(f"_g_{c}") for c in by], F.inline(per_repeat))
    order = Window.partitionBy(*by, "_repeat").orderBy("_draw", *keys)
    inside = drawn.select(*dict.fromkeys([*by, *keys]), F.inline("_open")).withColumn("_p", F.row_number().over(order))
    last = inside.join(small_side(left), same & (F.col("_repeat") == F.col("_at"))).where(F.col("_p") == F.col("_left"))
    return cut_lineage(last.select(*by, "_repeat", F.struct(F.col("_draw").alias("draw"), *keys).alias("cut")))


def repeated_bits(
    df: DataFrame,
    repeats: int,
    share: float,
    by: Sequence[str],
    keys: Sequence[str],
    seed: int = 0,
    name: str = "bits",
    draw: Draw = hash_draw,
) -> DataFrame:
    """Adds one column with ``repeats`` independent stratified splits: bit i of it tells whether the row is in split i + 1.

    Each split holds exactly the ``floor(share * n)`` rows with the smallest draws of every group. The bits are an array of
    numbers with WORD bits each, see ``in_split``. A row's keys should be its own; rows that repeat them share their draws
    and may overrun the cut together.

    A uniform draw's quantile lies close to the share. So rows are stored once with the bits of the draws below a window
    around the share and with the few draws inside, some square root of the group's rows; the cut is the one with the right
    place among these, and only they are compared with it. A window that does not hold it, as may happen with other draws,
    is widened.
    """
    by = list(by)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by]) if by else F.lit(True)
    sizes = small_side(df.groupBy(*[F.col(c).alias(f"_g_{c}") for c in by]).agg(F.count(F.lit(1)).alias("_n")))
    rows = sizes.agg(F.sum("_n")).first()[0] or 0
    tasks = max(1, -(-rows * repeats // DRAWS_PER_TASK))
    sizes = sizes.withColumn("_take", F.floor(F.col("_n") * F.lit(float(share)))).where("_take > 0")
    wanted, deviations = sizes.count() * repeats, DEVIATIONS
    while True:
        drawn = _drawn(df, sizes, same, tasks, repeats, share, keys, seed, draw, deviations)
        cuts = _split_cuts(drawn, sizes, same, repeats, by, keys)
        if cuts.count() == wanted:
            break
        deviations *= 16
    listed = cuts.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_repeat", "cut"))).alias("_cuts"))
    listed = small_side(listed.select(*[F.col(c).alias(f"_g_{c}") for c in by], F.transform("_cuts", lambda x: x["cut"]).alias("_cuts")), SMALL_ROWS // repeats)
    own = F.struct(*keys)

    def taken(x: Column) -> Column:
        cut = F.get("_cuts", x["_repeat"] - 1)
        return (x["_draw"] < cut["draw"]) | ((x["_draw"] == cut["draw"]) & (own <= F.struct(*[cut[k] for k in keys])))

    def word(i: int) -> Column:
        ours = F.filter("_taken", lambda r: F.floor((r - 1) / WORD) == i)
        return F.aggregate(ours, F.get("_sure", F.lit(i)), lambda a, r: a + F.call_function("shiftleft", F.lit(1).cast("long"), (r - 1) % WORD))

    marked = drawn.join(listed, same, "left").withColumn("_taken", F.transform(F.filter("_open", taken), lambda x: x["_repeat"]))
    words = F.array(*[word(i) for i in range(-(-repeats // WORD))])
    return marked.withColumn(name, words).select(*df.columns, name)


def in_split(bits: Column | str, repeat: int) -> Column:
    """Whether a row is in split ``repeat``, from 1, of ``repeated_bits``."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    word, place = divmod(repeat - 1, WORD)
    return F.shiftright(bits[word], place).bitwiseAND(F.lit(1)) == 1


def repeated_splits(
    df: DataFrame,
    repeats: int,
    share: float,
    by: Sequence[str],
    keys: Sequence[str],
    seed: int = 0,
    name: str = "is_public",
    draw: Draw = hash_draw,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The splits of ``repeated_bits`` as one long table: (keys, by, keep, repeat, flag), rows times repeats.

    The long table is made last, from the bits, and is not shuffled. Columns to ``keep`` travel along.
    """
    marked = repeated_bits(df.select(*dict.fromkeys([*keys, *by, *keep])), repeats, share, by, keys, seed, "_bits", draw)
    flags = F.array(*[in_split("_bits", r) for r in range(1, repeats + 1)])
    long = marked.select("*", F.posexplode(flags).alias("_r", name)).withColumn("repeat", F.col("_r") + 1)
    return long.select(*dict.fromkeys([*keys, *by, *keep]), "repeat", name)


def add_canaries(
    df: DataFrame, n: int, keys: Sequence[str], seed: int = 0, prefix: str = "canarito_", draw: Draw = hash_draw
) -> DataFrame:
    """``n`` uniform columns in front of the others."""
    canaries = [draw(keys, seed + i).alias(f"{prefix}{i}") for i in range(1, n + 1)]
    return df.select(*canaries, *df.columns)


def shuffle_together(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    seed: int = 0,
    prefix: str = "canarito_",
    draw: Draw = hash_draw,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Copies of the columns permuted over the rows together: every row gets the values of one other row.

    Rows ordered by key meet rows ordered by the draw at the same position.
    """
    rows = ranked(df, [], list(keys), position="_p", rows_per_task=rows_per_task)
    mixed = ranked(
        df.select(*keys, *columns, draw(keys, seed).alias("_draw")),
        [],
        ["_draw", *keys],
        position="_p",
        uniform=True,
        rows_per_task=rows_per_task,
    ).select("_p", *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    return rows.join(mixed, "_p").drop("_p")


def shuffle_apart(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    seed: int = 0,
    draw: Draw = hash_draw,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The keys with every column permuted on its own, so columns keep their values but lose their relation.

    All columns are permuted in one long table of (column, position, value), then put back side by side.
    """
    values = F.array(
        *[F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)]
    )
    long = df.select(*keys, F.inline(values)).withColumn("_draw", draw([*keys, "column"], seed))
    mixed = ranked(long, ["column"], ["_draw", *keys], position="_p", uniform=True, rows_per_task=rows_per_task)
    side_by_side = mixed.groupBy("_p").agg(
        *[F.max(F.when(F.col("column") == i, F.col("value"))).alias(c) for i, c in enumerate(columns)]
    )
    rows = ranked(df.select(*keys), [], list(keys), position="_p", rows_per_task=rows_per_task)
    return rows.join(side_by_side, "_p").drop("_p")


def contrast_set(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], seed: int = 0, draw: Draw = hash_draw, **options
) -> DataFrame:
    """Real rows labelled 1 and rows with every column shuffled on its own labelled 0."""
    real = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns], F.lit(1).alias("real"))
    mixed = shuffle_apart(df, columns, keys, seed, draw, **options).withColumn("real", F.lit(0))
    return real.unionByName(mixed)


def period_split(df: DataFrame, parts: Mapping[str, Sequence[int]], period: str = "period") -> dict[str, DataFrame]:
    """Train, validation, test and future rows by lists of periods; the filters reach the scan."""
    return {name: df.where(F.col(period).isin(*periods)) for name, periods in parts.items()}


def period_weights(df: DataFrame, weights: Mapping[int, float], period: str = "period", name: str = "w_train") -> DataFrame:
    """Training weight of each period, 1 where none is given."""
    pairs = [F.lit(x) for item in weights.items() for x in (int(item[0]), float(item[1]))]
    return df.withColumn(name, F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(period)), F.lit(1.0)))


def class_weight(label: Column, names: tuple[str, str] = ("BAJA+2", "BAJA+1")) -> Column:
    """Weights that only mark the class, so that a gain metric can read it back."""
    # Marks of the class that pays and of the other churn class.
    return F.when(label == names[0], 1.00002).when(label == names[1], 1.00001).otherwise(1.0)
