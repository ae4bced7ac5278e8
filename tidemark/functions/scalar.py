"""Column expressions shared by the operators. All stay inside Spark's generated code."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_index(period: Column) -> Column:
    """Consecutive month number of an integer YYYYMM period."""
    return (F.floor(period / 100) * 12 + period % 100).cast("int")


def month_number(period: Column) -> Column:
    return (period % 100).cast("int")


def month_end(period: Column) -> Column:
    """Last day of an integer YYYYMM period as a date."""
    return F.last_day(F.make_date(F.floor(period / 100).cast("int"), (period % 100).cast("int"), F.lit(1)))


def month_start(period: Column) -> Column:
    """First day of an integer YYYYMM period, read through its text form."""
    return F.to_date(F.concat(period.cast("string"), F.lit("01")), "yyyyMMdd")


def period_of(date: Column) -> Column:
    """Integer YYYYMM period of a date."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def months_between_dates(later: Column, earlier: Column) -> Column:
    """Whole calendar months from ``earlier`` to ``later``, also across years."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def sum_without_null(*parts: Column) -> Column:
    total = F.coalesce(parts[0], F.lit(0))
    for part in parts[1:]:
        total = total + F.coalesce(part, F.lit(0))
    return total


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Ratio that is NULL for a NULL or zero divisor, so no infinity enters the panel."""
    return top / F.nullif(bottom, F.lit(0))


def clip(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Value moved into [low, high]; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def row_mean(names: Sequence[str]) -> Column:
    """Mean over columns, leaving out NULL; NULL when all are NULL."""
    known = sum(F.col(n).isNotNull().cast("int") for n in names)
    return sum_without_null(*[F.col(n).cast("double") for n in names]) / F.nullif(known, F.lit(0))


def row_arg_max(names: Sequence[str]) -> Column:
    """Name of the column with the largest value; the first one wins a tie."""
    best = F.greatest(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0])
    result = F.lit(None).cast("string")
    for name in reversed(names):
        result = F.when(F.col(name) == best, F.lit(name)).otherwise(result)
    return result


def assign_in_order(start: Column, *rules: tuple[Column, Column]) -> Column:
    """Start value overwritten rule by rule: where a condition holds, its value replaces what was there."""
    result = start
    for condition, value in rules:
        result = F.when(condition, value).otherwise(result)
    return result


def scale_outliers(value: Column, above: float, factor: float) -> Column:
    return F.when(value > above, value * factor).otherwise(value)


def draw(keys: Sequence[str], seed: int | Column = 0) -> Column:
    """Repeatable uniform draw in [0, 1) from the row's keys; it does not depend on partitions or retries."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    mixed = F.xxhash64(*[F.col(k) for k in keys], seed)
    return F.shiftrightunsigned(mixed, 11).cast("double") / F.lit(float(2**53))


class Md5Draw:
    """Like ``draw``, from MD5, for draws that another database has to repeat.

    A draw is the first 12 digits of a hash, so hashes have the order of their draws. Many draws of a row can share the text of
    its keys, and be compared as they are: ``hashed(text, seed) < bound(x)`` says the same as ``draw < x``.
    """

    DIGITS = 12

    def __call__(self, keys: Sequence[str], seed: int | Column = 0) -> Column:
        seed = F.lit(seed) if isinstance(seed, int) else seed
        text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], seed.cast("string"))
        return self.number(F.md5(text))

    def text(self, keys: Sequence[str]) -> Column:
        """What a row's keys put before the seed; keys without a value are left out."""
        values = [F.col(k).cast("string") for k in keys]
        return F.when(F.coalesce(*values).isNotNull(), F.concat(F.concat_ws("|", *values), F.lit("|"))).otherwise("")

    def hashed(self, text: Column, seed: Column) -> Column:
        return F.md5(F.concat(text, seed.cast("string")))

    def number(self, hashed: Column) -> Column:
        return F.conv(F.substring(hashed, 1, self.DIGITS), 16, 10).cast("long").cast("double") / F.lit(float(16**self.DIGITS))

    def bound(self, x: Column) -> Column:
        """The digits of the first draw that is not below ``x``."""
        first = F.ceil(F.least(x, F.lit(1.0)) * F.lit(float(16**self.DIGITS)))
        digits = F.lpad(F.lower(F.hex(first)), self.DIGITS, "0")
        # No hash is below an empty text, all are below a letter that is no digit.
        return F.when(first <= 0, "").when(first >= 16**self.DIGITS, "g").otherwise(digits)


md5_draw = Md5Draw()


def erfc(x: Column) -> Column:
    """The complementary error function, to some 14 digits: a series near zero, a continued fraction in the tails."""
    size = F.abs(x)
    squared = size * size
    # The odd double factorials' series, all of whose terms are positive.
    zero = F.struct(F.lit(0.0).alias("sum"), size.alias("term"))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)),
        zero,
        lambda a, n: F.struct((a["sum"] + a["term"]).alias("sum"), (a["term"] * 2 * squared / (2 * n + 1)).alias("term")),
        lambda a: a["sum"],
    )
    near = 1 - F.lit(2 / math.sqrt(math.pi)) * F.exp(-squared) * terms
    fraction = F.aggregate(F.sequence(F.lit(80), F.lit(1)), size, lambda a, n: size + n / F.lit(2.0) / a)
    far = F.exp(-squared) / F.lit(math.sqrt(math.pi)) / fraction
    tail = F.when(size < 2.0, near).otherwise(far)
    return F.when(x < 0, 2 - tail).otherwise(tail)
