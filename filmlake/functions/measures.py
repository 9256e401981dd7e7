"""Sums of doubles that don't depend on the order they are added in, and means of them.

A plain sum of doubles changes in its last bits with the order in which partial results are merged, so a
mean that is rounded and then ranked could change places between two runs, or after a lost executor. Here a
sum is made of whole numbers: a double is a whole number times a power of two, and values of one
power are added exactly. ``bins`` gives each value its power and that number in three parts
of ``PART`` bits, whose sums fit a long for some 10^12 rows; ``total`` puts the sums of a group's powers
together, always in the same order and with the error of each step carried along. The result is
the same bits for any split of the input, and rounded as if it had been added without error; a mean of it
is rounded once. No value is cut.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PART = 20
# a value's whole number is scaled so that it keeps all 53 bits, even if its power is one off
SCALE = 53


def _times_power(value: Column, power: Column) -> Column:
    """``value * 2 ** power`` in two steps, neither of which leaves the range of a double."""
    half = F.floor(power / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def bins(value: Column, name: str) -> list[Column]:
    """Columns ``name_power``, ``name_0`` to ``name_2`` and, for NaN and infinite values, ``name_odd``."""
    value = value.cast("double")
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    finite = F.when(~odd, value)
    power = F.coalesce(F.floor(F.log2(F.abs(finite))), F.lit(0)).cast("int")
    whole = _times_power(finite, F.lit(SCALE) - power).cast("long")
    mask = F.lit((1 << PART) - 1)
    return [
        power.alias(f"{name}_power"),
        whole.bitwiseAND(mask).alias(f"{name}_0"),
        F.shiftright(whole, PART).bitwiseAND(mask).alias(f"{name}_1"),
        F.shiftright(whole, 2 * PART).alias(f"{name}_2"),
        F.when(odd, value).alias(f"{name}_odd"),
    ]


def bin_sums(name: str) -> list[Column]:
    """Sums of ``bins``, to be taken by group and power."""
    return [F.sum(f"{name}_{i}").alias(f"{name}_{i}") for i in (0, 1, 2, "odd")]


def total(name: str) -> Column:
    """The sum of a group, over its powers; NULL when there were no values."""
    def part(row: Column, i: int) -> Column:
        return _times_power(row[f"{name}_{i}"].cast("double"), row[f"{name}_power"] - SCALE + PART * i)

    rows = F.collect_list(F.struct(*(F.col(f"{name}_{i}") for i in ("power", 2, 1, 0))))
    rows = F.filter(F.array_sort(rows), lambda row: row[f"{name}_0"].isNotNull())
    terms = F.flatten(F.transform(F.reverse(rows), lambda row: F.array(*(part(row, i) for i in (2, 1, 0)))))

    def add(sum_: Column, term: Column) -> Column:
        high = sum_["high"] + term
        back = high - sum_["high"]
        lost = (sum_["high"] - (high - back)) + (term - back)
        return F.struct(high.alias("high"), (sum_["low"] + lost).alias("low"))

    start = F.struct(F.lit(0.0).alias("high"), F.lit(0.0).alias("low"))
    exact = F.aggregate(terms, start, add, lambda sum_: sum_["high"] + sum_["low"])
    return F.coalesce(F.sum(f"{name}_odd"), F.when(F.size(rows) > 0, exact))


def mean(sum_: Column | str, count: Column | str) -> Column:
    """A sum by the number of its values; NULL when there are none."""
    return F.try_divide(sum_, count)
