"""Sums of doubles that do not depend on the order of the rows.

A double is split at fixed places into whole numbers (limbs) of ``WIDTH`` bits. Their sums are sums of longs, which
are the same in any order, combine before a shuffle like any other sum, and work over windows and on streams. One fold per
result carries them into the double that is nearest to the true sum of all rows.

Limbs reach from 2^-118 to 2^102 (about 3e-36 to 5e30). What lies outside, and NaN and infinities, goes to one plain
sum beside them: NaN stays NaN, opposite infinities give NaN, and only sums in which numbers above 5e30 or bits below 3e-36
decide can depend on the order. A limb holds the rows of a group up to 2^41; beyond, the sum of longs raises.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 22
LIMBS = 10
LOWEST = -118
TOP = LOWEST + WIDTH * LIMBS
#: Limbs above the highest that take up carries.
CARRY = 3


def _double(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def parts(value: Column | str) -> list[Column]:
    """The limbs of a double from the lowest, and what is outside of them. All are NULL if they hold nothing."""
    x = _double(value)
    inside = F.abs(x) < F.lit(2.0**TOP)  # NaN is greater than any number
    limbs = [F.when(inside, (x * F.lit(2.0 ** -(LOWEST + WIDTH * i)) % F.lit(2.0**WIDTH)).cast("long")) for i in range(LIMBS)]
    below = x % F.lit(2.0**LOWEST)
    return [*limbs, F.when(~inside, x).when(below != 0, below)]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _carried(limbs: Column) -> Column:
    """Struct of what is carried out at the top (-1 below zero) and limbs of 0 to 2^WIDTH - 1, from the highest."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("limbs"))

    def step(acc: Column, limb: Column) -> Column:
        v = limb + acc["carry"]
        return F.struct(F.shiftright(v, WIDTH).alias("carry"), F.array_prepend(acc["limbs"], v.bitwiseAND(F.lit(2**WIDTH - 1).cast("long"))).alias("limbs"))

    return F.aggregate(limbs, start, step)


def _nearest(high_first: Column) -> Column:
    """The double nearest to non-negative limbs.

    Four limbs from the first that isn't zero make two whole numbers of at most 44 bits, whose sum is rounded once. Anything further
    down only matters as being there, which the last bit says.
    """
    padded = F.concat(high_first, F.array_repeat(F.lit(0).cast("long"), 3))
    first = F.array_position(F.transform(high_first, lambda x: x != 0), True)

    def fold(at: Column) -> Column:
        def limb(i: int) -> Column:
            return F.element_at(padded, (at + i).cast("int"))

        rest = F.exists(F.slice(padded, (at + 4).cast("int"), LIMBS + CARRY), lambda x: x != 0)
        low = F.shiftleft(limb(2), WIDTH) + limb(3)
        low = F.when(rest, low.bitwiseOR(F.lit(1).cast("long"))).otherwise(low)
        high = (F.shiftleft(limb(0), WIDTH) + limb(1)).cast("double") * F.lit(2.0 ** (2 * WIDTH))
        places = F.lit(LIMBS + CARRY) - at - 3
        scaled = (high + low.cast("double")) * F.pow(F.lit(2.0), places * WIDTH + LOWEST)
        return F.when(at == 0, F.lit(0.0)).otherwise(scaled)

    return _let(first, fold)


def fold(sums: list[Column]) -> Column:
    """The sum from the sums of ``parts``; NULL if no row had a value."""
    *limbs, rest = sums
    # a lowest limb is there for every number inside
    whole = F.array(*[F.coalesce(s, F.lit(0).cast("long")) for s in limbs], *[F.lit(0).cast("long")] * CARRY)

    def signed(c: Column) -> Column:
        return F.when(c["l"]["carry"] < 0, -_nearest(_carried(F.transform(c["w"], lambda x: -x))["limbs"])).otherwise(_nearest(c["l"]["limbs"]))

    inside = _let(_let(whole, lambda w: F.struct(w.alias("w"), _carried(w).alias("l"))), signed)
    return F.when(limbs[0].isNull(), rest).when(rest.isNull(), inside).otherwise(inside + rest)


def exact_sum(value: Column | str) -> Column:
    """Sum of doubles, rounded once: the same whatever the order of the rows; NULL if there are none."""
    return fold([F.sum(p) for p in parts(value)])


def exact_avg(value: Column | str) -> Column:
    return F.try_divide(exact_sum(value), F.count(_double(value)))


def partial_sums(value: Column | str, name: str) -> list[Column]:
    """Sums of a first aggregation, of which a second one gets the whole sum (``whole_sum``), still rounded once."""
    return [F.sum(p).alias(f"{name}_{i}") for i, p in enumerate(parts(value))]


def whole_sum(name: str) -> Column:
    return fold([F.sum(f"{name}_{i}") for i in range(LIMBS + 1)])
