"""Exact sums of doubles, guarded division, tolerant equality."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# The tolerances of a result comparison.
REL_TOL = 1e-6
ABS_TOL = 1e-6


# --- sums of doubles that do not depend on the order of rows ---------------------------------------
#
# A value is cut into whole numbers of at most 24 bits, its limbs, worth 2^24, 1, 2^-24, 2^-48 and 2^-72 each. Limbs are
# summed as BIGINT, so partial sums may meet in any order, and a lost and recomputed task gives the same digits. Every
# double below 2^48 that is a multiple of 2^-72 is its limbs exactly, which money and distances are. What limbs cannot
# hold (infinities, NaN, values from 2^48 on, what is left below 2^-72) is summed as a double beside them, so nothing is
# rounded away; only that part depends on the order.

LIMB_BITS = 24
LIMBS = ("l0", "l1", "l2", "l3", "l4")
REST = "rest"
_LARGEST = float(2**48)
_MASK = (1 << LIMB_BITS) - 1


def _scaled(value: Column, limb: int) -> Column:
    """The value in whole units of the given limb, rounded; scaling by a power of two is exact."""
    return F.rint(value * F.lit(2.0 ** (LIMB_BITS * (limb - 1))))


def sum_state(col: Column) -> Column:
    """An aggregate: the exact sum of the non-null values as one struct, to be merged and finished."""
    x = col.cast("double")
    held = F.abs(x) < _LARGEST
    value = F.when(held, x).when(x.isNotNull(), 0.0)
    limbs = [_scaled(value, 0)]
    limbs += [_scaled(value, i) - _scaled(value, i - 1) * float(1 << LIMB_BITS) for i in range(1, len(LIMBS))]
    finest = 2.0 ** (LIMB_BITS * (len(LIMBS) - 2))
    rest = F.when(held, (x * finest - _scaled(x, len(LIMBS) - 1)) / finest).otherwise(x)
    return F.struct(*[F.sum(limb.cast("long")).alias(name) for limb, name in zip(limbs, LIMBS)], F.sum(rest).alias(REST))


def merged_state(state: str, window: WindowSpec | None = None) -> Column:
    """An aggregate, or one over a window: the state over all rows of which column ``state`` holds partial ones."""
    sums = {name: F.sum(F.col(state)[name]) for name in (*LIMBS, REST)}
    return F.struct(*[(total if window is None else total.over(window)).alias(name) for name, total in sums.items()])


def state_value(state: Column) -> Column:
    """The double next to the exact sum; NULL without values, NaN with one, as in a plain sum."""
    l0, l1, l2, l3, l4 = (state[name] for name in LIMBS)
    l3 = l3 + F.shiftright(l4, LIMB_BITS)
    l2 = l2 + F.shiftright(l3, LIMB_BITS)
    whole = l0.cast("double") * float(1 << LIMB_BITS) + (l1 + F.shiftright(l2, LIMB_BITS)).cast("double")
    upper = F.shiftleft(l2.bitwiseAND(F.lit(_MASK)), LIMB_BITS).bitwiseOR(l3.bitwiseAND(F.lit(_MASK)))
    lower = l4.bitwiseAND(F.lit(_MASK)).cast("double") * 2.0**-72
    return whole + (upper.cast("double") * 2.0**-48 + lower) + state[REST]


def exact_sum(col: Column) -> Column:
    return state_value(sum_state(col))


def exact_mean(col: Column) -> Column:
    return safe_divide(exact_sum(col), F.count(col))


def safe_divide(num: Column, den: Column) -> Column:
    """NULL instead of an error when the divisor is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def half_even_int(col: Column) -> Column:
    """A floating value as INT, rounding halves to the even neighbour."""
    return F.rint(col).cast("int")


def code_text(col: Column, type_name: str) -> Column:
    """A code as text; a code stored as a floating number loses its ``.0``."""
    if type_name in ("double", "float"):
        return F.when(col == F.rint(col), col.cast("long").cast("string")).otherwise(col.cast("string"))
    return col.cast("string")


def close_to(a: Column, b: Column) -> Column:
    """Equal within a relative tolerance; two NULLs are equal, and an infinity is close to itself alone."""
    bound = F.greatest(F.lit(REL_TOL) * F.greatest(F.abs(a), F.abs(b)), F.lit(ABS_TOL))
    return a.eqNullSafe(b) | F.coalesce((F.abs(a - b) <= bound) & (bound < float("inf")), F.lit(False))
