"""Numeric and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.constants import MINUTES_PER_DAY  # noqa: E402


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def floor_ratio_at_least_one(col, divisor: int = 20) -> Column:
    """``max(1, floor(x / divisor))`` as bigint (F9: flights from shipments)."""
    return F.greatest(F.lit(1).cast("bigint"), F.floor(_c(col) / F.lit(divisor)).cast("bigint"))


def round_half_even(col, digits: int = 2) -> Column:
    """Banker's rounding of predictions (F13), like ``numpy.round``."""
    return F.bround(_c(col), digits)


def circular_add(base, delta, period: int = MINUTES_PER_DAY) -> Column:
    """``(base + delta) mod period`` with a non-negative result."""
    return F.pmod(_c(base) + _c(delta), F.lit(float(period)))


def circular_diff(a, b, period: int = MINUTES_PER_DAY) -> Column:
    """Signed wrapped difference in ``[-period/2, period/2)``."""
    half = period / 2.0
    return F.pmod(_c(a) - _c(b) + F.lit(half), F.lit(float(period))) - F.lit(half)


def label_index(col, labels) -> Column:
    """Map a label to its position in ``labels``; unknown labels give NULL."""
    pairs = []
    for i, lbl in enumerate(labels):
        pairs.extend([F.lit(lbl), F.lit(i)])
    return F.try_element_at(F.create_map(*pairs), _c(col)) if pairs else F.lit(None).cast("int")


def ordered_bits(col) -> Column:
    """A 64-bit integer in the order of the double ``col``, different for different values (W4, A11): sign,
    exponent and mantissa as IEEE 754 lays them out, negative numbers mirrored. NaN is last; -0.0 equals 0.0."""
    v = _c(col).cast("double")
    size = F.abs(v)
    guess = F.greatest(F.lit(-1022), F.least(F.lit(1023), F.floor(F.log2(F.greatest(size, F.lit(5e-324)))).cast("int")))

    def laid_out(x: Column) -> Column:  # x: size, guess and 2**guess, of which the logarithm may miss by one
        scaled = x["a"] / F.pow(F.lit(2.0), x["e"])
        e = F.when(scaled >= 2, x["e"] + 1).when((scaled < 1) & (x["e"] > -1022), x["e"] - 1).otherwise(x["e"])
        scaled = F.when(scaled >= 2, scaled / 2).when((scaled < 1) & (x["e"] > -1022), scaled * 2).otherwise(scaled)
        whole = F.when(scaled >= 1, (e + 1023).cast("long")).otherwise(F.lit(0).cast("long"))
        part = F.when(scaled >= 1, scaled - 1).otherwise(scaled)
        return F.shiftleft(whole, 52) + (part * F.lit(float(1 << 52))).cast("long")

    finite = F.get(F.transform(F.array(F.struct(size.alias("a"), guess.alias("e"))), laid_out), 0)
    bits = F.when(size == 0, F.lit(0).cast("long")).when(size == float("inf"), F.lit(2047 << 52)).otherwise(finite)
    return F.when(v.isNull(), F.lit(None).cast("long")).when(F.isnan(v), F.lit((1 << 63) - 1)) \
        .when(v < 0, -bits).otherwise(bits)


def normalized_problem_type(kind: str) -> str:
    """binary/multiclass are reported as classification."""
    return "classification" if kind in ("binary", "multiclass") else kind
