"""Rounding, reproducible sums and unit conversions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
KG_TO_LB = 2.2046226218
KM_TO_MI = 0.621371
SEMICIRCLES_PER_HALF_TURN = 2.0 ** 31

_SPLIT = 134217729.0  # 2**27 + 1, splits a double into two halves
_RADIX = 2.0 ** 20
_LARGE = 2.0 ** 60
LIMBS = ("high", "mid", "low", "bits", "fine")


def round_half_up(c: Column, digits: int) -> Column:
    """Rounding of the SQL reports: half away from zero."""
    return F.round(c, digits)


def round_half_even(c: Column, digits: int = 0) -> Column:
    """Rounding of the record-level reports: nearest, and only true binary ties go to even.

    ``bround`` rounds the printed decimal, so it sends 1.05 to 1.0 although the double lies above
    the tie. Here the rounding error of ``c * 10**digits`` is recovered exactly and settles such
    cases.
    """
    c = c.cast("double")
    if digits == 0:
        return F.rint(c)
    scale = F.lit(float(10 ** digits))
    product = c * scale
    spread = c * F.lit(_SPLIT)
    high = spread - (spread - c)
    low = c - high
    error = (high * scale - product) + low * scale
    floor = F.floor(product).cast("double")
    tie = (product - floor) == F.lit(0.5)
    return (
        F.when(tie & (error > 0), floor + 1)
        .when(tie & (error < 0), floor)
        .otherwise(F.rint(product))
        / scale
    )


def round_to_int(c: Column) -> Column:
    """Nearest integer; a bare cast would truncate 87.52 to 87."""
    return F.rint(c.cast("double")).cast("int")


def exact_parts(c: Column) -> dict[str, Column]:
    """A double in parts whose sums do not depend on order.

    ``high``, ``mid``, ``low`` and ``bits`` are longs of 20 binary digits each, with the sign of the
    value: three before the point, one behind it. ``fine`` is the double that is left, below 2**-20;
    its rounding is far below that of the total. A value of 2**60 or more, infinite or NaN is all
    ``fine``.
    """
    c = c.cast("double")
    plain = F.abs(c) < F.lit(_LARGE)  # false for NaN
    # All steps are exact: powers of two are divided by, and what was split off is taken away.
    high = (c / F.lit(_RADIX * _RADIX)).cast("long")
    below = c - high * F.lit(_RADIX * _RADIX)
    mid = (below / F.lit(_RADIX)).cast("long")
    units = below - mid * F.lit(_RADIX)
    low = units.cast("long")
    scaled = (units - low) * F.lit(_RADIX)
    bits = scaled.cast("long")
    return {
        "high": F.when(plain, high),
        "mid": F.when(plain, mid),
        "low": F.when(plain, low),
        "bits": F.when(plain, bits),
        "fine": F.when(plain, (scaled - bits) / F.lit(_RADIX)).otherwise(c),
    }


def sum_parts(parts: dict[str, Column]) -> dict[str, Column]:
    """Sums over rows: a long holds those of 2**43 rows, some 9e12."""
    return {name: F.sum(part) for name, part in parts.items()}


def sum_sums(sums: dict[str, Column]) -> dict[str, Column]:
    """Sums of earlier sums, in decimals, which hold any number of them."""
    return {name: F.sum(part if name == "fine" else part.cast("decimal(28,0)"))
            for name, part in sums.items()}


def exact_total(sums: dict[str, Column]) -> Column:
    """The double that summed :func:`exact_parts` stand for."""
    def wide(name: str) -> Column:
        return F.coalesce(sums[name].cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))

    radix = F.lit(int(_RADIX)).cast("decimal(38,0)")
    carry = F.call_function("div", wide("bits"), radix)
    whole = (wide("high") * radix + wide("mid")) * radix + wide("low") + carry
    units = whole.cast("double")
    fraction = (wide("bits") - carry * radix).cast("double") / F.lit(_RADIX)
    # What rounding takes away from the larger part goes to the small one. ``units`` is 0 or larger
    # than ``fraction``, so one difference tells it.
    total = units + fraction
    return total + ((fraction - (total - units)) + sums["fine"])


def exact_sum(c: Column) -> Column:
    """Sum of doubles, the same whatever the order in which tasks add.

    Longs are added, which stay in generated code; they are joined once per group. Only what lies
    below 2**-20 is added as doubles. Infinite, NaN and huge values make the sum what a plain sum
    would be.
    """
    return exact_total(sum_parts(exact_parts(c)))


def exact_avg(c: Column) -> Column:
    """Mean of the non-null values on top of :func:`exact_sum`; null for an empty group."""
    return F.try_divide(exact_sum(c), F.count(c))


def m_to_km(c: Column) -> Column:
    return c / F.lit(1000.0)


def mps_to_kmh(c: Column) -> Column:
    return c * F.lit(3.6)


def s_to_min(c: Column) -> Column:
    return c / F.lit(60.0)


def s_to_h(c: Column) -> Column:
    return c / F.lit(3600.0)


def h_to_days(c: Column) -> Column:
    return c / F.lit(24)


def j_to_kj(c: Column) -> Column:
    return c / F.lit(1000)


def kg_to_lb(c: Column) -> Column:
    return c * F.lit(KG_TO_LB)


def km_to_mi(c: Column) -> Column:
    return c * F.lit(KM_TO_MI)


def semicircles_to_degrees(c: Column) -> Column:
    return c * F.lit(180.0 / SEMICIRCLES_PER_HALF_TURN)


def mean_watts(kj: Column, seconds: Column) -> Column:
    """Mean power; null when either input is null or zero."""
    return F.nullif(kj, F.lit(0.0)) * F.lit(1000) / F.nullif(seconds, F.lit(0.0))


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("double"))


def first_non_null(*columns: Column) -> Column:
    return F.coalesce(*columns)
