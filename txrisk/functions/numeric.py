"""Exact numeric helpers.

Money is ``DECIMAL(18,2)`` inside the engine.  Ratios that the reports round
(means, rates, percentages) are rounded HALF_UP from the exact rational value
with integer arithmetic, so the result does not depend on floating-point
summation order, on the engine, or on how a double prints.  Only the final
projection turns a value into ``DOUBLE``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT = "decimal(38,0)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _idiv(a: Column, b: Column) -> Column:
    """Integer division (SQL ``div``) of two non-negative exact values."""
    return F.call_function("div", a, b)


def half_up_ratio(num, den, digits: int, num_scale: int = 0) -> Column:
    """``num / den`` rounded HALF_UP (away from zero on ties) to ``digits``
    decimals, returned as DOUBLE; NULL when ``den`` is 0 or NULL.

    ``num`` must hold an exact value with at most ``num_scale`` decimals
    (an integer count: 0; a money sum: 2); ``den`` is an integer.
    """
    num, den = _c(num), _c(den)
    p = (num * (10 ** num_scale)).cast(_INT)
    q = (den.cast(_INT) * (10 ** num_scale)).cast(_INT)
    scale = F.lit(10 ** digits).cast(_INT)
    mag = _idiv((F.abs(p) * 2 * scale + q).cast(_INT), (q * 2).cast(_INT))
    signed = F.when(p < 0, -mag).otherwise(mag)
    return F.when(den.isNull() | (den == 0), F.lit(None).cast("double")).otherwise(
        signed.cast("double") / F.lit(float(10 ** digits)))


def cents(x) -> Column:
    """A money column (decimal or a double holding a 2-decimal value) as
    integer cents."""
    x = _c(x)
    return F.round(x * 100).cast("long")


def money_from_cents(c) -> Column:
    """Integer cents to ``DECIMAL(18,2)``, exactly."""
    return (_c(c).cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def flag(predicate: Column) -> Column:
    """Boolean predicate to an integer 0/1 flag; NULL stays NULL."""
    return predicate.cast("int")


def sample_stddev_cents(n, s1, s2) -> Column:
    """Sample standard deviation, rounded HALF_UP to whole cents and returned
    in currency units (DOUBLE), from exact moments over integer cents:
    ``n`` rows, ``s1`` = sum of cents, ``s2`` = sum of squared cents.
    NULL for fewer than two rows.

    The variance numerator ``n*s2 - s1^2`` is exact; one double division and
    one square root follow, both correctly rounded by IEEE 754.
    """
    n, s1, s2 = _c(n), _c(s1), _c(s2)
    nd = n.cast(_INT)
    num = (nd * s2.cast(_INT) - s1.cast(_INT) * s1.cast(_INT)).cast(_INT)
    den = (nd * (nd - 1)).cast(_INT)
    sd = F.sqrt(num.cast("double") / den.cast("double"))
    return F.when(n > 1, F.floor(sd + F.lit(0.5)).cast("double") / F.lit(100.0))


def decimals_to_double(df):
    """Final projection for reports: every DECIMAL column becomes DOUBLE
    (exact decimal -> nearest double), all other columns unchanged."""
    from pyspark.sql.types import DecimalType

    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])
