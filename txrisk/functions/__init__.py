"""Column-level helpers: exact rounding, money conversion, flags, vectors."""

from txrisk.functions.numeric import (  # noqa: F401
    cents,
    decimals_to_double,
    flag,
    half_up_ratio,
    money_from_cents,
    sample_stddev_cents,
)
from txrisk.functions.vectors import positive_probability  # noqa: F401
