"""ML vector helpers."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def positive_probability(col: str = "probability") -> Column:
    """Class-1 probability out of a classifier's probability vector."""
    return vector_to_array(F.col(col)).getItem(1)
