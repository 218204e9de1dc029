"""How one raw column becomes one clean feature."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for a missing category.
MISSING = "MISSING"


def flag(column: str) -> Column:
    """1 for true, 0 for false and for NULL."""
    return F.when(F.col(column).cast("boolean"), 1).otherwise(0).alias(column)


def category(column: str) -> Column:
    """Text, with ``MISSING`` for NULL. Empty text is a value of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING)).alias(column)


def number(column: str) -> Column:
    """Double, with 0 for NULL. NaN stays NaN, which ``na.fill`` would replace."""
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias(column)


def score(column: str) -> Column:
    """Score as float; text that is no number becomes NULL instead of failing the job."""
    return F.col(column).try_cast("float")
